import random

import pytest

from tidemark.operators.asof import Side, asof_join, asof_join_many

LEFT = [("a", "2020-01-05"), ("a", "2020-01-05"), ("a", "2020-03-01"), ("b", "2020-01-01"), ("c", "2020-01-01"), ("a", None)]
RIGHT = [("a", "2020-01-05", 1), ("a", "2020-02-01", 2), ("b", "2020-01-02", 3)]


def frames(spark, d):
    left = spark.createDataFrame([(i, k, d(t)) for i, (k, t) in enumerate(LEFT)], "i int, k string, t date")
    right = spark.createDataFrame([(k, d(t), v) for k, t, v in RIGHT], "k string, t date, v int")
    return left, right


@pytest.mark.parametrize("bucket", [None, "year", "month"])
def test_left_keeps_copies_and_unmatched_rows(spark, d, bucket):
    left, right = frames(spark, d)
    got = {r.i: r.v for r in asof_join(left, right, ["k"], "t", "t", ["v"], bucket=bucket).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: None, 4: None, 5: None}


def test_strict_excludes_equal_times(spark, d):
    left, right = frames(spark, d)
    got = {r.i: r.v for r in asof_join(left, right, ["k"], "t", "t", ["v"], strict=True).collect()}
    assert got == {0: None, 1: None, 2: 2, 3: None, 4: None, 5: None}


def test_inner(spark, d):
    left, right = frames(spark, d)
    assert sorted(r.i for r in asof_join(left, right, ["k"], "t", "t", ["v"], how="inner").collect()) == [0, 1, 2]


@pytest.mark.parametrize("bucket", [None, "month"])
def test_against_brute_force(spark, bucket):
    import datetime

    rng = random.Random(3)
    day = lambda: datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randrange(200))
    # one key owns most rows
    left = [(i, rng.choice(["hot"] * 8 + ["x", "y"]), day()) for i in range(300)]
    right = list({(rng.choice(["hot", "x"]), day()): rng.randrange(1000) for _ in range(60)}.items())
    got = asof_join(
        spark.createDataFrame(left, "i int, k string, t date"),
        spark.createDataFrame([(k, t, v) for (k, t), v in right], "k string, t date, v int"), ["k"], "t", "t", ["v"], bucket=bucket)
    want = {}
    for i, k, t in left:
        seen = [(rt, v) for (rk, rt), v in right if rk == k and rt <= t]
        want[i] = max(seen)[1] if seen else None
    assert {r.i: r.v for r in got.collect()} == want


def test_per_column_carries_each_column_alone(spark, d):
    left = spark.createDataFrame([("a", d("2020-01-10"))], "k string, t date")
    right = spark.createDataFrame([("a", d("2020-01-01"), 1, None), ("a", d("2020-01-05"), None, 2)], "k string, t date, x int, y int")
    whole = asof_join_many(left, ["k"], "t", [Side(right, "t", {"x": "x", "y": "y"})], left_unique=True).first()
    each = asof_join_many(left, ["k"], "t", [Side(right, "t", {"x": "x", "y": "y"}, per_column=True)], left_unique=True).first()
    assert (whole.x, whole.y, each.x, each.y) == (None, 2, 1, 2)


def test_one_exchange_for_many_sides(spark, d):
    left, right = frames(spark, d)
    df = asof_join_many(left.distinct(), ["k"], "t", [Side(right, "t", {f"v{i}": "v"}) for i in range(4)], left_unique=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("bucket", [None, "year"])
def test_null_keys_match_nothing(spark, d, unique, bucket):
    left = spark.createDataFrame([(None, d("2020-01-02"), 1), ("a", d("2020-01-02"), 2)], "k string, t date, v int")
    right = spark.createDataFrame([(None, d("2020-01-01"), 9.0), ("a", d("2019-12-30"), 7.0)], "k string, s date, x double")
    got = asof_join(left, right, ["k"], "t", "s", ["x"], left_unique=unique, bucket=bucket)
    assert sorted((r.v, r.x) for r in got.collect()) == [(1, None), (2, 7.0)]
