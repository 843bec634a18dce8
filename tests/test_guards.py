import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators.intervals import alive_counts, coverage
from tidemark.plans import bars, fundamentals, pit, quality
from tidemark.plans.bars import class_bars
from tidemark.sources import merge, snapshots
from tidemark.streaming import jobs


def test_coverage_counts_overlaps_once(spark, d):
    held = [("a", d("2020-01-01"), d("2020-01-11")), ("a", d("2020-01-03"), d("2020-01-05")), ("a", d("2020-01-09"), d("2020-01-21")), ("a", d("2020-02-01"), None),
            ("b", d("2019-01-01"), d("2019-06-01")), ("x", d("2020-01-01"), None), ("c", d("2020-01-01"), None)]
    lives = [("a", d("2020-01-01"), None), ("b", d("2020-01-01"), d("2020-01-05")), ("c", None, None), ("e", d("2021-01-01"), None)]
    got = coverage(spark.createDataFrame(held, "code string, valid_from date, valid_to date"), spark.createDataFrame(lives, "code string, born date, died date"), "code", "2020-02-11")
    assert {r.code: (r.days_alive, r.days_covered, r.share) for r in got.collect()} == {"a": (41, 30, 30 / 41), "b": (4, 0, 0.0), "c": (None, 0, None), "e": (0, 0, None)}


def test_alive_counts(spark, d):
    lives = spark.createDataFrame([(d("2020-01-01"), d("2020-01-03")), (d("2020-01-02"), None), (None, d("2020-01-02")), (d("2020-01-02"), d("2020-01-02"))], "born date, died date")
    days = spark.createDataFrame([(d(f"20{x}"),) for x in ("19-12-31", "20-01-01", "20-01-02", "20-01-02", "20-01-03", "20-05-05")] + [(None,)], "day date")
    assert [r.n_alive for r in alive_counts(lives, days, "day").orderBy("day").collect()] == [0, 1, 2, 1, 1]


def test_keys_that_do_not_convert_are_refused(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    inc = spark.createDataFrame([("zz", "lost")], "k string, v string")
    with pytest.raises(Exception, match="does not convert"):
        merge.upsert(old, inc, ["k"]).collect()
    good = spark.createDataFrame([(None, "m"), ("2", "b")], "k string, v string")
    assert {tuple(r) for r in merge.upsert(old, good, ["k"]).collect()} == {(1, "a"), (None, "m"), (2, "b")}


def test_a_merge_that_shrinks_is_taken_back(spark):
    root, rows = tempfile.mkdtemp(prefix="tidemark-test-"), "k int, v int"
    spark.createDataFrame([(1, 1), (1, 2), (1, 3)], rows).write.parquet(jobs.version_path(root + "/t", 0))
    spark.createDataFrame([(1, 9)], rows).coalesce(1).write.parquet(root + "/inc")
    with pytest.raises(Exception, match="shrink"):
        jobs.merge_stream(spark.readStream.schema(rows).parquet(root + "/inc"), root + "/t", ["k"], root + "/state").awaitTermination()
    assert jobs.latest_version(spark, root + "/t") == 0


def test_nested_dividend_function(spark, d):
    rows = [("a", d("2019-12-31"), "y", d("2020-01-10"), "p", 5.0, None), ("a", d("2019-12-31"), "y", d("2020-03-01"), "q", 6.0, None), ("a", d("2018-12-31"), "y", d("2019-05-01"), "p", 2.0, d("2020-02-01"))]
    spark.createDataFrame(rows, "code string, report_date date, bonus_type string, visible_date date, plan_progress string, bonus_amount_rmb double, bonus_cancel_pub_date date").createOrReplaceTempView("t_div")
    pit.register_dividends_sql(spark, "t_div")
    got = spark.sql("SELECT w.d, f.bonus_amount_wan_rmb AS s, f.n_plan AS n FROM VALUES (DATE '2020-01-15'), (DATE '2020-03-05'), (DATE '2022-01-01') AS w(d), LATERAL dividend_ttm_on(w.d) f ORDER BY 1")
    assert [(str(r.d), r.s, r.n) for r in got.collect()] == [("2020-01-15", 7.0, 2), ("2020-03-05", 6.0, 1)]


def test_unit_by_third_refuses_ties_and_misfits(spark):
    rows = [("a", 99.0), ("a", 103.0), ("a", 9000.0), ("b", 1.05), ("c", 40.0), ("e", None), ("f", 1.5)]
    got = quality.unit_by_third(spark.createDataFrame(rows, "src string, s double"), ["src"], "s", (1, 100))
    assert {r.src: r.unit for r in got.collect()} == {"a": 100.0, "b": 1.0, "c": None, "f": None}
    tie = quality.unit_by_third(spark.createDataFrame([("t", 4.0)], "src string, s double"), ["src"], "s", (4, 4), 1.0)
    assert [r.unit for r in tie.collect()] == [None]


def test_frozen_partitions(spark, d):
    bars = spark.createDataFrame([("sh1", d("2004-01-05"), 1.0), ("sh1", d("2005-01-05"), 2.0), ("bj1", d("2004-01-05"), 3.0), ("sh1", d("2002-01-05"), 4.0), ("sh2", d("2004-01-05"), 5.0)], "symbol string, date date, close double")
    kinds = spark.createDataFrame([("sh1", "stock"), ("bj1", "stock"), ("sh2", "unknown")], "symbol string, class string")
    now, parts, path = class_bars(bars, kinds), ["class", "year"], tempfile.mkdtemp(prefix="tidemark-test-")
    assert sorted(r.close for r in now.collect()) == [1.0, 2.0]
    snapshots.write_unfrozen(now, path, parts, snapshots.partition_manifest(now.where("false"), parts))
    frozen = snapshots.partition_manifest(now.where("year = 2004"), parts)
    revised = now.withColumn("close", F.when(F.col("year") == 2005, 9.0).otherwise(F.col("close")))
    snapshots.write_unfrozen(revised, path, parts, frozen)
    assert sorted(r.close for r in spark.read.parquet(path).collect()) == [1.0, 9.0]
    twice = revised.unionByName(revised.where("year = 2004"))
    for bad in (revised.withColumn("close", F.lit(7.0)), revised.where("year = 2005"), twice):
        with pytest.raises(ValueError, match="frozen"):
            snapshots.write_unfrozen(bad, path, parts, frozen)
    assert sorted(r.close for r in spark.read.parquet(path).collect()) == [1.0, 9.0]


def test_calendar_rule_that_fails_on_the_past_is_refused(spark):
    days = spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("2024-01-05",)], "date string").select(F.col("date").cast("date"))
    none, thursday = days.where("false"), days.limit(1).select(F.lit("2024-01-04").cast("date").alias("date"))
    until = F.to_date(F.lit("2024-01-09"))
    got = [(str(r.date), r.is_future) for r in bars.verified_extension(days, thursday, until).orderBy("date").collect()]
    assert got == [("2024-01-02", False), ("2024-01-03", False), ("2024-01-05", False), ("2024-01-08", True), ("2024-01-09", True)]
    with pytest.raises(Exception, match="0 trading days it misses, 1 it invents"):
        bars.verified_extension(days, none, until).collect()
    assert bars.verified_extension(none, thursday, until).count() == 0


def test_list_whose_years_do_not_add_up_is_refused(spark):
    raw = spark.createDataFrame([("a\r", "2020-01-01", "x"), ("b", "2021-01-01", None), ("c\r\r", "2021-02-01", "2021-02-30")], "code string, day string, other string")
    year = F.substring("day", 1, 4).cast("int")
    want = lambda rows: spark.createDataFrame(rows, "year int, expected long")
    out = fundamentals.load_list(raw, ["day", "other"], year, want([(2020, 1)]))
    assert [(r.code, str(r.day), r.other, r.year) for r in out.orderBy("code").collect()] == [("a", "2020-01-01", None, 2020), ("b", "2021-01-01", None, 2021), ("c", "2021-02-01", None, 2021)]
    assert fundamentals.carriage_returns(raw).first()[0] == 3 and fundamentals.carriage_returns(raw.limit(0)).first()[0] == 0
    with pytest.raises(Exception, match="2021: 2 rows, 3 expected; 2022: 0 rows, 1 expected"):
        fundamentals.load_list(raw, ["day"], year, want([(2020, 1), (2021, 3), (2022, 1)])).collect()


def test_halt_and_jumps(spark):
    rows = [(s, f"2024-01-{d:02d}", 10.0 * (3.0 if s < "c" and d == 5 else 1.0), 100, 5.0) for s in "abc" for d in range(1, 7)]
    df = spark.createDataFrame(rows, "symbol string, date string, close double, volume long, amount double").withColumn("date", F.col("date").cast("date"))
    assert [(str(r.date), r.n_jumped) for r in quality.mass_jump_days(df, at_least=2).orderBy("date").collect()] == [("2024-01-05", 2), ("2024-01-06", 2)]
    assert [str(x) for x in quality.safe_end(df, quality.mass_jump_days(df, at_least=2)).first()] == ["2024-01-05", "2024-01-04"]
    assert str(quality.safe_end(df, df.limit(0)).first()["safe_end"]) == "2024-01-06"
    kinds = spark.createDataFrame([("a", "stock"), ("b", "index"), ("c", "etf")], "symbol string, class string")
    got = {r.date.day: (r.n, r.n_price, r.halt) for r in quality.halt_verdicts(df, kinds, halt_at={"n_price": 1}).collect()}
    assert got[5] == (2, 1, True) and got[4] == (2, 0, False)
