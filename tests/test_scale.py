"""What a task holds does not grow with the table, and work that few rows need is not done for all."""

import datetime
import math

from pyspark.sql import functions as F

from tidemark.functions.scalars import round_half
from tidemark.operators.asof import Side, asof_join_many
from tidemark.plans import factors, quality
from tidemark.queries import standin
from tidemark.queries.registry import Inputs
from tidemark.session import ROWS_A_PART, parts_of, spread


def test_parts_follow_the_rows(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts_of(spark, 10) == n and parts_of(spark, 50 * n * ROWS_A_PART + 1) == 50 * n + 1
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("t"), F.lit(2).alias("x"))
    assert spread(df, "k", parts=17).rdd.getNumPartitions() == 17
    right = Side(spark.createDataFrame([(1, 1, 5)], "k long, at int, v int"), "at", {"v": "v"})
    got = asof_join_many(df, ["k"], "t", [right], left_unique=True, parts=19)
    assert got.rdd.getNumPartitions() == 19 and got.where("v = 5").count() == 1 and got.count() == 100


def test_asof_moves_only_what_is_read(spark):
    left = spark.createDataFrame([(1, 5, 1.0, "wide"), (1, 3, 2.0, "wide"), (None, 4, 3.0, "wide"), (1, None, 4.0, None)], "k int, t int, x double, unread string")
    right = Side(spark.createDataFrame([(1, 4, 7), (1, 5, 8), (None, 1, 9)], "k int, at long, v int"), "at", {"v": "v"})
    got = asof_join_many(left, ["k"], "t", [right], left_unique=True, previous={"before": "x"})
    assert got.columns == ["k", "t", "x", "unread", "before", "v"] and dict(got.dtypes)["t"] == "int"
    assert {tuple(r) for r in got.collect()} == {(1, 5, 1.0, "wide", 2.0, 8), (1, 3, 2.0, "wide", 4.0, None), (None, 4, 3.0, "wide", None, None), (1, None, 4.0, None, None, None)}
    plan = got.select("k", "t", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "unread" not in plan[: plan.index("Union")]


def test_rounding_is_that_of_the_decimal_text(spark):
    odd = [0.0, -0.0, -0.3, 0.3, 0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 4503599627370497.5, 4503599627370495.5, 9007199254740993.0, 1e300, -1e300, math.inf, -math.inf, math.nan, None, 1.005, 2.675, 123456.7894999]
    df = spark.createDataFrame([(x / k if x is not None else None,) for x in odd for k in (1, 10, 100, 1000)], "x double")
    for digits in (1, 2, 6):
        scale = F.lit(float(10**digits))
        rows = df.select(round_half(F.col("x"), digits).alias("a"), (F.round(F.col("x") * scale, 0) / scale).alias("b")).collect()
        assert [repr(r.a) for r in rows] == [repr(r.b) for r in rows]
    assert "round(" not in df.select(round_half(F.col("x"), 2))._jdf.queryExecution().optimizedPlan().toString()


def _statement(spark, rows):
    fields = [*(f"b_{x}" for x in factors.BALANCE), *(f"{k}_{x}" for k in "tc" for x in (*factors.INCOME, *factors.CASHFLOW))]
    return spark.createDataFrame(rows, "code string, report_date date, pub_date date, loan double, cash double").select(
        "code", "report_date", "pub_date", *[(F.col("loan") if f == "b_shortterm_loan" else F.col("cash") if f == "b_cash_equivalents" else F.lit(None).cast("double")).alias(f) for f in fields])


def test_factors_of_the_report_are_computed_once_a_report(spark, d):
    market = spark.createDataFrame([("a", d("2020-01-01") + datetime.timedelta(days=i), 10.0 * i) for i in range(4)] + [("b", d("2020-01-02"), 1.0), (None, d("2020-01-03"), 2.0)], "jq_code string, date date, totalmv double")
    market = market.select("*", *[F.lit(1.0).alias(x) for x in ("close_hfq", "volume_shares", "amount", "turnover", "close_bfq", "high", "low", "open", "preclose", "hfq_factor", "floatmv")])
    filed = _statement(spark, [("a", d("2019-12-31"), d("2020-01-02"), 5.0, 2.0), ("a", d("2020-03-31"), d("2020-01-04"), None, 3.04), (None, d("2019-12-31"), d("2020-01-01"), 9.0, 9.0)])
    specs = [s for s in factors.ALL if s.id in ("fin_liab", "net_debt", "cash_ratio", "ttm_ocf_ev", "mv")]
    plan = factors.Plan.of(specs, [*factors.DAILY, *factors.STATEMENT])
    assert sorted(factors.by_report(plan, factors.STATEMENT)) == ["cash_ratio", "fin_liab", "net_debt"]
    for dtype, finish in ((None, lambda x: round_half(x, 1)), ("float", None)):
        got = factors.factor_daily(market, filed, specs, dtype=dtype, finish=finish, parts=3)
        assert {k for _, k in got.dtypes[2:]} == {dtype or "double"}
        rows = {(r.jq_code, r.date.day): (r.fin_liab, r.net_debt, r.cash_ratio, r.mv) for r in got.collect()}
        last = 3.0 if finish else 3.04
        assert rows[("a", 1)] == rows[("b", 2)][:3] + (0.0,) == (0.0, 0.0, None, 0.0)  # no report yet: blanks count as nothing
        assert rows[("a", 2)] == (5.0, 3.0, None, 10.0) and rows[("a", 3)] == (5.0, 3.0, None, 20.0)
        assert rows[("a", 4)][0] == 0.0 and math.isclose(rows[("a", 4)][1], -last, rel_tol=1e-6)
        assert rows[(None, 3)] == (0.0, 0.0, None, 2.0)


def test_allow_list_meets_suspects_only(spark, d):
    days = [d("2020-01-01") + datetime.timedelta(days=i) for i in range(4)]
    rows = [("a", x, 20_000.0, 10.0 if i < 3 else 100_000.0, 1.0) for i, x in enumerate(days)] + [("b", days[0], 20_000.0, 100_000.0, 1.0), (None, days[1], 20_000.0, 100_000.0, 1.0)]
    panel = spark.createDataFrame(rows, "jq_code string, date date, amount double, volume_shares double, low double").select(
        "*", F.lit(1e9).alias("high"), *[F.lit(None).cast(k).alias(c) for c, k in (("ret_1d", "double"), ("fin_pub_date", "date"), ("fin_report_date", "date"), ("listed_days", "long"), ("list_date", "date"), ("limit_rule_ok", "boolean"), ("close_hfq", "double"), ("floatmv", "double"), ("sw_l1_name", "string"))])
    allow = spark.createDataFrame([("b", days[0]), ("b", days[0]), (None, days[1])], "jq_code string, date date")
    for listed, n in ((None, 3.0), (allow, 2.0)):  # a null code is on no list
        got = quality.panel_checks(panel, panel, listed)
        found = {r["check"]: r for r in got.collect()}
        assert len(found) == 12 and found["vwap_below_low"].value == n and not found["vwap_below_low"].ok
        assert found["row_count"].ok and found["duplicate_keys"].ok
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("LeftAnti"):].split("\n")
    assert any("amount" in line and "Filter" in line for line in join[1:4])


def test_grouped_relations_are_dealt_by_their_rows(spark, tmp_path, monkeypatch):
    day = datetime.datetime(1995, 1, 2)
    rows = [(i, i % 5, i % 4 if i % 9 else None, 1, 2.0, 1000.0 + i % 90, 0.05, day + datetime.timedelta(days=i % 50) if i % 11 else None) for i in range(300)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                "l_discount double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr("tidemark.session.ROWS_A_PART", 20)
    r = Inputs(spark, str(tmp_path))
    plain = {n: standin.relation(spark, str(tmp_path), n) for n in ("bars_sk", "basic_daily")}
    assert r("bars_sk").rdd.getNumPartitions() == 15
    for name, want in plain.items():
        got = r(name)
        assert got.dtypes == want.dtypes and got.count() == want.count() > 0
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    r.store("bars_sk")
    assert r("basic_daily").rdd.getNumPartitions() == r.parts("bars_sk") > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert r("basic_daily").exceptAll(plain["basic_daily"]).isEmpty()
