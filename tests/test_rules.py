"""Golden values and edge rules of the composed jobs, on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import maximum, round_half, safe_div, where
from tidemark.operators.dedupe import newest_report_asof
from tidemark.operators.intervals import compress_changes, day_islands, gap_segments, overlaps
from tidemark.plans import bars, corporate, fundamentals, panel, pit
from tidemark.plans.selection import roe_increase
from tidemark.plans.shares import share_asof_rows
from tidemark.operators.asof import asof_join


def test_round_half_is_binary_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (10.075,), (2.5,), (-2.5,)], "x double")
    got = [r[0] for r in df.select(round_half(F.col("x"), 2)).collect()]
    assert got == [1.0, 0.28, 10.07, 2.5, -2.5]  # 0.285 * 100 is 28.499999999999996
    assert [r[0] for r in df.select(round_half(F.col("x"), 0)).collect()][3:] == [3.0, -3.0]


def test_null_rules(spark):
    df = spark.createDataFrame([(1.0, None, 0.0)], "a double, b double, z double")
    r = df.select(maximum(F.col("a"), F.col("b")).alias("m"), safe_div(F.col("a"), F.col("z")).alias("q"), where(F.col("b") > 0, F.lit(1), F.lit(0)).alias("w")).first()
    assert (r.m, r.q, r.w) == (None, None, 0)


def core(spark, d, rows):
    return spark.createDataFrame(
        [(c, d(rd), d(pd), float(np_), float(np_) * 10, e) for c, rd, pd, np_, e in rows],
        "code string, report_date date, pub_date date, net_profit_parent double, revenue double, eps_basic double")


def ratio(spark, d, rows):
    return spark.createDataFrame([(c, d(rd), 1.0, 2.0, 3.0, float(eq)) for c, rd, eq in rows],
                                 "code string, report_date date, roe_parent double, bps double, total_assets double, equities double")


def test_single_quarters_and_ttm(spark, d):
    rows = [("a", "2022-12-31", "2023-04-01", 200.0, 0.5), ("a", "2022-03-31", "2022-04-20", 50.0, 0.1),
            ("a", "2023-03-31", "2023-04-25", 62.14, 0.0095), ("a", "2023-06-30", "2023-08-25", 125.54, -0.07),
            ("a", "2023-09-30", "2023-10-25", 191.53, -0.05), ("a", "2023-12-31", "2024-04-20", 231.89, 0.2)]
    got = {str(r.report_date): r for r in fundamentals.financial_chain(core(spark, d, rows), ratio(spark, d, [("a", "2023-03-31", 9)])).collect()}
    q = [got[f"2023-{x}"].np_q for x in ("03-31", "06-30", "09-30", "12-31")]
    assert q == pytest.approx([62.14, 63.40, 65.99, 40.36])
    assert got["2023-09-30"].eps_q == pytest.approx(0.02)
    assert got["2023-03-31"].np_ttm == pytest.approx(62.14 + 200 - 50)
    assert got["2023-12-31"].np_ttm == pytest.approx(231.89)
    assert got["2023-06-30"].np_ttm is None  # last year's second quarter is missing
    assert got["2022-12-31"].np_q is None  # not continuous
    assert got["2023-06-30"].equities == 9 and got["2023-06-30"].equities_is_stale and not got["2023-03-31"].equities_is_stale


def test_same_day_annual_and_first_quarter(spark, d):
    rows = [("a", "2022-12-31", "2023-04-28", 10, 0.1), ("a", "2023-03-31", "2023-04-28", 3, 0.1), ("a", "2022-09-30", "2023-05-05", 9, 0.1)]
    got = newest_report_asof(core(spark, d, rows)).collect()
    assert [(str(r.pub_date), str(r.report_date)) for r in got] == [("2023-04-28", "2023-03-31")]  # and the late old report is dropped


def test_growth_uses_the_signed_base(spark, d):
    rows = [(f"{y}-12-31", v) for y, v in ((2019, -10.0), (2020, -18.885))]
    df = spark.createDataFrame([("a", d(r), d(r), v, v, v, v) for r, v in rows],
                               "code string, report_date date, pub_date date, revenue double, profit_before_tax double, net_profit_total double, net_profit_parent double")
    got = {str(r.report_date): r.g_npp for r in fundamentals.growth_rates(df).collect()}
    assert got["2020-12-31"] == pytest.approx(0.8885)


def shares(spark, d, rows):
    return spark.createDataFrame([("a", d(c), d(p), why, float(tot), float(tr), b, h) for c, p, why, tot, tr, b, h in rows],
                                 "code string, change_date date, pub_date date, change_reason string, share_total double, share_trade_total double, share_b double, share_h double")


def ask(spark, d, rows, day):
    left = spark.createDataFrame([("a", d(day))], "code string, date date")
    return asof_join(left, share_asof_rows(shares(spark, d, rows)), ["code"], "date", "eff_date", ["float_sh"], left_unique=True).first().float_sh


def test_shares_need_publication_and_effect(spark, d):
    seen = [("2015-10-16", "2015-10-10", "转增", 20000, 16744.3595, None, None), ("2015-12-31", "2016-03-31", "定期报告", 20000, 17000, None, None)]
    assert ask(spark, d, seen, "2015-12-31") == pytest.approx(16744.3595e4)
    later = [("2026-09-30", "2026-09-22", "转增", 20000, 13866, None, None), ("2026-06-30", "2026-08-29", "定期报告", 20000, 10001, None, None)]
    assert ask(spark, d, later, "2026-09-28") == pytest.approx(10001e4)
    assert ask(spark, d, later, "2026-09-30") == pytest.approx(13866e4)


def test_periodic_report_may_not_undercut_an_event(spark, d):
    rows = [("2018-06-13", "2018-06-10", "限售股份上市", 9000, 6025.41, None, None), ("2018-06-30", "2018-08-20", "定期报告", 9000, 4200, None, None)]
    assert ask(spark, d, rows, "2018-09-01") == pytest.approx(6025.41e4)


def test_removed_h_shares_stay_removed(spark, d):
    rows = [("2017-10-31", "2017-10-31", "上市", 23238, 20619, None, 3513.0), ("2022-08-30", "2022-08-30", "股份回购", 19758, 17139, None, None),
            ("2023-06-30", "2023-06-30", "定期报告", 19758, 17139, None, None)]
    assert ask(spark, d, rows, "2022-01-01") == pytest.approx((20619 - 3513) * 1e4)
    assert ask(spark, d, rows, "2022-09-01") == pytest.approx(17139e4)
    assert ask(spark, d, rows, "2023-07-01") == pytest.approx(17139e4)


def test_volume_units(spark):
    rows = [(10.0, 11.0, 100 * 100, 10.5 * 100), (10.0, 11.0, 100 * 10000, 10.5 * 100), (10.0, 11.0, 100, 10.5 * 100), (0.0, 0.0, 100, 5.0)]
    df = spark.createDataFrame([(lo, hi, v, a) for lo, hi, v, a in rows], "low double, high double, volume long, amount double")
    got = [r[0] for r in df.select(bars.volume_divisor(F.col("low"), F.col("high"), F.col("volume"), F.col("amount"))).collect()]
    assert got == [100.0, 10000.0, 1.0, 100.0]


def test_limit_percent(spark, d):
    rows = [("sh688001", "2019-01-01", "ST", 0.2), ("sz300001", "2020-08-24", "ST", 0.2), ("sz300001", "2020-08-23", "ST", 0.05), ("sz300001", "2020-08-23", None, 0.1),
            ("sh600000", "2026-07-05", "*ST", 0.05), ("sh600000", "2026-07-06", "*ST", 0.1), ("sh600000", "2020-01-01", "进入退市整理期", 0.1)]
    df = spark.createDataFrame([(s, d(t), st, w) for s, t, st, w in rows], "s string, t date, st string, w double")
    for r in df.withColumn("got", panel.limit_percent(F.col("s"), F.col("t"), F.col("st"))).collect():
        assert r.got == r.w, r


def test_limit_flags_on_a_one_price_day(spark):
    df = spark.createDataFrame([(10.0, 11.0, 11.0, 11.0, 11.0, 0.1), (None, 11.0, 11.0, 11.0, 11.0, 0.1)], "preclose double, close_bfq double, open double, high double, low double, limit_pct double")
    a, b = panel.limit_columns(df).collect()
    assert a.is_limit_up and a.is_open_limit_up and a.limit_rule_ok and not a.is_limit_down
    assert b.is_limit_up is None and b.limit_rule_ok is None


def test_intervals(spark, d):
    days = spark.createDataFrame([("a", d(x)) for x in ("2020-01-01", "2020-01-02", "2020-01-02", "2020-01-06")], "code string, date date")
    got = sorted((str(r.valid_from), str(r.valid_to)) for r in day_islands(days, "code", "date").collect())
    assert got == [("2020-01-01", "2020-01-03"), ("2020-01-06", "2020-01-07")]
    snaps = spark.createDataFrame([("i", "a", d(x)) for x in ("2020-03-31", "2020-06-30", "2020-12-31", "2021-03-31")] + [("i", "b", d("2020-03-31"))], "ix string, code string, as_of date")
    segs = sorted((r.code, str(r.valid_from), str(r.valid_to), r.is_current) for r in gap_segments(snaps, ["ix", "code"], "as_of", 100).collect())
    assert segs == [("a", "2020-03-31", "2020-06-30", False), ("a", "2020-12-31", "None", True), ("b", "2020-03-31", "2020-03-31", False)]
    ind = spark.createDataFrame([("a", d(x), l1, l2) for x, l1, l2 in (("2020-03-31", "x", None), ("2020-06-30", "x", None), ("2020-09-30", "x", "z"))], "code string, as_of date, l1 string, l2 string")
    got = sorted((str(r.valid_from), str(r.valid_to), r.l2) for r in compress_changes(ind, ["code"], "as_of", ["l1", "l2"]).collect())
    assert got == [("2020-03-31", "2020-09-30", None), ("2020-09-30", "None", "z")]
    iv = spark.createDataFrame([("a", d("2020-01-01"), None), ("a", d("2020-02-01"), d("2020-03-01"))], "code string, valid_from date, valid_to date")
    assert overlaps(iv, ["code"]).count() == 1


def test_ex_right_price(spark, d):
    acts = spark.createDataFrame([("x", "a", d("2020-01-02"), 30.876, 0.0, 0.0, 0.0)], "symbol string, jq_code string, ex_date date, cash_per_share double, split_per_share double, rights_per_share double, rights_price double")
    jumps = spark.createDataFrame([("a", d("2020-01-02"), 1521.5, 1521.5 / 1490.624)], "jq_code string, date date, pc double, ratio double")
    assert corporate.ex_right_errors(acts, jumps).first().error < 1e-9


def test_late_publication_is_not_seen_early(spark, d):
    rows = [("a", "2019-09-30", "2019-10-28", 5, 0.1), ("a", "2019-12-31", "2020-05-29", 9, 0.1), ("b", "2019-12-31", "2019-12-31", 1, 0.1)]
    got = pit.fin_visible_at(core(spark, d, rows), "2020-03-15").collect()
    assert [(r.code, str(r.report_date)) for r in got] == [("a", "2019-09-30")]  # and placeholder dates never count


def test_roe_increase_needs_five_reports(spark, d):
    qs = ["2019-03-31", "2019-06-30", "2019-09-30", "2019-12-31", "2020-03-31"]
    rows = [("a", d(q), d(q), 0.1 * (i + 1)) for i, q in enumerate(qs)] + [("b", d(q), d(q), 0.1) for q in qs[:4]]
    got = roe_increase(spark.createDataFrame(rows, "code string, report_date date, pub_date date, roe double")).collect()
    assert [(r.code, str(r.pub_date)) for r in got] == [("a", "2020-03-31")]
    assert got[0].increase == pytest.approx(4 * 0.5 - 0.4 - 0.3 - 0.2 - 0.1)


def test_a_later_event_changes_the_guard(spark, d):
    """Reverse proof: without the event before it, the periodic row stands."""
    alone = [("2018-06-30", "2018-08-20", "定期报告", 9000, 4200, None, None)]
    assert ask(spark, d, alone, "2018-09-01") == pytest.approx(4200e4)


def test_load_is_refused(spark, d):
    good = spark.createDataFrame([("a", d("2020-03-31"), d("2020-04-30")), ("b", d("2020-03-31"), d("2020-04-30"))], "code string, report_date date, pub_date date")
    assert fundamentals.accepted_filings(good).count() == 2
    for bad in (good.union(good), good.union(spark.createDataFrame([("c", d("2020-03-31"), None)], good.schema))):
        assert not fundamentals.load_faults(bad).first().accepted
        with pytest.raises(Exception, match="duplicate keys"):
            fundamentals.accepted_filings(bad).collect()
