"""Smoothers, long windows and beta in one pass over the rows of each code."""

import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import recursive
from tidemark.plans import beta, factors


def days(n):
    return [datetime.date(2000, 1, 1) + datetime.timedelta(days=i) for i in range(n)]


def test_chained_smoothers_are_one_pass_whatever_the_batches(spark):
    """Groups that are cut by batches, a null code, and smoothers that read smoothers and their difference."""
    rng = np.random.default_rng(11)
    rows = pd.concat([pd.DataFrame({"code": c, "t": range(n), "x": rng.normal(10, 3, n)}) for c, n in (("a", 90), ("b", 1), ("c", 7), (None, 40))], ignore_index=True)
    rows.loc[[4, 30, 31, 32, 95, 110], "x"] = np.nan
    many = [recursive.ema("one", "x", 5), recursive.ema("two", "one", 5), recursive.wilder("fast", "x", 3), recursive.ema("signal", ("fast", "one"), 4)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        out = recursive.apply_smoothers(spark.createDataFrame(rows), "code", "t", many, ["x"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and plan.count("Window [") == 1 and "lag(" not in plan
        got = out.toPandas().sort_values("t")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == len(rows)
    for code in ("a", "b", "c", None):
        mine = got[got.code.isna()] if code is None else got[got.code == code]
        x = (rows[rows.code.isna()] if code is None else rows[rows.code == code]).x.to_numpy()
        want = {"one": recursive.smooth(x, 2 / 6, 5), "fast": recursive.smooth(x, 1 / 3, 3)}
        want |= {"two": recursive.smooth(want["one"], 2 / 6, 5), "signal": recursive.smooth(want["fast"] - want["one"], 2 / 5, 4)}
        for k, w in want.items():
            np.testing.assert_allclose(mine[k].to_numpy(float), w, rtol=1e-9, atol=1e-12, err_msg=f"{code} {k}")


def test_all_smoothers_and_long_windows_pass_python_once(spark):
    spec = {s.id: s for s in factors.ALL}
    ids = ["trix5", "macd", "mass", "skew120", "price_div_ma250", "pos_1y", "to_ma60", "ma20"]
    columns = ("close_hfq", "volume_shares", "amount", "turnover", "close_bfq", "high", "low", "open", "preclose", "hfq_factor")
    panel = spark.createDataFrame([("a", d) for d in days(3)], "jq_code string, date date").select("jq_code", "date", *[F.lit(1.0).alias(c) for c in columns])
    out = factors.factor_daily(panel, None, [spec[i] for i in ids], parts=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Sort [") == 2 and plan.count("Exchange hashpartitioning") == 2


def test_long_windows_with_gaps(spark):
    rng = np.random.default_rng(5)
    rows = pd.concat([pd.DataFrame({"jq_code": c, "date": days(n), "X": rng.normal(0, 1, n)}) for c, n in (("a", 200), ("b", 3))], ignore_index=True)
    rows.loc[[20, 150], "X"] = np.nan
    df = spark.createDataFrame(rows).withColumn("X", F.when(~F.isnan("X"), F.col("X")))
    got = factors.merge_blocks(df, 60, {"w": ("X", {"sum", "ends", "m4"})}).select("jq_code", "date", "w.*").toPandas().sort_values("date")
    for code, m in rows.groupby("jq_code"):
        s, g = m.X.reset_index(drop=True), got[got.jq_code == code].reset_index(drop=True)
        w = s.rolling(60, min_periods=1)
        assert g.n.tolist() == w.count().tolist()
        mean = w.mean()
        want = {"sum": w.sum(), "low": w.min(), "high": w.max(), **{f"m{k}": pd.Series([np.nansum((s[max(0, i - 59) : i + 1] - mean[i]) ** k) for i in range(len(s))]) for k in (2, 3, 4)}}
        for k, v in want.items():
            np.testing.assert_allclose(g[k].to_numpy(float), v.to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=f"{code} {k}")


def test_beta_of_frames_with_gaps_and_a_flat_benchmark(spark):
    rng = np.random.default_rng(6)
    n = 130
    m = np.round(rng.normal(0, 0.01, n), 6)
    m[60:80] = 0.1 + 0.2  # frames of 10 rows do not differ in these
    rows = pd.concat([pd.DataFrame({"code": c, "date": days(n)[:k], "sret": rng.normal(0, 0.02, k)}) for c, k in (("a", n), ("b", 4), (None, 60))], ignore_index=True)
    rows.loc[[3, 40, 41, 42, 43, 44, 45, 46, 140], "sret"] = np.nan
    bench = spark.createDataFrame(pd.DataFrame({"date": days(n), "mret": m}))
    out = beta.beta_daily(spark.createDataFrame(rows), bench, {10: 5, 40: 20}, parts=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "regr_slope" not in plan and plan.count("MapInArrow") == 1
    got = out.toPandas()
    assert len(got) == len(rows)
    for code in ("a", "b", None):
        pick = lambda t: (t[t.code.isna()] if code is None else t[t.code == code]).sort_values("date")  # noqa: B023, E731
        s, g = pick(rows).sret.to_numpy(), pick(got)
        for w, least in ((10, 5), (40, 20)):
            for i, have in enumerate(g[f"beta_{w}"].astype(float)):
                x, y = s[max(0, i - w + 1) : i + 1], m[max(0, i - w + 1) : i + 1]
                y, x = y[~np.isnan(x)], x[~np.isnan(x)]
                if len(x) < least or y.min() == y.max():
                    assert np.isnan(have)
                else:
                    np.testing.assert_allclose(have, ((x - x.mean()) * (y - y.mean())).sum() / ((y - y.mean()) ** 2).sum(), atol=6e-7, rtol=1e-9)


def test_ranks_of_many_equal_values_and_repeated_keys(spark, monkeypatch):
    """Against pandas: ties in every range, NaN, a factor without values, keys that come twice and null keys."""
    from tidemark.plans import metrics

    rng = np.random.default_rng(7)
    n = 400
    rows = pd.DataFrame({"jq_code": [f"c{i % 9}" if i % 50 else None for i in range(n)], "date": [days(60)[i // 9] for i in range(n)], "a": np.round(rng.normal(0, 1, n), 2)})
    rows["b"] = rows.a + np.round(rng.normal(0, 0.2, n), 1)
    rows["c"] = np.where(rng.random(n) < 0.7, 0.0, -rows.a)  # most are equal
    rows.loc[::7, "b"], rows["none"], rows["flat"] = np.nan, np.nan, 1.0
    rows.loc[3, "c"] = -0.0
    rows = pd.concat([rows, rows.iloc[:25].assign(a=5.0)], ignore_index=True)
    cols = ["a", "b", "c", "none", "flat"]
    ranks = rows[cols].rank().assign(jq_code=rows.jq_code.fillna("?"), date=rows.date).groupby(["jq_code", "date"])[cols].max()
    want = {}
    for i, x in enumerate(cols):
        for y in cols[i + 1 :]:
            both = ranks[[x, y]].dropna()
            if len(both) and both[x].std() > 0 and both[y].std() > 0:
                want[x, y] = (both[x].corr(both[y]), len(both))
    assert set(want) == {("a", "b"), ("a", "c"), ("b", "c")}
    df = spark.createDataFrame(rows, f"jq_code string, date date, {', '.join(f'{c} double' for c in cols)}").repartition(3)
    for most in (10**6, 40):  # one range, and eleven of them
        monkeypatch.setattr(metrics, "ROWS_A_PART", most)
        out = metrics.rank_duplicate_pairs(df, cols, 0.0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "stack" not in plan
        got = {(r.factor_a, r.factor_b): (r.rank_corr, r.n) for r in out.collect()}
        assert set(got) == set(want)
        for k, (corr, both) in want.items():
            assert got[k][1] == both and abs(got[k][0] - corr) < 1e-9


def test_long_windows_on_repeated_days(spark):
    """A frame that starts on a repeated day counts that day's rows up to its first one; equal values have no moments."""
    day = days(8)
    day[3] = day[2]
    df = spark.createDataFrame(pd.DataFrame({"jq_code": "a", "date": day, "X": 0.1}))
    got = factors.merge_blocks(df, 4, {"w": ("X", {"sum", "m4"})}).withColumn("at", F.row_number().over(factors.ROLL.base())).orderBy("at").select("w.*").toPandas()
    assert got.n.tolist() == [1, 2, 3, 4, 4, 3, 5, 4]
    assert (got[["m2", "m3", "m4"]] == 0.0).all().all()
    np.testing.assert_allclose(got["sum"], 0.1 * got.n, rtol=1e-12)
