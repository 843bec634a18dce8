"""Recursive and array factors against literal recurrences; independence of partitioning."""

import datetime
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.recursive import smooth
from tidemark.operators.dedupe import newest_report_per_day
from tidemark.operators.ranking import average_ranks, exact_quantiles, keep_fraction, spearman
from tidemark.plans import catalog, factors, indicators
from tidemark.plans.beta import beta_daily

IDS = [s.id for s in factors.PRICE_VOLUME]


def literal_smooth(x, alpha, n):
    out, avg, w, seeds = [], None, 1.0, 0
    for t in range(len(x)):
        win = x[t - n + 1: t + 1] if t >= n - 1 else []
        full = len(win) == n and not any(np.isnan(win))
        seeds += full
        v = x[t]
        if avg is None:
            avg = float(np.mean(win)) if full else None
        elif np.isnan(v) or seeds < 2:
            w *= 1 - alpha
        else:
            avg, w = (w * (1 - alpha) * avg + alpha * v) / (w * (1 - alpha) + alpha), 1.0
        out.append(np.nan if avg is None else avg)
    return out


@pytest.mark.parametrize("n,gaps", [(5, ()), (5, (12, 13, 20)), (9, (3, 30)), (1, (4,))])
def test_smoother_equals_the_recurrence(n, gaps):
    rng = np.random.default_rng(n)
    x = rng.normal(10, 2, 60)
    x[list(gaps)] = np.nan
    alpha = 2 / (n + 1) if n > 1 else 0.4
    if n == 1:
        want, avg, w = [], None, 1.0
        for v in x:
            if avg is None:
                avg = v
            elif np.isnan(v):
                w *= 1 - alpha
            else:
                avg, w = (w * (1 - alpha) * avg + alpha * v) / (w * (1 - alpha) + alpha), 1.0
            want.append(avg)
    else:
        want = literal_smooth(x, alpha, n)
    np.testing.assert_allclose(smooth(x, alpha, n), want, rtol=1e-12)


@pytest.fixture(scope="module")
def market(spark):
    rng = random.Random(1)
    rows = []
    for code in ("a", "b", "c"):
        p, pc = 100.0, None
        for i in range(300 if code != "c" else 30):
            p = max(5.0, p + rng.choice([-2, -1, 0, 0, 1, 2]))
            hi, lo = p + rng.choice([0, 1, 2]), p - rng.choice([0, 1, 2])
            rows.append((code, datetime.date(2020, 1, 1) + datetime.timedelta(days=i), p, float(100 + rng.randrange(50)), p * 120, None if i % 37 == 5 else 0.5 + rng.random(),
                         p, hi, lo, p - rng.choice([0, 1]) if lo < p else p, None if i % 41 == 7 else pc, 1.0, 1e6, 5e5, 1.2))
            pc = p
    return spark.createDataFrame(rows, "jq_code string, date date, close_hfq double, volume_shares double, amount double, turnover double, close_bfq double, high double, low double, open double, preclose double, hfq_factor double, totalmv double, floatmv double, peg double").cache()


@pytest.fixture(scope="module")
def table(market):
    return factors.factor_daily(market, None, factors.PRICE_VOLUME, dtype=None).toPandas().sort_values(["jq_code", "date"]).reset_index(drop=True)


def test_rolling_factors_against_pandas(market, table):
    m = market.toPandas().sort_values(["jq_code", "date"]).reset_index(drop=True)
    a = m[m.jq_code == "a"].reset_index(drop=True)
    t = table[table.jq_code == "a"].reset_index(drop=True)
    C, V, TO, H, L, PC = a.close_hfq, a.volume_shares, a.turnover, a.high, a.low, a.preclose
    R, TP = C.pct_change(), (a.high + a.low + a.close_hfq) / 3
    want = {
        "ma120": C.rolling(120).mean(), "to_ma60": TO.rolling(60).mean(), "var60": R.rolling(60).var(), "skew60": R.rolling(60).skew(), "kurt120": R.rolling(120).kurt(),
        "std20": R.rolling(20).std(), "boll_up": C.rolling(20).mean() + 2 * C.rolling(20).std(ddof=0), "pvt": (R * V).cumsum(),
        "slope12": C.rolling(12).apply(lambda w: np.polyfit(range(12), w, 1)[0]),
        "cci88": (TP - TP.rolling(88).mean()) / (0.015 * TP.rolling(88).apply(lambda w: np.abs(w - w.mean()).mean())),
        "aroon_up": 100 * (25 - H.rolling(26).apply(lambda w: 25 - np.argmax(w))) / 25, "pos_1y": (C - L.rolling(250).min()) / (H.rolling(250).max() - L.rolling(250).min()),
        "psy12": 100 * (R > 0).astype(float).rolling(12).sum() / 12,
    }
    for k, w in want.items():
        np.testing.assert_allclose(t[k].to_numpy(float), w.to_numpy(float), rtol=1e-7, atol=1e-9, err_msg=k)


def test_recursive_factors(market, table):
    a = market.where("jq_code = 'a'").toPandas().sort_values("date").reset_index(drop=True)
    t = table[table.jq_code == "a"].reset_index(drop=True)
    C, hl = a.close_hfq.to_numpy(), (a.high - a.low).to_numpy()
    ema = lambda x, n: np.array(literal_smooth(x, 2 / (n + 1), n))
    dif = ema(C, 12) - ema(C, 26)
    tr = np.where(np.isnan(a.preclose), np.nan, np.maximum(hl, np.maximum(abs(a.high - a.preclose), abs(a.low - a.preclose))))
    e3 = ema(ema(ema(C, 5), 5), 5)
    e1 = ema(hl, 9)
    import pandas as pd

    want = {"ema20": ema(C, 20), "macd": 2 * (dif - ema(dif, 9)), "atr14": literal_smooth(tr, 1 / 14, 14), "trix5": np.r_[np.nan, e3[1:] / e3[:-1] - 1],
            "mass": pd.Series(e1 / ema(e1, 9)).rolling(25).sum().to_numpy(), "bull_power": a.high.to_numpy() - ema(C, 13)}
    for k, w in want.items():
        np.testing.assert_allclose(t[k].to_numpy(float), np.asarray(w, float), rtol=1e-9, err_msg=k)


def test_short_history_gives_nothing(table):
    c = table[table.jq_code == "c"]
    assert c["ma60"].isna().all() and c["skew20"].notna().sum() == 10 and len(c) == 30


def test_constant_window_shape(spark):
    rows = [("k", datetime.date(2020, 1, 1) + datetime.timedelta(days=i), 10.0, 1.0, 1.0, 1.0, 10.0, 10.0, 10.0, 10.0, 10.0, 1.0) for i in range(70)]
    df = spark.createDataFrame(rows, "jq_code string, date date, close_hfq double, volume_shares double, amount double, turnover double, close_bfq double, high double, low double, open double, preclose double, hfq_factor double")
    specs = [s for s in factors.PRICE_VOLUME if s.id in ("skew60", "kurt60", "var60", "cci10", "wvad")]
    last = factors.factor_daily(df, None, specs, dtype=None).orderBy(F.col("date").desc()).first()
    assert (last.skew60, last.kurt60, last.var60, last.cci10, last.wvad) == (0.0, -3.0, 0.0, None, None)


def test_partitioning_does_not_change_a_bit(spark, market):
    specs = [s for s in factors.PRICE_VOLUME if s.group in ("dist", "vol")]
    first = factors.factor_daily(market, None, specs).toPandas().sort_values(["jq_code", "date"]).reset_index(drop=True)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = factors.factor_daily(market.orderBy(F.rand(5)), None, specs).toPandas().sort_values(["jq_code", "date"]).reset_index(drop=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert first.equals(again)


def test_counts_and_duplicate_ids():
    assert (len(factors.PRICE_VOLUME), len(factors.FINANCIAL), len(factors.ALL)) == (98, 64, 162)
    with pytest.raises(ValueError):
        factors.check_ids([factors.ALL[0], factors.ALL[0]])


def test_catalog(spark, market):
    specs = [s for s in factors.ALL if s.id in ("ma60", "psy12")]
    rows = {r.factor_id: r for r in catalog.factor_catalog(factors.factor_daily(market, None, specs, dtype=None), specs).collect()}
    assert rows["ma60"].n_values == 2 * 241 and rows["ma60"].comparable is False and rows["psy12"].comparable


def test_recursive_indicators(spark, market):
    df = market.select(F.col("jq_code").alias("symbol"), "date", "open", "high", "low", F.col("close_hfq").alias("close"), F.col("volume_shares").cast("long").alias("volume"))
    got = indicators.indicators(df).where("symbol = 'a'").toPandas().sort_values("date").reset_index(drop=True)
    c = got.close
    macd = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    np.testing.assert_allclose(got.ind_macd, macd, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(got.ind_macd_hist, macd - macd.ewm(span=9, adjust=False).mean(), rtol=1e-9, atol=1e-9)
    lo, hi = got.low.rolling(9, min_periods=1).min(), got.high.rolling(9, min_periods=1).max()
    k = ((c - lo) / (hi - lo) * 100).ewm(com=2, adjust=False).mean()
    np.testing.assert_allclose(got.ind_kdj_k.to_numpy(float), k.to_numpy(float), rtol=1e-9)


def test_ranks_and_quantiles_with_a_hot_value(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xy"), 5.0 if rng.random() < 0.4 else float(rng.randrange(50)), float(rng.randrange(20))) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, v double, w double")
    import pandas as pd

    p = pd.DataFrame(rows, columns=["g", "v", "w"])
    q = {r.g: (r.m, r.h) for r in exact_quantiles(df, ["g"], "v", {"m": 0.5, "h": 0.93}).collect()}
    for g, x in p.groupby("g"):
        assert q[g] == pytest.approx((x.v.quantile(0.5), x.v.quantile(0.93)))
    got = sorted((r.v, r.k) for r in average_ranks(df, [], "v", "k").collect())
    assert got == sorted(zip(p.v, p.v.rank()))
    assert spearman(df, "v", "w").first().rank_corr == pytest.approx(p.v.rank().corr(p.w.rank()))


def test_fraction_is_floored_not_ntiled(spark):
    df = spark.createDataFrame([(1, f"c{i}", float(i)) for i in range(7)] + [(2, f"c{i}", 1.0) for i in range(5)], "day int, code string, pb double")
    got = sorted((r.day, r.code) for r in keep_fraction(df, ["day"], "pb", "code", 0.5).collect())
    assert got == [(1, "c0"), (1, "c1"), (1, "c2"), (2, "c0"), (2, "c1")]


def test_long_windows_forget_what_left_them(spark):
    """One huge value and one NaN: windows that do not hold them any more are as if they had never been."""
    rng = np.random.default_rng(3)
    n = 5_000
    r = rng.normal(0, 0.02, n)
    x = r.copy()
    x[100] = 2000.0
    x[150] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"jq_code": "a", "date": pd.date_range("2000-01-01", periods=n).date, "X": x})).withColumn("X", F.when(~F.isnan("X"), F.col("X")))
    ctx = factors.Ctx()
    out = {f"{op}{k}": getattr(ctx, op)("X", k) for op in ("rsum", "var", "skew", "kurt") for k in (20, 60, 120)}
    df = df.withColumn("ord", F.row_number().over(factors.ROLL.base())).withColumns(ctx.windows)
    for k in (60, 120):
        df = factors.merge_blocks(df, k, {f"__block_X_{k}": ("X", ctx.blocks[f"__block_X_{k}"])})
    got = df.select("date", *[v.alias(k) for k, v in out.items()]).orderBy("date").toPandas()
    s = pd.Series(x)
    for k in (20, 60, 120):
        want = {"rsum": s.rolling(k).sum(), "var": s.rolling(k).var(), "skew": s.rolling(k).skew(), "kurt": s.rolling(k).kurt()}
        clean = {"rsum": pd.Series(r).rolling(k).sum(), "var": pd.Series(r).rolling(k).var(), "skew": pd.Series(r).rolling(k).skew(), "kurt": pd.Series(r).rolling(k).kurt()}
        for op in want:
            mine = got[f"{op}{k}"].astype(float).to_numpy()
            assert np.allclose(mine[150 + k :], clean[op].to_numpy()[150 + k :], rtol=1e-7, atol=1e-9)
            assert np.isnan(mine[150 : 150 + k]).all() and np.isnan(mine[: k - 1]).all()
            assert np.allclose(mine[k - 1 : 100], clean[op].to_numpy()[k - 1 : 100], rtol=1e-7, atol=1e-9)


def test_beta_forgets_too(spark):
    rng = np.random.default_rng(4)
    n = 1_000
    m, s = rng.normal(0, 0.01, n), rng.normal(0, 0.02, n)
    dirty = s.copy()
    dirty[50], dirty[60] = 2000.0, np.nan
    days = pd.date_range("2000-01-01", periods=n).date
    bench = spark.createDataFrame(pd.DataFrame({"date": days, "mret": m}))
    one, two = (beta_daily(spark.createDataFrame(pd.DataFrame({"code": "a", "date": days, "sret": x})), bench).orderBy("date").toPandas() for x in (s, dirty))
    for w in (60, 120, 252):
        assert (one[f"beta_{w}"][60 + w :] == two[f"beta_{w}"][60 + w :]).all()


def test_only_what_the_factors_read_is_planned(spark):
    spec = {s.id: s for s in factors.ALL}
    plan = lambda *ids: factors.Plan.of([spec[i] for i in ids], [*factors.DAILY, *factors.STATEMENT])
    assert plan("trix5").base == {"C"} and max(plan("trix5").rounds.values()) == 4 and len(plan("trix5").ctx.smoothers) == 3
    assert plan("close_bfq").rounds == {} and plan("close_bfq").base == {"close_bfq"}
    assert len(plan("macd", "ema12", "ema26").ctx.smoothers) == 3  # the signal line shares both means
    assert plan("mass").base == {"HL"} and plan("curr_ratio").base == {"b_total_current_assets", "b_total_current_liability"}


def test_formulas_nest_windows_and_recursions_both_ways(spark, market):
    """ema(ma(x, 5), 9) / ema(ema(x, 9), 9), a window over a recursion over an expression, and a recursion over a point function."""
    c = F.col
    formulas = {
        "two": lambda x: x.ema(x.ma("C", 5), 9) / x.ema(x.ema("C", 9), 9),
        "over": lambda x: x.rmax(x.ema(c("V") / x.ma("V", 3) - 1, 4), 6),
        "point": lambda x: x.wilder(F.abs(x.shift(c("C") - c("L"), 1)), 7),
        "gaps": lambda x: x.ema(x.ema("TO", 5), 5),
    }
    got = factors.factor_daily(market, None, [factors.Spec(k, "osc", k, "plain", f) for k, f in formulas.items()], dtype=None).toPandas()
    smooth_n = lambda x, n: pd.Series(literal_smooth(np.asarray(x, float), 2 / (n + 1), n))
    for code, m in market.toPandas().sort_values("date").groupby("jq_code"):
        m, g = m.reset_index(drop=True), got[got.jq_code == code].sort_values("date").reset_index(drop=True)
        C, V, L = m.close_hfq, m.volume_shares, m.low * m.hfq_factor
        want = {
            "two": smooth_n(C.rolling(5).mean(), 9) / smooth_n(smooth_n(C, 9), 9),
            "over": smooth_n(V / V.rolling(3).mean() - 1, 4).rolling(6).max(),
            "point": pd.Series(literal_smooth((C - L).shift(1).abs().to_numpy(), 1 / 7, 7)),
            "gaps": smooth_n(smooth_n(m.turnover, 5), 5),
        }
        for k, w in want.items():
            np.testing.assert_allclose(g[k].to_numpy(float), w.to_numpy(float), rtol=1e-9, err_msg=f"{code} {k}")


def test_requirements_are_read_from_the_formulas(spark):
    need = {name: (deps, rows, rec) for name, deps, rows, rec in factors.requirements()}
    assert len(need) == 162
    assert need["ma20"] == (["close_hfq"], 19, False) and need["skew20"] == (["close_hfq"], 20, False)
    assert need["macd"] == (["close_hfq"], 4 * 26 + 4 * 9, True) and need["trix5"] == (["close_hfq"], 61, True)
    assert need["mfi14"] == (["close_hfq", "hfq_factor", "high", "low", "volume_shares"], 14, False)
    assert need["pvt"] == (["close_hfq", "volume_shares"], None, False)
    assert need["ocf_np"][0] == ["t_net_operate_cash_flow", "t_net_profit"] and need["ocf_np"][1] == 0
    with pytest.raises(ValueError, match="operators of Ctx"):
        factors.Plan.of([factors.Spec("x", "osc", "x", "plain", lambda x: F.lag("C").over(factors.ROLL.base()))], factors.DAILY)


def test_scan_refuses_groups_beyond_its_reach(spark, monkeypatch):
    from tidemark.functions import recursive

    monkeypatch.setattr(recursive, "STRIDES", (1, 4))
    monkeypatch.setattr(recursive, "LONGEST", 16)
    df = lambda n: spark.range(n).selectExpr("'a' AS code", "id AS t", "id * 1.0D AS x")
    one = recursive.Smooth("y", "x", 0.5, 1)
    assert recursive.apply_smoothers(df(16), "code", "t", [one], ["x"]).count() == 16
    with pytest.raises(Exception, match="more than 16 rows"):
        recursive.apply_smoothers(df(17), "code", "t", [one], ["x"]).collect()


def test_restated_report_stays_visible_until_the_next_one(spark, d):
    rows = [("a", d("2019-03-31"), d("2019-09-01"), 1.0), ("a", d("2019-06-30"), d("2019-08-20"), 2.0), ("a", d("2019-09-30"), d("2019-10-20"), 3.0), ("a", d("2018-12-31"), d("2019-08-20"), 0.0)]
    got = newest_report_per_day(spark.createDataFrame(rows, "code string, report_date date, pub_date date, v double"))
    assert sorted(r.v for r in got.collect()) == [1.0, 2.0, 3.0]


def test_a_scan_looks_back_as_often_for_many_smoothers_as_for_one(spark):
    from tidemark.functions import recursive

    rng = np.random.default_rng(8)
    rows = pd.DataFrame({"code": np.repeat(["a", "b"], 40), "t": [*range(40)] * 2, "x": rng.normal(10, 2, 80), "z": rng.normal(5, 1, 80)})
    rows.loc[[7, 8, 30, 50], "x"] = np.nan
    many = [recursive.ema(f"y{n}", "x", n) for n in (2, 5, 9)] + [recursive.wilder("w", "z", 4), recursive.ema("d", ("x", "z"), 5), recursive.ewm_first("z", "z", 0.4)]
    out = recursive.apply_smoothers(spark.createDataFrame(rows), "code", "t", many, ["x", "z"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert out._jdf.queryExecution().analyzed().toString().count("windowspecdefinition") < 21 + 7 * len(many) + 7
    got = out.toPandas().sort_values(["code", "t"])
    for s in many:
        for code, m in rows.groupby("code"):
            x = m[s.src] if isinstance(s.src, str) else m[s.src[0]] - m[s.src[1]]
            np.testing.assert_allclose(got[got.code == code][s.out].to_numpy(float), recursive.smooth(x.to_numpy(), s.alpha, s.seed), rtol=1e-9, err_msg=f"{code} {s.out}")


def test_ranges_are_found_by_halving(spark):
    from tidemark.operators.ranking import cumulative_counts

    rng = np.random.default_rng(4)
    rows = pd.DataFrame({"g": rng.integers(0, 3, 500), "v": np.round(rng.normal(0, 3, 500), 1)})
    for ranges in (2, 3, 8, 33):
        acc = cumulative_counts(spark.createDataFrame(rows), ["g"], "v", ranges)
        assert "lambda" not in acc._jdf.queryExecution().analyzed().toString()
        got = {(r.g, r.v): (r.n, r.below) for r in acc.collect()}
        assert got == {(g, v): (int(((rows.g == g) & (rows.v == v)).sum()), int(((rows.g == g) & (rows.v < v)).sum())) for g, v in zip(rows.g, rows.v)}
