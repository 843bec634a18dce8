"""Data-quality checks and technical indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.intervals import alive_counts, coverage, overlaps
from tidemark.plans import catalog, factors, indicators, quality
from tidemark.plans.bars import class_bars
from tidemark.plans.dimensions import industry_intervals, name_intervals
from tidemark.plans.shares import share_asof_rows
from tidemark.operators.asof import asof_join
from tidemark.queries.factor_queries import market, statements
from tidemark.queries.inputs import panel, px
from tidemark.queries import recurrence
from tidemark.queries.registry import part, query, rnd
from tidemark.session import cut_lineage, kept, spread
from tidemark.sources.snapshots import frozen_breaks, partition_manifest


def _rate(c: str) -> str:
    return f"avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END)"


_VWAP = "volume_shares > 0 AND amount > 0 AND low > 0"
_PANEL_CHECKS = [
    ("future_filings", "count(*) FILTER (WHERE fin_pub_date > date)", 0, 0), ("return_outliers", _rate("abs(ret_1d) > 0.45"), None, 0.0001),
    ("vwap_below_low", f"count(*) FILTER (WHERE {_VWAP} AND amount > 10000 AND amount / nullif(volume_shares, 0) < low * 0.99 AND day(date) <> 9)", 0, 0),
    ("vwap_above_high", f"count(*) FILTER (WHERE {_VWAP} AND amount / nullif(volume_shares, 0) > high * 1.01)", None, 500),
    ("codes_before_listing", "count(DISTINCT CASE WHEN listed_days < 0 THEN jq_code END)", 0, 0), ("limit_rule_ok", _rate("limit_rule_ok"), 0.999, None),
    ("close_hfq_null", _rate("close_hfq IS NULL"), None, 0.001), ("floatmv_null", _rate("floatmv IS NULL"), None, 0.02), ("sw_l1_name_null", _rate("sw_l1_name IS NULL"), None, 0.05),
    ("fin_report_date_null", "avg((fin_report_date IS NULL)::INT) FILTER (WHERE list_date IS NOT NULL)", None, 0.02),
]


def _check_sql(rel: str, checks) -> str:
    def b(x):
        return "NULL::DOUBLE" if x is None else f"{x}::DOUBLE"

    rows = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", ({e})::DOUBLE AS value, {b(lo)} AS lo, {b(hi)} AS hi FROM {rel}" for n, e, lo, hi in checks)
    return f"SELECT \"check\", round(value, 6) AS value, lo, hi, value IS NOT NULL AND coalesce(value >= lo, true) AND coalesce(value <= hi, true) AS ok FROM ({rows})"


@query("panel_checks", ["o_panel", "o_px"], _check_sql("o_panel", _PANEL_CHECKS) + """
    UNION ALL SELECT 'row_count', count(*)::DOUBLE, (SELECT count(*) FROM o_px)::DOUBLE, (SELECT count(*) FROM o_px)::DOUBLE, count(*) = (SELECT count(*) FROM o_px) FROM o_panel
    UNION ALL SELECT 'duplicate_keys', count(*)::DOUBLE, 0::DOUBLE, 0::DOUBLE, count(*) = 0 FROM (SELECT 1 FROM o_panel GROUP BY date, jq_code HAVING count(*) > 1)""")
def q_panel_checks(r):
    p = kept(panel(r).select("date", "jq_code", "ret_1d", "amount", "volume_shares", "low", "high", "fin_pub_date", "fin_report_date", "listed_days", "list_date",
                             "limit_rule_ok", "close_hfq", "floatmv", "sw_l1_name"))
    allow = p.where(F.dayofmonth("date") == 9)  # a stand-in for a list of known days
    return quality.panel_checks(p, px(r), allow).withColumn("value", rnd("value"))


@query("identity_checks", ["o_panel"], _check_sql("o_panel", [
    ("annual_ttm", "count(*) FILTER (WHERE month(fin_report_date) = 12 AND abs(np_ttm - net_profit_parent) > 1)", 0, 0),
    ("first_quarter", "count(*) FILTER (WHERE quarter(fin_report_date) = 1 AND abs(np_q - net_profit_parent) > 1)", 0, 0),
    ("np_q_null", "avg((np_q IS NULL)::INT) FILTER (WHERE fin_report_date IS NOT NULL)", None, 0.05)]))
def q_identity(r):
    return quality.identity_checks(panel(r)).withColumn("value", rnd("value"))


@query("valuation_checks", ["o_panel"], _check_sql("(SELECT * FROM o_panel WHERE date >= DATE '1993-01-01')", [
    ("pb_null", _rate("pb IS NULL"), None, 0.1), ("pb_median", "median(pb)", 1.0, 5.0), ("pe_ttm_median", "median(pe_ttm)", 15.0, 60.0), ("roe_ttm_median", "median(roe_ttm)", 0.02, 0.15)]))
def q_valuation(r):
    return quality.valuation_checks(cut_lineage(panel(r).select("date", "pb", "pe_ttm", "roe_ttm")), "1993-01-01").withColumn("value", rnd("value"))


@query("daily_count_checks", ["o_panel"], _check_sql("(SELECT count(*) AS n FROM o_panel GROUP BY date)", [
    ("daily_p05", "quantile_cont(n, 0.05)", 2000, None), ("daily_median", "median(n)", 2500, 6000), ("daily_max", "max(n)", None, 6500)]))
def q_daily_counts(r):
    return quality.daily_count_checks(panel(r), None).withColumn("value", rnd("value"))


_TURN = "turnover > 0 AND public_status IN ('正常上市', 'ST', '*ST')"


@query("turnover_checks", ["o_panel"], _check_sql(f"(SELECT median(turnover) AS m FROM o_panel WHERE {_TURN} GROUP BY year(date))", [("years_too_high", "count(*) FILTER (WHERE m > 1)", 0, 0)])
       + " UNION ALL " + _check_sql(f"(SELECT median(turnover) AS m, count(*) AS n FROM o_panel WHERE {_TURN} AND date >= DATE '1993-01-01' GROUP BY date)", [("days_too_low", "count(*) FILTER (WHERE m < 0.5 AND n > 12)", 0, 0)]))
def q_turnover(r):
    p = kept(panel(r).select("date", "turnover", "public_status"))
    return quality.turnover_checks(p, "1993-01-01", year_most=1, day_least=0.5, day_codes=12).withColumn("value", rnd("value"))


@query("share_truth_checks", ["o_panel", "o_shr"], _check_sql("""(SELECT floatmv / close_bfq AS mine, totalmv / close_bfq AS whole, s.float_sh, s.total_sh
    FROM (SELECT * FROM o_panel WHERE close_bfq > 0 AND floatmv > 0) p ASOF JOIN o_shr s ON s.code = p.jq_code AND s.eff_date <= p.date)""", [
    ("float_agreement", _rate("abs(mine / nullif(float_sh, 0) - 1) < 0.01"), 0.99, None), ("float_understated", _rate("mine < float_sh * 0.9"), None, 0.005),
    ("total_agreement", _rate("whole IS NULL OR abs(whole / nullif(total_sh, 0) - 1) < 0.01"), 0.99, None)]))
def q_share_truth(r):
    p = cut_lineage(panel(r).select("jq_code", "date", "floatmv", "totalmv", "close_bfq"))
    truth = asof_join(p.select("jq_code", "date"), share_asof_rows(r("share_change")).withColumnRenamed("code", "jq_code"), ["jq_code"], "date", "eff_date", ["float_sh", "total_sh"], how="inner", left_unique=True)
    return quality.share_truth_checks(p, truth, None).withColumn("value", rnd("value"))


@query("share_guard_activity", ["o_share_fold"], _check_sql("(SELECT coalesce(periodic AND event > trade, false) AS acts FROM o_share_fold)",
    [("guard_activity", _rate("acts"), 0.04, 0.10)]))
def q_guard(r):
    return quality.guard_activity(r("share_change")).withColumn("value", rnd("value"))


@query("turnover_medians", ["o_fd0"], "SELECT CAST(year(date) AS INTEGER) AS year, round(median(TURN), 6) AS p50, count(TURN) AS n FROM o_fd0 GROUP BY 1")
def q_medians(r):
    return quality.medians_by_year(market(r), "turnover").withColumn("p50", rnd("p50"))


@query("limit_breaches", ["o_panel"], """
    SELECT jq_code, date, round(ret_1d, 6) AS ret_1d, limit_pct FROM (SELECT *, row_number() OVER w AS bar, date - lag(date) OVER w AS gap FROM o_panel WINDOW w AS (PARTITION BY jq_code ORDER BY date))
    WHERE abs(ret_1d) > limit_pct * 1.1 AND limit_pct > 0 AND public_status = '正常上市' AND bar > 5 AND gap <= 5 AND date >= DATE '1993-01-01' AND day(date) <> 9""")
def q_breaches(r):
    p = kept(panel(r).select("jq_code", "date", "ret_1d", "limit_pct", "public_status"))
    return quality.limit_breaches(spread(p, "jq_code", parts=r.parts("bars_sk")), p.where(F.dayofmonth("date") == 9), "1993-01-01").withColumn("ret_1d", rnd("ret_1d"))


@query("mass_move_days", ["bars"], """
    SELECT date, count(*) FILTER (WHERE abs(r) > 0.15) AS n_moved, count(r) AS n FROM (SELECT date, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS r FROM bars) GROUP BY date HAVING count(*) FILTER (WHERE abs(r) > 0.15) >= 2""")
def q_mass(r):
    return quality.mass_move_days(r("bars"), at_least=2, move=0.15)


@query("day_anomalies", ["bars"], """
    SELECT date, count(*) AS n, count(*) FILTER (WHERE pc > 0 AND abs((close / pc - 1) * 100) > 12) AS n_price,
           count(*) FILTER (WHERE volume / nullif(vm, 0) > 3 OR volume / nullif(vm, 0) < 1.0::DOUBLE / 3) AS n_volume, count(*) FILTER (WHERE amount / nullif(am, 0) > 3 OR amount / nullif(am, 0) < 1.0::DOUBLE / 3) AS n_amount
    FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS pc, median(volume) OVER w AS vm, median(amount) OVER w AS am FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) GROUP BY date""")
def q_anomalies(r):
    return quality.day_anomalies(r("bars"), pct=12.0, ratio=3.0)


@query("mass_jump_days", ["bars"], """
    SELECT date, count(*) FILTER (WHERE x > 1.15 OR x < 1 / 1.15::DOUBLE) AS n_jumped, count(x) AS n FROM (SELECT date, CASE WHEN p > 0 THEN close / p END AS x FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS p FROM bars))
    GROUP BY date HAVING count(*) FILTER (WHERE x > 1.15 OR x < 1 / 1.15::DOUBLE) >= 2""")
def q_jumps(r):
    return quality.mass_jump_days(r("bars"), at_least=2, ratio=1.15)


@query("safe_end", ["bars"], """
    WITH bad AS (SELECT min(date) AS first_bad FROM (SELECT date FROM (SELECT date, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS r FROM bars) GROUP BY date HAVING count(*) FILTER (WHERE abs(r) > 0.15) >= 3))
    SELECT first_bad, (SELECT max(date) FROM bars, bad b WHERE b.first_bad IS NULL OR date < b.first_bad) AS safe_end FROM bad""")
def q_safe_end(r):
    return quality.safe_end(r("bars"), quality.mass_move_days(r("bars"), at_least=3, move=0.15))


@query("halt_verdicts", ["bars"], """
    SELECT *, n_price >= 1 OR n_volume >= 3 OR n_amount >= 3 AS halt FROM (
    SELECT date, count(*) AS n, count(*) FILTER (WHERE pc > 0 AND abs((close / pc - 1) * 100) > 12) AS n_price,
           count(*) FILTER (WHERE volume / nullif(vm, 0) > 3 OR volume / nullif(vm, 0) < 1.0::DOUBLE / 3) AS n_volume, count(*) FILTER (WHERE amount / nullif(am, 0) > 3 OR amount / nullif(am, 0) < 1.0::DOUBLE / 3) AS n_amount
    FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS pc, median(volume) OVER w AS vm, median(amount) OVER w AS am FROM bars WHERE right(symbol, 1) <> '7' WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) GROUP BY date)""")
def q_halt(r):
    kinds = r("bars").select("symbol", F.when(F.col("symbol").endswith("7"), "index").otherwise("stock").alias("class")).distinct()
    return quality.halt_verdicts(r("bars"), kinds, halt_at={"n_price": 1, "n_volume": 3, "n_amount": 3}, pct=12.0, ratio=3.0)


@query("scale_guard", ["bars"], """
    SELECT 'scale_ratio' AS "check", median(c2 / close) AS value, 0.2::DOUBLE AS lo, 5.0::DOUBLE AS hi, median(c2 / close) BETWEEN 0.2 AND 5 AS ok FROM (SELECT *, CASE WHEN volume % 3 = 0 THEN close * 8 ELSE close * 2 END AS c2 FROM bars) WHERE date > (SELECT max(date) - 250 FROM bars)""")
def q_scale(r):
    new = r("bars").withColumn("close", F.when(F.col("volume") % 3 == 0, F.col("close") * 8).otherwise(F.col("close") * 2))
    return quality.scale_guard(r("bars"), new)


@query("two_source_reconciliation", ["fin_core", "express"], """
    SELECT round(median(r), 6) AS median_ratio, count(*) AS n, round(avg(CASE WHEN abs(r - 1) <= 0.01 THEN 1.0 ELSE 0.0 END), 6) AS share_close FROM (
      SELECT c.net_profit_parent / nullif(e.net_profit_parent, 0) AS r FROM fin_core c JOIN (SELECT code, report_date, max(net_profit) AS net_profit_parent FROM express GROUP BY ALL) e USING (code, report_date)) WHERE r IS NOT NULL""")
def q_reconcile(r):
    e = r("express").groupBy("code", "report_date").agg(F.max("net_profit").alias("net_profit_parent"))
    return quality.reconcile(r("fin_core"), e, ["code", "report_date"], "net_profit_parent").select(rnd("median_ratio").alias("median_ratio"), "n", rnd("share_close").alias("share_close"))


@query("interval_overlaps", ["o_names", "o_industry"], """
    WITH s AS (SELECT code, valid_from, coalesce(valid_to, DATE '9999-12-31') + CASE WHEN valid_to IS NULL THEN 0 ELSE 40 END AS valid_to FROM o_names)
    SELECT code, valid_from FROM (SELECT *, lag(valid_to) OVER (PARTITION BY code ORDER BY valid_from) AS pe FROM s) WHERE pe > valid_from""")
def q_overlaps(r):
    stretched = name_intervals(r("name_history")).select("code", "valid_from", F.date_add("valid_to", 40).alias("valid_to"))
    return overlaps(stretched, ["code"]).select("code", "valid_from")


@query("layer_watermarks", ["bars", "fin_core", "universe"], """
    SELECT 'bars' AS layer, max(date) AS newest, count(*) AS n FROM bars UNION ALL SELECT 'fin_core', max(pub_date), count(*) FROM fin_core UNION ALL SELECT 'universe', max(list_date), count(*) FROM universe""")
def q_watermarks(r):
    return quality.layer_watermarks({"bars": (r("bars"), "date"), "fin_core": (r("fin_core"), "pub_date"), "universe": (r("universe"), "list_date")})


@query("freshness", ["bars", "fin_core", "calendar_days"], """
    SELECT layer, newest, (SELECT count(*) FROM calendar_days WHERE date > newest AND date <= DATE '2002-01-01') AS lag_trading_days, CAST(DATE '2002-01-01' - newest AS INTEGER) AS lag_days
    FROM (SELECT 'bars' AS layer, max(date) AS newest FROM bars UNION ALL SELECT 'fin_core', max(report_date) FROM fin_core)""")
def q_fresh(r):
    return quality.freshness(r("calendar_days"), {"bars": (r("bars"), "date"), "fin_core": (r("fin_core"), "report_date")}, "2002-01-01")


@query("complete_days", ["bars"], """
    SELECT date, n, lag(n) OVER (ORDER BY date) AS n_prev, coalesce(n >= lag(n) OVER (ORDER BY date) * 0.95, true) AS complete FROM (SELECT date, count(*) AS n FROM bars GROUP BY date)""")
def q_complete(r):
    return quality.complete_days(r("bars"))


@query("lost_or_filtered", ["filings", "fin_core"], """
    SELECT count(*) FILTER (WHERE NOT ((sk + q + y) % 17 <> 0)) AS n_filtered, count(*) FILTER (WHERE (sk + q + y) % 17 <> 0) AS n_lost FROM filings f
    WHERE NOT EXISTS (SELECT 1 FROM fin_core c WHERE c.code = f.code AND c.report_date = f.report_date)""")
def q_lost(r):
    return quality.lost_or_filtered(r("filings"), r("fin_core"), ["code", "report_date"], (F.col("sk") + F.col("q") + F.col("y")) % 17 != 0)


@query("table_equality", ["bars"], """
    SELECT column_name, count(*) AS rows_a, count(v) AS n_a, min(v) AS lo_a, max(v) AS hi_a, count(*) AS rows_b, count(w) AS n_b, min(w) AS lo_b, max(w) AS hi_b,
           count(v) = count(w) AND abs(min(v) - min(w)) <= 1e-9 AND abs(max(v) - max(w)) <= 1e-9 AS equal FROM (
      SELECT 'close' AS column_name, close AS v, close AS w FROM bars UNION ALL SELECT 'amount', amount, CASE WHEN amount = (SELECT max(amount) FROM bars) THEN NULL ELSE amount END FROM bars) GROUP BY 1""")
def q_equality(r):
    b = r("bars")
    top = b.agg(F.max("amount").alias("__top"))
    changed = b.crossJoin(F.broadcast(top)).withColumn("amount", F.when(F.col("amount") < F.col("__top"), F.col("amount")))
    return quality.table_equality(b, changed, ["close", "amount"])


@query("recomputation_differences", ["bars"], """
    SELECT 'close' AS column_name, 0::BIGINT AS n_different UNION ALL SELECT 'amount', count(*) FILTER (WHERE volume % 5 = 0) FROM bars""")
def q_differences(r):
    changed = r("bars").withColumn("amount", F.when(F.col("volume") % 5 == 0, F.col("amount") + 1).otherwise(F.col("amount")))
    return quality.differing_rows(r("bars"), changed, ["symbol", "date"], ["close", "amount"])


@query("baseline_check", ["bars", "fin_core"], """
    SELECT 'bars' AS item, 'count' AS kind, 10.0::DOUBLE AS base, count(*)::DOUBLE AS value, count(*) >= 10 AS ok FROM bars
    UNION ALL SELECT 'max_high', 'value', 119.0, max(high), max(high) = 119 FROM bars UNION ALL SELECT 'fin_core', 'count', 1e9, count(*), count(*) >= 1e9 FROM fin_core""")
def q_baseline(r):
    base = r.spark.createDataFrame([("bars", "count", 10.0), ("max_high", "value", 119.0), ("fin_core", "count", 1e9)], "item string, kind string, value double")
    now = r("bars").agg(F.count("*").cast("double").alias("bars"), F.max("high").alias("max_high")).unpivot([], ["bars", "max_high"], "item", "value").unionByName(
        r("fin_core").agg(F.count("*").cast("double").alias("value")).withColumn("item", F.lit("fin_core")))
    return quality.baseline_check(now, base)


# --- catalogue -------------------------------------------------------------------------------------------
_CAT = ("bias20", "roc20", "to_ma20", "psy12", "price_div_ma20")
_META = {s.id: s for s in factors.ALL}


@query("factor_catalog", ["o_trial"], " UNION ALL ".join(f"""
    SELECT '{i}' AS factor_id, '{_META[i].group}' AS "group", '{_META[i].formula}' AS formula, '{_META[i].unit}' AS unit, {_META[i].comparable} AS comparable,
           count({i}) AS n_values, round(count({i}) / count(*), 6) AS coverage, round(min({i}), 6) AS lo, round(max({i}), 6) AS hi,
           (SELECT CAST(y AS INTEGER) FROM (SELECT year(date) AS y, count({i}) / count(*) AS c FROM o_trial GROUP BY 1) ORDER BY c, y LIMIT 1) AS worst_year FROM o_trial""" for i in _CAT))
def q_catalog(r):
    table = factors.factor_daily(market(r), None, [_META[i] for i in _CAT], dtype=None, parts=r.parts("bars_sk"))
    df = catalog.factor_catalog(table, [_META[i] for i in _CAT])
    return df.withColumns({x: rnd(x) for x in ("coverage", "lo", "hi")})


@query("factor_daily_all")
def q_factor_daily(r):
    """The whole table from the panel: 162 factors as 32-bit floats."""
    return factors.factor_daily(panel(r), statements(r), parts=r.parts("bars_sk"))


# --- technical indicators ----------------------------------------------------------------------------------
def _w(n: int, end: str = "CURRENT ROW") -> str:
    return f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND {end})"


def _m(x: str, n: int, fn: str = "avg") -> str:
    return f"(CASE WHEN count({x}) OVER {_w(n)} = {n} THEN {fn}({x}) OVER {_w(n)} END)"


part("o_ind0", ["bars"], """
    SELECT *, (high + low + close) / 3.0 AS tp, row_number() OVER w AS rn, lag(close) OVER w AS pc, lag(high) OVER w AS ph, lag(low) OVER w AS pl FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)""")
part("o_ind1", ["o_ind0"], """
    SELECT *, close / pc - 1 AS ret, CASE WHEN close > pc THEN close - pc ELSE 0.0 END AS gain, CASE WHEN close < pc THEN pc - close ELSE 0.0 END AS loss,
           greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, CASE WHEN high - ph > pl - low THEN greatest(high - ph, 0) ELSE 0.0 END AS pdm, CASE WHEN pl - low > high - ph THEN greatest(pl - low, 0) ELSE 0.0 END AS mdm
    FROM o_ind0""")


def _rsi(n: int) -> str:
    g, l = _m("gain", n), _m("loss", n)
    return f"CASE WHEN {l} > 0 THEN 100 - 100 / (1 + {g} / {l}) WHEN {g} > 0 THEN 100.0 END"


def _ret(n: int) -> str:
    return f"(close - lag(close, {n}) OVER (PARTITION BY symbol ORDER BY date)) / lag(close, {n}) OVER (PARTITION BY symbol ORDER BY date) * 100"


_UP = "OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)"
IND = {
    **{f"ind_ma{n}": _m("close", n) for n in indicators.MA_DAYS}, **{f"ind_rsi{n}": _rsi(n) for n in (6, 14, 24)},
    "ind_boll_mid": _m("close", 20), "ind_boll_up": f"{_m('close', 20)} + 2 * {_m('close', 20, 'stddev_samp')}", "ind_boll_dn": f"{_m('close', 20)} - 2 * {_m('close', 20, 'stddev_samp')}",
    "ind_atr": _m("tr", 14), "ind_obv": f"sum(coalesce(sign(close - pc) * volume, 0)) {_UP}", "ind_vwap": f"(sum((high + low + close) * volume) {_UP}) / 3.0::DOUBLE / (sum(volume) {_UP})",
    **{f"ind_cci{n}": f"(tp - {_m('tp', n)}) / nullif(0.015 * list_avg(list_transform(list(tp) OVER {_w(n)}, lambda v: abs(v - {_m('tp', n)}))), 0)" for n in (10, 20)},
    "ind_roc12": _ret(12), "ind_wr": f"({_m('high', 14, 'max')} - close) / nullif({_m('high', 14, 'max')} - {_m('low', 14, 'min')}, 0) * -100",
    "ind_pdi": f"{_m('pdm', 14)} / nullif({_m('tr', 14)}, 0) * 100", "ind_mdi": f"{_m('mdm', 14)} / nullif({_m('tr', 14)}, 0) * 100",
    **{f"ind_bias{n}": f"(close - {_m('close', n)}) / {_m('close', n)} * 100" for n in (6, 20, 60)},
    **{f"ind_vol{n}": f"{_m('ret', n, 'stddev_samp')} * sqrt(252) * 100" for n in (20, 60)}, **{f"ind_ret{n}": _ret(n) for n in (5, 10, 20, 60)},
    **{f"ind_dd{n}": f"(close - max(close) OVER {_w(n)}) / (max(close) OVER {_w(n)}) * 100" for n in (20, 60)},
    "ind_high20": f"max(high) OVER {_w(21, '1 PRECEDING')}", **{f"ind_vma{n}": _m("volume", n) for n in (5, 10, 20)},
}


@query("indicators_native", ["o_ind1"], f"""
    SELECT symbol, date, {", ".join(f"round({x}, {6 if x == 'ind_vwap' else 4}) AS {x}" for x in IND)}, round(CASE WHEN count(dx) OVER {_w(14)} = 14 THEN avg(dx) OVER {_w(14)} END, 4) AS ind_adx, round(ind_high20 - 3 * ind_atr, 4) AS ind_trailing_stop
    FROM (SELECT *, abs(ind_pdi - ind_mdi) / nullif(ind_pdi + ind_mdi, 0) * 100 AS dx FROM (SELECT symbol, date, {", ".join(f"{e} AS {x}" for x, e in IND.items())} FROM o_ind1))""")
def q_indicators(r):
    df = indicators.native_indicators(r("bars"))
    cols = [x for x in df.columns if x.startswith("ind_")]
    return df.select("symbol", "date", *[rnd(x, 6 if x == "ind_vwap" else 4).alias(x) for x in cols])


_RSV = "PARTITION BY symbol ORDER BY date ROWS BETWEEN 8 PRECEDING AND CURRENT ROW"
_EWM = {
    **{f"e{n}": ("b.close", 1, f"(2.0::DOUBLE / {n + 1})") for n in indicators.EMA_DAYS}, "signal": ("new_e12 - new_e26", 1, "(2.0::DOUBLE / 10)"),
    "k": ("b.rsv", 1, "(1.0::DOUBLE / 3)"), "d": ("new_k", 1, "(1.0::DOUBLE / 3)"),
}


@query("indicators_recursive", ["bars"], f"""WITH RECURSIVE own AS (SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn,
      (close - min(low) OVER ({_RSV})) / nullif(max(high) OVER ({_RSV}) - min(low) OVER ({_RSV}), 0) * 100 AS rsv FROM bars),
    {recurrence.states("own", "symbol", _EWM)}
    SELECT symbol, date, {", ".join(f"round(e{n}, 5) AS ind_ema{n}" for n in indicators.EMA_DAYS)}, round(e12 - e26, 5) AS ind_macd, round(signal, 5) AS ind_macd_signal,
      round(e12 - e26 - signal, 5) AS ind_macd_hist, round(k, 5) AS ind_kdj_k, round(d, 5) AS ind_kdj_d, round(3 * k - 2 * d, 5) AS ind_kdj_j
    FROM state JOIN own USING (symbol, rn)""")
def q_indicators_recursive(r):
    df = indicators.indicators(r("bars"))
    return df.select("symbol", "date", *[rnd(x, 5).alias(x) for x in df.columns if x.startswith(("ind_ema", "ind_macd", "ind_kdj"))])


@query("industry_coverage", ["o_industry", "universe"], """
    WITH held AS (SELECT u.code, unnest(generate_series(greatest(i.valid_from, list_date), least(coalesce(i.valid_to, DATE '1999-01-01'), coalesce(delist_date, DATE '1999-01-01'), DATE '1999-01-01') - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
      FROM o_industry i JOIN universe u ON u.code = i.code),
    days AS (SELECT code, count(DISTINCT d) AS n FROM held GROUP BY code)
    SELECT u.code, greatest(date_diff('day', list_date, least(coalesce(delist_date, DATE '1999-01-01'), DATE '1999-01-01')), 0) AS days_alive, coalesce(days.n, 0) AS days_covered,
           round(CASE WHEN date_diff('day', list_date, least(coalesce(delist_date, DATE '1999-01-01'), DATE '1999-01-01')) > 0
                 THEN coalesce(days.n, 0) / date_diff('day', list_date, least(coalesce(delist_date, DATE '1999-01-01'), DATE '1999-01-01')) END, 6) AS share
    FROM (FROM universe WHERE list_date IS NOT NULL) u LEFT JOIN days ON days.code = u.code""")
def q_industry_coverage(r):
    lives = r("universe").where("list_date is not null").select("code", F.col("list_date").alias("born"), F.col("delist_date").alias("died"))
    return coverage(industry_intervals(r("industry_snapshot")), lives, "code", "1999-01-01").withColumn("share", rnd("share"))


@query("survivor_counts", ["months", "universe"], """
    SELECT as_of, (SELECT count(*) FROM universe WHERE list_date <= as_of AND (delist_date IS NULL OR delist_date > as_of)) AS n_alive FROM months""")
def q_survivors(r):
    """Codes alive at every month end, those that are gone by now included."""
    lives = r("universe").select(F.col("list_date").alias("born"), F.col("delist_date").alias("died"))
    return alive_counts(lives, r("months"), "as_of")


@query("volume_units", ["bars"], """
    SELECT symbol, year, count(*) AS n, round(median(s), 6) AS "median", CASE WHEN abs(median(s) - 1) <= 0.15 THEN 1.0::DOUBLE WHEN abs(median(s) / 100 - 1) <= 0.15 THEN 100.0::DOUBLE WHEN abs(median(s) / 10000 - 1) <= 0.15 THEN 10000.0::DOUBLE END AS unit
    FROM (SELECT symbol, CAST(year(date) AS INTEGER) AS year, volume / (amount / close) AS s FROM bars) GROUP BY symbol, year""")
def q_volume_units(r):
    """Whether a symbol's volumes are shares, lots or ten thousands, told by amount and price."""
    rows = r("bars").select("symbol", F.year("date").alias("year"), (F.col("volume") / (F.col("amount") / F.col("close"))).alias("s"))
    return quality.unit_by_third(rows, ["symbol", "year"], "s", (1, 100, 10000)).withColumn("median", rnd("median"))


@query("frozen_breaks", ["bars", "symbol_class"], """
    SELECT DISTINCT class, CAST(year(date) AS INTEGER) AS year, CASE WHEN class = 'etf' THEN 'lost' ELSE 'changed' END AS change FROM bars JOIN symbol_class USING (symbol)
    WHERE date >= DATE '1993-01-01' AND symbol NOT LIKE 'bj%' AND ((class = 'etf' AND year(date) = 1996) OR (class = 'stock' AND year(date) IN (1995, 1997)))""")
def q_frozen_breaks(r):
    """All classes and years are frozen; then an ETF year is lost, a year of stocks is revised, another holds rows twice."""
    now = class_bars(r("bars"), r("symbol_class"), "1993-01-01")
    stock, etf, year = F.col("class") == "stock", F.col("class") == "etf", F.col("year")
    new = now.where(~(etf & (year == 1996))).withColumn("close", F.when(stock & (year == 1995), F.col("close") + 1).otherwise(F.col("close")))
    new = new.unionByName(new.where(stock & (year == 1997)))
    return frozen_breaks(new, partition_manifest(now, ["class", "year"]), ["class", "year"])
