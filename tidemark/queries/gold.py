"""Queries over the panel and the layers it is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_div
from tidemark.functions.windows import JQ_DATE
from tidemark.operators.asof import asof_join
from tidemark.plans import fundamentals as fu
from tidemark.plans.panel import paused_days
from tidemark.plans.shares import share_asof_rows
from tidemark.queries.inputs import codes, panel, px
from tidemark.queries.registry import query, rnd


@query("bias_top10", ["o_px"], """
    SELECT date, jq_code, close_hfq, round(ret_1d, 6) AS ret_1d, round((close_hfq - ma) / ma, 6) AS bias20 FROM (
      SELECT *, CASE WHEN count(*) OVER w = 20 THEN avg(close_hfq) OVER w END AS ma, max(date) OVER () AS last FROM o_px
      WINDOW w AS (PARTITION BY jq_code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
    WHERE date >= last - INTERVAL 30 DAY AND ma IS NOT NULL ORDER BY round((close_hfq - ma) / ma, 6), jq_code, date LIMIT 10""")
def bias_top10(r):
    """Adjusted close, return, distance from the 20-day mean; the ten lowest of the last month."""
    c = F.col("close_hfq")
    bars = px(r)
    last = r("bars").agg(F.date_sub(F.max("date"), 30).alias("__from"))  # one row
    df = bars.withColumn("ma", JQ_DATE.ma(c, 20)).where(F.col("ma").isNotNull())
    df = df.crossJoin(F.broadcast(last)).where(F.col("date") >= F.col("__from"))
    return (
        df.select("date", "jq_code", "close_hfq", rnd("ret_1d").alias("ret_1d"), rnd(safe_div(c - F.col("ma"), F.col("ma"))).alias("bias20"))
        .orderBy(F.col("bias20").asc_nulls_last(), "jq_code", "date").limit(10)
    )


@query("code_map", ["o_code_map"], "SELECT * FROM o_code_map")
def q_code_map(r):
    return codes(r)


@query("base_bars", ["o_px"], """
    SELECT date, jq_code, symbol, close AS close_bfq, open, high, low, volume_shares, amount, close_hfq, hfq_factor,
           round(ret_1d, 6) AS ret_1d, vol_div::DOUBLE AS vol_div FROM o_px""")
def q_base_bars(r):
    return px(r).withColumn("ret_1d", rnd("ret_1d"))


@query("financial_chain", ["o_fin3"], """
    SELECT code, report_date, pub_date, roe_parent, bps, total_assets, equities, equities_report_date, equities_is_stale, np_ttm, rev_ttm,
           round(rev_yoy, 6) AS rev_yoy, round(np_yoy, 6) AS np_yoy, q_ok, np_q, rev_q, eps_q, round(np_q_yoy, 6) AS np_q_yoy, round(rev_q_yoy, 6) AS rev_q_yoy
    FROM o_fin3""")
def q_financial_chain(r):
    df = fu.financial_chain(r("fin_core"), r("fin_ratio"))
    for c in ("rev_yoy", "np_yoy", "np_q_yoy", "rev_q_yoy"):
        df = df.withColumn(c, rnd(c))
    return df.drop("revenue", "net_profit_parent", "net_profit_total", "profit_before_tax", "eps_basic")


@query("filing_asof_keys", ["o_fin3_asof"], "SELECT code, pub_date, report_date, np_ttm, np_q FROM o_fin3_asof")
def q_filing_asof_keys(r):
    from tidemark.operators.dedupe import newest_report_asof

    return newest_report_asof(fu.financial_chain(r("fin_core"), r("fin_ratio"))).select("code", "pub_date", "report_date", "np_ttm", "np_q")


@query("share_asof", ["o_shr"], "SELECT * FROM o_shr")
def q_share_asof(r):
    return share_asof_rows(r("share_change"))


@query("asof_left", ["bars", "o_code_map", "o_shr"], """
    SELECT k.symbol, k.date, s.eff_date, s.float_sh FROM bars k JOIN o_code_map m ON m.tdx_symbol = k.symbol
    ASOF LEFT JOIN o_shr s ON s.code = m.jq_code AND s.eff_date <= k.date""")
def q_asof_left(r):
    left = r("bars").join(codes(r).select(F.col("tdx_symbol").alias("symbol"), F.col("jq_code").alias("code")), "symbol")
    out = asof_join(left.select("symbol", "code", "date"), share_asof_rows(r("share_change")), ["code"], "date", "eff_date",
                    ["eff_date", "float_sh"], left_unique=True, bucket="year")
    return out.select("symbol", "date", "eff_date", "float_sh")


@query("asof_inner_strict", ["lines", "o_status", "o_code_map"], """
    SELECT m.jq_code AS code, s.eff_from, s.public_status, count(*) AS n, CAST(sum(l.qty) AS BIGINT) AS qty
    FROM (SELECT lines.*, concat(CASE WHEN sk % 20 = 19 THEN 'sh51' WHEN sk % 20 = 18 THEN 'sz39' WHEN sk % 20 = 17 THEN 'sh90'
            WHEN sk % 4 = 0 THEN 'sh60' WHEN sk % 4 = 1 THEN 'sh68' WHEN sk % 4 = 2 THEN 'sz30' ELSE 'sz00' END, CASE WHEN sk < 10000 THEN lpad(CAST(sk AS VARCHAR), 4, '0') ELSE CAST(sk AS VARCHAR) END) AS symbol FROM lines) l
    JOIN o_code_map m ON m.tdx_symbol = l.symbol
    ASOF JOIN o_status s ON s.code = m.jq_code AND s.eff_from < l.date GROUP BY ALL""")
def q_asof_inner_strict(r):
    """Inner, strict, left side with many rows per key and day: the match runs on distinct (key, day)."""
    from tidemark.plans.dimensions import status_asof
    from tidemark.queries.standin import _symbol

    lines = r("lines").withColumn("symbol", F.expr(_symbol("sk")))
    left = lines.join(codes(r).select(F.col("tdx_symbol").alias("symbol"), F.col("jq_code").alias("code")), "symbol")
    out = asof_join(left, status_asof(r("security_status")), ["code"], "date", "eff_from", ["eff_from", "public_status"],
                    how="inner", strict=True, bucket="quarter")
    return out.groupBy("code", "eff_from", "public_status").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))


_ROUND = {"ret_1d": 6, "change_pct": 6, "amplitude": 6, "rev_yoy": 6, "np_yoy": 6, "np_q_yoy": 6, "rev_q_yoy": 6, "roe_q_derived": 6,
          "pb": 6, "pe_ttm": 6, "ps_ttm": 6, "roe_ttm": 6, "peg": 6}
_SQL_ROUND = ", ".join(f"round({c}, {d}) AS {c}" for c, d in _ROUND.items())


@query("panel_daily", ["o_panel"], f"SELECT * REPLACE ({_SQL_ROUND}) FROM o_panel")
def q_panel_daily(r):
    return panel(r).withColumns({c: rnd(c, d) for c, d in _ROUND.items()})


@query("paused_daily", ["o_px", "universe", "calendar_days"], """
    SELECT t.date, u.code AS jq_code FROM universe u JOIN calendar_days t
      ON t.date >= greatest(u.list_date, DATE '1995-01-01') AND t.date <= least(coalesce(u.delist_date, DATE '2200-01-01'), (SELECT max(date) FROM calendar_days))
    WHERE u.list_date IS NOT NULL AND u.code IN (SELECT DISTINCT jq_code FROM o_px)
      AND NOT EXISTS (SELECT 1 FROM o_px p WHERE p.jq_code = u.code AND p.date = t.date)""")
def q_paused_daily(r):
    return paused_days(px(r), r("universe"), r("calendar_days"), "1995-01-01")
