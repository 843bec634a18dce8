"""The daily panel: one row per (date, code) with everything that was known on that day.

Bars move twice: once by (symbol, date) to meet factors and basics, once by code for everything else.  That
second pass sorts bars and all dimensions together and reads off, per bar, the previous close, the filings,
indicators, share counts, status, name, industry and eight index memberships known that day.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import null_if, round_half
from tidemark.functions.windows import JQ_DATE
from tidemark.operators.asof import Side, asof_join_many
from tidemark.operators.dedupe import newest_report_asof
from tidemark.plans.bars import matched_stocks, repaired_turnover, volume_divisor, with_factor
from tidemark.plans.dimensions import status_asof
from tidemark.plans.fundamentals import financial_chain, indicator_asof
from tidemark.plans.shares import share_asof_rows
from tidemark.session import spread

# Index code -> panel flag.
INDEX_FLAGS = {
    "000300.XSHG": "in_hs300", "000905.XSHG": "in_zz500", "399303.XSHE": "in_gz2000", "000852.XSHG": "in_zz1000",
    "000016.XSHG": "in_sz50", "399006.XSHE": "in_cyb", "000688.XSHG": "in_kc50", "000906.XSHG": "in_zz800",
}
# Status texts and the dates price-limit rules changed.
ST = ("ST", "*ST")
DELISTING = "进入退市整理期"
RISK_MARKS = ("ST", "*", "退")
GROWTH_BOARD_20_FROM = "2020-08-24"
ST_10_FROM = "2026-07-06"
TICK = 0.005


def limit_percent(symbol: Column, day: Column, status: Column) -> Column:
    """Price-limit fraction by board, date and special treatment (first matching rule)."""
    st = F.coalesce(status.isin(*ST), F.lit(False))
    growth = symbol.startswith("sz30")
    return (
        F.when(symbol.startswith("sh68"), 0.20)
        .when(growth & (day >= F.to_date(F.lit(GROWTH_BOARD_20_FROM))), 0.20)
        .when(growth & st, 0.05)
        .when(growth, 0.10)
        .when(st & (day >= F.to_date(F.lit(ST_10_FROM))), 0.10)
        .when(st, 0.05)
        .otherwise(0.10)
    )


def limit_columns(df: DataFrame) -> DataFrame:
    """Limit prices, whether the rule explains the day, and the four at-limit flags."""
    pct, pre = F.col("limit_pct"), F.col("preclose")
    df = df.withColumns({"limit_up": round_half(pre * (1 + pct), 2), "limit_down": round_half(pre * (1 - pct), 2)})
    up, down = F.col("limit_up"), F.col("limit_down")
    under, over = F.col("high") <= up + TICK, F.col("low") >= down - TICK

    def at(price: str, limit: Column, bound: Column) -> Column:
        return (pre > 0) & (F.abs(F.col(price) - limit) < TICK) & bound

    return df.withColumns({
        "limit_rule_ok": (pre > 0) & under & over,
        "is_limit_up": at("close_bfq", up, under),
        "is_limit_down": at("close_bfq", down, over),
        "is_open_limit_up": at("open", up, under),
        "is_open_limit_down": at("open", down, over),
    })


def valuation_columns(df: DataFrame) -> DataFrame:
    """Ratios on the report visible that day, each guarded by a positive denominator."""
    mv, eq, np_, rev = F.col("__totalmv"), F.col("equities"), F.col("np_ttm"), F.col("rev_ttm")
    return df.withColumns({
        "roe_q_derived": F.when(eq > 0, F.col("np_q") / eq),
        "pb": F.when(eq > 0, mv / eq),
        "pe_ttm": F.when(np_ > 0, mv / np_),
        "ps_ttm": F.when(rev > 0, mv / rev),
        "roe_ttm": F.when(eq > 0, np_ / eq),
        "peg": F.when((np_ > 0) & (F.col("np_yoy") > 0), (mv / np_) / (F.col("np_yoy") * 100)),
    })


def priced_bars(bars: DataFrame, factor: DataFrame, codes: DataFrame, parts: int | None = None) -> DataFrame:
    """Matched stock bars with adjusted close and repaired volume."""
    div = volume_divisor(F.col("low"), F.col("high"), F.col("volume"), F.col("amount"))
    # one exchange for the factors here and the basics later
    df = with_factor(spread(matched_stocks(bars, codes), "symbol", "date", parts=parts), factor).withColumn("vol_div", div)
    return df.select(
        "date", "jq_code", "symbol", F.col("close").alias("close_bfq"), "open", "high", "low",
        (F.col("volume") / F.col("vol_div")).alias("volume_shares"), "amount",
        round_half(F.col("close") * F.col("hfq_factor"), 2).alias("close_hfq"), "hfq_factor", "vol_div",
    )


def daily_return(prev: Column) -> Column:
    return F.when(prev > 0, F.col("close_hfq") / prev - 1)


def base_bars(bars: DataFrame, factor: DataFrame, codes: DataFrame, parts: int | None = None) -> DataFrame:
    """``priced_bars`` with the daily return."""
    df = priced_bars(bars, factor, codes, parts).withColumn("__prev", JQ_DATE.shift(F.col("close_hfq"), 1))
    return df.withColumn("ret_1d", daily_return(F.col("__prev"))).drop("__prev")


def membership_side(members: DataFrame, key: dict[str, str]) -> Side:
    """All eight indexes as one right table of the as-of pass.

    A membership row holds from its snapshot until the next snapshot of the *same* index, whether or not the
    code is in that one; so each row carries the date it is superseded.  The snapshot calendar is a small
    table (dates x indexes).  One row per (code, snapshot date) holds a column per index.
    """
    rows = members.where(F.col("index_code").isin(*INDEX_FLAGS)).select("index_code", "stock_code", "as_of")
    calendar = rows.select("index_code", "as_of").distinct()
    w = Window.partitionBy("index_code").orderBy("as_of")
    calendar = calendar.withColumn("superseded", F.coalesce(F.lead("as_of").over(w), F.to_date(F.lit("9999-12-31"))))
    wide = (
        rows.join(F.broadcast(calendar), ["index_code", "as_of"])
        .groupBy(F.col("stock_code").alias("code"), "as_of")
        .agg(*[F.max(F.when(F.col("index_code") == k, F.col("superseded"))).alias(flag) for k, flag in INDEX_FLAGS.items()])
    )
    return Side(wide, "as_of", {f"__until_{flag}": flag for flag in INDEX_FLAGS.values()}, key, per_column=True)


def _still_valid(until: str) -> Column:
    return F.col(until).isNull() | (F.col(until) > F.col("date"))


def membership_flags() -> dict[str, Column]:
    return {
        flag: F.when(F.col(f"__until_{flag}") > F.col("date"), 1).otherwise(0).cast("byte")
        for flag in INDEX_FLAGS.values()
    }


@dataclass(frozen=True)
class PanelInputs:
    bars: DataFrame
    factor: DataFrame
    basic: DataFrame
    codes: DataFrame
    core: DataFrame
    ratio: DataFrame
    indicator: DataFrame
    share_change: DataFrame
    status: DataFrame
    names: DataFrame
    industries: DataFrame
    universe: DataFrame
    members: DataFrame


FIN_COLS = (
    "revenue", "net_profit_parent", "eps_basic", "roe_parent", "bps", "total_assets", "equities", "np_ttm", "rev_ttm",
    "rev_yoy", "np_yoy", "np_q", "rev_q", "np_q_yoy", "rev_q_yoy",
)
INDUSTRY_COLS = (
    "sw_l1_code", "sw_l1_name", "sw_l2_code", "sw_l2_name", "sw_l3_code", "sw_l3_name", "zjw_code", "zjw_name",
)


def panel_daily(x: PanelInputs, parts: int | None = None) -> DataFrame:
    """``parts``: into how many parts the bars are dealt, for the joins and for the as-of pass (``session.parts_of`` their number)."""
    px = priced_bars(x.bars, x.factor, x.codes, parts)
    basic = x.basic.select(
        "symbol", "date", "preclose", "change_pct", "amplitude", "turnover",
        F.col("floatmv").alias("__floatmv"), F.col("totalmv").alias("__totalmv"),
    )
    px = px.join(basic, ["symbol", "date"], "left").withColumn(
        "turnover", repaired_turnover(F.col("turnover"), F.col("vol_div"))
    )

    fin = newest_report_asof(financial_chain(x.core, x.ratio))
    key = {"jq_code": "code"}
    sides = [
        Side(share_asof_rows(x.share_change), "eff_date", {"__float_sh": "float_sh"}, key),
        Side(fin, "pub_date", {"fin_report_date": "report_date", "fin_pub_date": "pub_date",
                               "eps_q_derived": "eps_q", **{c: c for c in FIN_COLS}}, key),
        Side(indicator_asof(x.indicator), "pub_date",
             {"ind_report_date": "report_date", "ind_pub_date": "pub_date", "eps_q": "eps", "roe_q": "roe",
              "adjusted_profit_q": "adjusted_profit"}, key),
        Side(status_asof(x.status), "eff_from", {"public_status": "public_status"}, key),
        # names and industries are closed by their successor, so "inside the interval" is an as-of as well
        Side(x.names, "valid_from", {"sec_name": "name", "__name_to": "valid_to"}, key),
        Side(x.industries, "valid_from", {**{c: c for c in INDUSTRY_COLS}, "__industry_to": "valid_to"}, key),
        membership_side(x.members, key),
    ]
    df = asof_join_many(px, ["jq_code"], "date", sides, left_unique=True, previous={"__prev_hfq": "close_hfq"}, parts=parts)

    df = df.withColumns({
        "sec_name": F.when(_still_valid("__name_to"), F.col("sec_name")),
        **{c: F.when(_still_valid("__industry_to"), F.col(c)) for c in INDUSTRY_COLS},
        **membership_flags(),
    })
    df = df.join(x.universe.select(F.col("code").alias("jq_code"), "list_date"), "jq_code", "left")

    status, name = F.col("public_status"), F.col("sec_name")
    risky = status.isin(*ST, DELISTING)
    df = df.withColumns({
        "ret_1d": daily_return(F.col("__prev_hfq")),
        "floatmv": F.coalesce(F.col("__float_sh") * F.col("close_bfq"), null_if(F.col("__floatmv"), 0.0)),
        "floatmv_tdx": null_if(F.col("__floatmv"), 0.0),
        "totalmv": null_if(F.col("__totalmv"), 0.0),
        "is_st": F.when(risky, 1).otherwise(0).cast("byte"),
        "is_risk_warned": reduce(lambda a, b: a | b, [risky, *[name.contains(m) for m in RISK_MARKS]]),
        "listed_days": F.datediff("date", "list_date").cast("long"),
        "limit_pct": limit_percent(F.col("symbol"), F.col("date"), status),
    })
    df = limit_columns(valuation_columns(df))
    return df.drop(*[c for c in df.columns if c.startswith("__")], "vol_div")


def paused_days(panel: DataFrame, universe: DataFrame, calendar: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Listed days without a bar.  ``end`` defaults to the last day of the panel.

    Each code is expanded over the calendar days inside its own listing window: calendar positions are
    looked up for both ends and the range is exploded, so no pair outside the window ever exists.
    """
    active = universe.where(F.col("list_date").isNotNull()).join(
        panel.select(F.col("jq_code").alias("code")).distinct(), "code", "left_semi"
    )
    days = calendar.select("date").distinct()
    # one row: the whole calendar as a sorted array (a few thousand dates)
    cal = days.agg(F.array_sort(F.collect_list("date")).alias("__days"), F.max("date").alias("__max"))
    last = F.to_date(F.lit(end)) if end else F.col("__max")
    lo = F.greatest(F.col("list_date"), F.to_date(F.lit(start)))
    hi = F.least(F.coalesce(F.col("delist_date"), F.to_date(F.lit("2200-01-01"))), last)
    expected = (
        active.crossJoin(F.broadcast(cal))
        .select(F.col("code").alias("jq_code"), lo.alias("__lo"), hi.alias("__hi"), "__days")
        .select("jq_code", F.explode(F.filter("__days", lambda d: (d >= F.col("__lo")) & (d <= F.col("__hi")))).alias("date"))
    )
    return expected.join(panel.select("jq_code", "date"), ["jq_code", "date"], "left_anti").select("date", "jq_code")
