"""Exchange-traded funds: universe, panel, price rewrite from a truth table, mass-move guard."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import round_half, safe_div
from tidemark.plans.bars import fund_segment, unified_code

DELISTED_AFTER_DAYS = 30
NORMAL = "正常上市"  # fixed value
# Columns of the stock panel that a fund has not; numbers, then index memberships.
DOUBLE_BLANKS = (
    "turnover", "floatmv", "totalmv", "pb", "pe_ttm", "ps_ttm", "roe_ttm", "peg", "np_ttm", "rev_ttm", "rev_yoy", "np_yoy",
    "np_q", "rev_q", "np_q_yoy", "rev_q_yoy", "eps_q", "roe_q", "eps_basic", "roe_parent", "bps", "revenue",
    "net_profit_parent", "adjusted_profit_q",
)
INDEX_BLANKS = ("in_hs300", "in_zz500", "in_zz1000", "in_sz50", "in_cyb", "in_kc50", "in_zz800")


def etf_universe(bars: DataFrame) -> DataFrame:
    """First and last bar per fund; no bar for 30 days before the end of the table means delisted."""
    end = bars.agg(F.max("date").alias("__end"))  # one row
    k = bars.where(fund_segment(F.col("symbol"))).groupBy("symbol").agg(
        F.min("date").alias("list_date"), F.max("date").alias("__last"), F.count(F.lit(1)).alias("n_days")
    )
    gone = F.col("__last") < F.date_sub("__end", DELISTED_AFTER_DAYS)
    return k.crossJoin(F.broadcast(end)).select(
        unified_code(F.col("symbol")).alias("code"), "symbol", F.lit(None).cast("string").alias("display_name_current"),
        "list_date", F.when(gone, F.col("__last")).alias("delist_date"), F.lit("etf").alias("sec_type"), "n_days",
    )


def fund_names(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Names from two sources, the first one preferred."""
    return primary.select("code", F.col("name").alias("__a")).join(
        secondary.select("code", F.col("name").alias("__b")), "code", "full"
    ).select("code", F.coalesce("__a", "__b").alias("name"))


def etf_panel(bars: DataFrame, factor: DataFrame, universe: DataFrame, names: DataFrame) -> DataFrame:
    pre = F.lag("close").over(Window.partitionBy("symbol").orderBy("date"))
    k = bars.where(fund_segment(F.col("symbol"))).withColumn("preclose", pre)
    k = k.join(factor.select("symbol", "date", "hfq_factor"), ["symbol", "date"])
    k = k.where((F.col("close") > 0) & F.col("preclose").isNotNull())
    k = k.join(universe.select("symbol", F.col("code").alias("__code"), "list_date"), "symbol", "left")
    k = k.join(names.select(F.col("code").alias("__code"), F.col("name").alias("sec_name")), "__code", "left")
    k = k.withColumns({"limit_up": round_half(F.col("preclose") * 1.1, 3), "limit_down": round_half(F.col("preclose") * 0.9, 3)})
    up, down, half = F.col("limit_up"), F.col("limit_down"), 0.0005
    blank = F.lit(None)
    return k.select(
        unified_code(F.col("symbol")).alias("jq_code"), "symbol", "date", "open", "high", "low", "close",
        round_half(F.col("close") * F.col("hfq_factor"), 6).alias("close_hfq"), "hfq_factor", "preclose", "volume", "amount",
        "limit_up", "limit_down",
        (F.col("close") >= up - half).alias("is_limit_up"), (F.col("close") <= down + half).alias("is_limit_down"),
        (F.col("open") >= up - half).alias("is_open_limit_up"), (F.col("open") <= down + half).alias("is_open_limit_down"),
        (F.col("preclose") > 0).alias("limit_rule_ok"),
        round_half((safe_div(F.col("close"), F.col("preclose")) - 1) * 100, 4).alias("change_pct"),
        F.col("close").alias("close_bfq"),
        round_half(safe_div(F.col("high") - F.col("low"), F.col("preclose")) * 100, 4).alias("amplitude"),
        (F.col("volume") / 100.0).alias("volume_shares"), F.lit(10.0).alias("limit_pct"), "sec_name", "list_date",
        *[blank.cast("double").alias(x) for x in DOUBLE_BLANKS],
        blank.cast("date").alias("fin_report_date"), blank.cast("date").alias("fin_pub_date"),
        blank.cast("string").alias("sw_l1_code"), blank.cast("string").alias("sw_l1_name"),
        F.lit(False).alias("is_st"), F.lit(False).alias("is_risk_warned"), F.lit(NORMAL).alias("public_status"),
        F.datediff("date", "list_date").cast("long").alias("listed_days"),
        *[F.lit(False).alias(x) for x in INDEX_BLANKS],
    )


def rewrite_prices(bars: DataFrame, truth: DataFrame) -> DataFrame:
    """Replace prices and amount by the truth table where it has the bar; running it twice changes nothing."""
    t = truth.select("symbol", "date", *[F.col(x).alias(f"__{x}") for x in ("o", "h", "l", "c", "amt")])
    names = {"open": "__o", "high": "__h", "low": "__l", "close": "__c", "amount": "__amt"}
    return bars.join(t, ["symbol", "date"], "left").select(
        *[F.coalesce(names[x], x).alias(x) if x in names else F.col(x) for x in bars.columns]
    )


def recompute_basic(bars: DataFrame) -> DataFrame:
    """Previous close, change and amplitude of rewritten bars."""
    pre = F.lag("close").over(Window.partitionBy("symbol").orderBy("date"))
    df = bars.withColumn("preclose", pre)
    return df.select(
        "symbol", "date", "close", "preclose",
        ((safe_div(F.col("close"), F.col("preclose")) - 1) * 100).alias("change_pct"),
        (safe_div(F.col("high") - F.col("low"), F.col("preclose")) * 100).alias("amplitude"),
    )


def scale_proof(bars: DataFrame, truth: DataFrame, divisor: float) -> DataFrame:
    """Do both tables agree after dividing by ``divisor``?  Shares of aligned and exactly scaled rows."""
    j = bars.select("symbol", "date", "close").join(truth.select("symbol", "date", "c"), ["symbol", "date"], "full")
    both = F.col("close").isNotNull() & F.col("c").isNotNull()
    return j.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(both).alias("n_aligned"),
        F.count_if(both & (F.abs(F.col("close") / divisor - F.col("c")) < 0.0005)).alias("n_scaled"),
    )
