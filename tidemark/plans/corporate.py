"""Corporate actions: per-share values, cash events, and the gate against adjustment factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_div
from tidemark.plans.bars import trading_calendar, unified_code

EX_RIGHT_CATEGORY = 1  # fixed value: the only category whose c1..c4 are ex-right terms
IMPLEMENTED = "实施方案"  # fixed value: plan_progress of an implemented plan
MAX_MEAN_ERROR, MAX_ERROR, MAX_BAD_SHARE, MIN_SAMPLE = 1e-6, 1e-4, 0.002, 10_000


def actions(gbbq: DataFrame) -> DataFrame:
    """Per-share cash, split and rights terms (the source states them per ten shares)."""
    return gbbq.where(F.col("category") == EX_RIGHT_CATEGORY).select(
        "symbol", unified_code(F.col("symbol")).alias("jq_code"), F.col("date").alias("ex_date"),
        (F.col("c1") / 10.0).alias("cash_per_share"), (F.col("c3") / 10.0).alias("split_per_share"),
        (F.col("c4") / 10.0).alias("rights_per_share"), F.col("c2").alias("rights_price"),
    )


def factor_jumps(bars: DataFrame) -> DataFrame:
    """Days whose factor differs from the previous bar, only where that bar is the adjacent trading day.

    A jump after a suspension may belong to any suspended day, so it proves nothing.
    """
    cal = trading_calendar(bars)
    w = Window.partitionBy("jq_code").orderBy("date")
    rows = bars.join(F.broadcast(cal), "date").withColumns({
        "pf": F.lag("hfq_factor").over(w), "pc": F.lag("close").over(w), "ps": F.lag("seq").over(w),
    })
    return rows.where((F.col("pf") != F.col("hfq_factor")) & (F.col("seq") - F.col("ps") == 1)).select(
        "jq_code", "date", "pc", (F.col("hfq_factor") / F.col("pf")).alias("ratio")
    )


def ex_right_errors(acts: DataFrame, jumps: DataFrame) -> DataFrame:
    pc = F.col("pc")
    price = (pc - F.col("cash_per_share") + F.col("rights_price") * F.col("rights_per_share")) / (
        1 + F.col("split_per_share") + F.col("rights_per_share")
    )
    joined = acts.join(jumps.withColumnRenamed("date", "ex_date"), ["jq_code", "ex_date"])
    return joined.withColumn("error", F.abs(F.col("ratio") - safe_div(pc, price)))


def ex_right_gate(acts: DataFrame, bars: DataFrame, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """One row: sample size, mean error, outliers and the verdict."""
    got = ex_right_errors(acts, factor_jumps(bars)).agg(
        F.count(F.lit(1)).alias("n"), F.avg("error").alias("mean_err"), F.count_if(F.col("error") > MAX_ERROR).alias("bad")
    )
    ok = (F.col("n") > min_sample) & (F.coalesce("mean_err", F.lit(0.0)) <= MAX_MEAN_ERROR) & (F.col("bad") <= F.col("n") * MAX_BAD_SHARE)
    return got.withColumn("accepted", ok)


def cash_events(dividend: DataFrame) -> DataFrame:
    """Cash per share by code and ex-date, implemented plans only (the source states it per ten shares)."""
    return (
        dividend.where((F.col("plan_progress") == IMPLEMENTED) & F.col("a_xr_date").isNotNull() & (F.col("bonus_ratio_rmb") > 0))
        .groupBy("code", F.col("a_xr_date").alias("ex_date"))
        .agg((F.sum("bonus_ratio_rmb") / 10.0).alias("cash_per_share"))
    )
