"""Stock selections for all rebalance dates in one job, and the rebalance calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import iso_week_start
from tidemark.operators.asof import asof_join
from tidemark.operators.ranking import keep_fraction

# Industries left out by name, and the size of the selection.
EXCLUDED_INDUSTRIES = (
    "钢铁I", "煤炭I", "石油石化I", "采掘I", "银行I", "非银金融I", "金融服务I", "交运设备I", "交通运输I", "传媒I", "环保I",
)
STOCKS, CANDIDATES, SMALL_CAP_CANDIDATES = 10, 10, 15
LISTED_DAYS, SMALL_CAP_LISTED_DAYS = 250, 375
BLACKLIST_DAYS = 20


def rebalance_dates(calendar: DataFrame) -> DataFrame:
    """First trading day of each ISO week with the trading day before it (one row per trading day at most)."""
    w = Window.orderBy("date")
    days = calendar.select("date", F.lag("date").over(w).alias("sel_date"))
    first = days.withColumn("__w", iso_week_start(F.col("date"))).groupBy("__w").agg(F.min(F.struct("date", "sel_date")).alias("d"))
    return first.select(F.col("d.date").alias("trade_date"), F.col("d.sel_date").alias("sel_date")).where(F.col("sel_date").isNotNull())


def _tradable(cand: DataFrame, panel: DataFrame, n: int) -> DataFrame:
    """Drop candidates locked at a limit at the open of the trade day; keep the first n, no refill."""
    ok = panel.where(~F.col("is_open_limit_up") & ~F.col("is_open_limit_down")).select(
        "jq_code", F.col("date").alias("trade_date")
    )
    kept = cand.join(ok, ["jq_code", "trade_date"], "left_semi")
    rn = F.row_number().over(Window.partitionBy("trade_date").orderBy("rank"))
    return kept.withColumn("position", rn).where(F.col("position") <= n)


def _smallest(df: DataFrame, n: int) -> DataFrame:
    """The n smallest by float value per trade date (ties by code)."""
    w = Window.partitionBy("trade_date").orderBy("floatmv", "jq_code")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _pool(panel: DataFrame, dates: DataFrame, listed_days: int) -> DataFrame:
    """Panel rows of the selection days that pass the common filters."""
    rows = panel.where(
        (F.col("is_st") == 0) & (F.col("listed_days") > listed_days) & F.col("list_date").isNotNull()
        & ~F.col("symbol").startswith("sh68") & (F.col("eps_q") > 0) & (F.col("floatmv") > 0)
    )
    return rows.join(F.broadcast(dates.withColumnRenamed("sel_date", "date")), "date")


def select_small_cap(panel: DataFrame, dates: DataFrame) -> DataFrame:
    cand = _smallest(_pool(panel, dates, SMALL_CAP_LISTED_DAYS).select("trade_date", "jq_code", "floatmv"), SMALL_CAP_CANDIDATES)
    return _tradable(cand, panel, STOCKS).select("trade_date", "jq_code", "position")


def roe_increase(indicator: DataFrame) -> DataFrame:
    """4 * newest - the four before it, over the five latest visible quarters; exactly five are required.

    For every rebalance date this must look at "the five newest reports published by then".  The state of a
    code changes only when it publishes, so the five are kept per publication and looked up as-of.
    """
    rows = indicator.where(F.col("roe").isNotNull() & F.col("pub_date").isNotNull()).select("code", "pub_date", "report_date", "roe")
    upto = Window.partitionBy("code").orderBy("pub_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # a code publishes four reports a year, so the list per code stays short
    seen = F.collect_list(F.struct("report_date", "roe")).over(upto)
    top5 = F.slice(F.sort_array(seen, asc=False), 1, 5)
    states = rows.withColumn("top", top5).groupBy("code", "pub_date").agg(F.first("top").alias("top"))
    return states.where(F.size("top") == 5).select(
        "code", "pub_date",
        (4 * F.col("top")[0]["roe"] - F.col("top")[1]["roe"] - F.col("top")[2]["roe"] - F.col("top")[3]["roe"] - F.col("top")[4]["roe"]).alias("increase"),
    )


def select_roe_increase(panel: DataFrame, indicator: DataFrame, dates: DataFrame, cheap: float = 0.5, best: float = 0.1) -> DataFrame:
    """Cheapest half by pb, top decile of the ROE increase, industries out, ten smallest, tradability filter."""
    base = _pool(panel, dates, LISTED_DAYS).where(F.col("pb") > 0).select(
        "date", "trade_date", "jq_code", "floatmv", "pb", "sw_l1_name"
    )
    half = keep_fraction(base, ["trade_date"], "pb", "jq_code", cheap)
    known = asof_join(half, roe_increase(indicator).withColumnRenamed("code", "jq_code"), ["jq_code"], "date", "pub_date",
                      ["increase"], how="inner", left_unique=True)
    top = keep_fraction(known, ["trade_date"], "increase", "jq_code", best, largest=True)
    allowed = top.where(F.col("sw_l1_name").isNull() | ~F.col("sw_l1_name").isin(*EXCLUDED_INDUSTRIES))
    return _tradable(_smallest(allowed, CANDIDATES), panel, STOCKS).select("trade_date", "jq_code", "position")


def limit_up_blacklist(panel: DataFrame, dates: DataFrame, calendar: DataFrame, days: int = BLACKLIST_DAYS) -> DataFrame:
    """(trade_date, code) closed at the upper limit within the last ``days`` trading days before the trade date."""
    cal = calendar.select("date", F.row_number().over(Window.orderBy("date")).alias("seq"))
    hits = panel.where(F.col("is_limit_up")).select("jq_code", "date").join(F.broadcast(cal), "date")
    trade = dates.select(F.col("trade_date").alias("date")).join(cal, "date").select(F.col("date").alias("trade_date"), F.col("seq").alias("tseq"))
    # each hit touches the rebalance dates at most ``days`` positions ahead: explode those positions, equi-join
    ahead = hits.select("jq_code", F.explode(F.sequence(F.col("seq") + 1, F.col("seq") + days)).alias("tseq"))
    return ahead.join(F.broadcast(trade), "tseq").select("trade_date", "jq_code").distinct()
