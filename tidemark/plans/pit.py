"""Point-in-time table functions: what was known on a day.

Each takes DataFrames and a day (string or date Column) and returns a DataFrame; ``register_sql`` publishes
the same rules as SQL table functions over named views, so they can be called per row with LATERAL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_div
from tidemark.operators.dedupe import keep_max


def _day(d: str | Column) -> Column:
    return F.to_date(F.lit(d)) if isinstance(d, str) else d


def fin_visible_at(core: DataFrame, d: str | Column) -> DataFrame:
    """Newest report per code that is published by ``d``; placeholder publication dates never count."""
    day = _day(d)
    seen = core.where((F.col("report_date") <= day) & (F.col("pub_date") <= day) & (F.col("pub_date") > F.col("report_date")))
    return keep_max(seen, ["code"], ["report_date"])


def dividend_visible_at(dividend: DataFrame, d: str | Column) -> DataFrame:
    """Plans visible and not cancelled by ``d``, the latest stage of each (code, report, type)."""
    day = _day(d)
    live = dividend.where(
        (F.col("visible_date") <= day) & (F.col("bonus_cancel_pub_date").isNull() | (F.col("bonus_cancel_pub_date") > day))
    )
    return keep_max(live, ["code", "report_date", "bonus_type"], ["visible_date", "plan_progress", "bonus_amount_rmb"])


def dividend_ttm_at(dividend: DataFrame, d: str | Column) -> DataFrame:
    """Cash announced in the 365 days before ``d``, per code."""
    day = _day(d)
    recent = dividend_visible_at(dividend, d).where((F.col("bonus_amount_rmb") > 0) & (F.col("visible_date") > F.date_sub(day, 365)))
    return recent.groupBy("code").agg(F.sum("bonus_amount_rmb").alias("bonus_amount_wan_rmb"), F.count("*").alias("n_plan"))


def index_members_at(members: DataFrame, index_code: str, d: str | Column) -> DataFrame:
    """Members on ``d``; these intervals are closed at the end."""
    day = _day(d)
    return members.where(
        (F.col("index_code") == index_code) & (F.col("valid_from") <= day)
        & (F.col("valid_to").isNull() | (F.col("valid_to") >= day))
    )


def market_state(limits: DataFrame, bars: DataFrame, paused: DataFrame, st: DataFrame) -> DataFrame:
    """Limits, suspension, special treatment and limit touches for every (code, date).

    ``bars`` carries ``code``; filter ``limits`` to one date for the state of a day.
    """
    flag = F.lit(True)
    df = limits.join(bars.select("code", "date", "open", "high", "low", "close"), ["code", "date"], "left")
    df = df.join(paused.select("code", "date").distinct().withColumn("__p", flag), ["code", "date"], "left")
    s = st.select(F.col("code").alias("__c"), F.col("valid_from").alias("__f"), F.col("valid_to").alias("__t"))
    df = df.join(s, (F.col("code") == F.col("__c")) & (F.col("__f") <= F.col("date")) & (F.col("__t") > F.col("date")), "left")
    high, low = F.col("high"), F.col("low")
    return df.select(
        "code", "date", "high_limit", "low_limit",
        F.col("__p").isNotNull().alias("is_paused"), F.col("__c").isNotNull().alias("is_st"),
        "open", "high", "low", "close",
        (low.isNotNull() & (low >= F.col("high_limit"))).alias("limit_up_sealed"),
        (high.isNotNull() & (high <= F.col("low_limit"))).alias("limit_down_sealed"),
        (high.isNotNull() & (high >= F.col("high_limit")) & (low < F.col("high_limit"))).alias("limit_up_opened"),
    )


def market_state_at(limits: DataFrame, bars: DataFrame, paused: DataFrame, st: DataFrame, d: str | Column) -> DataFrame:
    day = _day(d)
    return market_state(limits.where(F.col("date") == day), bars.where(F.col("date") == day), paused.where(F.col("date") == day), st)


def valid_at(intervals: DataFrame, d: str | Column, known: str | None = None) -> DataFrame:
    """Rows valid on ``d`` (half-open); with ``known`` also already announced."""
    day = _day(d)
    ok = (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))
    if known:
        ok = ok & (F.col(known) <= day)
    return intervals.where(ok)


def register_sql(spark: SparkSession, fin_core: str = "fin_core", index_member: str = "index_member") -> None:
    """SQL table functions over existing views, usable as ``FROM days, LATERAL fin_visible_on(days.d)``."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION fin_visible_on(d DATE)
        RETURNS TABLE (code STRING, report_date DATE, pub_date DATE, net_profit_parent DOUBLE)
        RETURN SELECT code, max(report_date), max_by(pub_date, report_date), max_by(net_profit_parent, report_date)
               FROM {fin_core} WHERE report_date <= d AND pub_date <= d AND pub_date > report_date GROUP BY code""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION index_members_on(idx STRING, d DATE)
        RETURNS TABLE (stock_code STRING, valid_from DATE, valid_to DATE)
        RETURN SELECT stock_code, valid_from, valid_to FROM {index_member}
               WHERE index_code = idx AND valid_from <= d AND (valid_to IS NULL OR valid_to >= d)""")


def register_dividends_sql(spark: SparkSession, dividend: str = "dividend") -> None:
    """``dividend_visible_on(d)`` over a view with visible dates, and ``dividend_ttm_on(d)``, which calls it."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION dividend_visible_on(d DATE)
        RETURNS TABLE (code STRING, report_date DATE, bonus_type STRING, visible_date DATE, plan_progress STRING, bonus_amount_rmb DOUBLE)
        RETURN SELECT code, report_date, bonus_type, top.visible_date, top.plan_progress, top.bonus_amount_rmb FROM (
                 SELECT code, report_date, bonus_type, max(struct(visible_date, plan_progress, bonus_amount_rmb)) AS top FROM {dividend}
                 WHERE visible_date <= d AND (bonus_cancel_pub_date IS NULL OR bonus_cancel_pub_date > d) GROUP BY code, report_date, bonus_type)""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION dividend_ttm_on(d DATE)
        RETURNS TABLE (code STRING, bonus_amount_wan_rmb DOUBLE, n_plan BIGINT)
        RETURN SELECT code, sum(bonus_amount_rmb), count(*) FROM dividend_visible_on(d)
               WHERE bonus_amount_rmb > 0 AND visible_date > date_sub(d, 365) GROUP BY code""")


def register_market_sql(spark: SparkSession, state: str = "market_state") -> None:
    """``market_state_on(d)`` over a view of ``market_state``: the day's limits, suspensions and limit touches.

    The view is a plan, not a table, so the day reaches the scans of limits, bars and suspensions.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION market_state_on(d DATE)
        RETURNS TABLE (code STRING, date DATE, high_limit DOUBLE, low_limit DOUBLE, is_paused BOOLEAN, is_st BOOLEAN, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE,
                       limit_up_sealed BOOLEAN, limit_down_sealed BOOLEAN, limit_up_opened BOOLEAN)
        RETURN SELECT code, date, high_limit, low_limit, is_paused, is_st, open, high, low, close, limit_up_sealed, limit_down_sealed, limit_up_opened
               FROM {state} WHERE date = d""")


def payout_ratio(ttm: DataFrame, fin: DataFrame) -> DataFrame:
    """Announced cash over visible profit, both as known on one day."""
    return ttm.join(fin.select("code", "net_profit_parent"), "code").withColumn(
        "payout", safe_div(F.col("bonus_amount_wan_rmb"), F.col("net_profit_parent"))
    )
