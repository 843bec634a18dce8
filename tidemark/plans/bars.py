"""Silver bar layer: code mapping, adjusted prices, calendars, class filters, unit repair."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import round_half

# Exchange prefix -> code suffix.
EXCHANGE_SUFFIX = {"sh": ".XSHG", "sz": ".XSHE", "bj": ".BJSE"}
# Symbol prefixes of exchange-traded funds.
FUND_PREFIXES = ("sh5", "sz15", "sz16")


def unified_code(symbol: Column) -> Column:
    """``sh600000`` -> ``600000.XSHG``."""
    out = None
    for prefix, suffix in EXCHANGE_SUFFIX.items():
        hit, val = symbol.startswith(prefix), F.concat(F.substring(symbol, 3, 64), F.lit(suffix))
        out = F.when(hit, val) if out is None else out.when(hit, val)
    return out


def fund_segment(symbol: Column) -> Column:
    """Does the symbol lie in an exchange-traded fund segment?"""
    return reduce(lambda a, b: a | b, [symbol.startswith(p) for p in FUND_PREFIXES])


def code_map(bars: DataFrame, symbol_class: DataFrame, universe: DataFrame) -> DataFrame:
    """Full join of traded symbols and known codes, each with the way it matched."""
    traded = (
        bars.select("symbol").distinct()
        .join(symbol_class.where(F.col("class").isin("stock", "etf", "index", "block")), "symbol")
        .select("class", F.col("symbol").alias("tdx_symbol"), unified_code(F.col("symbol")).alias("__code"))
    )
    known = universe.select(F.col("code").alias("__known"))
    sym, known_col, cls = F.col("tdx_symbol"), F.col("__known"), F.col("class")
    match = (
        F.when(sym.isNull(), "pit_only")
        .when(known_col.isNotNull(), "matched")
        .when(sym.startswith("bj"), "kline_only_bj")
        .when(sym.startswith("sh900") | sym.startswith("sz200"), "kline_only_bshare")
        .when(cls == "etf", "kline_only_etf")
        .when(cls == "index", "kline_only_index")
        .when(cls == "block", "kline_only_block")
        .otherwise("kline_only_other")
    )
    return traded.join(known, F.col("__code") == known_col, "full").select(
        F.coalesce(cls, F.lit("pit_only")).alias("class"),
        sym,
        F.coalesce("__code", "__known").alias("jq_code"),
        match.alias("match_type"),
        (sym.isNotNull() & ~F.coalesce(sym, F.lit("")).startswith("bj")).alias("included"),
    )


def with_factor(bars: DataFrame, factor: DataFrame) -> DataFrame:
    """Raw bars with their adjustment factor; a missing factor means 1."""
    return bars.join(factor.select("symbol", "date", "hfq_factor"), ["symbol", "date"], "left").withColumn(
        "hfq_factor", F.coalesce("hfq_factor", F.lit(1.0))
    )


PRICES = ("open", "high", "low", "close")


def backward_adjusted(bars: DataFrame, factor: DataFrame) -> DataFrame:
    df = with_factor(bars, factor)
    return df.select(
        "symbol", "date", *[round_half(F.col(p) * F.col("hfq_factor"), 2).alias(p) for p in PRICES], "volume", "amount", "hfq_factor"
    )


def forward_adjusted(bars: DataFrame, factor: DataFrame) -> DataFrame:
    """Prices scaled so that the latest factor of each symbol is 1."""
    latest = factor.groupBy("symbol").agg(F.max_by("hfq_factor", "date").alias("__lf"))
    df = with_factor(bars, factor).join(latest, "symbol", "left")
    last = F.coalesce("__lf", F.lit(1.0))
    return df.select(
        "symbol", "date", *[round_half(F.col(p) * F.col("hfq_factor") / last, 2).alias(p) for p in PRICES], "volume", "amount"
    )


def matched_stocks(bars: DataFrame, codes: DataFrame) -> DataFrame:
    """Bars of stocks that exist in the point-in-time dimensions, foreign-currency shares left out."""
    keep = codes.where((F.col("class") == "stock") & (F.col("match_type") == "matched")).select(
        F.col("tdx_symbol").alias("symbol"), "jq_code"
    )
    return bars.where(~F.col("symbol").startswith("sh90") & ~F.col("symbol").startswith("sz20")).join(keep, "symbol")


def volume_divisor(low: Column, high: Column, volume: Column, amount: Column) -> Column:
    """What raw volume must be divided by to give shares, judged by where the average price falls."""
    live = (low > 0) & (volume > 0) & (amount > 0)
    vol = volume.cast("double")
    return (
        F.when(live & (amount * 100.0 < low * 0.99 * vol), 10000.0)
        .when(
            live & (high > 0) & (amount * 100.0 > high * 1.01 * vol)
            & (amount >= low * 0.99 * vol) & (amount <= high * 1.01 * vol),
            1.0,
        )
        .otherwise(100.0)
    )


def repaired_turnover(turnover: Column, divisor: Column) -> Column:
    """Turnover follows the volume unit; the usual case is passed through untouched."""
    return F.when(divisor == 10000.0, turnover / 100.0).when(divisor == 1.0, turnover * 100.0).otherwise(turnover)


def trading_calendar(bars: DataFrame) -> DataFrame:
    """Distinct trading days with a running number.  One row per day of history, so one task numbers them."""
    return bars.select("date").distinct().withColumn("seq", F.row_number().over(Window.orderBy("date")).cast("long"))


def weekday_calendar(spark_one_row: DataFrame, holidays: DataFrame) -> DataFrame:
    """Weekdays between ``first`` and ``last`` of a one-row frame, holidays removed."""
    days = spark_one_row.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.where(~F.dayofweek("date").isin(1, 7)).join(holidays.select("date"), "date", "left_anti")


def extend_calendar(actual: DataFrame, holidays: DataFrame, until: Column) -> DataFrame:
    """Past days from the bars, future days from weekdays minus holidays."""
    last = actual.agg(F.date_add(F.max("date"), 1).alias("first"), F.max(until).alias("last"))
    last = last.where(F.col("first") <= F.col("last"))
    future = weekday_calendar(last, holidays)
    return actual.select("date", F.lit(False).alias("is_future")).unionByName(future.withColumn("is_future", F.lit(True)))


def calendar_differences(actual: DataFrame, rule: DataFrame) -> DataFrame:
    """Days only one of two calendars has; a rule is trusted for the future when this is empty on the past."""
    a, b = actual.select("date"), rule.select("date")
    return a.exceptAll(b).withColumn("only_in", F.lit("actual")).unionByName(
        b.exceptAll(a).withColumn("only_in", F.lit("rule"))
    )


def verified_extension(actual: DataFrame, holidays: DataFrame, until: Column) -> DataFrame:
    """``extend_calendar`` that fails when weekdays less holidays are not the actual days of the past, telling how many differ."""
    span = actual.agg(F.min("date").alias("first"), F.max("date").alias("last")).where("first is not null")
    wrong = calendar_differences(actual, weekday_calendar(span, holidays)).agg(F.count_if(F.col("only_in") == "actual").alias("missing"), F.count_if(F.col("only_in") == "rule").alias("extra"))
    told = F.format_string("the holiday rule fails on the past: %d trading days it misses, %d it invents", "missing", "extra")
    checked = extend_calendar(actual, holidays, until).crossJoin(F.broadcast(wrong))  # one row
    day = F.when(F.col("missing") + F.col("extra") > 0, F.raise_error(told).cast("date")).otherwise(F.col("date"))
    return checked.select(day.alias("date"), "is_future")


#: Classes of the bar layer, its first day and the exchange without point-in-time dimensions.
BAR_CLASSES = ("stock", "etf", "index", "block")
BAR_START = "2003-01-01"
BAR_EXCLUDED = ("bj",)


def class_bars(bars: DataFrame, symbol_class: DataFrame, start: str = BAR_START, excluded: Sequence[str] = BAR_EXCLUDED) -> DataFrame:
    """Bars of the known classes from ``start`` on, with class and year, the partitions they are kept and frozen by."""
    ours = symbol_class.where(F.col("class").isin(*BAR_CLASSES)).select("symbol", "class")
    kept = bars.where(F.col("date") >= F.to_date(F.lit(start)))
    for prefix in excluded:
        kept = kept.where(~F.col("symbol").startswith(prefix))
    return kept.join(ours, "symbol").withColumn("year", F.year("date"))
