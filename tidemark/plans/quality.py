"""Data-quality checks.  Each returns rows (check, value, lo, hi, ok); a gold table is published only if all hold.

Measures of one table are taken in one aggregation and unpivoted; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_div
from tidemark.operators.ranking import exact_quantiles

Bounds = tuple[float | None, float | None]


def measures(df: DataFrame, values: Mapping[str, tuple[Column, Bounds]]) -> DataFrame:
    """Aggregates with bounds as check rows (one pass over the table)."""
    names = list(values)
    one = df.agg(*[values[n][0].cast("double").alias(n) for n in names])

    def bound(x: float | None) -> str:
        return "CAST(NULL AS DOUBLE)" if x is None else f"{float(x)!r}D"

    rows = ", ".join(f"'{n}', `{n}`, {bound(values[n][1][0])}, {bound(values[n][1][1])}" for n in names)
    return judged(one.selectExpr(f"stack({len(names)}, {rows}) AS (check, value, lo, hi)"))


def judged(rows: DataFrame) -> DataFrame:
    v = F.col("value")
    ok = v.isNotNull() & (F.col("lo").isNull() | (v >= F.col("lo"))) & (F.col("hi").isNull() | (v <= F.col("hi")))
    return rows.withColumn("ok", ok)


def all_checks(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def rate(cond: Column) -> Column:
    """Share of rows where the condition holds; NULL counts as no."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def null_rate(col: str) -> Column:
    return rate(F.col(col).isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_check(df: DataFrame, keys: Sequence[str], name: str = "duplicate_keys") -> DataFrame:
    return measures(duplicate_keys(df, keys), {name: (F.count(F.lit(1)), (0, 0))})


NORMAL, TRADED = "正常上市", ("正常上市", "ST", "*ST")  # fixed values: public_status


def unlisted(df: DataFrame, allow: DataFrame | None) -> DataFrame:
    """Rows of ``df`` whose (jq_code, date) is not on the allow-list."""
    return df if allow is None else df.join(allow.select("jq_code", "date"), ["jq_code", "date"], "left_anti")


def panel_checks(panel: DataFrame, source_rows: DataFrame, allow_vwap: DataFrame | None = None, early_codes: Sequence[str] = ()) -> DataFrame:
    """Row count against the source, key, look-ahead, nulls, outliers, average prices, limit rule, listing days.

    ``allow_vwap`` lists known (jq_code, date) whose average price lies below the low; ``early_codes`` reused codes with bars
    before their listing.
    """
    vwap = safe_div(F.col("amount"), F.col("volume_shares"))
    traded = (F.col("volume_shares") > 0) & (F.col("amount") > 0) & (F.col("low") > 0)
    dated = F.col("list_date").isNotNull()
    early = F.when(F.col("listed_days") < 0, F.col("jq_code"))
    # the list is asked for suspects only, so the panel is not shuffled for it
    below = panel.where(traded & (F.col("amount") > 10_000) & (vwap < F.col("low") * 0.99)).select("jq_code", "date")
    body = measures(panel, {
        "future_filings": (F.count_if(F.col("fin_pub_date") > F.col("date")), (0, 0)),
        "return_outliers": (rate(F.abs("ret_1d") > 0.45), (None, 0.0001)),
        "vwap_above_high": (F.count_if(traded & (vwap > F.col("high") * 1.01)), (None, 500)),
        "codes_before_listing": (F.count_distinct(F.when(~early.isin(*early_codes), early) if early_codes else early), (0, 0)),
        "limit_rule_ok": (rate(F.col("limit_rule_ok")), (0.999, None)),
        "close_hfq_null": (null_rate("close_hfq"), (None, 0.001)),
        "floatmv_null": (null_rate("floatmv"), (None, 0.02)),
        "sw_l1_name_null": (null_rate("sw_l1_name"), (None, 0.05)),
        "fin_report_date_null": (F.avg(F.when(dated, F.col("fin_report_date").isNull().cast("double"))), (None, 0.02)),
    })
    n = panel.agg(F.count(F.lit(1)).cast("double").alias("value"))
    src = source_rows.agg(F.count(F.lit(1)).cast("double").alias("lo"))
    rows = n.crossJoin(src).select(F.lit("row_count").alias("check"), "value", "lo", F.col("lo").alias("hi"))
    low = measures(unlisted(below, allow_vwap), {"vwap_below_low": (F.count(F.lit(1)), (0, 0))})
    return all_checks(body, low, judged(rows), key_check(panel, ["date", "jq_code"]))


def identity_checks(panel: DataFrame) -> DataFrame:
    """An annual report's trailing profit is its own, a first quarter's single profit the cumulative one; gaps are few."""
    off = lambda x: F.abs(F.col(x) - F.col("net_profit_parent")) > 1
    return measures(panel, {
        "annual_ttm": (F.count_if((F.month("fin_report_date") == 12) & off("np_ttm")), (0, 0)),
        "first_quarter": (F.count_if((F.quarter("fin_report_date") == 1) & off("np_q")), (0, 0)),
        "np_q_null": (F.avg(F.when(F.col("fin_report_date").isNotNull(), F.col("np_q").isNull().cast("double"))), (None, 0.05)),
    })


#: Medians that a panel is expected to have, and the share of missing pb.
VALUATION: dict[str, Bounds] = {"pb": (1.0, 5.0), "pe_ttm": (15.0, 60.0), "roe_ttm": (0.02, 0.15)}


def valuation_checks(panel: DataFrame, since: str | None = "2010-01-01", bounds: Mapping[str, Bounds] = VALUATION) -> DataFrame:
    rows = panel if since is None else panel.where(F.col("date") >= F.to_date(F.lit(since)))
    parts = [measures(rows, {"pb_null": (null_rate("pb"), (None, 0.10))})]
    for name, (lo, hi) in bounds.items():
        mid = exact_quantiles(rows.select(name), [], name, {"value": 0.5})
        parts.append(judged(mid.select(F.lit(f"{name}_median").alias("check"), "value", F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi"))))
    return all_checks(*parts)


def daily_count_checks(panel: DataFrame, since: str | None = "2015-01-01", p05: float = 2000, median: Bounds = (2500, 6000), most: float = 6500) -> DataFrame:
    """Codes a day: the 5 % quantile, so that real days of suspension do not count, the median and the maximum."""
    rows = panel if since is None else panel.where(F.col("date") >= F.to_date(F.lit(since)))
    days = rows.groupBy("date").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return measures(days, {"daily_p05": (F.percentile("n", 0.05), (p05, None)), "daily_median": (F.percentile("n", 0.5), median), "daily_max": (F.max("n"), (None, most))})


def turnover_checks(panel: DataFrame, since: str | None = "2005-01-01", year_most: float = 20, day_least: float = 0.2, day_codes: int = 500) -> DataFrame:
    """Years whose median turnover is too high, and days (of over ``day_codes`` codes) on which it is too low."""
    rows = panel.where((F.col("turnover") > 0) & F.col("public_status").isin(*TRADED)).select("date", F.year("date").alias("year"), "turnover")
    years = exact_quantiles(rows, ["year"], "turnover", {"p50": 0.5})
    days = exact_quantiles(rows if since is None else rows.where(F.col("date") >= F.to_date(F.lit(since))), ["date"], "turnover", {"p50": 0.5})
    return all_checks(
        measures(years, {"years_too_high": (F.count_if(F.col("p50") > year_most), (0, 0))}),
        measures(days, {"days_too_low": (F.count_if((F.col("p50") < day_least) & (F.col("n") > day_codes)), (0, 0))}),
    )


def share_truth_checks(panel: DataFrame, truth: DataFrame, since: str | None = "2016-01-01") -> DataFrame:
    """Values against an independent share table: agreement within 1 %, float shares understated by over 10 %, total shares."""
    j = panel.where((F.col("close_bfq") > 0) & (F.col("floatmv") > 0))
    j = j if since is None else j.where(F.col("date") >= F.to_date(F.lit(since)))
    j = j.join(truth.select("jq_code", "date", F.col("float_sh").alias("__float"), F.col("total_sh").alias("__total")), ["jq_code", "date"])
    mine, whole = F.col("floatmv") / F.col("close_bfq"), F.col("totalmv") / F.col("close_bfq")
    return measures(j, {
        "float_agreement": (rate(F.abs(safe_div(mine, F.col("__float")) - 1) < 0.01), (0.99, None)),
        "float_understated": (rate(mine < F.col("__float") * 0.9), (None, 0.005)),
        "total_agreement": (rate(whole.isNull() | (F.abs(safe_div(whole, F.col("__total")) - 1) < 0.01)), (0.99, None)),
    })


def guard_activity(changes: DataFrame) -> DataFrame:
    """How often the periodic-report guard would act: within a known band, neither dead nor everywhere."""
    from tidemark.plans.shares import PERIODIC

    w = Window.partitionBy("code").orderBy("change_date", "pub_date").rowsBetween(Window.unboundedPreceding, 0)
    tradable, reason = F.col("share_trade_total"), F.col("change_reason")
    event = F.last(F.when(reason != PERIODIC, tradable), ignorenulls=True).over(w)
    df = changes.where((tradable > 0) & F.col("pub_date").isNotNull()).withColumn("__acts", (reason == PERIODIC) & (event > tradable))
    return measures(df, {"guard_activity": (rate(F.col("__acts")), (0.04, 0.10))})


def medians_by_year(panel: DataFrame, col: str) -> DataFrame:
    return exact_quantiles(panel.select(F.year("date").alias("year"), col), ["year"], col, {"p50": 0.5})


def limit_breaches(panel: DataFrame, allow: DataFrame | None = None, since: str | None = "2007-01-01") -> DataFrame:
    """Adjusted returns over 1.1 times the limit: normal status, after the fifth bar, at most five days since the last.

    ``allow`` lists known (jq_code, date).
    """
    w = Window.partitionBy("jq_code").orderBy("date")
    df = panel.withColumns({"__bar": F.row_number().over(w), "__gap": F.datediff("date", F.lag("date").over(w))})
    bad = (F.col("limit_pct") > 0) & (F.abs("ret_1d") > F.col("limit_pct") * 1.1) & (F.col("public_status") == NORMAL) & (F.col("__bar") > 5) & (F.col("__gap") <= 5)
    if since is not None:
        bad = bad & (F.col("date") >= F.to_date(F.lit(since)))
    return unlisted(df.where(bad), allow).select("jq_code", "date", "ret_1d", "limit_pct")


def mass_move_days(bars: DataFrame, at_least: int = 50, move: float = 0.5) -> DataFrame:
    """Days on which many symbols move by more than half: a scale change, not a market."""
    w = Window.partitionBy("symbol").orderBy("date")
    r = safe_div(F.col("close"), F.lag("close").over(w)) - 1
    return (
        bars.withColumn("__r", r).groupBy("date").agg(F.count_if(F.abs(F.col("__r")) > move).alias("n_moved"), F.count("__r").alias("n"))
        .where(F.col("n_moved") >= at_least)
    )


def mass_jump_days(bars: DataFrame, at_least: int = 50, ratio: float = 2.0) -> DataFrame:
    """Days on which many symbols close at over ``ratio`` times the previous close or under its inverse; ``bars`` of one class."""
    w = Window.partitionBy("symbol").orderBy("date")
    before = F.lag("close").over(w)
    times = F.when(before > 0, F.col("close") / before)
    days = bars.withColumn("__x", times).groupBy("date").agg(F.count_if((F.col("__x") > ratio) | (F.col("__x") < 1 / ratio)).alias("n_jumped"), F.count("__x").alias("n"))
    return days.where(F.col("n_jumped") >= at_least)


def safe_end(bars: DataFrame, bad_days: DataFrame) -> DataFrame:
    """(first_bad, safe_end): the last day before the first bad one; the last day of all where none is bad."""
    first = bad_days.agg(F.min("date").alias("first_bad"))
    good = bars.crossJoin(F.broadcast(first)).where(F.col("first_bad").isNull() | (F.col("date") < F.col("first_bad")))
    return first.crossJoin(F.broadcast(good.agg(F.max("date").alias("safe_end"))))


#: The classes whose days are judged, and how many anomalies of a kind halt the load of a day.
HALT_CLASSES = ("stock", "etf")
HALT_AT = {"n_price": 50, "n_volume": 300, "n_amount": 300}


def halt_verdicts(bars: DataFrame, symbol_class: DataFrame, classes: Sequence[str] = HALT_CLASSES, halt_at: Mapping[str, int] | None = None, window: int = 20, pct: float = 50.0, ratio: float = 20.0) -> DataFrame:
    """``day_anomalies`` of the given classes with ``halt``: whether any count reaches its limit.

    Whole symbols are left out before the windows, so the others' windows are the same.
    """
    ours = bars.join(symbol_class.where(F.col("class").isin(*classes)).select("symbol").distinct(), "symbol", "left_semi")
    limits = HALT_AT if halt_at is None else halt_at
    return day_anomalies(ours, window, pct, ratio).withColumn("halt", reduce(lambda a, b: a | b, [F.col(c) >= n for c, n in limits.items()]))


def day_anomalies(bars: DataFrame, window: int = 20, pct: float = 50.0, ratio: float = 10.0) -> DataFrame:
    """Per day: symbols whose price moved over ``pct`` percent or whose volume or amount left its recent median.

    The median of the previous ``window`` rows is short by definition, so the frame stays small.
    """
    w = Window.partitionBy("symbol").orderBy("date")
    before = w.rowsBetween(-window, -1)
    half = F.lit(0.5)
    df = bars.withColumns({
        "__pc": F.lag("close").over(w), "__vm": F.percentile("volume", half).over(before), "__am": F.percentile("amount", half).over(before),
    })
    chg = (safe_div(F.col("close"), F.col("__pc")) - 1) * 100
    vr, ar = safe_div(F.col("volume"), F.col("__vm")), safe_div(F.col("amount"), F.col("__am"))

    def odd(x: Column) -> Column:
        return (x > ratio) | (x < 1 / ratio)

    return df.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("__pc") > 0) & (F.abs(chg) > pct)).alias("n_price"),
        F.count_if(odd(vr)).alias("n_volume"), F.count_if(odd(ar)).alias("n_amount"),
    )


def scale_guard(old: DataFrame, new: DataFrame, days: int = 250, lo: float = 0.2, hi: float = 5.0) -> DataFrame:
    """Median ratio of two versions over the last days of the old one must stay within (0.2, 5)."""
    last = old.agg(F.date_sub(F.max("date"), days).alias("__from"))
    j = old.select("symbol", "date", "close").join(new.select("symbol", "date", F.col("close").alias("__new")), ["symbol", "date"])
    j = j.crossJoin(F.broadcast(last)).where(F.col("date") > F.col("__from")).withColumn("ratio", safe_div(F.col("__new"), F.col("close")))
    q = exact_quantiles(j, [], "ratio", {"value": 0.5})
    return judged(q.select(F.lit("scale_ratio").alias("check"), "value", F.lit(lo).alias("lo"), F.lit(hi).alias("hi")))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], col: str, tolerance: float = 0.01) -> DataFrame:
    """Two sources of one quantity: overlap, share within the tolerance, median ratio."""
    j = a.select(*keys, F.col(col).alias("__a")).join(b.select(*keys, F.col(col).alias("__b")), list(keys))
    j = j.withColumn("ratio", safe_div(F.col("__a"), F.col("__b"))).where(F.col("ratio").isNotNull())
    share = j.agg(rate(F.abs(F.col("ratio") - 1) <= tolerance).alias("share_close"))
    return exact_quantiles(j, [], "ratio", {"median_ratio": 0.5}).crossJoin(F.broadcast(share))


def baseline_check(now: DataFrame, base: DataFrame, exceptions: Mapping[str, str] | None = None) -> DataFrame:
    """(item, kind, value) against a recorded baseline: counts may only grow, values must not change."""
    j = base.select("item", "kind", F.col("value").alias("base")).join(now.select("item", "value"), "item", "left")
    ok = F.when(F.col("kind") == "count", F.col("value") >= F.col("base")).otherwise(F.col("value") == F.col("base"))
    named = F.col("item").isin(*exceptions) if exceptions else F.lit(False)
    return j.withColumn("ok", F.coalesce(ok, F.lit(False)) | named)


def layer_watermarks(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest date and row count per layer."""
    rows = [df.agg(F.max(day).alias("newest"), F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(name)) for name, (df, day) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), rows).select("layer", "newest", "n")


def lost_or_filtered(raw: DataFrame, std: DataFrame, keys: Sequence[str], rule: Column) -> DataFrame:
    """Raw rows missing from the next layer, split into dropped by the rule and lost."""
    gone = raw.join(std.select(*keys).distinct(), list(keys), "left_anti")
    return gone.agg(F.count_if(~rule).alias("n_filtered"), F.count_if(rule).alias("n_lost"))


def freshness(calendar: DataFrame, tables: Mapping[str, tuple[DataFrame, str]], today: str) -> DataFrame:
    """Lag of each table in trading days and in calendar days."""
    marks = layer_watermarks(tables)
    day = F.to_date(F.lit(today))
    cal = calendar.where(F.col("date") <= day).select("date")
    lag = marks.join(F.broadcast(cal), F.col("date") > F.col("newest"), "left")
    return lag.groupBy("layer", "newest").agg(F.count("date").alias("lag_trading_days")).withColumn("lag_days", F.datediff(day, "newest"))


def complete_days(bars: DataFrame, share: float = 0.95) -> DataFrame:
    """A day is complete when it has at least 95 % of the previous day's symbols."""
    daily = bars.groupBy("date").agg(F.count(F.lit(1)).alias("n"))  # one row per trading day
    prev = F.lag("n").over(Window.orderBy("date"))
    return daily.withColumn("n_prev", prev).withColumn("complete", F.coalesce(F.col("n") >= F.col("n_prev") * share, F.lit(True)))


def table_equality(a: DataFrame, b: DataFrame, cols: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """Rows, non-NULL counts, minima and maxima of numeric columns in two copies."""

    def stats(df: DataFrame, tag: str) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("rows")]
        for x in cols:
            aggs += [F.count(x).alias(f"n_{x}"), F.min(x).cast("double").alias(f"lo_{x}"), F.max(x).cast("double").alias(f"hi_{x}")]
        one = df.agg(*aggs)
        rows = ", ".join(f"'{x}', rows, `n_{x}`, `lo_{x}`, `hi_{x}`" for x in cols)
        return one.selectExpr(f"stack({len(cols)}, {rows}) AS (column_name, rows_{tag}, n_{tag}, lo_{tag}, hi_{tag})")

    j = stats(a, "a").join(F.broadcast(stats(b, "b")), "column_name")
    close = (F.abs(F.col("lo_a") - F.col("lo_b")) <= tolerance) & (F.abs(F.col("hi_a") - F.col("hi_b")) <= tolerance)
    return j.withColumn("equal", (F.col("rows_a") == F.col("rows_b")) & (F.col("n_a") == F.col("n_b")) & close)


def differing_rows(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per column how many keyed rows differ (NULL equals NULL, NaN equals NaN); a missing row differs everywhere."""
    x, y = a.select(*keys, F.struct(*cols).alias("__a")), b.select(*keys, F.struct(*cols).alias("__b"))
    j = x.join(y, list(keys), "full")
    one = j.agg(*[F.count_if(~F.col(f"__a.{c}").eqNullSafe(F.col(f"__b.{c}")) | F.col("__a").isNull() | F.col("__b").isNull()).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column_name", "n_different")


def unit_by_third(rows: DataFrame, by: Sequence[str], implied: str, candidates: Sequence[float], tolerance: float = 0.15) -> DataFrame:
    """(by, n, median, unit): the unit that a third quantity gives away, per source.

    ``implied`` is the scale each row implies (two quantities of the source against one it knows nothing of). The candidate
    with the least relative error to its median wins; none does when the error exceeds ``tolerance`` or two are as close.
    """
    known = rows.where((F.col(implied) > 0) & (F.col(implied) < float("inf")))
    got = exact_quantiles(known, by, implied, {"median": 0.5})
    errors = F.array(*[F.struct(F.abs(F.col("median") / F.lit(float(c)) - 1).alias("error"), F.lit(float(c)).alias("unit")) for c in candidates])
    least = F.array_sort("__e")
    clear = F.get(least, F.lit(1)).isNull() | (F.get(least, F.lit(1))["error"] > F.get(least, F.lit(0))["error"])
    fits = F.get(least, F.lit(0))["error"] <= tolerance
    return got.withColumn("__e", errors).select(*by, "n", "median", F.when(clear & fits, F.get(least, F.lit(0))["unit"]).alias("unit"))
