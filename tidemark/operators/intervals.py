"""Validity intervals: building them from events, snapshots and day lists, and looking days up in them.

Intervals are half-open ``[valid_from, valid_to)`` with NULL meaning open, unless ``closed`` says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def close_with_next(df: DataFrame, by: Sequence[str], start: str, out: str = "valid_to") -> DataFrame:
    """Each event ends where the next one of the same key starts."""
    return df.withColumn(out, F.lead(start).over(Window.partitionBy(*by).orderBy(start)))


def compress_changes(df: DataFrame, by: Sequence[str], order: str, watch: Sequence[str]) -> DataFrame:
    """Keep snapshots whose watched columns differ from the previous snapshot of the key, as intervals.

    All watched columns are compared together, NULL counting as an empty value.
    """
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in watch])
    w = Window.partitionBy(*by).orderBy(order)
    changed = (
        df.withColumn("__key", key)
        .withColumn("__prev", F.lag("__key").over(w))
        .where(~F.col("__key").eqNullSafe(F.col("__prev")))
        .drop("__key", "__prev")
    )
    return close_with_next(changed.withColumn("valid_from", F.col(order)), by, "valid_from").drop(order)


def day_islands(df: DataFrame, by: str, day: str) -> DataFrame:
    """Runs of consecutive calendar days as half-open intervals."""
    days = df.select(by, day).where(F.col(by).isNotNull()).distinct()
    rn = F.row_number().over(Window.partitionBy(by).orderBy(day))
    return (
        days.withColumn("__run", F.date_sub(F.col(day), rn))
        .groupBy(by, "__run")
        .agg(F.min(day).alias("valid_from"), F.date_add(F.max(day), 1).alias("valid_to"))
        .drop("__run")
    )


def gap_segments(df: DataFrame, by: Sequence[str], day: str, max_gap: int) -> DataFrame:
    """Runs of snapshots in which neighbours lie at most ``max_gap`` days apart.

    ``valid_to`` is the last sighting, NULL for segments that reach the last snapshot of the whole table.
    """
    seen = df.select(*by, day).distinct()
    w = Window.partitionBy(*by).orderBy(day)
    gap = F.datediff(day, F.lag(day).over(w))
    starts = seen.withColumn("__new", F.when(gap.isNull() | (gap > max_gap), 1).otherwise(0))
    segs = (
        starts.withColumn("__seg", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*by, "__seg")
        .agg(F.min(day).alias("valid_from"), F.max(day).alias("last_seen"))
        .drop("__seg")
    )
    end = df.agg(F.max(day).alias("__end"))  # one row
    return segs.crossJoin(F.broadcast(end)).select(
        *by,
        "valid_from",
        "last_seen",
        F.when(F.col("last_seen") < F.col("__end"), F.col("last_seen")).alias("valid_to"),
        (F.col("last_seen") >= F.col("__end")).alias("is_current"),
    )


def interval_lookup(
    left: DataFrame,
    intervals: DataFrame,
    key: dict[str, str],
    day: str,
    cols: dict[str, str],
    *,
    start: str = "valid_from",
    end: str = "valid_to",
    closed: bool = False,
    how: str = "left",
) -> DataFrame:
    """Equi-join on the key with the day inside the interval (an ordinary join, so AQE may split it)."""
    r = intervals.select(
        *[F.col(rk).alias(f"__k_{lk}") for lk, rk in key.items()],
        F.col(start).alias("__from"),
        F.col(end).alias("__to"),
        *[F.col(src).alias(out) for out, src in cols.items()],
    )
    cond = (F.col("__from") <= F.col(day)) & (
        F.col("__to").isNull() | (F.col("__to") >= F.col(day) if closed else F.col("__to") > F.col(day))
    )
    for lk in key:
        cond = cond & (F.col(lk) == F.col(f"__k_{lk}"))
    drops = [f"__k_{lk}" for lk in key] + ["__from", "__to"]
    return left.join(r, cond, how).drop(*drops)


def overlaps(df: DataFrame, by: Sequence[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows whose interval begins before the previous one of the key has ended (open ends included)."""
    w = Window.partitionBy(*by).orderBy(start)
    prev_end, prev_start = F.lag(end).over(w), F.lag(start).over(w)
    far = F.to_date(F.lit("9999-12-31"))
    return (
        df.withColumn("__pe", F.when(prev_start.isNotNull(), F.coalesce(prev_end, far)))
        .where(F.col("__pe") > F.col(start))
        .drop("__pe")
    )


def coverage(intervals: DataFrame, lifetimes: DataFrame, key: str, until: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """(key, days_alive, days_covered, share) for every row of ``lifetimes`` (key, born, died): how much of each life the intervals cover.

    Lives and intervals are half-open, an open end is cut at ``until``. Overlapping intervals count once: sorted by start, each
    adds what lies beyond the furthest end so far. A key without intervals has 0 covered days; one whose life is empty or
    whose birth is unknown has no share.
    """
    last = F.to_date(F.lit(until))
    lives = lifetimes.select(key, F.col("born").alias("__b"), F.least(F.coalesce("died", last), last).alias("__d"))
    cut = intervals.select(key, F.col(start).alias("__s"), F.coalesce(F.col(end), last).alias("__e")).join(lives.where(F.col("__b").isNotNull()), key)
    cut = cut.select(key, F.greatest("__s", "__b").alias("__s"), F.least("__e", "__d").alias("__e")).where(F.col("__s") < F.col("__e"))
    so_far = F.max("__e").over(Window.partitionBy(key).orderBy("__s", "__e").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.datediff("__e", F.greatest("__s", so_far)), F.lit(0))
    covered = cut.withColumn("__n", fresh).groupBy(key).agg(F.sum("__n").alias("days_covered"))
    alive = F.when(F.col("__b").isNotNull(), F.greatest(F.datediff("__d", "__b"), F.lit(0))).cast("long").alias("days_alive")
    out = lives.select(key, alive).join(covered, key, "left").withColumn("days_covered", F.coalesce("days_covered", F.lit(0)).cast("long"))
    return out.withColumn("share", F.when(F.col("days_alive") > 0, F.col("days_covered") / F.col("days_alive")))


def alive_counts(lifetimes: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """(day, n_alive): lives (born, died), half-open, that hold each of ``days``; lives of unknown birth do not count.

    Births and deaths are summed by day first, so the running sum goes over one row a calendar day, not over lives.
    """
    known = lifetimes.where(F.col("born").isNotNull() & (F.col("died").isNull() | (F.col("died") > F.col("born"))))
    moves = known.select(F.explode(F.array(F.struct(F.col("born").alias("t"), F.lit(1).alias("by")), F.struct(F.col("died").alias("t"), F.lit(-1).alias("by")))).alias("x"))
    moves = moves.select("x.*").where("t is not null").groupBy("t").agg(F.sum("by").alias("by"))
    asked = days.select(F.col(day).alias("t")).where("t is not null").distinct().withColumn("asked", F.lit(True))
    both = asked.join(moves, "t", "full")
    total = F.sum(F.coalesce("by", F.lit(0))).over(Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0))  # one row a day
    return both.withColumn("n_alive", total).where("asked").select(F.col("t").alias(day), "n_alive")
