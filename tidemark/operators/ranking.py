"""Exact ranks and quantiles without gathering a group in one task.

Values are first counted (map-side combined), then cut into ranges at approximate quantiles of their group.
Counts inside a range accumulate in a window over (group, range); ranges are offset by the totals of the
ranges below, one small row each.  The approximate cut only decides the parallelism, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

LEAST_RANGES = 32


def _cuts_below(df: DataFrame, value: str, most: int) -> DataFrame:
    """``__range`` counts the ascending ``__cuts``, ``most`` at most, below the value, by halving: the steps of a row grow with the logarithm."""
    for step in (2**k for k in reversed(range(most.bit_length()))):
        # beyond the last cut there is NULL, which is not below
        at = F.col("__range")
        df = df.withColumn("__range", at + F.when(F.get("__cuts", at + (step - 1)) < F.col(value), step).otherwise(0))
    return df


def cumulative_counts(df: DataFrame, by: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """(by..., value, n, below): how often each value occurs and how many rows of its group lie below it.

    ``ranges`` is the number of tasks a group may use; by default as many as a shuffle has, 32 at least.
    """
    by = list(by)
    ranges = ranges or max(LEAST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # the counts are read three times below, so they are written once
    counts = cut_lineage(df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n")))
    probs = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = counts.groupBy(*by).agg(F.percentile_approx(value, probs, F.lit(10 * ranges)).alias("__cuts"))
    # the cut table has one row per group; a single group is one row
    placed = counts.join(cuts, by) if by else counts.crossJoin(F.broadcast(cuts))
    placed = _cuts_below(placed.withColumn("__range", F.lit(0)), value, ranges - 1).drop("__cuts")
    totals = placed.groupBy(*by, "__range").agg(F.sum("n").alias("__total"))
    up = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "__range", F.coalesce(F.sum("__total").over(up), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*by, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("__in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, [*by, "__range"])
        .select(*by, value, "n", (F.col("__in") + F.col("__offset")).alias("below"))
    )


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Interpolated quantiles (continuous definition) per group, with the row count ``n``."""
    by = list(by)
    acc = cumulative_counts(df, by, value)
    totals = acc.groupBy(*by).agg(F.sum("n").alias("__rows"))
    acc = acc.join(totals, by) if by else acc.crossJoin(F.broadcast(totals))
    upto = F.col("below") + F.col("n")

    def at(pos: Column) -> Column:
        return F.min(F.when(upto > pos, F.col(value)))

    aggs = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("__rows") - 1)
        aggs += [at(F.floor(pos)).alias(f"__lo_{name}"), at(F.ceil(pos)).alias(f"__hi_{name}")]
    got = acc.groupBy(*by).agg(F.max("__rows").alias("n"), *aggs)
    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return got.select(*by, *out, "n")


def average_ranks(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Join the 1-based average rank of ``value`` within its group onto every row with a value."""
    acc = cumulative_counts(df, by, value).select(
        *by, value, (F.col("below") + (F.col("n") + 1) / 2).cast("double").alias(out)
    )
    return df.join(acc, [*by, value], "inner")


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Rank correlation of two columns over the rows where both are present."""
    # ranking reads its rows twice, so what they are computed from is run once
    both = cut_lineage(df.select(*by, x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull()))
    ranked = average_ranks(cut_lineage(average_ranks(both, by, x, "__rx").drop(x)), by, y, "__ry")
    return ranked.groupBy(*by).agg(F.corr("__rx", "__ry").alias("rank_corr"), F.count(F.lit(1)).alias("n"))


def keep_fraction(df: DataFrame, by: Sequence[str], value: str, tie: str, fraction: float, *, largest: bool = False) -> DataFrame:
    """The ``floor(fraction * n)`` smallest (or largest) rows of each group, ties decided by ``tie`` ascending.

    The cut value is found from counts; only rows equal to it are ordered.
    """
    by = list(by)
    key = "__sort"
    rows = cut_lineage(df.where(F.col(value).isNotNull()).withColumn(key, -F.col(value) if largest else F.col(value)))
    acc = cumulative_counts(rows, by, key)
    totals = acc.groupBy(*by).agg(F.floor(F.sum("n") * F.lit(fraction)).alias("__k"))
    acc = acc.join(totals, by)
    cut = acc.where((F.col("below") < F.col("__k")) & (F.col("below") + F.col("n") >= F.col("__k"))).select(
        *by, F.col(key).alias("__cut"), (F.col("__k") - F.col("below")).alias("__room")
    )
    near = rows.join(cut, by)
    below = near.where(F.col(key) < F.col("__cut"))
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(tie))
    ties = near.where(F.col(key) == F.col("__cut")).withColumn("__rn", rn).where(F.col("__rn") <= F.col("__room")).drop("__rn")
    return below.unionByName(ties).drop(key, "__cut", "__room")
