"""Factor catalogue: metadata next to what the stored factor table actually contains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.factors import ALL, Spec, check_ids


def factor_catalog(factor_table: DataFrame, specs: Sequence[Spec] = tuple(ALL)) -> DataFrame:
    """One row per factor: metadata, coverage, range and the year with the lowest coverage.

    One aggregation per year over the wide table (map-side combined to years x factors), then an unpivot of
    that tiny result.
    """
    check_ids(specs)
    ids = [s.id for s in specs]
    aggs = []
    for i in ids:
        aggs += [F.count(i).alias(f"n_{i}"), F.min(i).cast("double").alias(f"lo_{i}"), F.max(i).cast("double").alias(f"hi_{i}")]
    yearly = factor_table.groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    rows = ", ".join(f"'{i}', `n_{i}`, `lo_{i}`, `hi_{i}`" for i in ids)
    long = yearly.selectExpr("year", "rows", f"stack({len(ids)}, {rows}) AS (factor_id, n, lo, hi)")
    cov = F.col("n") / F.col("rows")
    stats = long.groupBy("factor_id").agg(
        F.sum("n").alias("n_values"), (F.sum("n") / F.sum("rows")).alias("coverage"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min_by("year", F.struct(cov, "year")).alias("worst_year"),
    )
    meta = factor_table.sparkSession.createDataFrame(
        [(s.id, s.group, s.formula, s.unit, s.comparable) for s in specs],
        "factor_id string, group string, formula string, unit string, comparable boolean",
    )
    return stats.join(F.broadcast(meta), "factor_id")


def worst_years(factor_table: DataFrame, ids: Sequence[str], k: int = 3) -> DataFrame:
    """The k years with the lowest coverage of each factor (years x factors rows are ranked)."""
    yearly = factor_table.groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("rows"), *[F.count(i).alias(i) for i in ids])
    long = yearly.unpivot(["year", "rows"], list(ids), "factor_id", "n").withColumn("coverage", F.col("n") / F.col("rows"))
    w = Window.partitionBy("factor_id").orderBy("coverage", "year")
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
