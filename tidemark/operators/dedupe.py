"""One row per key by an explicit preference.

Written as an aggregate (``max_by`` over a struct), not as ``row_number``: Spark combines it on the map side,
so a key that owns a third of the table still reaches the reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_max(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the row with the largest ``order`` per key (NULLs lose).  The order must be total per key."""
    rest = [c for c in df.columns if c not in keys]
    top = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(top.alias("__row")).select(
        *[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns]
    )


def keep_min(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    top = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(top.alias("__row")).select(
        *[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns]
    )


def newest_report_per_day(df: DataFrame, code: str = "code", pub: str = "pub_date", report: str = "report_date") -> DataFrame:
    """One row per (code, publication date), the newest period of the day; a restated old period counts from its own day."""
    return keep_max(df.where(F.col(pub).isNotNull()), [code, pub], [report])


def newest_report_asof(df: DataFrame, code: str = "code", pub: str = "pub_date", report: str = "report_date") -> DataFrame:
    """Right side of a filing as-of: unique on (code, pub_date), late restatements of old periods dropped.

    Several periods published on one day keep the newest period; afterwards a row survives only if no newer
    period was known before it (report date equals the running maximum by publication date).
    """
    from pyspark.sql import Window

    one = keep_max(df.where(F.col(pub).isNotNull()), [code, pub], [report])
    w = Window.partitionBy(code).orderBy(pub).rowsBetween(Window.unboundedPreceding, 0)
    return one.withColumn("__top", F.max(report).over(w)).where(F.col(report) == F.col("__top")).drop("__top")
