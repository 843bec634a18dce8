"""Incremental merge by natural key, and the guard for whole-partition replacement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP_SHARE = 0.95


def conform_increment(old: DataFrame, inc: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Increment in the old table's columns and types.  A missing column is an error, an extra one is ignored.

    What does not convert becomes NULL; ``increment_losses`` counts it.  In ``keys`` it is refused: as NULL it would meet, and
    replace, the old row whose key is NULL.
    """
    missing = [c for c in old.columns if c not in inc.columns]
    if missing:
        raise ValueError(f"increment lacks columns {missing}")

    def cast(c: str, t: str):
        new = F.col(c).try_cast(t)
        if c not in keys:
            return new.alias(c)
        bad = F.col(c).isNotNull() & new.isNull()
        say = F.concat(F.lit(f"key {c} does not convert to {t}: "), F.col(c).cast("string"))
        return F.when(bad, F.raise_error(say).cast(t)).otherwise(new).alias(c)

    return inc.select(*[cast(c, t) for c, t in old.dtypes])


def increment_losses(old: DataFrame, inc: DataFrame) -> DataFrame:
    """One row: per column of the old table how many values of the increment do not convert to its type."""
    lost = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in old.dtypes if c in inc.columns]
    return inc.agg(*lost)


def upsert(old: DataFrame, inc: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The increment wins; old rows whose key (NULL equal to NULL, compared as text) is not in it stay.

    A key of the increment that does not convert to the old type fails the query.
    """
    new = conform_increment(old, inc, keys)
    probe = new.select(*[F.col(k).cast("string").alias(f"__n_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).cast("string").eqNullSafe(F.col(f"__n_{k}")) for k in keys])
    return new.unionByName(old.join(probe, same, "left_anti"))


def merge_counts(old: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: sizes before and after, and whether the table did not shrink."""
    return old.agg(F.count(F.lit(1)).alias("n_old")).crossJoin(
        F.broadcast(merged.agg(F.count(F.lit(1)).alias("n_new")))
    ).withColumn("ok", F.col("n_new") >= F.col("n_old"))


def replace_guard(old: DataFrame, new: DataFrame, part: str, keep: float = KEEP_SHARE) -> DataFrame:
    """Per partition of the replacement: accepted unless it has under 95 % of the old rows."""
    n_new = new.groupBy(part).agg(F.count(F.lit(1)).alias("n_new"))
    n_old = old.groupBy(part).agg(F.count(F.lit(1)).alias("n_old"))
    return n_new.join(n_old, part, "left").withColumn(
        "accepted", F.col("n_old").isNull() | (F.col("n_new") >= F.col("n_old") * keep)
    )
