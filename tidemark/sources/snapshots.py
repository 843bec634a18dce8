"""Daily snapshots: content hash, manifest, and the difference of two snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row_hash(columns: Sequence[str]) -> Column:
    """Hash of a row that tells where a NULL stands: the hash function alone skips NULLs."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def content_hash(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of a table: row count, xor and sum of row hashes (all combine on the map side)."""
    h = _row_hash(sorted(df.columns))
    return df.select(h.alias("__h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.bit_xor("__h"), F.lit(0)).alias("hash_xor"),
        F.coalesce(F.sum(F.col("__h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
    )


def group_hash(df: DataFrame, by: Sequence[str]) -> DataFrame:
    h = _row_hash([c for c in sorted(df.columns) if c not in by])
    return df.withColumn("__h", h).groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor("__h").alias("hash_xor"))


def same_content(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with ``equal``."""
    x, y = content_hash(a), content_hash(b).select(*[F.col(c).alias(f"other_{c}") for c in ("n_rows", "hash_xor", "hash_sum")])
    eq = (F.col("n_rows") == F.col("other_n_rows")) & (F.col("hash_xor") == F.col("other_hash_xor")) & (F.col("hash_sum") == F.col("other_hash_sum"))
    return x.crossJoin(F.broadcast(y)).select(eq.alias("equal"), "n_rows", "other_n_rows")


def manifest_row(df: DataFrame, day: str, previous: DataFrame | None = None) -> DataFrame:
    """The manifest line of a snapshot; ``stored`` is false when the content equals the previous line's."""
    row = content_hash(df).withColumn("snapshot_date", F.to_date(F.lit(day)))
    if previous is None:
        return row.withColumn("stored", F.lit(True))
    last = previous.agg(F.max_by(F.struct("n_rows", "hash_xor", "hash_sum"), "snapshot_date").alias("__p"))
    changed = ~F.struct("n_rows", "hash_xor", "hash_sum").eqNullSafe(F.col("__p"))
    return row.crossJoin(F.broadcast(last)).withColumn("stored", changed).drop("__p")


def key_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys only one of two snapshots has."""
    a, b = old.select(*keys).distinct(), new.select(*keys).distinct()
    removed = a.join(b, list(keys), "left_anti").withColumn("change", F.lit("removed"))
    return b.join(a, list(keys), "left_anti").withColumn("change", F.lit("added")).unionByName(removed)


def partition_manifest(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(parts, n_rows, hash_xor, hash_sum): what each partition holds, whatever the order of its rows; copies count."""
    h = _row_hash([c for c in sorted(df.columns) if c not in parts])
    return df.select(*parts, h.alias("__h")).groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor("__h").alias("hash_xor"), F.sum(F.col("__h").cast("decimal(38,0)")).cast("string").alias("hash_sum")
    )


def frozen_breaks(df: DataFrame, frozen: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(parts, change): partitions of the manifest ``frozen`` that ``df`` would change; ``lost`` when it has no row of them.

    Partitions the manifest does not name are free.
    """
    same = [F.col(f"f.{p}").eqNullSafe(F.col(f"d.{p}")) for p in parts]
    held = F.struct("n_rows", "hash_xor", "hash_sum")
    now = partition_manifest(df, parts).select(*parts, held.alias("now")).alias("d")
    was = frozen.select(*parts, held.alias("was")).alias("f")
    both = was.join(now, reduce(lambda a, b: a & b, same), "left").where(~F.col("was").eqNullSafe(F.col("now")))
    return both.select(*[F.col(f"f.{p}").alias(p) for p in parts], F.when(F.col("now").isNull(), "lost").otherwise("changed").alias("change"))


def write_unfrozen(df: DataFrame, path: str, parts: Sequence[str], frozen: DataFrame) -> None:
    """Replace the partitions of ``df`` that ``frozen`` does not name; if a frozen one would change, nothing is written."""
    broken = frozen_breaks(df, frozen, parts).limit(5).collect()
    if broken:
        raise ValueError(f"frozen partitions would change: {[tuple(r) for r in broken]}")
    same = reduce(lambda a, b: a & b, [F.col(f"d.{p}").eqNullSafe(F.col(f"f.{p}")) for p in parts])
    free = df.alias("d").join(frozen.select(*parts).alias("f"), same, "left_anti")
    free.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
