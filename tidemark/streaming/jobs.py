"""Streaming wrappers over the batch functions.  State lives in the shared folder, so lost executors only cost a retry."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.merge import merge_counts, upsert


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version:08d}"


def latest_version(spark: SparkSession, root: str) -> int:
    """Highest finished version below ``root`` (a finished write leaves _SUCCESS)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/v=*/_SUCCESS")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return max([int(f.getPath().getParent().getName()[2:]) for f in found], default=-1) if found else -1


def merge_stream(increments: DataFrame, root: str, keys: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Arriving increment files are merged by key into a versioned table; version = batch number + 1.

    Re-running a batch rewrites the same version, so a failure between write and commit does no harm.  A version with fewer
    rows than the one before is taken away again and the batch fails.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        base = spark.read.parquet(version_path(root, epoch))
        out = version_path(root, epoch + 1)
        upsert(base, batch, keys).write.mode("overwrite").parquet(out)
        sizes = merge_counts(base, spark.read.parquet(out)).first()
        if not sizes.ok:
            path = spark._jvm.org.apache.hadoop.fs.Path(out)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            raise ValueError(f"the merge would shrink the table from {sizes.n_old} to {sizes.n_new} rows: {out}")

    return increments.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def snapshot_stream(arrivals: DataFrame, on_snapshot: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every arriving snapshot to a batch function (content hash, manifest line)."""
    return arrivals.writeStream.foreachBatch(on_snapshot).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bars_from_ticks(ticks: DataFrame, key: str, ts: str, price: str, order: str, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Open, high, low, close and totals per key and window; rows later than the watermark are dropped."""
    at = F.struct(F.col(ts), F.col(order))
    return (
        ticks.withWatermark(ts, late).groupBy(F.col(key), F.window(ts, width)).agg(
            F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
            F.max_by(price, at).alias("close"), F.count(F.lit(1)).alias("n"),
        )
        .select(key, F.col("window.start").cast("date").alias("date"), "open", "high", "low", "close", "n")
    )


def write_bars(bars: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Finished windows only (append), to files."""
    return (
        bars.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
