"""Sinks: yearly partitions, checked publication, build manifests, empty tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_yearly(df: DataFrame, path: str, code: str = "jq_code", only_years: bool = False) -> None:
    """Zstandard Parquet by year, sorted by (code, date) inside each file.

    Range partitioning on (year, code) splits a large year over many tasks.  With ``only_years`` just the
    partitions present in ``df`` are replaced, so one year can be rebuilt alone.
    """
    out = df.withColumn("year", F.year("date")).repartitionByRange("year", code).sortWithinPartitions("year", code, "date")
    writer = out.write.mode("overwrite").partitionBy("year").option("compression", "zstd")
    if only_years:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], bool] | None = None) -> None:
    """Write beside the target, check what was written, then swap by two renames.  A failed check changes nothing.

    The old version is kept next to the target and comes back if the second rename fails; between the renames readers find
    no table.
    """
    spark, staging, old = df.sparkSession, path + "__new", path + "__old"
    df.write.mode("overwrite").parquet(staging)
    if check is not None and not check(spark.read.parquet(staging)):
        raise ValueError(f"not published, the check failed: {staging}")
    jvm, target, fs = _fs(spark, path)
    if fs.exists(jvm.org.apache.hadoop.fs.Path(old)):
        fs.delete(jvm.org.apache.hadoop.fs.Path(old), True)
    if fs.exists(target) and not fs.rename(target, jvm.org.apache.hadoop.fs.Path(old)):
        raise OSError(f"the old table cannot be moved, nothing is published: {path}")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), target):
        back = fs.exists(jvm.org.apache.hadoop.fs.Path(old)) and fs.rename(jvm.org.apache.hadoop.fs.Path(old), target)
        raise OSError(f"rename failed: {staging}; the old table is {'back' if back else 'at ' + old}")


def manifest(df: DataFrame, bad_days: DataFrame | None = None) -> DataFrame:
    """One row about a dated table: rows, range, codes and the last day before the first bad one."""
    got = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.countDistinct("symbol").alias("n_symbols"),
    )
    if bad_days is None:
        return got.withColumn("safe_end", F.col("last_day"))
    bad = bad_days.agg(F.min("date").alias("__bad"), F.count(F.lit(1)).alias("n_bad_days"))
    return got.crossJoin(F.broadcast(bad)).withColumn(
        "safe_end", F.coalesce(F.date_sub("__bad", 1), F.col("last_day"))
    ).drop("__bad")


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)
