"""The training-data pipeline: documents pass its stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, lines, minhash, mixing
from tidemark.session import shared_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letters, or none with a fair probability) go."""
    return langid.keep_identified(docs)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go, and documents of which nothing is left; n_chars follows the text."""
    out = lines.dedup_lines(docs)
    kinds = dict(docs.dtypes)
    return out.withColumn("n_chars", F.length("text").cast(kinds["n_chars"])) if "n_chars" in kinds else out


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, shuffled; adds copy and shuffle_key."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_lines),
    ("minhash_neardup", remove_near_duplicates),
    ("decontaminate", remove_leaks),
    ("mix_sources", mix_sources),
]
#: SQL cannot express the trained stage; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``. A stage's table is removed once the next one is written; the last one stays."""
    docs, folder, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            _remove(spark, last)
        last = f"{folder}/{name}"
    return docs
