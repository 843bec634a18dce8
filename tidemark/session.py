"""Session helpers.  Library functions never create or reconfigure a session; only tests and bench do."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or the checkpoint folder already set.

    Only a local master (tests) falls back to a temporary folder, because a machine-local folder would be
    lost with its executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


#: Rows of the panel's width that one task sorts comfortably: a few sorts of 100 MB at most.
ROWS_A_PART = 200_000


def parts_of(spark: SparkSession, rows: int) -> int:
    """Parts for so many rows: ``spark.sql.shuffle.partitions``, more where a part would hold over ``ROWS_A_PART`` rows.

    So what a task holds does not grow with the table, whatever number of partitions the session was given.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_PART))


def spread(df: DataFrame, *by: str, parts: int | None = None) -> DataFrame:
    """Hash-partition by columns into ``parts`` parts (see ``parts_of``), by default ``spark.sql.shuffle.partitions``.

    The number is given, so adaptive execution does not merge parts by their compressed size: sorted rows take many times
    that in memory, and computation does not shrink with bytes.
    """
    return df.repartition(parts or parts_of(df.sparkSession, 0), *by)


def store(df: DataFrame) -> str:
    """Write ``df`` as Parquet under a new name in the shared folder and return its path.

    Unlike a checkpoint it is compressed and readers take the columns they need.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def kept(df: DataFrame) -> DataFrame:
    """``df`` read back from where ``store`` wrote it: for rows that several passes read, each a few columns."""
    return df.sparkSession.read.parquet(store(df))
