"""Text sources: CSV landings, typed conversion with loss counts, repair of damaged multi-line files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD_START = r"^\d+,\d+,\d{6}\.XSH[EG],"  # fixed value: how a forecast record begins
HEAD_FIELDS = 15  # fields before the free text


def yearly_glob(folder: str, stem: str, suffix: str = ".csv.gz") -> str:
    """Files ``stem_YYYY`` only: the anchored year keeps ``stem_q_...`` out."""
    return f"{folder}/{stem}_[12][0-9][0-9][0-9]{suffix}"


def read_csv_text(spark: SparkSession, *paths: str) -> DataFrame:
    """CSV as text, one read per path, united by column name (absent columns become NULL)."""
    out = None
    for p in paths:
        df = spark.read.csv(p, header=True, inferSchema=False)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Convert the listed text columns; what does not parse becomes NULL.  Others stay text."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def coercion_losses(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column how many non-empty texts would be lost by the conversion (one pass over the data)."""
    lost = [
        F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & F.col(c).try_cast(t).isNull()).alias(c) for c, t in types.items()
    ]
    one = df.agg(*lost)
    pairs = ", ".join(f"'{c}', `{c}`" for c in types)
    return one.selectExpr(f"stack({len(types)}, {pairs}) AS (column_name, lost)")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, pos, line): the lines of text files with an order that survives splitting.

    A block is one input split.  Only line feeds end a line here, so stray carriage returns stay inside.
    """
    df = spark.read.option("lineSep", "\n").text(path)
    return df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"),
    )


def strip_carriage_returns(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", F.regexp_replace("line", "\r", ""))


def assemble_records(lines: DataFrame, start: str = RECORD_START, header: bool = True) -> DataFrame:
    """Join continuation lines to their record: (file, rec, n_lines, record).

    With ``header`` the first line of a file is its header and goes, unless it begins a record; every other line is kept.  Lines before the first that begins a
    record are record 0, a damaged one.  Records are numbered by a running count inside each block plus the counts of the
    blocks before it, so no file is ever read by one task; a record cut by a block border is put together by the final
    grouping.
    """
    begins = F.col("line").rlike(start).cast("long")
    rows = lines.withColumn("__begin", begins)
    if header:
        first = lines.groupBy("file").agg(F.min(F.struct("block", "pos")).alias("__header"))
        rows = rows.join(first, "file").where((F.struct("block", "pos") != F.col("__header")) | (F.col("__begin") > 0)).drop("__header")
    per_block = rows.groupBy("file", "block").agg(F.sum("__begin").alias("__n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select("file", "block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("__in", F.sum("__begin").over(inside)).join(offsets, ["file", "block"])
    parts = F.sort_array(F.collect_list(F.struct("block", "pos", "line")))
    return (
        numbered.withColumn("rec", F.col("__in") + F.col("__offset"))
        .groupBy("file", "rec")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("record"))
    )


def split_record(record: Column, n_head: int = HEAD_FIELDS) -> tuple[list[Column], Column]:
    """The scalar head fields and the free text (unquoted when it is quoted)."""
    bits = F.split(record, ",", n_head + 1)
    text = F.coalesce(F.try_element_at(bits, F.lit(n_head + 1)), F.lit(""))
    trimmed = F.trim(text)
    body = F.regexp_replace(F.regexp_replace(trimmed, '^"', ""), '"$', "")
    unquoted = F.regexp_replace(body, '""', '"')
    return [F.try_element_at(bits, F.lit(i + 1)) for i in range(n_head)], F.when(trimmed.startswith('"'), unquoted).otherwise(text)


def repair_records(lines: DataFrame, names: list[str], start: str = RECORD_START, header: bool = True) -> DataFrame:
    """Damaged multi-line CSV to columns; ``names`` holds the head fields and the free-text field."""
    head, text = split_record(F.col("record"), len(names) - 1)
    recs = assemble_records(lines, start, header)
    return recs.select("file", "rec", "n_lines", *[h.alias(n) for h, n in zip(head, names)], text.alias(names[-1]))


def record_checks(df: DataFrame) -> DataFrame:
    """The split is only trusted when every record passes: one row of failure counts."""
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("id").rlike(r"^\d+$")).alias("bad_id"),
        F.count_if(~F.col("code").rlike(r"^\d{6}\.XSH[EG]$")).alias("bad_code"),
        F.count_if(F.col("pub_date").try_cast("date").isNull()).alias("bad_date"),
    )


def counts_against_manifest(df: DataFrame, by: str, manifest: DataFrame) -> DataFrame:
    """Rows per group next to the expected number; a row per mismatch."""
    got = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return got.join(manifest.select(by, "expected"), by, "full").where(~F.col("n").eqNullSafe(F.col("expected")))
