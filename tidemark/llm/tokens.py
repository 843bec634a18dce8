"""Token counts as rollups that deltas maintain: signed rows update additive totals, and batches commit once.

A store is a folder with three tables, each partitioned by batch:

* ``ledger``: for each document (an id and, where ids are null or repeat, a part) and tokenizer version a batch touched, what it counts now, or that it is gone;
* ``deltas``: what the batch adds to the totals of (source, lang, version): new counts less the counts they replace;
* ``commits``: one row for each batch, written last.

A batch writes only below its own name and overwrites what an earlier attempt left there, and readers see committed batches
only, so a lost attempt leaves no trace and a batch that comes again changes nothing.
"""

from __future__ import annotations

import base64
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import shared_folder

#: Fixed value: how the byte-level tokenizer cuts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEYS = ["source", "lang", "version"]
DOCUMENT = ["doc_id", "part"]
COUNTS = "source string, lang string, version string, n_docs long, n_chars long, n_tokens long"
SUMS = ["n_docs", "n_chars", "n_tokens"]


@dataclass(frozen=True)
class Tokenizer:
    """A vocabulary of byte strings and ranks, under the name that totals carry as their version."""

    version: str = "byte_bpe_50k"
    folder: str = "/opt/tokenizers"

    def load(self):
        import tiktoken

        with open(f"{self.folder}/{self.version}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        return tiktoken.Encoding(self.version, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counted(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``docs`` (doc_id, source, lang, text) as (doc_id, part, source, lang, version, n_chars, n_tokens); a null text has none.

    ``part`` is a hash of source, lang and text, so that rows that share an id can be told apart.
    """

    def run(batches):
        encoding = tokenizer.load()
        for batch in batches:
            tokens = pa.array([len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column("text").to_pylist()], pa.int64())
            version = pa.array([tokenizer.version] * batch.num_rows, pa.string())
            told = ["doc_id", "part", "source", "lang"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in told), version, batch.column("n_chars"), tokens], [*told, "version", "n_chars", "n_tokens"])

    text = F.col("text").cast("string")
    part = F.md5(F.to_json(F.struct(F.col("source").cast("string").alias("s"), F.col("lang").cast("string").alias("l"), F.md5(text.cast("binary")).alias("t"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), text.alias("text"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"))
    return rows.mapInArrow(run, "doc_id long, part string, source string, lang string, version string, n_chars long, n_tokens long")


def _part(rows: DataFrame) -> Column:
    return (F.coalesce(F.col("part").cast("string"), F.lit("")) if "part" in rows.columns else F.lit("")).alias("part")


def _matching(rows: DataFrame, other: DataFrame, how: str, keys: list[str]) -> DataFrame:
    """A semi or anti join whose null keys are equal."""
    names = [f"_other_{k}" for k in keys]
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    return rows.join(other.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True))), reduce(and_, same), how)


class Rollups:
    """The totals of one folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        """(batch, number): the batches that count, in the order of their commits."""
        return self._read("commits", "number long, batch string")

    def _committed(self, table: str, schema: str) -> DataFrame:
        done = self.commits()
        names = [r.batch for r in done.select("batch").collect()]  # a row for each batch; prunes the folders of all others
        return self._read(table, schema).where(F.col("batch").isin(names)).join(done, "batch")

    def ledger(self) -> DataFrame:
        """(doc_id, part, source, lang, version, n_docs, n_chars, n_tokens): what every living document counts now."""
        rows = self._committed("ledger", f"doc_id long, part string, {COUNTS}, gone boolean, batch string")
        last = rows.groupBy(*DOCUMENT, "version").agg(F.max_by(F.struct("source", "lang", *SUMS, "gone"), "number").alias("now"))
        return last.where("not now.gone").select(*DOCUMENT, "now.source", "now.lang", "version", *(f"now.{c}" for c in SUMS))

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_chars, n_tokens): sums of committed deltas; keys without documents are left out."""
        rows = self._committed("deltas", f"{COUNTS}, batch string")
        return rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS)).where("n_docs <> 0 or n_chars <> 0 or n_tokens <> 0")

    def commit(self, batch: str, upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """Commits a batch of counted documents that are new or revised, and of documents that go; false if it was there.

        One batch at a time writes to a store. A document is a doc_id and a part, '' where the batch has no column ``part``; it
        may stand for several equal ones (``n_docs``, 1 if absent). It counts once for each version: the row of the largest
        (n_tokens, n_chars, source, lang, n_docs) wins where a batch repeats one. A deletion removes all versions of a document,
        and wins over an upsert in the same batch; a document that is not there is ignored. A null doc_id without a part names
        no document: upserts of it raise, deletions of it are ignored. No rows leave a commit and no deltas.
        """
        done = self.commits()
        if not done.where(F.col("batch") == batch).isEmpty():
            return False
        number = (done.agg(F.max("number")).first()[0] or 0) + 1
        before = self.ledger()
        change = None
        if upserts is not None:
            best = F.max(F.struct("n_tokens", "n_chars", "source", "lang", "n_docs")).alias("now")
            nameless = F.raise_error(F.lit("a row without doc_id or part cannot be counted")).cast("string")
            docs = (F.col("n_docs") if "n_docs" in upserts.columns else F.lit(1)).cast("long").alias("n_docs")
            new = upserts.select("doc_id", _part(upserts), "version", "source", "lang", docs, "n_chars", "n_tokens")
            new = new.withColumn("part", F.when(F.col("doc_id").isNull() & (F.col("part") == ""), nameless).otherwise(F.col("part")))
            change = new.groupBy(*DOCUMENT, "version").agg(best).select(*DOCUMENT, "now.source", "now.lang", "version", *(f"now.{c}" for c in SUMS), F.lit(False).alias("gone"))
        if deletes is not None:
            lost = deletes.select("doc_id", _part(deletes)).where("doc_id is not null or part <> ''").distinct()
            drop = _matching(before, lost, "left_semi", DOCUMENT).select(*DOCUMENT, *KEYS, *(F.lit(0).cast("long").alias(c) for c in SUMS), F.lit(True).alias("gone"))
            change = drop if change is None else _matching(change, lost, "left_anti", DOCUMENT).unionByName(drop)
        if change is not None:
            self._write("ledger", batch, change)
            change = self.spark.read.parquet(f"{self.folder}/ledger/batch={batch}")
            after = change.where("not gone").select(*KEYS, *SUMS)
            old = _matching(before, change, "left_semi", [*DOCUMENT, "version"]).select(*KEYS, *((-F.col(c)).alias(c) for c in SUMS))
            self._write("deltas", batch, after.unionByName(old).groupBy(*KEYS).agg(*(F.sum(c).cast("long").alias(c) for c in SUMS)))
        self._write("commits", batch, self.spark.range(1).select(F.lit(number).cast("long").alias("number")))
        return True

    def _write(self, table: str, batch: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{table}/batch={batch}")


def corpus_totals(docs: DataFrame, tokenizer: Tokenizer = Tokenizer(), slices: int = 8) -> DataFrame:
    """(source, lang, version, n_docs, n_chars, n_tokens) of ``docs`` from a store of its own, as deltas leave them.

    Documents are counted once. All are loaded but those of slice 0, which come without their text; slice 0 is then revised
    to its counts, slice 1 deleted and restored. Each batch is delivered twice. Every row counts: equal rows are one document
    with ``n_docs`` copies, and rows that share an id, or have none, are told apart by a hash of their other columns. A null
    text counts as empty; extra columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    store = Rollups(spark, f"{shared_folder(spark)}/rollups-{uuid.uuid4().hex}")
    rows = counted(docs, tokenizer)
    rows = rows.groupBy(*DOCUMENT, *KEYS).agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.sum("n_tokens").alias("n_tokens"))
    rows = stored(rows.withColumn("slice", F.pmod(F.xxhash64(*DOCUMENT), F.lit(slices))))
    first, second = rows.where("slice = 0"), rows.where("slice = 1")
    blank = rows.select(*DOCUMENT, *KEYS, "n_docs", *(F.when(F.col("slice") == 0, 0).otherwise(F.col(c)).alias(c) for c in ("n_chars", "n_tokens")))
    for batch, upserts, deletes in (("load", blank, None), ("revise", first, None), ("delete", None, second), ("restore", second, None)):
        for _ in range(2):
            store.commit(batch, upserts, deletes)
    return stored(store.totals())
