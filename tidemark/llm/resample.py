"""Importance resampling towards a target distribution on hashed word n-grams.

Features are single words and pairs of neighbouring words.  A feature's bucket is a CRC of its bytes: the distinct features of a
block of texts are grouped by equal length into two-dimensional arrays of bytes, all CRCs of an array advance column by column,
and the buckets are scattered back to every place where the feature stands.  Two passes over the texts, one for the counts of the
buckets and one for the weights; between them only the counts travel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, folded_words, stored, utf8
from tidemark.operators.ranking import cumulative_counts

BUCKETS = 10_000
#: Cells of a byte matrix at most, and the length from which features, too rare to share one, are hashed one by one.
CELLS, LONG = 1 << 22, 1 << 10


def _crc_table() -> np.ndarray:
    """One step of the CRC (reversed polynomial 0xEDB88320) for each byte."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_STEP = _crc_table()


def crc32s(features: pa.Array) -> np.ndarray:
    """The unsigned CRC-32 of each value of a binary column."""
    _, offsets, body = features.buffers()
    at = np.frombuffer(offsets, np.int64)[features.offset : features.offset + len(features) + 1]
    body = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    lengths = np.diff(at)
    order = np.argsort(lengths, kind="stable")
    ends = np.flatnonzero(np.diff(lengths[order], append=-1)) + 1
    out, lo = np.zeros(len(lengths), np.uint32), 0
    for hi in ends.tolist():
        size = int(lengths[order[lo]])
        if size > LONG:
            for i in order[lo:hi].tolist():
                out[i] = zlib.crc32(body[at[i] : at[i + 1]])
        else:
            step = max(1, CELLS // max(1, size))
            for a in range(lo, hi, step):
                rows = order[a : min(hi, a + step)]
                matrix = body[at[rows][:, None] + np.arange(size)]
                crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
                for column in matrix.T:
                    crc = _STEP[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
                out[rows] = ~crc
        lo = hi
    return out


def feature_buckets(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of texts: buckets of all words, buckets of all pairs (-1 where a text ends), and the places where each text's words begin and end."""
    data, offsets = utf8(column)
    for lo, hi in blocks(offsets):
        words, at = folded_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        if not len(words):
            yield np.zeros(0, np.int64), np.zeros(0, np.int64), at[:-1], at[1:]
            continue
        coded = words.dictionary_encode()
        code, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        one = (crc32s(known) % np.uint32(buckets)).astype(np.int64)[code]
        two = np.full(len(code), -1, np.int64)
        within = np.ones(len(code), bool)
        within[at[1:][at[1:] > at[:-1]] - 1] = False
        places = np.flatnonzero(within)
        if len(places):
            pair, distinct = pd.factorize(code[places] * len(known) + code[places + 1])
            texts = pc.binary_join_element_wise(known.take(pa.array(distinct // len(known))), known.take(pa.array(distinct % len(known))), pa.scalar(b" ", pa.large_binary()))
            two[places] = (crc32s(texts) % np.uint32(buckets)).astype(np.int64)[pair]
        yield one, two, at[:-1], at[1:]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all ``texts`` (text) fall into each bucket; buckets without any are absent."""

    def run(batches):
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for one, two, _, _ in feature_buckets(batch.column(0), buckets):
                held += np.bincount(one, minlength=buckets)
                held += np.bincount(two[two >= 0], minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["bucket", "n"])

    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket 1000 times the logarithm of its smoothed share in ``target`` over that in ``raw`` (counts), rounded down.

    ``buckets`` numbers reach the driver, however large the tables are.
    """
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(target.select("bucket", F.lit(0).alias("s"), F.col("n").alias("t")))
    both = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    held = both.unionByName(both.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t")))
    held = stored(held.groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t")))
    total = held.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    share = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    rows = held.crossJoin(total).select("bucket", F.floor(1000 * F.log(share)).alias("gain")).collect()  # one row on the right
    out = np.zeros(buckets, np.int64)
    out[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    return out


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the mean gain of each text's features, rounded down; 0 without features."""
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            out = []
            for one, two, lo, hi in feature_buckets(batch.column(1), buckets):
                told = np.concatenate([[0], np.cumsum(gain[one] + np.where(two >= 0, gain[two], 0))]) if len(one) else np.zeros(1, np.int64)
                words = hi - lo
                features = words + np.maximum(words - 1, 0)
                out.append(np.stack([words, features, (told[hi] - told[lo]) // np.maximum(features, 1)]))
            out = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in out.astype(np.int64))], ["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, seed: int = 7, percent: int = 25, least_words: int = 20, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs`` (doc_id, text): a draw without replacement towards ``target`` (text).

    Score is the weight plus Gumbel noise from a hash of seed and doc_id. Of the N rows with ``least_words`` words and a doc_id,
    the floor(percent * N / 100) highest scores are drawn and ranked from 1, ties by doc_id; the rank of all others is null.

    Null or empty text: no features, weight 0, never drawn, but scored. Null doc_id: score and rank null; the text counts in the
    buckets. Rows that repeat a doc_id are rows of their own; equal ones differ in rank alone. Extra columns are ignored. An empty
    ``docs`` gives no rows, an empty ``target`` weights by smoothing alone.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))
    scored = stored(weights(docs, gain).withColumn("score", score))
    fit = scored.where((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull())
    above = cumulative_counts(fit.select((-F.col("score")).alias("minus")), [], "minus").select((-F.col("minus")).alias("score"), F.col("below").alias("above"))
    drawn = fit.count() * percent // 100
    # rows of a score that reaches the draw are ordered among themselves; noise spreads the rows over the scores
    fits = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull() & F.col("above").isNotNull()
    found = scored.join(above.where(F.col("above") < drawn), "score", "left").withColumn("fits", fits)
    order = F.row_number().over(Window.partitionBy("score").orderBy("doc_id"))
    ranked = found.where("fits").withColumn("rank", F.col("above") + order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(out).unionByName(found.where("not fits").withColumn("rank", F.lit(None).cast("long")).select(out))
