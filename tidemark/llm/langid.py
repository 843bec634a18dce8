"""Language identification by a convolutional network over bytes, trained in numpy and applied to fixed-length windows.

Filters of widths 2, 3 and 4 over one-hot bytes, the maximum over a window, a rectifier and a softmax layer.  A filter over
one-hot bytes is a sum of table entries, so a window costs three look-ups a byte.  A text's prediction is the mean of its
windows' probabilities, weighted by their bytes; every window of a text counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import blocks, utf8

WIDTHS = (2, 3, 4)
SPAN = max(WIDTHS)
UNKNOWN = "und"
#: Labels that training takes at most; a table with more of them raises.
MOST_LANGUAGES = 1000


@dataclass
class Settings:
    """window: bytes of a window; filters: of each width; per_language: documents of each language to learn from at most;
    cuts: windows taken from each of these; epochs, batch, rate, seed: of the training."""

    window: int = 256
    filters: int = 16
    per_language: int = 500
    cuts: int = 3
    epochs: int = 8
    batch: int = 128
    rate: float = 0.01
    seed: int = 7


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def cut_windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, lengths, text): all texts cut into windows of ``size`` bytes, the last of each padded with zeros."""
    lengths = np.diff(offsets)
    many = -(-lengths // size)
    first = np.concatenate([[0], np.cumsum(many)])
    out = np.zeros((int(first[-1]), size), np.uint8)
    flat = out.reshape(-1)
    for i, n in enumerate(lengths.tolist()):
        if n:
            flat[first[i] * size : first[i] * size + n] = data[offsets[i] : offsets[i] + n]
    text = np.repeat(np.arange(len(lengths)), many)
    held = np.minimum(size, lengths[text] - (np.arange(len(out)) - first[:-1][text]) * size)
    return _FOLD[out], held, text


class ByteNetwork:
    """Tables for each width and place in it, and a dense layer."""

    def __init__(self, names: list[str], filters: int, seed: int):
        rng = np.random.default_rng(seed)
        self.names, self.filters = names, filters
        self.tables = [rng.normal(0, 0.3 / w, (w, 256, filters)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(filters * len(WIDTHS), np.float32)
        self.dense = rng.normal(0, 0.2, (filters * len(WIDTHS), len(names))).astype(np.float32)
        self.offset = np.zeros(len(names), np.float32)

    def lookups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums over the first two bytes of all filters by byte pair; the third and fourth bytes' parts."""
        f, (two, three, four) = self.filters, self.tables
        pair = np.concatenate([(t[0][:, None] + t[1][None, :]).reshape(65_536, f) for t in self.tables], axis=1)
        return pair, np.concatenate([three[2], four[2]], axis=1), four[3]

    def pooled(self, windows: np.ndarray, lengths: np.ndarray, tables=None, where: bool = False):
        """The maximum of each filter over the places of a window that hold text, and where it is."""
        pair, third, fourth = tables or self.lookups()
        f, places = self.filters, windows.shape[1] - SPAN + 1
        w = windows.astype(np.int32)
        z = pair.take(w[:, :places] * 256 + w[:, 1 : places + 1], axis=0)
        z[:, :, f:] += third.take(w[:, 2 : places + 2], axis=0)
        z[:, :, 2 * f :] += fourth.take(w[:, 3 : places + 3], axis=0)
        used = np.maximum(1, lengths - SPAN + 1)
        for i in np.flatnonzero(used < places):
            z[i, used[i] :] = -np.inf
        if not where:
            return z.max(axis=1)
        at = z.argmax(axis=1)
        return np.take_along_axis(z, at[:, None, :], 1)[:, 0], at

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.dense + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, s: Settings) -> ByteNetwork:
        rng = np.random.default_rng(s.seed)
        params = [*self.tables, self.bias, self.dense, self.offset]
        moment, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        f = self.filters
        for _ in range(s.epochs):
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), s.batch):
                rows = order[lo : lo + s.batch]
                x, n, y = windows[rows], lengths[rows], labels[rows]
                short = rng.random(len(rows)) < 0.4  # short texts are learned from too
                n = np.where(short, np.minimum(n, rng.integers(6, 80, len(rows))), n)
                high, at = self.pooled(x, n, where=True)
                hidden = np.maximum(high + self.bias, 0)
                p = self.probabilities(high)
                p[np.arange(len(y)), y] -= 1
                p /= len(y)
                back = (p @ self.dense.T) * (hidden > 0)
                grads = []
                for k, w in enumerate(WIDTHS):
                    g = np.zeros_like(self.tables[k])
                    part, place = back[:, k * f : (k + 1) * f], at[:, k * f : (k + 1) * f]
                    for j in range(w):
                        byte = np.take_along_axis(x, place + j, 1)
                        np.add.at(g[j], (byte, np.arange(f)[None, :]), part)
                    grads.append(g)
                grads += [back.sum(0), hidden.T @ p + 1e-4 * self.dense, p.sum(0)]
                step += 1
                for a, g, m, v in zip(params, grads, moment, square, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    a -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        return self

    def texts(self, data: np.ndarray, offsets: np.ndarray, window: int, tables) -> np.ndarray:
        """Mean probabilities of each text; zeros for a text without bytes."""
        out = np.zeros((len(offsets) - 1, len(self.names)))
        for lo, hi in blocks(offsets, 1 << 19):
            x, n, text = cut_windows(data, offsets[lo : hi + 1], window)
            for at in range(0, len(x), 64):
                p = self.probabilities(self.pooled(x[at : at + 64], n[at : at + 64], tables))
                np.add.at(out, lo + text[at : at + 64], p * n[at : at + 64, None])
        return out / np.maximum(np.diff(offsets), 1)[:, None]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _lettered(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, s: Settings = Settings()) -> ByteNetwork:
    """Learns from ``docs`` (doc_id, text, lang) but not from held-out rows, null ids, null languages or texts without letters.

    The sample is bounded by ``per_language`` documents (smallest hashes of id and text) times ``cuts`` windows, spread over
    the whole text; only these windows reach the driver.
    """
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    known = known.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("h")).where(_lettered(F.col("text")))
    counts = known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    # a row for each language, so the sample is taken where the texts are read and only its rows are shuffled
    share = docs.sparkSession.createDataFrame([(r.lang, (2.0 * s.per_language + 20) / r["count"]) for r in counts], "lang string, share double")
    few = known.join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("rank") <= s.per_language)
    rest = F.greatest(F.length("text") - s.window, F.lit(0))
    cuts = [F.substring("text", (rest * j / max(1, s.cuts - 1)).cast("int") + 1, F.lit(s.window)) for j in range(s.cuts)]
    rows = few.select("lang", "h", F.explode(F.array_distinct(F.array(*cuts))).alias("cut")).orderBy("lang", "h", "cut").collect()
    names = sorted({r.lang for r in rows})
    raw = [r.cut.encode()[: s.window] for r in rows]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    windows, lengths, _ = cut_windows(np.frombuffer(b"".join(raw), np.uint8), offsets, s.window)
    labels = np.array([names.index(r.lang) for r in rows], np.int64)
    return ByteNetwork(names, s.filters, s.seed).fit(windows, lengths, labels, s)


def identified(docs: DataFrame, network: ByteNetwork, s: Settings = Settings()) -> DataFrame:
    """(row, lang_pred, score): each row of ``docs`` as a struct, its language and that language's probability.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.select("row", F.when(_lettered(F.col("row.text").cast("string")), F.col("row.text").cast("string")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        net = sent.value
        tables = net.lookups() if net.names else None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                text = part.column(1)
                lang, score = pa.nulls(part.num_rows, pa.string()), pa.nulls(part.num_rows, pa.float64())
                if net.names:
                    data, offsets = utf8(text)
                    p = net.texts(data, offsets, s.window, tables)
                    blank = pc.is_null(text)
                    lang = pc.if_else(blank, None, pa.array([net.names[i] for i in p.argmax(axis=1)], pa.string()))
                    score = pc.if_else(blank, None, pa.array(np.clip(p.max(axis=1), 0, 1)))
                yield pa.RecordBatch.from_arrays([part.column(0), lang.fill_null(UNKNOWN), score.fill_null(0.0)], ["row", "lang_pred", "score"])

    return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def predictions(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang); extra columns are ignored."""
    found = identified(docs.select("doc_id", "text"), train(docs, s), s)
    ident = F.col("row.doc_id")
    return found.select(ident.cast("long").alias("doc_id"), held_out(ident).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3, s: Settings = Settings()) -> DataFrame:
    """``docs`` without those that have no language or one of a probability under ``least``; columns as they were."""
    found = identified(docs, train(docs, s), s).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
