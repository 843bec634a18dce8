"""Removal of long repeated byte strings by prefix doubling over anchored positions.

Plain prefix doubling ranks every byte position at lengths 1, 2, 4, ... and moves all of them in every round.  Here the
positions are thinned first, without losing a repetition: each window of ``length`` bytes names an anchor, the smallest hashed
8-gram among its first ``reach`` positions, so equal windows name anchors at equal places.  Anchors are then reranked at
growing offsets, and only those that are not yet unique go on:

1. the bytes that all windows of an anchor share (``length - reach + 1`` from the anchor on) give the first rank; an anchor
   alone in its rank has no repeated window and is dropped;
2. the pair of this rank and the bytes that the anchor's windows cover together; two anchors with an equal pair settle all
   their windows at once;
3. what is left, at the edges of repetitions, is ranked window by window past the threshold, one representative for each
   class of equal pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import U64, Prefix, blocks, mix, stored, utf8

GRAM = 8


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def anchors(body: np.ndarray, edges: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): each anchor of the texts in ``body`` and the range of window starts that name it."""
    none = np.zeros(0, np.int64)
    whole = np.diff(edges) >= length
    if not whole.any():
        return none, none, none
    x = body.astype(U64)
    for size in (1, 2, 4):
        x = x[:-size] | (x[size:] << U64(8 * size))
    with np.errstate(over="ignore"):
        x *= U64(0x9E3779B97F4A7C15)
    x >>= U64(32)
    x <<= U64(32)
    x |= np.arange(len(x), dtype=U64)
    low = _slide_min(x, reach)
    step = np.zeros(len(body) + 1, np.int8)
    step[edges[:-1][whole]] += 1
    step[edges[1:][whole] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8))
    at = (low[starts] & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(at, prepend=-1))
    return at[new], starts[new], starts[np.append(new[1:], len(starts)) - 1]


def _ranked(docs: DataFrame, length: int, reach: int) -> DataFrame:
    """(doc_id, tag, spot, narrow, wide) for every anchor; spot packs its place, its distance to its first window and their number."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for lo, hi in blocks(offsets):
                edges = offsets[lo : hi + 1] - offsets[lo]
                body = data[offsets[lo] : offsets[hi]]
                at, first, last = anchors(body, edges, length, reach)
                if not len(at):
                    continue
                name = Prefix(body)
                narrow = name(at, at + (length - reach + 1))
                with np.errstate(over="ignore"):
                    wide = mix(name(first, last + length) + ((at - first) * 65_536 + (last - first)).astype(U64))
                row = np.searchsorted(edges, at, "right") - 1
                of = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of), pa.array(((at - edges[row]) << 32) | ((at - first) << 16) | (last - first)), pa.array(narrow.view(np.int64)), pa.array(wide.view(np.int64))],
                    ["doc_id", "tag", "spot", "narrow", "wide"],
                )

    return docs.select("doc_id", "tag", "text").mapInArrow(run, "doc_id long, tag long, spot long, narrow long, wide long")


def _windows(docs: DataFrame, spots: DataFrame, length: int) -> DataFrame:
    """(doc_id, tag, start, name): every window of the anchors in ``spots``, named by its anchor's rank and its own bytes."""
    listed = spots.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("spot", "narrow")).alias("spots"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                data, offsets = utf8(part.column(2))
                lists = part.column(4)
                of = np.repeat(np.arange(part.num_rows), np.asarray(lists.value_lengths()))
                flat = lists.flatten()
                packed, narrow = (np.asarray(flat.field(i)) for i in range(2))
                spot, left, count = packed >> 32, (packed >> 16) & 0xFFFF, (packed & 0xFFFF) + 1
                whose = np.repeat(np.arange(len(of)), count)
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = (spot - left)[whose] + step
                place = start + offsets[:-1][of][whose]
                with np.errstate(over="ignore"):
                    name = mix(Prefix(data)(place, place + length) ^ mix(narrow[whose].view(U64) + (spot[whose] - start).astype(U64)))
                rows = pa.array(of[whose])
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array(start.astype(np.int32)), pa.array(name.view(np.int64))], ["doc_id", "tag", "start", "name"])

    return docs.join(listed, ["doc_id", "tag"]).mapInArrow(run, "doc_id long, tag long, start int, name long")


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, tag, spans) of ``docs`` (doc_id, tag, text, known), no nulls: runs [lo, hi) of bytes covered by a ``length``-byte string that also starts elsewhere."""
    reach = max(1, min(2 * length // 5, length - GRAM + 1, 65_535))
    ranked = _ranked(docs, length, reach)
    again = ranked.groupBy("narrow").agg(F.count("*").alias("n")).where("n > 1").select("narrow")
    left = stored(ranked.join(again, "narrow", "left_semi"))
    classes = stored(left.groupBy("narrow", "wide").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "tag", "spot")).alias("one")))
    settled = left.join(classes.where("n > 1").select("narrow", "wide"), ["narrow", "wide"], "left_semi")
    lo = F.shiftright("spot", 32) - F.shiftright("spot", 16).bitwiseAND(0xFFFF)
    runs = settled.select("doc_id", "tag", lo.alias("lo"), (lo + F.col("spot").bitwiseAND(0xFFFF) + length).alias("hi"))
    several = classes.groupBy("narrow").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("narrow")
    spots = classes.join(several, "narrow", "left_semi").select("one.*", "narrow")
    # each class sends one anchor, so a group here holds different texts only; large groups spill
    same = F.count("*").over(Window.partitionBy("name"))
    edge = _windows(docs, spots, length).withColumn("same", same).where("same > 1")
    edge = edge.select("doc_id", "tag", F.col("start").cast("long").alias("lo"), (F.col("start") + length).cast("long").alias("hi"))
    return runs.unionByName(edge).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return list(zip(lo[new].tolist(), hi[np.append(new[1:], len(lo)) - 1].tolist(), strict=True))


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256.

    Texts are UTF-8 bytes, null is empty, and matches never cross texts. A byte goes if a string of ``length`` bytes covers
    it that also starts anywhere else. Repeated rows are documents of their own, so they remove each other; null ids are
    kept as such. Texts shorter than ``length`` stay whole; extra columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"), F.col("doc_id").isNotNull().alias("known"))
    # the texts are shuffled once: the windows and this join read the same exchange
    both = base.join(repeated_spans(base, length), ["doc_id", "tag"], "left")

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                data, offsets = utf8(part.column(2))
                lists = part.column(4)
                ends = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))])
                flat = lists.flatten()
                lo, hi = (np.asarray(flat.field(i)).astype(np.int64) for i in (0, 1))
                out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
                for i in range(part.num_rows):
                    text = data[offsets[i] : offsets[i + 1]]
                    gone = _merged(lo[ends[i] : ends[i + 1]], hi[ends[i] : ends[i + 1]]) if ends[i + 1] > ends[i] else []
                    stay = [b"", *(text[a:b].tobytes() for a, b in zip([0, *(h for _, h in gone)], [*(g for g, _ in gone), len(text)], strict=True))]
                    out["n_bytes"].append(len(text))
                    out["n_removed"].append(sum(h - g for g, h in gone))
                    out["n_spans"].append(len(gone))
                    out["kept"].append(b"".join(stay))
                kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.binary()}
                digest = pa.array([hashlib.sha256(x).hexdigest() for x in out["kept"]], pa.string())
                ids = pc.if_else(part.column(3), part.column(0), None)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, kinds[k]) for k, v in out.items()), digest], ["doc_id", *out, "kept_sha256"])

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
