"""Near-duplicates on word shingles by circulant MinHash, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, blocks, components, mix, names, stored, utf8

#: Fixed value: bytes that part words (space, tab, line feed, vertical tab, form feed, carriage return).
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

#: Bins of the parity sketch.
PARITY = 1024

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles; a text with fewer words is one shingle."""
    for lo, hi in blocks(offsets):
        base = offsets[lo]
        body = _LOWER[data[base : offsets[hi]]]
        edges = offsets[lo : hi + 1] - base
        gap = np.ones(len(body) + 2, bool)
        gap[1:-1] = _IS_SPACE[body]
        first = ~gap[1:-1] & gap[:-2]
        last = ~gap[1:-1] & gap[2:]
        inner = edges[(edges > 0) & (edges < len(body))]  # words end with their text
        first[inner] = ~gap[inner + 1]
        last[inner - 1] = ~gap[inner]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        # each distinct word is hashed once, whole
        lengths = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words_of = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(body[~gap[1:-1]])]).dictionary_encode()
        _, where, held = words_of.dictionary.buffers()
        where = np.frombuffer(where, np.int64)[: len(words_of.dictionary) + 1]
        word = names(np.frombuffer(held, np.uint8) if held is not None else body[:0], where[:-1], where[1:])[:, 0][words_of.indices.to_numpy()]
        at = np.searchsorted(starts, edges)
        salts = mix(np.arange(1, words + 1, dtype=U64)) | U64(1)
        with np.errstate(over="ignore"):
            runs = len(word) - words + 1
            if runs > 0:
                rolled = word[:runs] * salts[0]
                for j in range(1, words):
                    rolled = rolled + word[j : j + runs] * salts[j]
                rolled = mix(rolled)
            for i in range(hi - lo):
                a, b = int(at[i]), int(at[i + 1])
                if b - a >= words:
                    yield np.unique(rolled[a : b - words + 1])
                elif b > a:
                    yield mix(np.array([(word[a:b] * salts[: b - a]).sum(dtype=U64)], U64) + U64(b - a))
                else:
                    yield np.zeros(0, U64)


def _mix32(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A bijection of the 32-bit numbers: one of the permutations of the universe."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(15)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def circulant_signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """``size`` minima: the first permutation places each element, the second, shifted by k, ranks it for coordinate k."""
    placed = _mix32((hashes >> U64(32)).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    shift = np.arange(1, size + 1, dtype=np.uint32)[:, None]
    low = np.full(size, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(placed), 512):
        low = np.minimum(low, _mix32(placed[None, lo : lo + 512] + shift, 0x7FEB352D, 0x846CA68B).min(axis=1))
    return low


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    groups = signature.reshape(-1, rows).astype(U64)
    key = np.arange(1, len(groups) + 1, dtype=U64)
    for j in range(rows):
        key = mix(key + groups[:, j])
    return key.view(np.int64)


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, tag, n_shingles, set_a, set_b, bands): size and 128-bit name of each text's set, and its band keys."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            n, a, b, keys = [], [], [], []
            for s in shingle_sets(data, offsets, words):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    a.append(mix(s).sum(dtype=U64))
                    b.append(mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64))
                keys.append(band_keys(circulant_signature(s, bands * rows), rows) if len(s) else np.zeros(0, np.int64))
            at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            keys = pa.ListArray.from_arrays(at, np.concatenate([*keys, np.zeros(0, np.int64)]))
            name = [pa.array(np.array(x, U64).view(np.int64)) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n, pa.int64()), *name, keys], ["doc_id", "tag", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select("doc_id", "tag", "text").mapInArrow(run, "doc_id long, tag long, n_shingles long, set_a long, set_b long, bands array<long>")


def _node() -> Column:
    return F.struct("doc_id", "tag").alias("node")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, shingles, parity): the whole sets and, by bits, which of their bins hold an odd number of shingles."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data, offsets = utf8(part.column(2))
                sets = list(shingle_sets(data, offsets, words))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                body = pa.ListArray.from_arrays(ends, np.concatenate([*sets, np.zeros(0, U64)]).view(np.int64))
                odd = [np.packbits(np.bincount((s & U64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1).view(np.int64) for s in sets]
                odd = pa.ListArray.from_arrays(np.arange(0, len(sets) * PARITY // 64 + 1, PARITY // 64).astype(np.int32), np.concatenate([*odd, np.zeros(0, np.int64)]))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], body, odd], ["doc_id", "tag", "shingles", "parity"])

    out = docs.select("doc_id", "tag", "text").mapInArrow(run, "doc_id long, tag long, shingles array<long>, parity array<long>")
    return out.select(_node(), "shingles", "parity")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b, ...) whose full sets reach ``percent`` of intersection over union."""
    left = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    both = pairs.join(left, "b").join(right, "a")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select(pairs.columns)


def _mixed(rest: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    several = rest.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("key")
    return rest.join(several, "key", "left_semi")


def _across(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) and their roots (ra, rb) of different components in a bucket (key, node, n, root, parity) that can reach ``percent``.

    Bins that hold an odd number of one set's shingles and an even number of the other's hold one at least that is in one set
    only, which bounds what the two have in common from above.
    """
    one = rest.select("key", F.struct("node", "n", "root", "parity").alias("x"))
    two = one.withColumnRenamed("x", "y")
    apart = sum((F.bit_count(F.col("x.parity")[i].bitwiseXOR(F.col("y.parity")[i])) for i in range(1, PARITY // 64)), F.bit_count(F.col("x.parity")[0].bitwiseXOR(F.col("y.parity")[0])))
    total = F.col("x.n") + F.col("y.n")
    most = F.least("x.n", "y.n", F.shiftright(total - apart, 1))
    can = (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & (100 * most >= percent * (total - most))
    return one.join(two, "key").where(can).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.root").alias("ra"), F.col("y.root").alias("rb")).distinct()


def _grouped(docs: DataFrame, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, tag, n_shingles, root) for every row of ``docs`` (doc_id, tag, text); root is the least node of its component.

    A node is the least (doc_id, tag) of an equal set, where tag is a hash of the text: rows that share a doc_id but not the
    text are nodes of their own. root is null for empty sets and null ids.
    """
    named = stored(signatures(docs, words, bands, rows))
    full = named.where("n_shingles > 0 and doc_id is not null")
    nodes = full.groupBy("set_a", "set_b").agg(F.min(_node()).alias("node"))
    keyed = full.join(nodes.select("node.*"), ["doc_id", "tag"], "left_semi").dropDuplicates(["doc_id", "tag"])
    member = keyed.select(_node(), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    bucket = member.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("size")).where("size > 1")
    inside = stored(member.join(bucket.select("key", "lead"), "key"))
    fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    star = inside.select(F.col("lead.node").alias("a"), F.col("node").alias("b"), "n", F.col("lead.n").alias("m"))
    star = stored(star.where("a <> b").where(fits).select("a", "b").distinct())
    met = docs.join(inside.select("node.*").distinct(), ["doc_id", "tag"], "left_semi").dropDuplicates(["doc_id", "tag"])
    sets = stored(full_sets(met, words))
    roots = components(_confirmed(star, sets, percent))
    rest = inside.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    rest = _mixed(rest).join(sets.select("node", "parity"), "node")
    late = _confirmed(_across(rest, percent).join(star, ["a", "b"], "left_anti"), sets, percent)
    # what was found late joins whole components, so only their roots are united again
    above = components(late, "ra", "rb").select(F.col("node").alias("low"), F.col("root").alias("top"))
    owner = nodes.join(roots, "node", "left").select("set_a", "set_b", F.coalesce("root", "node").alias("low")).join(above, "low", "left")
    shown = named.join(owner.select("set_a", "set_b", F.coalesce("top", "low").alias("root")), ["set_a", "set_b"], "left")
    return shown.select("doc_id", "tag", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("root")).alias("root"))


def _tagged(doc_id: Column, text: Column) -> tuple[Column, Column, Column]:
    text = text.cast("string")
    return doc_id.cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tag"), text.alias("text")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, bands: int = 32, rows: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Equal sets are one node, so copies never meet as pairs. Within a band bucket all members are compared with its smallest
    one. Members still in different components are then compared with each other, unless a bound on what their sets have in
    common rules a link out. Every pair that shares a bucket is therefore confirmed on full sets,
    in one component already, or ruled out by a bound.

    Null or blank text: empty set, linked with nothing, kept. Rows with a null doc_id form no links: component_id is null
    and kept is true. Rows that repeat a doc_id are linked by their own texts, each with its own component_id. Extra columns
    are ignored; an empty table gives no rows.
    """
    done = _grouped(docs.select(*_tagged(F.col("doc_id"), F.col("text"))), words, percent, bands, rows)
    done = done.select("doc_id", "n_shingles", F.coalesce("root.doc_id", "doc_id").alias("component_id"))
    return done.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, bands: int = 32, rows: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates; columns as they were, whatever their names.

    Rows that repeat a doc_id go or stay by their own texts; rows equal in doc_id and text go down to one. Rows with a null
    doc_id, and texts without words, stay otherwise.
    """
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    packed = packed.select("row", *_tagged(F.col("row.doc_id"), F.col("row.text")))
    done = stored(_grouped(packed.select("doc_id", "tag", "text"), words, percent, bands, rows).where("doc_id is not null"))
    lost = done.where((F.col("root.doc_id") != F.col("doc_id")) | (F.col("root.tag") != F.col("tag"))).select("doc_id", "tag").distinct()
    left = packed.join(lost, ["doc_id", "tag"], "left_anti").select("row", "doc_id", "tag")
    again = done.groupBy("doc_id", "tag").count().where("count > 1").limit(1)
    if not again.isEmpty():
        left = left.where("doc_id is null").unionByName(left.where("doc_id is not null").dropDuplicates(["doc_id", "tag"]))
    return left.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
