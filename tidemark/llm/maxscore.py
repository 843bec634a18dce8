"""Ranked lexical search by MaxScore with bounds of term pairs.

The index holds one row a segment of documents: the terms, and for each the documents that hold it with their counts.  For a block
of items, lists of term pairs are made for each segment beforehand: what the two lists have in common and the greatest joint impact
there.  A document holds both terms, and its share of the score is at most the joint maximum, or one of them at most; so a pair is
bounded by the greatest of three numbers, which is less than the sum of two maxima wherever they do not meet.  A search orders an
item's terms by their maxima and combines pair bounds along that order: the terms that together stay below the item's twentieth
score name no candidates, and a candidate is left as soon as its score and the bound of what remains cannot reach that score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import folded_words, utf8, written

#: Documents and bytes of a segment at most (a longer text is a segment of its own); characters of a block of items, about; segments of a file.
SEGMENT_DOCS, SEGMENT_BYTES, BLOCK_CHARS, PER_FILE = 4096, 8 << 20, 4 << 20, 2
# The parts of a term's impact in a document.
SCALE, SLOPE = 1_000_000_000, 25

INDEX = "segment long, ids array<long>, lengths array<long>, terms array<string>, many array<int>, places array<int>, tf array<int>"


def _slices(batches) -> Iterator[list[tuple[pa.Array, pa.Array]]]:
    """Runs of rows that make one segment each."""
    held, docs, size = [], 0, 0
    for batch in batches:
        _, offsets = utf8(batch.column(1))
        lo = 0
        while lo < batch.num_rows:
            room = int(np.searchsorted(offsets, offsets[lo] + SEGMENT_BYTES - size, "right")) - 1
            hi = min(batch.num_rows, lo + SEGMENT_DOCS - docs, max(room, lo if held else lo + 1))
            if hi > lo:
                part = batch.slice(lo, hi - lo)
                held.append((part.column(0), part.column(1)))
                docs, size, lo = docs + hi - lo, size + int(offsets[hi] - offsets[lo]), hi
            if lo < batch.num_rows:
                yield held
                held, docs, size = [], 0, 0
    if held:
        yield held


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), one row a segment, written to the shared folder.

    ``many`` has the documents of each term, ``places`` and ``tf`` their places in the segment and counts, term by term.
    """

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for rows in _slices(batches):
            ids = pa.concat_arrays([r[0] for r in rows])
            words, at = folded_words(*utf8(pa.concat_arrays([r[1] for r in rows])))
            coded = words.dictionary_encode()
            doc = np.repeat(np.arange(len(ids)), np.diff(at))
            key, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(ids) + doc, return_counts=True)
            term, place = key // len(ids), key % len(ids)
            one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), one(ids, pa.int64()), one(np.diff(at), pa.int64()), one(coded.dictionary.cast(pa.large_string()), pa.string()),
                 one(np.bincount(term, minlength=len(coded.dictionary)), pa.int32()), one(place, pa.int32()), one(tf, pa.int32())],
                ["segment", "ids", "lengths", "terms", "many", "places", "tf"],
            )
            number += 1

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(docs.mapInArrow(run, INDEX), "index", PER_FILE)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times): the terms of ``items`` (item_id, text); rows that share an item_id are one item."""

    def run(batches):
        for batch in batches:
            words, at = folded_words(*utf8(batch.column(1)))
            row = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(at)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), words.cast(pa.large_string()).cast(pa.string())], ["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "item_id long, term string")
    return rows.groupBy("item_id", "term").agg(F.count("*").alias("times"))


@dataclass
class Block:
    """Items with their weighted terms (places in ``terms``, rarest first), and the pairs of neighbours among them."""

    terms: list[str]
    weights: np.ndarray
    items: list[tuple[int | None, np.ndarray]]
    pairs: np.ndarray
    documents: int
    length: int

    @classmethod
    def of(cls, rows, documents: int, length: int) -> Block:
        """From rows (item_id, list of (weight, times, term)) of one block; a term with other repetitions is another weighted term."""
        known, items = {}, []
        for row in rows:
            order = sorted(row["terms"], key=lambda t: (-t["weight"] * t["times"], t["term"]))
            items.append((row["item_id"], np.array([known.setdefault((t["term"], t["weight"] * t["times"]), len(known)) for t in order], np.int64)))
        pairs = [np.stack([t[:-1], t[1:]], axis=1) for _, t in items if len(t) > 1]
        pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        return cls([t for t, _ in known], np.array([w for _, w in known], np.int64), items, pairs, documents, length)


class Segment:
    """One row of the index, as a block of items sees it."""

    def __init__(self, row: dict[str, pa.Array], block: Block):
        lengths = row["lengths"].to_numpy()
        self.ids, self.size = row["ids"], len(lengths)
        many = row["many"].to_numpy().astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(many)])
        self.places = row["places"].to_numpy()
        tf = row["tf"].to_numpy().astype(np.int64)
        m = 100 - SLOPE + SLOPE * lengths * block.documents // max(block.length, 1)
        self.part = SCALE * tf // (1000 * tf + 12 * m[self.places])
        found = pc.index_in(pa.array(block.terms, pa.string()), value_set=row["terms"])
        self.at = found.fill_null(-1).to_numpy()
        self.weights = block.weights

    def impacts(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents with a weighted term of the block, ascending, and its impacts there."""
        k = self.at[term]
        if k < 0:
            return self.places[:0], self.part[:0]
        lo, hi = self.starts[k], self.starts[k + 1]
        return self.places[lo:hi], self.part[lo:hi] * self.weights[term]


def _segments(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Array]]:
    for i in range(batch.num_rows):
        yield {name: batch.column(k)[i] if name == "segment" else batch.column(k)[i].values for k, name in enumerate(batch.schema.names)}


def pair_lists(index: DataFrame, block: Block, beside: bool = False) -> DataFrame:
    """(segment, tops, shared, joint): the greatest impact of each weighted term of a block in each segment, and for each of its
    pairs the documents that hold both and their greatest joint impact (0 without any). ``beside``: as columns of the index."""
    kept = index.columns if beside else ["segment"]

    def run(batches):
        for batch in batches:
            for place, row in enumerate(_segments(batch)):
                s, last, own = Segment(row, block), -1, None
                tops = [int(s.impacts(t)[1].max(initial=0)) for t in range(len(block.terms))]
                shared, joint = np.zeros(len(block.pairs), np.int64), np.zeros(len(block.pairs), np.int64)
                for k, (a, b) in enumerate(block.pairs.tolist()):
                    if a != last:
                        own = np.full(s.size, -1, np.int64)
                        places, worth = s.impacts(a)
                        own[places], last = worth, a
                    places, worth = s.impacts(b)
                    both = own[places] >= 0
                    shared[k], joint[k] = both.sum(), (own[places] + worth)[both].max(initial=0)
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64()))
                own_row = batch.slice(place, 1)
                yield pa.RecordBatch.from_arrays([*(own_row.column(c) for c in kept), one(tops), one(shared), one(joint)], [*kept, "tops", "shared", "joint"])

    return index.mapInArrow(run, f"{INDEX if beside else 'segment long'}, tops array<long>, shared array<long>, joint array<long>")


def prefix_bounds(terms: np.ndarray, tops: np.ndarray, joint: dict[tuple[int, int], int]) -> tuple[list[int], list[int]]:
    """An item's terms by ascending maxima, and for each how much it and those before it can add to a score together.

    A term joins the pair list of a neighbour that stands before it and is still alone, the one that saves more against two maxima.
    """
    terms = terms[tops[terms] > 0].tolist()
    order = sorted(range(len(terms)), key=lambda i: (int(tops[terms[i]]), i))
    alone, total, bounds = set(), 0, []
    for i in order:
        own, saved, with_ = int(tops[terms[i]]), 0, None
        for j in (i - 1, i + 1):
            pair = (terms[min(i, j)], terms[max(i, j)]) if j in alone else None
            if pair in joint:
                other = int(tops[terms[j]])
                saving = own + other - max(joint[pair], own, other)
                if saving > saved:
                    saved, with_ = saving, j
        if with_ is None:
            alone.add(i)
        else:
            alone.discard(with_)
        total += own - saved
        bounds.append(total)
    return [terms[i] for i in order], bounds


@dataclass
class Best:
    """The best documents of an item so far; ``floor`` is the least score that still matters."""

    size: int
    scores: np.ndarray
    nulls: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls, size: int) -> Best:
        return cls(size, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    @property
    def floor(self) -> int:
        return max(1, int(self.scores[-1])) if len(self.scores) == self.size else 1

    def add(self, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        scores, nulls, ids = np.concatenate([self.scores, scores]), np.concatenate([self.nulls, nulls]), np.concatenate([self.ids, ids])
        if len(scores) > self.size:
            keep = scores >= np.partition(scores, -self.size)[-self.size]
            scores, nulls, ids = scores[keep], nulls[keep], ids[keep]
        order = np.lexsort((ids, nulls, -scores))[: self.size]
        self.scores, self.nulls, self.ids = scores[order], nulls[order], ids[order]


def search_segment(s: Segment, terms: list[int], bounds: list[int], floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of all documents of a segment that reach ``floor`` (1 at least), and how many postings were read."""
    apart = int(np.searchsorted(bounds, floor, "left"))  # the terms whose bound together stays below the floor name no candidates
    if apart == len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    score, read = np.zeros(s.size, np.int64), 0
    for t in terms[apart:]:
        places, worth = s.impacts(t)
        score[places] += worth
        read += len(places)
    docs = np.flatnonzero(score)
    score = score[docs]
    for k in range(apart - 1, -1, -1):
        fit = score + bounds[k] >= floor
        docs, score = docs[fit], score[fit]
        if not len(docs):
            break
        places, worth = s.impacts(terms[k])
        at = np.minimum(np.searchsorted(places, docs), len(places) - 1)
        score = score + np.where(places[at] == docs, worth[at], 0)
        read += min(len(places), len(docs))
    fit = score >= floor
    return docs[fit], score[fit], read


def search_block(index: DataFrame, block: Block, size: int) -> DataFrame:
    """(item_id, doc_id, score): the best documents of each item of a block, ``size`` a task; a task carries its floors from segment to segment.

    A segment's pair lists are put beside it as it is read, so the index, rows of megabytes, is neither shuffled nor sorted.
    """
    pairs = [tuple(p) for p in block.pairs.tolist()]

    def run(batches):
        best = [Best.none(size) for _ in block.items]
        for batch in batches:
            for row in _segments(batch):
                s = Segment(row, block)
                tops, joint = row["tops"].to_numpy(), dict(zip(pairs, row["joint"].to_pylist()))
                nulls = np.asarray(s.ids.is_null())
                ids = s.ids.fill_null(0).to_numpy()
                for mine, (_, terms) in zip(best, block.items):
                    docs, scores, _ = search_segment(s, *prefix_bounds(terms, tops, joint), mine.floor)
                    if len(docs):
                        mine.add(scores, nulls[docs], ids[docs])
        name = [item for mine, (item, _) in zip(best, block.items) for _ in mine.ids]
        col = lambda of: np.concatenate([getattr(b, of) for b in best]) if best else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(name, pa.int64()), pa.array(col("ids").astype(np.int64), mask=col("nulls").astype(bool)), pa.array(col("scores").astype(np.int64))], ["item_id", "doc_id", "score"],
        )

    return pair_lists(index, block, beside=True).mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, size: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``size`` best of all ``docs`` (doc_id, text) for each of ``items`` (item_id, text), scores above 0 alone.

    Items are taken in blocks of about BLOCK_CHARS characters of terms, each of which passes the driver by itself; one block's
    results are a plan, those of several are written one after the other.

    Null or empty texts hold no terms: such a document is never found and not counted, such an item has no rows. Rows that share
    an item_id, null included, are one item. Rows that repeat a doc_id are documents of their own; a null doc_id comes last among
    equal scores. Extra columns are ignored; an empty table on either side gives no rows.
    """
    index = build_index(docs)
    lengths = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    total = index.agg(F.sum(F.size(F.filter("lengths", lambda n: n > 0))).alias("n"), F.sum(lengths).alias("l")).first()
    documents, length = int(total["n"] or 0), int(total["l"] or 0)
    asked = written(item_terms(items), "items")
    held = index.select(F.explode(F.arrays_zip("terms", "many")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.many").alias("many"))
    df = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("many").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    asked = asked.join(df.select("term", weight.alias("weight")), "term").where("weight > 0")
    blocks = max(1, -(-int(asked.agg(F.sum(F.length("term") + 8)).first()[0] or 0) // BLOCK_CHARS))
    one = asked.groupBy("item_id").agg(F.collect_list(F.struct("term", "times", "weight")).alias("terms"))
    one = written(one.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "weighted")
    plans = (search_block(index, Block.of(one.where(F.col("block") == b).collect(), documents, length), size) for b in range(blocks))
    found = next(plans) if blocks == 1 else None
    if found is None:
        for plan in plans:
            part = written(plan, "found")
            found = part if found is None else found.unionByName(part)
    order = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", order).where(F.col("rank") <= size).select("item_id", "rank", "doc_id", "score")
