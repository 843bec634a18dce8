"""Benchmark decontamination: approximate occurrences of test items by the pigeonhole principle and Myers' bit vectors.

An item with an error budget of e is cut into e + 1 pieces; whatever e edits do, one piece stays as it was.  Documents are
scanned once for exact pieces, and the text around each hit is searched for the item with at most e edits.  The search grows
by doubling: of any two parts of u and v pieces that make up a match of at most u + v - 1 edits, one has at most its number of
pieces less one, so a chance hit ends after a few characters and no match is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, blocks, utf8

GRAM = 8
#: Bytes of items that one pass over the documents takes to the tasks.
BLOCK_BYTES = 4 << 20
_TABLE_BITS = 22


def normal(text: str | None) -> str:
    """Lower case ASCII letters; runs of white space (ASCII) become one space, none at the ends."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    return _normal_bytes(data, np.array([0, len(data)]))[0].tobytes().decode().strip(" ")


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def _normal_bytes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The normalised bytes of texts between ``edges``, and which bytes they keep."""
    body = _FOLD[data]
    space = body == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[edges[:-1][edges[:-1] < len(keep)]] = True
    return body[keep], keep


def _slot(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (x * U64(0x9E3779B97F4A7C15)) >> U64(64 - _TABLE_BITS)


def edits(item: str, text: str) -> int:
    """The least number of edits between ``item`` and any substring of ``text``: Myers' bit vectors, one word of len(item) bits."""
    m, masks = len(item), {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (full & ~(xh | up)), up & xh
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
            if score < best:
                best = score
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(xv | plus)), plus & xv
    return best


class Items:
    """Test items of one block with their pieces, and a table that most 8-grams of a text miss."""

    def __init__(self, rows: list[tuple[int, str]], rate: float):
        self.ids = [i for i, t in rows if normal(t)]
        self.texts = [normal(t) for _, t in rows if normal(t)]
        self.raw = [np.frombuffer(t.encode(), np.uint8) for t in self.texts]
        self.budget = [max(0, min(int(rate * len(t)), len(t) - 1)) for t in self.texts]
        self.short = [k for k, (r, e) in enumerate(zip(self.raw, self.budget, strict=True)) if len(r) < GRAM and not e]
        cut = []
        for r, e in zip(self.raw, self.budget, strict=True):
            starts = np.append(np.flatnonzero((r & 0xC0) != 0x80), len(r))
            if len(r) // (e + 1) >= GRAM:
                cut.append(starts[np.searchsorted(starts, np.arange(e + 2) * len(r) // (e + 1))])
            else:  # by characters, so that no piece is empty
                cut.append(starts[np.arange(e + 2) * (len(starts) - 1) // (e + 1)])
        none, short = np.zeros(0, np.int64), set(self.short)
        used = [(k, c) for k, c in enumerate(cut) if k not in short]
        owner = np.concatenate([none, *(np.full(len(c) - 1, k) for k, c in used)])
        place = np.concatenate([none, *(c[:-1] for _, c in used)])
        size = np.concatenate([none, *(np.diff(c) for _, c in used)])
        number = np.concatenate([none, *(np.arange(len(c) - 1) for _, c in used)])
        self.flat = np.concatenate([np.zeros(0, np.uint8), *self.raw])
        self.first = np.concatenate([[0], np.cumsum([len(r) for r in self.raw])]).astype(np.int64)
        at = self.first[owner] + place
        width = np.minimum(size, GRAM)
        gram = np.zeros(len(at), U64)
        for j in range(GRAM):
            inside = width > j
            gram[inside] |= self.flat[at[inside] + j].astype(U64) << U64(8 * j)
        order = np.lexsort([gram, width])
        self.gram, self.owner, self.place, self.size, self.number = gram[order], owner[order], place[order], size[order], number[order]
        points = [np.concatenate([[0], np.cumsum((r & 0xC0) != 0x80)]) for r in self.raw]
        #: For each item the places of its pieces, and its end, in code points.
        self.cuts = [points[k][c] for k, c in enumerate(cut)]
        #: For each length of grams (that of the piece, eight at most) the range of its pieces, and its table.
        self.tables = []
        for g in np.unique(width).tolist():
            lo, hi = np.searchsorted(width[order], [g, g + 1]).tolist()
            table = np.zeros(1 << _TABLE_BITS, bool)
            table[_slot(self.gram[lo:hi])] = True
            self.tables.append((g, lo, hi, table))

    def hits(self, body: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, piece) for each exact piece within one of the texts of ``body``, by bytes."""
        none = np.zeros(0, np.int64)
        out = [(none, none, none)]
        if not len(body) or not self.tables:
            return out[0]
        x = np.concatenate([body, np.zeros(GRAM - 1, np.uint8)]).astype(U64)
        for n in (1, 2, 4):
            x = x[:-n] | (x[n:] << U64(8 * n))
        for g, first, end, table in self.tables:
            y = x if g == GRAM else x & U64((1 << 8 * g) - 1)
            at = np.flatnonzero(table[_slot(y)])
            gram = self.gram[first:end]
            lo, hi = np.searchsorted(gram, y[at], "left"), np.searchsorted(gram, y[at], "right")
            many = hi - lo
            piece = first + np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            at = np.repeat(at, many)
            text = np.searchsorted(edges, at, "right") - 1
            inside = at + self.size[piece] <= edges[text + 1]
            at, piece, text = at[inside], piece[inside], text[inside]
            for back in range(g, int(self.size[first:end].max())):  # the rest of each piece, byte by byte
                own = self.first[self.owner[piece]] + self.place[piece] + back
                same = (self.size[piece] <= back) | (body[np.minimum(at + back, len(body) - 1)] == self.flat[np.minimum(own, len(self.flat) - 1)])
                at, piece, text = at[same], piece[same], text[same]
            out.append((text, at, piece))
        text, at, piece = (np.concatenate(p) for p in zip(*out, strict=True))
        return text, at, piece

    def _grown(self, text: str, item: int, piece: int, place: int) -> int | None:
        """Edits of the item around its exact ``piece`` at ``place``, or None where a part on the way has too many."""
        cuts, pattern, pieces = self.cuts[item], self.texts[item], self.budget[item] + 1
        lo, hi, score = piece, piece + 1, 0
        start = place - int(cuts[piece])
        width = 1
        while hi - lo < pieces:
            width *= 2
            lo = piece // width * width
            hi = min(lo + width, pieces)
            a, b, may = int(cuts[lo]), int(cuts[hi]), hi - lo - 1
            score = edits(pattern[a:b], text[max(0, start + a - may) : max(0, start + b + may)])
            if score > may:
                return None
        return score

    def found(self, body: np.ndarray, edges: np.ndarray) -> dict[tuple[int, int], int]:
        """Edits of each (text, item) within the item's budget."""
        text, at, piece = self.hits(body, edges)
        best: dict[tuple[int, int], int] = {}
        if len(text):
            point = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
            place = point[at] - point[edges[text]]
            whole, last = "", -1
            for i, k, j, p in np.unique(np.stack([text, self.owner[piece], self.number[piece], place], 1), axis=0).tolist():
                if i != last:
                    whole, last = body[edges[i] : edges[i + 1]].tobytes().decode(), i
                if best.get((i, k), 1):
                    score = self._grown(whole, k, j, p)
                    if score is not None and score < best.get((i, k), score + 1):
                        best[(i, k)] = score
        for k in self.short:
            word = self.raw[k].tobytes()
            for i in range(len(edges) - 1):
                if word in body[edges[i] : edges[i + 1]].tobytes():
                    best[(i, k)] = 0
        return best


def _blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of at most BLOCK_BYTES (an item longer than that is a block of its own)."""
    rows, size = [], 0
    for row in benchmark.where("text is not null").select("item_id", "text").toLocalIterator():
        n = len(row.text.encode())
        if rows and size + n > BLOCK_BYTES:
            yield rows
            rows, size = [], 0
        rows.append((row.item_id, row.text))
        size += n
    if rows:
        yield rows


def _scan(docs: DataFrame, rows: list[tuple[int, str]], rate: float, id_type: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        items = Items(sent.value, rate)
        for batch in batches:
            ids, item, score = [], [], []
            data, offsets = utf8(batch.column(1))
            for lo, hi in blocks(offsets):
                body, keep = _normal_bytes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                edges = np.concatenate([[0], np.cumsum(keep)])[offsets[lo : hi + 1] - offsets[lo]]
                for (i, k), e in sorted(items.found(body, edges).items()):
                    ids.append(lo + i)
                    item.append(items.ids[k])
                    score.append(e)
            if ids:
                kind = batch.schema.field(0).type
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids)).cast(kind), pa.array(item, pa.int64()), pa.array(score, pa.int64())], ["doc_id", "item_id", "edits"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, item_id long, edits long")


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1) -> DataFrame:
    """(doc_id, item_id, edits): each document that holds a test item, and the fewest edits that make it one.

    Documents and items are compared with lower-case ASCII letters and runs of ASCII white space as one space. The budget is
    ``rate`` edits a character. Null or blank texts match nothing; items without a budget must occur as they are. The items pass in blocks of bounded size, each against all documents, without a
    shuffle of texts. Rows that repeat a doc_id count as one document; a null doc_id is one document too. Tables without rows
    give no rows; extra columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, edits long")
    for rows in _blocks_of(benchmark):
        found = found.unionByName(_scan(docs, rows, rate, "long"))
    return found.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1) -> DataFrame:
    """``docs`` without those that hold a test item; columns as they were, whatever their names.

    Rows with a null id stay if no such row leaks; rows that repeat an id go together; no items or no rows change nothing.
    """
    lost = leaks(docs, benchmark, rate).select(F.col("doc_id").alias("lost")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    stay = rows.join(lost, F.col("row.doc_id").cast("long").eqNullSafe(F.col("lost")), "left_anti")
    return stay.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
