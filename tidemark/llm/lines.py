"""Removal of repeated lines, one edit apart included, by a deletion-neighbourhood join.

Two lines are one edit apart if they give the same string once at most one character of each is deleted: at the same place
(a substitution) or from one of them only (an insertion).  Each line emits these strings as hashed keys; equal keys meet in
a grouping that keeps the earliest line, so a key shared by many lines costs a row for each and never a pair for each two.

One edit leaves the first or the second half of the longer line as it was.  Only lines that share such a half with another
line emit variants, and only with deletions in the other half.  This drops no pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import U64, Prefix, blocks, mix, names, stored, utf8

#: The four halves: the first and second half of a line that is the longer one of a pair, then as the shorter one.
HALVES = ("p0", "s0", "p1", "s1")


def _points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)


def _line_edges(points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number, first, end) of each line of the texts between ``edges``, parted by line feeds."""
    feeds = np.flatnonzero(points == 10)
    first = np.sort(np.concatenate([edges[:-1], feeds + 1]), kind="stable")
    end = np.sort(np.concatenate([feeds, edges[1:]]), kind="stable")
    text = np.searchsorted(feeds, edges[:-1], "left")
    starts = text + np.arange(len(text))  # the place of each text's first line
    of = np.repeat(np.arange(len(text)), np.diff(np.append(starts, len(first))))
    return of, np.arange(len(first)) - starts[of], first, end


def _halves(name: Prefix, first: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    out = []
    with np.errstate(over="ignore"):
        for more in (0, 1):
            long = end - first + more
            cut = long // 2
            out.append(mix(name(first, first + cut) + long.astype(U64) * U64(4)))
            out.append(mix(name(end - (long - cut), end) + long.astype(U64) * U64(4) + U64(1)))
    return out


def line_table(base: DataFrame, min_chars: int) -> DataFrame:
    """(doc, tag, line, ha, hb, n, p0, s0, p1, s1) for every line that is not blank; no halves under ``min_chars`` - 1."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for lo, hi in blocks(offsets, 1 << 20):
                raw = data[offsets[lo] : offsets[hi]]
                count = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                edges = count[offsets[lo : hi + 1] - offsets[lo]]
                points = _points(raw)
                of, number, first, end = _line_edges(points, edges)
                filled = np.concatenate([[0], np.cumsum((points > 32) & (points != 0x85) & (points != 0xA0))])
                keep = filled[end] > filled[first]
                of, number, first, end = of[keep], number[keep], first[keep], end[keep]
                halves = _halves(Prefix(points), first, end)
                begins = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
                name = names(raw, begins[first], begins[end])
                short = pa.array(end - first < min_chars - 1)
                rows = pa.array(of + lo)
                put = lambda x: pa.array(x.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(number.astype(np.int32)), put(np.ascontiguousarray(name[:, 0])), put(np.ascontiguousarray(name[:, 1])), pa.array((end - first).astype(np.int32)),
                     *(pc.if_else(short, None, put(h)) for h in halves)],
                    ["doc", "tag", "line", "ha", "hb", "n", *HALVES],
                )

    return base.mapInArrow(run, "doc long, tag long, line int, ha long, hb long, n int, " + ", ".join(f"{h} long" for h in HALVES))


def _variants(texts: DataFrame) -> DataFrame:
    """(key, at, doc, tag, line): hashed deletions of (doc, tag, line, body, sides); ``at`` is -1 for the whole line."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                data, offsets = utf8(part.column(3))
                count = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                edges = count[offsets]
                points = _points(data)
                first, end = edges[:-1], edges[1:]
                sides = np.asarray(part.column(4))
                n = end - first
                cut = n // 2
                lo = np.where(sides & 2, 0, np.where(sides & 1, cut, n))  # p0 shared: the edit is behind; s0 shared: before
                hi = np.where(sides & 1, n, np.where(sides & 2, cut, n))
                size = hi - lo
                whose = np.repeat(np.arange(len(n)), size)
                at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[whose]
                name = Prefix(points)
                with np.errstate(over="ignore"):
                    # the hash of a line without one character: what stands before, and what stands behind moved by one
                    before = (name.sums[first[whose] + at] - name.sums[first[whose]]) * name.back[first[whose]]
                    behind = (name.sums[end[whose]] - name.sums[first[whose] + at + 1]) * name.back[first[whose] + 1]
                    key = mix(mix(before + behind) + (n[whose] - 1).astype(U64))
                    zero = np.flatnonzero(sides & 12)
                    whole = mix(name(first[zero], end[zero]) + n[zero].astype(U64))
                rows = pa.array(np.concatenate([whose, zero]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([key, whole]).view(np.int64)), pa.array(np.concatenate([at, np.full(len(zero), -1)]).astype(np.int32)), *(part.column(i).take(rows) for i in range(3))],
                    ["key", "at", "doc", "tag", "line"],
                )

    return texts.mapInArrow(run, "key long, at int, doc long, tag long, line int")


def _bodies(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, tag, line, body, sides) of the lines in ``wanted`` (doc, tag, line, sides)."""
    listed = wanted.groupBy("doc", "tag").agg(F.collect_list(F.struct("line", "sides")).alias("spots"))
    spot = F.explode("spots").alias("spot")
    cut = base.join(listed, ["doc", "tag"]).select("doc", "tag", F.split("text", "\n", -1).alias("lines"), "spots").select("doc", "tag", "lines", spot)
    return cut.select("doc", "tag", F.col("spot.line").alias("line"), F.get("lines", F.col("spot.line")).alias("body"), F.col("spot.sides").alias("sides"))


def _place(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """What tells documents apart and orders them: the id, null ids last, then a hash of the text."""
    return F.coalesce(doc_id.cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))).alias("tag")


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(*_place(F.col("doc_id"), F.col("text")), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def kept_lines(docs: DataFrame, max_edits: int = 1, min_chars: int = 16) -> DataFrame:
    """(doc, tag, line): of each line that is not blank the occurrence that stays.

    Order is (doc_id, hash of the text, line number), null ids last.  An occurrence goes if an equal line comes before it, or
    one within the edit bound; whether that earlier line stays itself does not matter.  The bound is ``max_edits`` (0 or 1)
    where the longer line has at least ``min_chars`` characters and none below: there, one edit tells numbers, names and list
    marks apart.  Rows that repeat id and text share their decisions; extra columns are ignored; no rows give no rows.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    base = _base(docs)
    first = F.min(F.struct("doc", "tag", "line")).alias("first")
    lines = line_table(base, min_chars if max_edits else 1 << 30)
    lines = stored(lines.groupBy("ha", "hb", "n").agg(first, *(F.min(h).alias(h) for h in HALVES)).select("first.*", *HALVES))
    if not max_edits:
        return lines.select("doc", "tag", "line")
    each = lines.where("p0 is not null").select("doc", "tag", "line", F.posexplode(F.array(*HALVES)).alias("half", "key"))
    shared = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    wanted = each.join(shared, "key", "left_semi").groupBy("doc", "tag", "line").agg(F.expr("bit_or(shiftleft(1, half))").alias("sides"))
    bodies = stored(_bodies(base, wanted))
    found = _variants(bodies)
    place = F.struct("doc", "tag", "line")
    keys = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = stored(found.join(keys, "key", "left_semi"))
    same = found.where("at >= 0").groupBy("key", "at").agg(F.min(place).alias("other"))
    whole = found.where("at < 0").groupBy("key").agg(F.min(place).alias("other"))
    parts = found.where("at >= 0").groupBy("key").agg(F.min(place).alias("other"))
    pairs = found.join(same, ["key", "at"]).select("doc", "tag", "line", "other")
    pairs = pairs.unionByName(found.where("at >= 0").join(whole, "key").select("doc", "tag", "line", "other"))
    pairs = pairs.unionByName(found.where("at < 0").join(parts, "key").select("doc", "tag", "line", "other"))
    pairs = pairs.where(F.col("other") < place).distinct()
    one = bodies.select("doc", "tag", "line", "body")
    two = bodies.select(place.alias("other"), F.col("body").alias("earlier"))
    late = pairs.join(one, ["doc", "tag", "line"]).join(two, "other").where((F.greatest(F.length("body"), F.length("earlier")) >= min_chars) & (F.levenshtein("body", "earlier", 1) >= 0))
    return lines.select("doc", "tag", "line").join(late.select("doc", "tag", "line").distinct(), ["doc", "tag", "line"], "left_anti")


def _reported(docs: DataFrame, max_edits: int, min_chars: int) -> DataFrame:
    """(row, n_lines, n_removed, kept): each row of ``docs`` as a struct, and its text without the lines that go."""
    stay = kept_lines(docs, max_edits, min_chars).groupBy("doc", "tag").agg(F.collect_list("line").alias("stay"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.select("row", *_place(F.col("row.doc_id"), F.col("row.text"))).join(stay, ["doc", "tag"], "left").select("row", "stay")

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = part.column(0).field("text").to_pylist()
                n, gone, kept = [], [], []
                for text, stays in zip(texts, part.column(1).to_pylist(), strict=True):
                    lines, stays = (text or "").split("\n"), set(stays or ())
                    left = [x for i, x in enumerate(lines) if i in stays or not _filled(x)]
                    n.append(len(lines))
                    gone.append(len(lines) - len(left))
                    kept.append(None if text is None else "\n".join(left))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["row", "n_lines", "n_removed", "kept"])

    out = StructType([rows.schema["row"], StructField("n_lines", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())])
    return rows.mapInArrow(run, out)


def _filled(line: str) -> bool:
    return any(c > " " and c not in "\x85\xa0" for c in line)


def dedup_lines(docs: DataFrame, max_edits: int = 1, min_chars: int = 16) -> DataFrame:
    """``docs`` with the lines that ``kept_lines`` drops taken out of ``text``; all other columns as they were.

    Blank lines stay, a null text stays null. A document goes only if lines were taken out and none that is not blank is left.
    """
    done = _reported(docs, max_edits, min_chars).where((F.col("n_removed") == 0) | (F.regexp_replace("kept", "[\\x00-\\x20\\x85\\xa0]+", "") != ""))
    return done.select(*(F.col("kept").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def digest(docs: DataFrame, max_edits: int = 1, min_chars: int = 16) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) for every row of ``docs``, repeated rows included; a null text counts as one empty line.

    A null id comes last in the order; extra columns are ignored, whatever their names; no rows give no rows.
    """
    done = _reported(docs.select("doc_id", "text"), max_edits, min_chars)
    return done.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))
