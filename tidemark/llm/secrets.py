"""Scans for secrets: fixed patterns and, beyond them, windows of high entropy in candidate strings, without Python on the way.

Candidates are runs of one alphabet.  A window slides over each, one character in and one out; the counts of the alphabet's
characters and the sum of c * log2(c) are carried along, so a step costs the same for any window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of the base patterns, their patterns, and what a match must have to count.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class Alphabet:
    """A character class: its characters, the length of the window, and the entropy in bits a character that is too much."""

    characters: str
    window: int
    bits: float


@dataclass(frozen=True)
class Scan:
    """Alphabets, and patterns of candidates that are let through."""

    alphabets: tuple[Alphabet, ...] = (
        Alphabet("0123456789abcdefABCDEF", 32, 3.3),
        Alphabet("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 20, 3.8),
    )
    allowed: tuple[str, ...] = (r"^[A-Za-z_-]+$", r"^[0-9_-]+$", r"(?i)example|sample|dummy|placeholder", r"0123456789|(?i)abcdefghijkl", r"^(/[A-Za-z_-]*)+$")


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: places (code points, end exclusive) and strings of the leftmost matches that do not overlap."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    return F.when(text.rlike(pattern), F.aggregate(lengths, start, step, lambda acc: acc["out"])).otherwise(none)


def _hot_windows(text: Column, a: Alphabet) -> Column:
    """array<struct<s, e>>: the merged windows of ``text`` (characters of ``a`` alone) whose entropy is at least ``a.bits``."""
    weight = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(a.window + 2)))
    most = a.window * (math.log2(a.window) - a.bits)  # the sum of c * log2(c) that this entropy allows
    came = F.transform(F.split(text, "", F.length(text)), lambda c: F.instr(F.lit(a.characters), c))
    gone = F.concat(F.array_repeat(F.lit(0), a.window), F.slice(came, F.lit(1), F.greatest(F.size(came) - a.window, F.lit(0))))
    moves = F.zip_with(came, gone, lambda x, y: F.struct(x.alias("came"), y.alias("gone")))
    start = F.struct(
        F.lit(0).alias("i"), F.array_repeat(F.lit(0), len(a.characters)).alias("counts"), F.lit(0.0).alias("sum"), F.array().cast("array<struct<s:int,e:int>>").alias("out"),
    )

    def step(acc: Column, x: Column) -> Column:
        before = F.element_at(acc["counts"], x["came"])
        grown = acc["sum"] + F.get(weight, before + 1) - F.get(weight, before)
        left = F.element_at(acc["counts"], F.greatest(x["gone"], F.lit(1))) + F.when(x["gone"] == x["came"], 1).otherwise(0)
        total = F.when(x["gone"] > 0, grown - F.get(weight, left) + F.get(weight, left - 1)).otherwise(grown)
        counts = F.transform(acc["counts"], lambda c, j: c + (j + 1 == x["came"]).cast("int") - (j + 1 == x["gone"]).cast("int"))
        i = acc["i"] + 1
        lo, last, out = i - a.window, F.try_element_at(acc["out"], F.lit(-1)), acc["out"]
        wider = F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(last["s"].alias("s"), i.alias("e"))))
        new = F.concat(out, F.array(F.struct(lo.alias("s"), i.alias("e"))))
        hot = (i >= a.window) & (total <= most + 1e-9)
        return F.struct(i.alias("i"), counts.alias("counts"), total.alias("sum"), F.when(~hot, out).when(last["e"] >= lo, wider).otherwise(new).alias("out"))

    return F.aggregate(moves, start, step, lambda acc: acc["out"])


def spans(docs: DataFrame, scan: Scan = Scan(), name: str = "found") -> DataFrame:
    """``docs`` (..., text) with a column ``name``, array<struct<s, k, e>>: start, kind (place in KINDS) and end of every span, sorted.

    The base patterns give assign, access and hex spans. Entropy spans are the merged windows of a candidate that no allowed
    pattern matches; spans of different alphabets that touch or overlap are one. A null or empty text has none.
    Columns of ``docs`` stay as they were, but for one called ``name``, which gives way. No rows give no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    as_kind = lambda array, k: F.transform(array, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
    assign = F.filter(_matches(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= LEAST_VALUE)
    found = [as_kind(assign, 0), as_kind(_matches(text, ACCESS), 1), as_kind(_matches(text, HEX), 2)]
    for a in scan.alphabets:
        runs = _matches(text, "[" + "".join("\\" + c if c in "-]\\^+/_" else c for c in a.characters) + "]{" + str(a.window) + ",}")
        runs = F.filter(runs, lambda x: ~F.coalesce(_any_match(x["m"], scan.allowed), F.lit(False)))
        hot = F.flatten(F.transform(runs, lambda x: F.transform(_hot_windows(x["m"], a), lambda w: F.struct((x["s"] + w["s"]).alias("s"), (x["s"] + w["e"]).alias("e")))))
        found.append(as_kind(hot, 3))
    base, hot = F.concat(*found[:3]), F.array_sort(F.concat(*found[3:]))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")

    def merge(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        wider = F.struct(last["s"].alias("s"), last["k"].alias("k"), F.greatest(last["e"], x["e"]).alias("e"))
        return F.when(last["e"] >= x["s"], F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(wider))).otherwise(F.concat(acc, F.array(x)))

    others = [c for c in docs.columns if c != name]
    cut = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"), base.alias("base"), hot.alias("hot"))
    return cut.select(*(F.col(f"row.`{c}`").alias(c) for c in others), F.array_sort(F.concat("base", F.aggregate("hot", none, merge))).alias(name))


def _any_match(text: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | text.rlike(p)
    return out


def report(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy) for every row of ``docs`` (doc_id, text).

    Null ids and repeated rows are rows like others; extra columns are ignored; no rows give no rows.
    """
    out = spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scan).select("doc_id", "found")
    name = F.array(*(F.lit(k) for k in KINDS))
    told = lambda array: F.array_join(F.transform(array, lambda x: F.concat(F.get(name, x["k"]), F.lit(":"), x["s"], F.lit(":"), x["e"])), ",")
    count = lambda k: F.size(F.filter("found", lambda x: x["k"] == k)).cast("long")
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(told(F.filter("found", lambda x: x["k"] < 3)), 256).alias("base_sha256"),
        told(F.col("found")).alias("spans"), count(3).alias("n_entropy"),
    )
