"""Helpers shared by the training-data operators: UTF-8 buffers of Arrow columns, hashing, stored steps, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, shared_folder

U64 = np.uint64
#: Odd multiplier of the polynomial hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there."""
    return cut_lineage(df)


def written(df: DataFrame, name: str, per_file: int = 0) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder: compressed, and columns are read apart.

    Spark decodes up to some thousand rows of a file at once, so rows of megabytes are kept to ``per_file`` a file.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", per_file).parquet(path)
    return df.sparkSession.read.parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; a null has length zero."""
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may own bytes; only its length counts
        lengths = np.diff(at) * np.asarray(column.is_valid())
        if (lengths != np.diff(at)).any():
            parts = [body[at[i] : at[i] + n] for i, n in enumerate(lengths)]
            return np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)])
    return body[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a longer text is a block of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True


def folded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of a block of texts as one binary column, A-Z in lower case, and for each text where its words begin.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII.
    """
    body = _FOLD[data]
    inside = np.zeros(len(body) + 2, bool)
    inside[1:-1] = _IN_WORD[body]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    inner = offsets[(offsets > 0) & (offsets < len(body))]  # words end with their text
    first[inner] = inside[inner + 1]
    last[inner - 1] = inside[inner]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(body[inside[1:-1]])])
    return words, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x = x * U64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> U64(33))
        x = x * U64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U64(33))


def names(body: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 128-bit hash of each slice of a byte buffer, as rows of two numbers. Unlike ``Prefix`` it is no polynomial, so texts that
    repeat and mirror themselves do not meet."""
    view = memoryview(np.ascontiguousarray(body))
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(first.tolist(), end.tolist())]), U64).reshape(-1, 2)


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per process and doubled when too short."""
    have = _POWERS.get((base, 0))
    if have is None or len(have) < n:
        size = 1 << max(12, int(n).bit_length())
        have, step = np.ones(size, U64), 1
        with np.errstate(over="ignore"):
            while step < size:
                have[step : 2 * step] = have[:step] * U64(pow(base, step, 1 << 64))
                step *= 2
        _POWERS[(base, 0)] = have
    return have[:n]


class Prefix:
    """Hashes of any slice of a byte buffer in constant time."""

    def __init__(self, data: np.ndarray, base: int = BASE):
        n = len(data)
        self.sums = np.zeros(n + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum((data.astype(U64) + U64(1)) * powers(n, base), out=self.sums[1:])
        self.back = powers(n + 1, pow(base, -1, 1 << 64))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[hi] - self.sums[lo]) * self.back[lo])


def _settled(e: DataFrame) -> bool:
    """Whether the edges (u, v) are stars: every u has one v, and no v is a u. One grouping with map-side sums."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = e.select(F.explode(ends).alias("x")).groupBy("x.node").agg(F.sum("x.up").alias("up"), F.max("x.down").alias("down"))
    return seen.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over the undirected ``edges``, for every node of an edge.

    Alternating large-star and small-star rounds until the edges are stars; each is stored, so a lost executor costs one
    round at most. A hub is reduced to a minimum before it is joined, and its edges may be split over tasks. Nulls and loops
    are ignored; no edges give an empty result.
    """
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    for _ in range(rounds):
        if _settled(e):
            nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = stored(small.where("u <> v").distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
