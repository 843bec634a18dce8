"""Recursive smoothers as composed affine maps.

A row of an exponential mean maps the state before it to the state after it: y -> a * y + b.  A missing value keeps the state, the
first full window replaces it, a value after a gap weighs more.  Maps compose, so all states come from a scan in which each round
composes a row's map with those 1, 4, 16, ... rows before: seven rounds of look-backs cover 16,384 rows.  Spark deals and orders
the rows; the maps are composed on arrays, for some ten thousand rows and all smoothers at once, over whole groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField

from tidemark.functions.histories import Tell, numbers, over_histories

#: Look-backs of the scan; four times the last one bounds the rows of a code.
STRIDES = tuple(4**k for k in range(7))
LONGEST = 4 * STRIDES[-1]


@dataclass(frozen=True)
class Smooth:
    """``out`` = smoother of ``src``.  ``src`` may be an earlier ``out`` or a pair ``(a, b)`` meaning a - b."""

    out: str
    src: str | tuple[str, str]
    alpha: float
    seed: int  # rows averaged for the first value; 1 starts from the first value itself


def ema(out: str, src: str | tuple[str, str], n: int) -> Smooth:
    return Smooth(out, src, 2.0 / (n + 1), n)


def wilder(out: str, src: str, n: int) -> Smooth:
    return Smooth(out, src, 1.0 / n, n)


def ewm_first(out: str, src: str | tuple[str, str], alpha: float) -> Smooth:
    return Smooth(out, src, alpha, 1)


def smooth(x: np.ndarray, alpha: float, seed: int) -> np.ndarray:
    """The recurrence over one array, for tests: started by the first full-window simple mean; the weight decays over gaps."""
    s = pd.Series(x, dtype="float64")
    if seed > 1:
        mean = s.rolling(seed, min_periods=seed).mean()
        filled = mean.notna().cumsum()
        start = (filled == 1) & mean.notna()
        s = s.where(filled > 1).mask(start, mean)
    return s.ewm(alpha=alpha, adjust=False, ignore_na=False).mean().to_numpy()


def in_rounds(smoothers: Sequence[Smooth]) -> list[list[Smooth]]:
    """Smoothers by depth: those of a round read columns and outputs of earlier rounds only."""
    depth: dict[str, int] = {}
    for s in smoothers:
        depth[s.out] = 1 + max((depth.get(x, -1) for x in ((s.src,) if isinstance(s.src, str) else s.src)), default=-1)
    return [[s for s in smoothers if depth[s.out] == d] for d in range(max(depth.values(), default=-1) + 1)]


def _first_windows(x: np.ndarray, place: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For values ``x`` (NaN: none) of whole groups, ``place`` counting a group's rows from 0: rows of the first full windows, their
    means, rows that have a state, rows whose value counts, and the rows since the last one that did."""
    at, valid = np.arange(len(x)), ~np.isnan(x)
    first = at - place
    full = at - np.maximum(np.maximum.accumulate(np.where(valid, -1, at)), first - 1) >= seed
    seen = np.cumsum(full)
    seen -= (seen - full)[first]
    start = full & (seen == 1)
    counts = valid & (seen > 1)  # between the first full window and the second, values do not count
    ends = np.flatnonzero(start)
    means = np.zeros(len(ends))
    for k in range(seed):
        means += x[ends - seed + 1 + k]
    last = np.concatenate([[0], np.maximum.accumulate(np.where(start | counts, at, 0))[:-1]])
    return ends, means / seed, seen > 0, counts, at - last


def _composed(a: np.ndarray, b: np.ndarray, place: np.ndarray, strides: Sequence[int]) -> np.ndarray:
    """The states before which nothing was known: each column's map y -> a * y + b after those of all rows of its group before it."""

    def back(m: np.ndarray, k: int, none: float) -> np.ndarray:
        out = np.full_like(m, none)  # before the first row nothing changes
        out[:, k:] = np.where(place[k:] >= k, m[:, : max(0, m.shape[1] - k)], none)
        return out

    for stride in strides:
        if stride > place.max():
            break
        (a1, b1), (a2, b2), (a3, b3) = ((back(a, k * stride, 1.0), back(b, k * stride, 0.0)) for k in (1, 2, 3))
        b = b + a * (b1 + a1 * (b2 + a2 * b3))
        a = a * a1 * a2 * a3
    return b


def _states(column: Callable[[str], np.ndarray], place: np.ndarray, rounds: Sequence[Sequence[Smooth]], strides: Sequence[int]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """out -> (states, rows without one) over whole groups; ``column`` gives a source, missing values as NaN."""
    told: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    read: dict[str, np.ndarray] = {}

    def source(name: str) -> np.ndarray:
        if name not in read:
            read[name] = np.where(told[name][1], np.nan, told[name][0]) if name in told else column(name)
        return read[name]

    for group in rounds:
        xs = [source(s.src) if isinstance(s.src, str) else source(s.src[0]) - source(s.src[1]) for s in group]
        a, b, empty, known = np.ones((len(group), len(place))), np.zeros((len(group), len(place))), [], {}
        for k, (x, s) in enumerate(zip(xs, group)):
            if (s.src, s.seed) not in known:
                known[s.src, s.seed] = _first_windows(x, place, s.seed)
            ends, means, has, counts, since = known[s.src, s.seed]
            weight = (1 - s.alpha) ** since[counts]
            a[k, counts], b[k, counts] = weight / (weight + s.alpha), s.alpha * x[counts] / (weight + s.alpha)
            a[k, ends], b[k, ends] = 0.0, means
            empty.append(~has)
        out = _composed(a, b, place, strides)
        for s, y, none in zip(group, out, empty):
            told[s.out] = (y, none)
            read.pop(s.out, None)
    return told


def telling(smoothers: Sequence[Smooth]) -> tuple[list[StructField], Tell]:
    """The columns of ``smoothers`` and how a pass over whole groups (``over_histories``) makes them."""
    rounds, strides = in_rounds(smoothers), STRIDES
    outs = list(dict.fromkeys(s.out for group in rounds for s in group))

    def tell(batch: pa.RecordBatch, place: np.ndarray) -> list[pa.Array]:
        told = _states(lambda name: numbers(batch, name), place, rounds, strides)
        return [pa.array(told[o][0], mask=told[o][1]) for o in outs]

    return [StructField(o, DoubleType()) for o in outs], tell


def apply_smoothers(df: DataFrame, by: str, order: str, smoothers: Sequence[Smooth], keep: Sequence[str]) -> DataFrame:
    """Append the smoothers' columns; ``keep`` are the columns to carry through. Rows are unique on (by, order)."""
    fields, tell = telling(smoothers)
    return over_histories(df.select(*dict.fromkeys([by, order, *keep])), by, order, fields, [tell], LONGEST)
