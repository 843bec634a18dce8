"""Rolling market beta."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from tidemark.functions.histories import frames, in_frame, numbers, over_histories
from tidemark.functions.scalars import round_half, safe_div
from tidemark.session import spread

# Window length -> minimum number of observations.
WINDOWS = {60: 40, 120: 80, 252: 120}


def benchmark_returns(index_bars: DataFrame, start: str | None = None) -> DataFrame:
    """Close-to-close return of one index; a few thousand rows, ordered by one task."""
    rows = index_bars.where(F.col("date") >= F.to_date(F.lit(start))) if start else index_bars
    return rows.select("date", (safe_div(F.col("close"), F.lag("close").over(Window.orderBy("date"))) - 1).alias("mret"))


def slopes(x: np.ndarray, y: np.ndarray, place: np.ndarray, rows: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Slope of ``x`` on ``y`` over each row's frame of ``rows`` rows of its group, pairs with a NaN left out, and the rows without one."""
    both = ~np.isnan(x) & ~np.isnan(y)
    x, y = np.where(both, x, 0.0), np.where(both, y, 0.0)
    n = in_frame(both, place, rows)
    out, none = np.zeros(len(x)), n < least
    # whole frames of pairs are read as they are, others with a mask
    for full in (True, False):
        at = np.flatnonzero(~none & ((n == rows) == full))
        for part, own, (a, b, ok) in frames(at, place, rows, x, y, both):
            to, count = at[part], n[at[part]]
            if not full:
                own = own & ok
                a, b = np.where(own, a, 0.0), np.where(own, b, 0.0)
            da, db = a - (a.sum(axis=1) / count)[:, None], b - (b.sum(axis=1) / count)[:, None]
            if not full:
                da, db = np.where(own, da, 0.0), np.where(own, db, 0.0)
            square = np.einsum("ij,ij->i", db, db)
            # benchmark returns that do not differ have no slope; their mean may be off by a rounding
            close = np.flatnonzero(square <= count * (1e-9 * (b.sum(axis=1) / count)) ** 2)
            v = b[close]
            mine = own[close] if not full else np.ones(v.shape, bool)
            flat = np.where(mine, v, np.inf).min(axis=1) == np.where(mine, v, -np.inf).max(axis=1)
            out[to] = np.einsum("ij,ij->i", da, db) / square
            none[to[square == 0]] = True
            none[to[close[flat]]] = True
    return out, none


def beta_daily(stocks: DataFrame, bench: DataFrame, windows: dict[int, int] = WINDOWS, parts: int | None = None) -> DataFrame:
    """Slope of stock on benchmark returns over the joined series.  ``stocks``: code, date, sret (present).

    Each window reads its own frame and only pairs without NULL or NaN; NULL below the minimum number of pairs.  The frames are read
    from arrays, in one pass over the rows of each code; ``parts`` is the number of parts by code.
    """
    # one row per trading day
    df = stocks.join(F.broadcast(bench), "date").select("code", "date", F.col("sret").cast("double").alias("__s"), F.col("mret").cast("double").alias("__m"))
    df = spread(df, "code", parts=parts) if parts else df

    def tell(batch: pa.RecordBatch, place: np.ndarray) -> list[pa.Array]:
        x, y = numbers(batch, "__s"), numbers(batch, "__m")
        return [pa.array(v, mask=none) for v, none in (slopes(x, y, place, w, least) for w, least in windows.items())]

    fields = [StructField(f"beta_{w}", DoubleType()) for w in windows]
    return over_histories(df, "code", "date", fields, [tell]).select("code", "date", *[round_half(F.col(f.name), 6).alias(f.name) for f in fields])
