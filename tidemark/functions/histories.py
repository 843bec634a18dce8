"""One pass over the rows of each group in their order, on arrays.

Spark deals and orders the rows and numbers them; Python gets them as Arrow batches, cut where groups begin, and appends columns.  It
holds whole groups of some ten thousand rows at a time: one group never more than the calendar, as rows are unique on (by, order).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: From the rows of whole groups and each row's place in its group (from 0) to the new columns.
Tell = Callable[[pa.RecordBatch, np.ndarray], list[pa.Array]]
#: Values of frames that are laid out side by side at a time.
SPREAD = 1 << 19


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column as doubles; NULL becomes NaN."""
    return pc.cast(batch.column(name), pa.float64(), safe=False).to_numpy(zero_copy_only=False)


def whole_groups(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """The same rows cut where groups begin; ``name`` numbers the rows of a group from 1, and groups come one after the other."""
    held: list[pa.RecordBatch] = []

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        begins = np.flatnonzero(batch.column(name).to_numpy() == 1)
        if len(begins):
            cut = int(begins[-1])
            if cut:
                held.append(batch.slice(0, cut))
            if held:
                yield joined()
            held, batch = [], batch.slice(cut)
        if batch.num_rows:
            held.append(batch)
    if held:
        yield joined()


def over_histories(df: DataFrame, by: str, order: str, fields: Sequence[StructField], tells: Sequence[Tell], longest: int | None = None) -> DataFrame:
    """``df`` with the columns ``fields``, which ``tells`` give one after the other; columns of the same name go. More than ``longest`` rows of a group are refused."""
    kept = [c for c in df.columns if c not in {f.name for f in fields}]
    number = f"CASE WHEN assert_true(__rn <= {longest}, 'more than {longest} rows of one group') IS NULL THEN __rn END" if longest else "__rn"
    numbered = df.selectExpr("*", f"row_number() OVER (PARTITION BY `{by}` ORDER BY `{order}`) AS __rn").selectExpr(*(f"`{c}`" for c in df.columns), f"{number} AS __rn")
    names = [*kept, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "__rn"):
            place = batch.column("__rn").to_numpy().astype(np.int64) - 1
            if place[0] != 0 or ((place[1:] != 0) & (place[1:] != place[:-1] + 1)).any():
                raise ValueError("rows of a group are not together and in order")
            with np.errstate(all="ignore"):
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(x for tell in tells for x in tell(batch, place))], names)

    return numbered.mapInArrow(run, StructType([*(df.schema[c] for c in kept), *fields]))


def in_frame(valid: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
    """How many of a row's group, from ``rows`` - 1 before it to itself, are ``valid``."""
    upto = np.concatenate([[0], np.cumsum(valid)])
    at = np.arange(len(valid))
    return upto[at + 1] - upto[at - np.minimum(place, rows - 1)]


def frames(at: np.ndarray, place: np.ndarray, rows: int, *columns: np.ndarray) -> Iterator[tuple[slice, np.ndarray, list[np.ndarray]]]:
    """For the rows ``at``, some at a time: (which of ``at``, what of their frames is of the same group, each column's frames)."""
    if not len(at):
        return
    wide = [np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(rows - 1, x.dtype), x]), rows) for x in columns]
    back, step = np.arange(rows - 1, -1, -1), max(1, SPREAD // rows)
    for lo in range(0, len(at), step):
        some = at[lo : lo + step]
        # rows that follow each other are read where they are
        pick = slice(some[0], some[-1] + 1) if some[-1] - some[0] == len(some) - 1 else some
        yield slice(lo, lo + len(some)), back <= place[some][:, None], [x[pick] for x in wide]
