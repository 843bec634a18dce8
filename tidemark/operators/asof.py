"""As-of join: for each left row the latest right row at or before its time, per key.

Both sides are tagged, unioned and ordered once per key, and the last right row seen so far is carried
forward.  Any number of right tables share that one exchange and one sort.

Groups stay bounded.  A left side that is unique on (key, time) is no longer than its calendar.  Any other
left side is first reduced to its distinct (key, time) pairs, and the match is joined back, so copies of one
key never meet in one task.  With ``bucket`` the ordering is cut into calendar periods: each period starts
from a carry row (the last right row of an earlier period), computed from one small row per period.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import spread

_TS, _SIDE = "__ts", "__side"
_LEFT = 1  # the side of left rows; right rows that may be met at their own time come before them, strict ones after


@dataclass(frozen=True)
class Side:
    """A right table: unique on (key, ``ts``).  ``cols`` maps output names to its columns.

    ``per_column`` carries each column on its own, skipping its NULLs; otherwise the latest row is taken whole.
    """

    df: DataFrame
    ts: str
    cols: dict[str, str]
    key: dict[str, str] = field(default_factory=dict)  # left key name -> name in df, when they differ
    strict: bool = False
    per_column: bool = False

    def slots(self, i: int) -> dict[str, dict[str, str]]:
        """Carried structs: name -> {output column: source column}."""
        if self.per_column:
            return {f"__right{i}_{out}": {out: src} for out, src in self.cols.items()}
        return {f"__right{i}": self.cols}


def _period(ts: Column, bucket: str | None) -> Column | None:
    return None if bucket is None else F.date_trunc(bucket, ts)


def _right_rows(side: Side, on: Sequence[str], i: int) -> DataFrame:
    def carried(cols: dict[str, str]) -> Column:
        packed = F.struct(*[F.col(src).alias(out) for out, src in cols.items()])
        return F.col(next(iter(cols.values()))) if side.per_column else packed

    known = reduce(lambda a, b: a & b, [F.col(side.key.get(k, k)).isNotNull() for k in on], F.col(side.ts).isNotNull())
    return side.df.where(known).select(  # a NULL key equals nothing
        *[F.col(side.key.get(k, k)).alias(k) for k in on],
        F.col(side.ts).alias(_TS),
        *[carried(cols).alias(slot) for slot, cols in side.slots(i).items()],
    )


def _carry_rows(rows: DataFrame, wanted: DataFrame, on: Sequence[str], slots: Sequence[str], bucket: str) -> DataFrame:
    """One right row per wanted (key, period): the last one of any earlier period."""
    last = rows.groupBy(*on, _period(F.col(_TS), bucket).alias("__p")).agg(
        *[F.max_by(s, F.when(F.col(s).isNotNull(), F.col(_TS))).alias(s) for s in slots]
    )
    both = last.withColumn("__want", F.lit(False)).unionByName(
        wanted.withColumn("__want", F.lit(True)), allowMissingColumns=True
    )
    # within a period the wanted row comes first, so it sees earlier periods only
    before = Window.partitionBy(*on).orderBy("__p", F.col("__want").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        both.withColumns({s: F.last(s, ignorenulls=True).over(before) for s in slots})
        .where(F.col("__want"))
        .select(*on, F.col("__p").alias(_TS), *slots)
    )


def asof_join_many(
    left: DataFrame,
    on: Sequence[str],
    left_ts: str,
    sides: Sequence[Side],
    *,
    left_unique: bool = False,
    bucket: str | None = None,
    previous: dict[str, str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Left as-of join of several right tables in one exchange.  All left rows and columns are kept.

    The left columns stay columns of the tagged rows, so those that nobody reads afterwards are never shuffled.
    ``parts`` is the number of parts of the exchange (see ``spread``).

    ``previous`` (output name -> left column) adds values of the previous left row of the key from the same
    sorted pass; it needs a unique left side and no ``bucket``.
    """
    on, previous = list(on), previous or {}
    if previous and (bucket is not None or not left_unique):
        raise ValueError("previous needs left_unique=True and no bucket")
    if not left_unique:
        keys = left.select(*on, left_ts).where(F.col(left_ts).isNotNull()).distinct()
        matched = asof_join_many(keys, on, left_ts, sides, left_unique=True, bucket=bucket, parts=parts)
        return left.join(matched, [*on, left_ts], "left")

    payload = [c for c in left.columns if c not in on and c != left_ts]
    slots: dict[str, dict[str, str]] = {}
    tagged = left.select(*on, F.col(left_ts).alias(_TS), F.lit(_LEFT).alias(_SIDE), *payload)
    for i, side in enumerate(sides):
        held = side.slots(i)
        slots.update(held)
        rows = _right_rows(side, on, i)
        tagged = tagged.unionByName(
            rows.withColumn(_SIDE, F.lit(_LEFT + 1 if side.strict else _LEFT - 1)), allowMissingColumns=True
        )
        if bucket is not None:
            wanted = left.select(*on, _period(F.col(left_ts), bucket).alias("__p")).distinct()
            carry = _carry_rows(rows, wanted, on, list(held), bucket).withColumn(_SIDE, F.lit(-1))
            tagged = tagged.unionByName(carry, allowMissingColumns=True)

    groups = [F.col(k) for k in on]
    if bucket is not None:
        groups.append(_period(F.col(_TS), bucket))
    else:
        tagged = spread(tagged, *on, parts=parts)
    ordered = Window.partitionBy(*groups).orderBy(F.col(_TS).asc_nulls_first(), _SIDE)
    w = ordered.rowsBetween(Window.unboundedPreceding, 0)
    carried = [F.last(s, ignorenulls=True).over(w).alias(s) for s in slots]
    own = F.col(_TS).cast(left.schema[left_ts].dataType)  # the right tables may have widened it
    mine, value = F.col(_SIDE) == _LEFT, {c: own if c == left_ts else F.col(c) for c in left.columns}
    if previous:
        earlier = F.when(mine, F.struct(*[value[c].alias(o) for o, c in previous.items()]))
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)
        carried.append(F.last(earlier, ignorenulls=True).over(before).alias("__previous"))
    seen = tagged.select(*on, _TS, _SIDE, *payload, *carried).where(mine)
    out = [value[c].alias(c) for c in left.columns]
    out += [F.col(f"__previous.{o}").alias(o) for o in previous]
    whole = {slot for i, side in enumerate(sides) if not side.per_column for slot in side.slots(i)}
    for slot, cols in slots.items():
        out += [F.col(f"{slot}.{c}").alias(c) if slot in whole else F.col(slot).alias(c) for c in cols]
    return seen.select(*out)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    cols: Sequence[str] | dict[str, str],
    *,
    how: str = "left",
    strict: bool = False,
    left_unique: bool = False,
    bucket: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """As-of join of one right table.  ``how='inner'`` drops left rows without a match."""
    mapping = dict(cols) if isinstance(cols, dict) else {c: c for c in cols}
    flag = "__matched"
    side = Side(right.withColumn(flag, F.lit(True)), right_ts, {**mapping, flag: flag}, strict=strict)
    out = asof_join_many(left, on, left_ts, [side], left_unique=left_unique, bucket=bucket, parts=parts)
    if how == "inner":
        out = out.where(F.col(flag))
    return out.drop(flag)
