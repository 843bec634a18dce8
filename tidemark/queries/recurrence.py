"""Oracle text of smoothers: the recurrence itself, row by row, as a recursive query that carries every smoother's state."""

from __future__ import annotations


def states(source: str, key: str, smoothers: dict[str, tuple[str, int, str]]) -> str:
    """Relations ``walk`` and ``state``: rows of ``source`` (``key``, rn from 1) with a column for each smoother.

    A smoother is (input, rows of its first mean, weight); the input may name columns of the source as ``b.x`` and earlier
    smoothers as ``new_name``.  Carried: length and sum of the run of present values, full windows seen, state, its weight.
    """
    old = [f"{n}_{what}" for n in smoothers for what in ("run", "total", "seen", "y", "w")]
    step = []
    for n, (x, first, alpha) in smoothers.items():
        step += [
            f"({x})::DOUBLE AS {n}_x",
            f"CASE WHEN {n}_x IS NULL THEN 0 ELSE r.{n}_run + 1 END AS {n}_run1",
            f"CASE WHEN {n}_x IS NULL THEN 0.0 ELSE r.{n}_total + {n}_x END AS {n}_total1",
            f"r.{n}_seen + ({n}_run1 >= {first})::INT AS {n}_seen1",
            f"CASE WHEN r.{n}_y IS NULL THEN CASE WHEN {n}_seen1 = 1 THEN {n}_total1 / {first} END WHEN {n}_x IS NULL OR {n}_seen1 < 2 THEN r.{n}_y "
            f"ELSE (r.{n}_w * (1 - {alpha}) * r.{n}_y + {alpha} * {n}_x) / (r.{n}_w * (1 - {alpha}) + {alpha}) END AS new_{n}",
            f"CASE WHEN r.{n}_y IS NOT NULL AND ({n}_x IS NULL OR {n}_seen1 < 2) THEN r.{n}_w * (1 - {alpha}) ELSE 1.0::DOUBLE END AS {n}_w1",
        ]
    new = [x for n in smoothers for x in (f"{n}_run1", f"{n}_total1", f"{n}_seen1", f"new_{n}", f"{n}_w1")]
    zero = [x for _ in smoothers for x in ("0", "0.0::DOUBLE", "0", "NULL::DOUBLE", "1.0::DOUBLE")]
    return f"""walk({key}, rn, {", ".join(old)}) AS (
      SELECT DISTINCT {key}, 0::BIGINT, {", ".join(zero)} FROM {source}
      UNION ALL SELECT {key}, rn, {", ".join(new)} FROM (
        SELECT b.{key}, b.rn, {", ".join(step)} FROM walk r JOIN {source} b ON b.{key} = r.{key} AND b.rn = r.rn + 1)),
    state AS (SELECT {key}, rn, {", ".join(f"{n}_y AS {n}" for n in smoothers)} FROM walk WHERE rn > 0)"""


def ema(x: str, n: int) -> tuple[str, int, str]:
    return x, n, f"(2.0::DOUBLE / {n + 1})"


def wilder(x: str, n: int) -> tuple[str, int, str]:
    return x, n, f"(1.0::DOUBLE / {n})"
