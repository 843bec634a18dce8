"""Rolling operators as Column helpers.

A *full* window is required everywhere: with fewer than ``n`` rows, or with a NULL inside, the result is
NULL.  All helpers of one ``Roll`` share the same partitioning and ordering, so Spark plans a single
exchange and a single sort for the whole factor table, and one window node per frame length.

Per-code windows run on tables that are unique on (code, date): a group can never be longer than the
calendar, however many raw rows one code contributes upstream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_div


@dataclass(frozen=True)
class Roll:
    """Window vocabulary for one (partition, order) pair."""

    by: str = "code"
    order: str = "date"

    def base(self) -> WindowSpec:
        return Window.partitionBy(self.by).orderBy(self.order)

    def last(self, n: int) -> WindowSpec:
        return self.base().rowsBetween(-(n - 1), 0)

    def before(self, n: int) -> WindowSpec:
        """The n rows before the current one, current excluded."""
        return self.base().rowsBetween(-n, -1)

    def upto(self) -> WindowSpec:
        return self.base().rowsBetween(Window.unboundedPreceding, 0)

    def full(self, x: Column, n: int, value: Column) -> Column:
        return F.when(F.count(x).over(self.last(n)) == n, value)

    def agg(self, x: Column, n: int, fn) -> Column:
        return self.full(x, n, fn(x).over(self.last(n)))

    # --- location and spread -------------------------------------------------------------------
    def ma(self, x: Column, n: int) -> Column:
        return self.agg(x, n, F.avg)

    def rsum(self, x: Column, n: int) -> Column:
        return self.agg(x, n, F.sum)

    def rmax(self, x: Column, n: int) -> Column:
        return self.agg(x, n, F.max)

    def rmin(self, x: Column, n: int) -> Column:
        return self.agg(x, n, F.min)

    def std(self, x: Column, n: int) -> Column:
        return self.agg(x, n, F.stddev_samp)

    def stdp(self, x: Column, n: int) -> Column:
        return self.agg(x, n, F.stddev_pop)

    def var(self, x: Column, n: int) -> Column:
        return self.agg(x, n, F.var_samp)

    # --- shape -----------------------------------------------------------------------------------
    def _flat(self, x: Column, n: int) -> Column:
        w = self.last(n)
        return F.min(x).over(w) == F.max(x).over(w)

    def skew(self, x: Column, n: int) -> Column:
        """Bias-adjusted skewness; a constant window gives 0."""
        k = (n * (n - 1)) ** 0.5 / (n - 2)
        body = F.when(self._flat(x, n), F.lit(0.0)).otherwise(F.skewness(x).over(self.last(n)) * k)
        return self.full(x, n, body)

    def kurt(self, x: Column, n: int) -> Column:
        """Bias-adjusted excess kurtosis; a constant window gives -3."""
        k = (n - 1) / ((n - 2) * (n - 3))
        g2 = F.kurtosis(x).over(self.last(n))
        body = F.when(self._flat(x, n), F.lit(-3.0)).otherwise(k * ((n + 1) * g2 + 6))
        return self.full(x, n, body)

    # --- neighbours ------------------------------------------------------------------------------
    def shift(self, x: Column, k: int) -> Column:
        return F.lag(x, k).over(self.base())

    def pct_change(self, x: Column, k: int = 1) -> Column:
        return safe_div(x, self.shift(x, k)) - 1

    def diff(self, x: Column) -> Column:
        return x - self.shift(x, 1)

    def cumsum(self, x: Column) -> Column:
        """Running sum that skips NULLs but stays NULL on a NULL row."""
        return F.when(x.isNotNull(), F.sum(x).over(self.upto()))

    def cummax(self, x: Column) -> Column:
        return F.max(x).over(self.upto())

    # --- frames read as arrays ---------------------------------------------------------------------
    def frame(self, x: Column, n: int) -> Column:
        return F.collect_list(x).over(self.last(n))

    def mad(self, x: Column, n: int) -> Column:
        """Mean absolute deviation around the mean of the same window."""
        mean = F.avg(x).over(self.last(n))
        total = F.aggregate(self.frame(x, n), F.lit(0.0), lambda acc, v: acc + F.abs(v - mean))
        return self.full(x, n, total / n)

    def since_max(self, x: Column, n: int) -> Column:
        """Rows since the window maximum; the earliest of equal maxima counts."""
        pos = F.array_position(self.frame(x, n), F.max(x).over(self.last(n)))
        return self.full(x, n, (F.lit(n) - pos).cast("double"))

    def since_min(self, x: Column, n: int) -> Column:
        pos = F.array_position(self.frame(x, n), F.min(x).over(self.last(n)))
        return self.full(x, n, (F.lit(n) - pos).cast("double"))

    def slope(self, x: Column, n: int, ordinal: Column) -> Column:
        """OLS slope of x on 0..n-1.  ``ordinal`` numbers the rows of a group; only its steps matter."""
        return self.full(x, n, F.regr_slope(x, ordinal).over(self.last(n)))

    def ordinal(self) -> Column:
        return F.row_number().over(self.base())

    def median_before(self, x: Column, n: int) -> Column:
        """Median of the n rows before the current one."""
        return F.percentile(x, F.lit(0.5)).over(self.before(n))


CODE_DATE = Roll("code", "date")
JQ_DATE = Roll("jq_code", "date")
SYMBOL_DATE = Roll("symbol", "date")
