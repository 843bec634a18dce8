"""Factor library: 98 price/volume and 64 financial factors over the panel.

A factor is a ``Spec``: metadata plus a function from ``Ctx`` to a Column.  ``Ctx`` hands out rolling
operators by (operator, input, length) and remembers them, so factors that need the same window share one
column.  An input is a column's name or any expression over columns and other operators' results, so windows and
recursions nest both ways.  ``factor_daily`` orders the operators by what they read and plans them in rounds
behind one exchange on the code.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemark.functions.histories import Tell, frames, in_frame, numbers, over_histories
from tidemark.functions.recursive import LONGEST, Smooth, telling
from tidemark.functions.scalars import log, null_if, safe_div, where, z
from tidemark.functions.windows import Roll
from tidemark.operators.asof import asof_join
from tidemark.operators.dedupe import newest_report_per_day
from tidemark.plans.fundamentals import BALANCE, CASHFLOW, INCOME
from tidemark.session import spread

ROLL = Roll("jq_code", "date")

# Units, and whether values in that unit compare across codes.
UNITS = {
    "price": False, "shares": False, "price per day": False, "money": True, "log money": True, "plain": True,
    "times": True, "percent": True, "fraction": True, "fraction squared": True, "0-100": True,
}
GROUPS = ("ma", "pos", "dist", "turn", "vol", "osc", "lev", "ttm", "val", "cfq")


#: Daily terms: the columns they are made of and the rows before today's that they look back over.
TERMS: dict[str, tuple[tuple[str, ...], int]] = {
    "C": (("close_hfq",), 0), "V": (("volume_shares",), 0), "A": (("amount",), 0), "TO": (("turnover",), 0),
    "H": (("high", "hfq_factor"), 0), "L": (("low", "hfq_factor"), 0), "O": (("open", "hfq_factor"), 0), "PC": (("preclose", "hfq_factor"), 0),
    "TP": (("H", "L", "C"), 0), "TR": (("H", "L", "PC"), 0), "HL": (("H", "L"), 0),
    "R": (("C",), 1), "TP1": (("TP",), 1), "R_prev": (("R",), 1), "ord": ((), 0),
    "UP": (("R",), 0), "V_UP": (("R", "V"), 0), "V_DN": (("R", "V"), 0), "MF": (("TP", "V"), 0), "MF_UP": (("TP", "TP1", "V"), 0), "MF_DN": (("TP", "TP1", "V"), 0),
    "PVT": (("R", "V"), 0), "WVAD": (("C", "O", "H", "L", "V"), 0), "AR_U": (("H", "O"), 0), "AR_D": (("O", "L"), 0), "BR_U": (("H", "PC"), 0), "BR_D": (("PC", "L"), 0),
    "CR_U": (("H", "TP1"), 0), "CR_D": (("TP1", "L"), 0),
}
#: Windows of so many rows are computed on arrays, in the pass of the smoothers; shorter ones by Spark.
LONG = 60
#: Rows after which a smoother of length n has forgotten its start for practical purposes, as a multiple of n.
SETTLED = 4


@dataclass
class Ctx:
    """Rolling and recursive operators, each computed once.

    An operator's input is the name of a column or an expression; expressions may use other operators' results.  ``inputs`` holds
    the expressions, ``windows`` everything that reads a frame, a lag or running totals of a column, ``smoothers`` the recursions.
    Window length is counted in rows; a NULL inside a window makes the result NULL.  No value outside a window can touch its
    result: each row reads its own frame.
    """

    inputs: dict[str, Column] = field(default_factory=dict)
    windows: dict[str, Column] = field(default_factory=dict)
    smoothers: dict[str, Smooth] = field(default_factory=dict)
    #: long windows: the statistics that are asked of them
    blocks: dict[str, set[str]] = field(default_factory=dict)
    #: operator -> the column that it reads, and the rows before today's that it looks back over (None: all of them)
    reads: dict[str, tuple[str, int | None]] = field(default_factory=dict)

    def _name(self, x: str | Column) -> str:
        """The name of an input; equal expressions share one."""
        if isinstance(x, str):
            return x
        for name, known in self.inputs.items():
            if known._jc.equals(x._jc):
                return name
        name = f"__x{len(self.inputs)}"
        self.inputs[name] = x
        return name

    def _memo(self, op: str, x: str | Column, n: int, make: Callable[[Column], Column], back: int | None = -1) -> Column:
        col = self._name(x)
        name = f"__{op}_{col}_{n}"
        if name not in self.windows:
            self.windows[name] = make(F.col(col))
            self.reads[name] = (col, n - 1 if back == -1 else back)
        return F.col(name)

    def _smooth(self, op: str, x: str | Column, n: int, alpha: float) -> Column:
        col = self._name(x)
        name = f"__{op}_{col}_{n}"
        self.smoothers[name] = Smooth(name, col, alpha, n)
        self.reads[name] = (col, SETTLED * n)
        return F.col(name)

    def ema(self, x: str | Column, n: int) -> Column:
        """Exponential mean of span ``n``, started by the mean of the first full window."""
        return self._smooth("ema", x, n, 2.0 / (n + 1))

    def wilder(self, x: str | Column, n: int) -> Column:
        """Exponential mean of weight 1/n, started by the mean of the first full window."""
        return self._smooth("wilder", x, n, 1.0 / n)

    def _count(self, col: str | Column, n: int) -> Column:
        return self._memo("count", col, n, lambda x: F.count(x).over(ROLL.last(n)))

    def _block(self, x: str | Column, n: int, *asked: str) -> Column:
        """count, sum, low, high, and central moments m2 to m4 of a window of ``n`` rows."""
        col = self._name(x)
        name = f"__block_{col}_{n}"
        self.blocks.setdefault(name, set()).update(asked)
        self.reads[name] = (col, n - 1)
        return F.col(name)

    def _full(self, op: str, col: str | Column, n: int, fn) -> Column:
        """Aggregate of a full window."""
        merged = {"sum": ("sum", lambda b: b["sum"]), "max": ("ends", lambda b: b["high"]), "min": ("ends", lambda b: b["low"]),
                  "std": ("m2", lambda b: F.sqrt(b["m2"] / (n - 1))), "stdp": ("m2", lambda b: F.sqrt(b["m2"] / n))}
        if n >= LONG and op in merged:
            asked, told = merged[op]
            b = self._block(col, n, asked)
            return F.when(b["n"] == n, told(b))
        value = self._memo(op, col, n, lambda x: fn(x).over(ROLL.last(n)))
        return F.when(self._count(col, n) == n, value)

    def rsum(self, col: str | Column, n: int) -> Column:
        return self._full("sum", col, n, F.sum)

    def ma(self, col: str | Column, n: int) -> Column:
        return self.rsum(col, n) / n

    def rmax(self, col: str | Column, n: int) -> Column:
        return self._full("max", col, n, F.max)

    def rmin(self, col: str | Column, n: int) -> Column:
        return self._full("min", col, n, F.min)

    def std(self, col: str | Column, n: int) -> Column:
        return self._full("std", col, n, F.stddev_samp)

    def stdp(self, col: str | Column, n: int) -> Column:
        return self._full("stdp", col, n, F.stddev_pop)

    def _unless_flat(self, op: str, col: str | Column, n: int, fn, flat: float, scale: Callable[[Column], Column]) -> Column:
        """A moment of a full window; a constant window gives ``flat``."""
        if n >= LONG:
            b = self._block(col, n, "ends", "m2" if op == "var" else "m4")
            told = {"var": b["m2"] / (n - 1), "skew": safe_div(n**0.5 * b["m3"], F.pow(b["m2"], 1.5)), "kurt": safe_div(n * b["m4"], b["m2"] * b["m2"]) - 3}[op]
            return F.when(b["n"] == n, F.when(b["low"] == b["high"], F.lit(flat)).otherwise(F.coalesce(scale(told), F.lit(flat))))
        value = self._memo(op, col, n, lambda x: fn(x).over(ROLL.last(n)))
        same = self.rmin(col, n) == self.rmax(col, n)
        return F.when(same, F.lit(flat)).when(self._count(col, n) == n, F.coalesce(scale(value), F.lit(flat)))

    def var(self, col: str | Column, n: int) -> Column:
        return self._unless_flat("var", col, n, F.var_samp, 0.0, lambda v: v)

    def skew(self, col: str | Column, n: int) -> Column:
        return self._unless_flat("skew", col, n, F.skewness, 0.0, lambda g1: g1 * ((n * (n - 1)) ** 0.5 / (n - 2)))

    def kurt(self, col: str | Column, n: int) -> Column:
        return self._unless_flat("kurt", col, n, F.kurtosis, -3.0, lambda g2: (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))

    def shift(self, col: str | Column, k: int) -> Column:
        return self._memo("lag", col, k, lambda x: F.lag(x, k).over(ROLL.base()), k)

    def cumsum(self, x: str | Column) -> Column:
        col = self._name(x)
        return F.when(F.col(col).isNotNull(), self._memo("run", col, 1, lambda v: F.sum(v).over(ROLL.upto()), None))

    def slope(self, col: str | Column, n: int) -> Column:
        return self._full("slope", col, n, lambda x: F.regr_slope(x, F.col("ord")))

    def _frame(self, col: str | Column, n: int) -> Column:
        return self._memo("list", col, n, lambda x: F.collect_list(x).over(ROLL.last(n)))

    def mad(self, col: str | Column, n: int) -> Column:
        mean = self.ma(col, n)
        total = F.aggregate(self._frame(col, n), F.lit(0.0), lambda acc, v: acc + F.abs(v - mean))
        return F.when(mean.isNotNull(), total / n)

    def since_max(self, col: str | Column, n: int) -> Column:
        top = self.rmax(col, n)
        return F.when(top.isNotNull(), n - F.array_position(self._frame(col, n), top).cast("double"))

    def since_min(self, col: str | Column, n: int) -> Column:
        low = self.rmin(col, n)
        return F.when(low.isNotNull(), n - F.array_position(self._frame(col, n), low).cast("double"))


@dataclass(frozen=True)
class Spec:
    id: str
    group: str
    formula: str
    unit: str
    calc: Callable[[Ctx], Column]

    @property
    def comparable(self) -> bool:
        return UNITS[self.unit]


c = F.col


def derived(panel: DataFrame) -> DataFrame:
    """Adjusted prices and the daily terms rolling factors are made of."""
    f = c("hfq_factor")
    base = panel.select(
        "jq_code", "date", c("close_hfq").alias("C"), c("volume_shares").alias("V"), c("amount").alias("A"),
        c("turnover").alias("TO"), "close_bfq", (c("high") * f).alias("H"), (c("low") * f).alias("L"),
        (c("open") * f).alias("O"), (c("preclose") * f).alias("PC"),
        *[x for x in ("totalmv", "floatmv", "peg") if x in panel.columns],
    )
    tr = F.when(
        c("PC").isNotNull(), F.greatest(c("H") - c("L"), F.abs(c("H") - c("PC")), F.abs(c("L") - c("PC")))
    )
    # NaN is a missing value from here on
    base = base.withColumns({k: F.when(~F.isnan(k), c(k)) for k, kind in base.dtypes if kind in ("double", "float")})
    return base.withColumns({"TP": (c("H") + c("L") + c("C")) / 3.0, "TR": tr, "HL": c("H") - c("L")})


def daily_terms(df: DataFrame) -> DataFrame:
    """Terms that need yesterday's row, then today's flags and flows."""
    w = ROLL.base()
    df = df.withColumns({
        "ord": F.row_number().over(w),
        "R": safe_div(c("C"), F.lag("C").over(w)) - 1,
        "TP1": F.lag("TP").over(w),
    }).withColumn("R_prev", F.lag("R").over(w))

    def positive(x: Column) -> Column:  # NULL stays NULL
        return F.when(x > 0, x).when(x <= 0, F.lit(0.0))

    rng = null_if(c("H") - c("L"), 0.0)
    mf = c("TP") * c("V")
    return df.withColumns({
        "UP": where(c("R") > 0, F.lit(1.0), F.lit(0.0)),
        "V_UP": where(c("R") > 0, c("V"), F.lit(0.0)),
        "V_DN": where(c("R") < 0, c("V"), F.lit(0.0)),
        "MF": mf,
        "MF_UP": where(c("TP") > c("TP1"), mf, F.lit(0.0)),
        "MF_DN": where(c("TP") < c("TP1"), mf, F.lit(0.0)),
        "PVT": c("R") * c("V"),
        "WVAD": (c("C") - c("O")) / rng * c("V"),
        "AR_U": c("H") - c("O"), "AR_D": c("O") - c("L"),
        "BR_U": positive(c("H") - c("PC")), "BR_D": positive(c("PC") - c("L")),
        "CR_U": positive(c("H") - c("TP1")), "CR_D": positive(c("TP1") - c("L")),
    })


def _ratio100(x: Ctx, up: str, dn: str) -> Column:
    return safe_div(100.0 * x.rsum(up, 26), x.rsum(dn, 26))


def _cci(x: Ctx, n: int) -> Column:
    return safe_div(c("TP") - x.ma("TP", n), 0.015 * x.mad("TP", n))


def _growth(now: Column, before: Column) -> Column:
    return safe_div(now, before) - 1


def _dif(x: Ctx, col: str) -> Column:
    return x.ema(col, 12) - x.ema(col, 26)


def _triple(x: Ctx, n: int) -> Column:
    return x.ema(x.ema(x.ema("C", n), n), n)


PRICE_VOLUME: list[Spec] = [
    # moving averages and trend
    *[Spec(f"ma{n}", "ma", f"MA(C,{n})", "price", lambda x, n=n: x.ma("C", n)) for n in (5, 10, 20, 60, 120)],
    *[Spec(f"ema{n}", "ma", f"EMA(C,{n})", "price", lambda x, n=n: x.ema("C", n)) for n in (5, 10, 12, 20, 26, 120)],
    Spec("macd", "ma", "2*(DIF-DEA), DIF=EMA12-EMA26, DEA=EMA(DIF,9)", "price",
         lambda x: 2 * (_dif(x, "C") - x.ema(_dif(x, "C"), 9))),
    Spec("vmacd", "ma", "MACD of volume", "shares", lambda x: 2 * (_dif(x, "V") - x.ema(_dif(x, "V"), 9))),
    *[Spec(f"trix{n}", "ma", f"pct change of triple EMA(C,{n})", "fraction",
           lambda x, n=n: _growth(_triple(x, n), x.shift(_triple(x, n), 1))) for n in (5, 10)],
    Spec("boll_up", "ma", "MA20 + 2*population std", "price", lambda x: x.ma("C", 20) + 2 * x.stdp("C", 20)),
    Spec("boll_dn", "ma", "MA20 - 2*population std", "price", lambda x: x.ma("C", 20) - 2 * x.stdp("C", 20)),
    Spec("bbi", "ma", "mean of MA 3, 6, 12, 24", "price",
         lambda x: (x.ma("C", 3) + x.ma("C", 6) + x.ma("C", 12) + x.ma("C", 24)) / 4.0),
    # position
    *[Spec(f"price_div_ma{n}", "pos", f"C/MA(C,{n})-1", "fraction", lambda x, n=n: _growth(c("C"), x.ma("C", n))) for n in (20, 60, 250)],
    *[Spec(f"slope{n}", "pos", f"OLS slope of C over {n}", "price per day", lambda x, n=n: x.slope("C", n)) for n in (6, 12, 24)],
    Spec("close_bfq", "pos", "raw close", "price", lambda x: c("close_bfq")),
    Spec("pos_1y", "pos", "(C-min L)/(max H-min L), 250", "fraction",
         lambda x: safe_div(c("C") - x.rmin("L", 250), x.rmax("H", 250) - x.rmin("L", 250))),
    # distribution of returns
    *[Spec(f"skew{n}", "dist", f"skewness of R, {n}", "plain", lambda x, n=n: x.skew("R", n)) for n in (20, 60, 120)],
    *[Spec(f"kurt{n}", "dist", f"excess kurtosis of R, {n}", "plain", lambda x, n=n: x.kurt("R", n)) for n in (20, 60, 120)],
    *[Spec(f"var{n}", "dist", f"sample variance of R, {n}", "fraction squared", lambda x, n=n: x.var("R", n)) for n in (20, 60, 120)],
    Spec("std20", "dist", "sample std of R, 20", "fraction", lambda x: x.std("R", 20)),
    # turnover
    *[Spec(f"to_ma{n}", "turn", f"MA(TO,{n})", "percent", lambda x, n=n: x.ma("TO", n)) for n in (5, 10, 20, 60, 120, 240)],
    *[Spec(f"to_ratio{n}", "turn", f"MA(TO,{n})/MA(TO,120)", "times", lambda x, n=n: safe_div(x.ma("TO", n), x.ma("TO", 120))) for n in (5, 10, 20)],
    Spec("to_std20", "turn", "sample std of TO, 20, /100", "fraction", lambda x: x.std("TO", 20) / 100.0),
    Spec("to_sum20", "turn", "sum of TO, 20", "percent", lambda x: x.rsum("TO", 20)),
    Spec("to_m_q", "turn", "sum of TO, 60, /3", "percent", lambda x: x.rsum("TO", 60) / 3.0),
    Spec("to_m_y", "turn", "sum of TO, 240, /12", "percent", lambda x: x.rsum("TO", 240) / 12.0),
    # volume and money flow
    *[Spec(f"v_ema{n}", "vol", f"EMA(V,{n})", "shares", lambda x, n=n: x.ema("V", n)) for n in (5, 10, 26)],
    Spec("vosc", "vol", "(MA(V,12)-MA(V,26))/MA(V,12)", "fraction",
         lambda x: safe_div(x.ma("V", 12) - x.ma("V", 26), x.ma("V", 12))),
    Spec("vmacd_dif", "vol", "EMA(V,12)-EMA(V,26)", "shares", lambda x: _dif(x, "V")),
    Spec("vmacd_dea", "vol", "EMA(vmacd_dif,9)", "shares", lambda x: x.ema(_dif(x, "V"), 9)),
    *[Spec(f"v_std{n}", "vol", f"sample std of V, {n}", "shares", lambda x, n=n: x.std("V", n)) for n in (10, 20)],
    Spec("v_ma12", "vol", "MA(V,12)", "shares", lambda x: x.ma("V", 12)),
    Spec("vr26", "vol", "sum V on up days / sum V on down days, 26", "times",
         lambda x: safe_div(x.rsum("V_UP", 26), x.rsum("V_DN", 26))),
    *[Spec(f"vroc{n}", "vol", f"V/V[-{n}]-1", "fraction", lambda x, n=n: _growth(c("V"), x.shift("V", n))) for n in (6, 12)],
    Spec("vol_ret20", "vol", "V/MA(V,20)*MA(R,20)", "fraction", lambda x: safe_div(c("V"), x.ma("V", 20)) * x.ma("R", 20)),
    *[Spec(f"a_ma{n}", "vol", f"MA(amount,{n})", "money", lambda x, n=n: x.ma("A", n)) for n in (6, 20)],
    *[Spec(f"a_std{n}", "vol", f"sample std of amount, {n}", "money", lambda x, n=n: x.std("A", n)) for n in (6, 20)],
    Spec("mfi14", "vol", "100*MF+/(MF+ + MF-), 14, by direction of TP", "0-100",
         lambda x: safe_div(100.0 * x.rsum("MF_UP", 14), x.rsum("MF_UP", 14) + x.rsum("MF_DN", 14))),
    Spec("mf_sum20", "vol", "sum of TP*V, 20", "money", lambda x: x.rsum("MF", 20)),
    Spec("pvt", "vol", "running sum of R*V", "shares", lambda x: x.cumsum("PVT")),
    *[Spec(f"pvt_ma{n}", "vol", f"MA(R*V,{n})", "shares", lambda x, n=n: x.ma("PVT", n)) for n in (6, 12)],
    # oscillators
    *[Spec(f"cci{n}", "osc", f"(TP-MA(TP,{n}))/(0.015*MAD)", "plain", lambda x, n=n: _cci(x, n)) for n in (10, 15, 20, 88)],
    *[Spec(f"bias{n}", "osc", f"(C-MA(C,{n}))/MA(C,{n})", "fraction", lambda x, n=n: safe_div(c("C") - x.ma("C", n), x.ma("C", n))) for n in (5, 10, 20, 60)],
    *[Spec(f"roc{n}", "osc", f"C/C[-{n}]-1", "fraction", lambda x, n=n: _growth(c("C"), x.shift("C", n))) for n in (6, 12, 20, 60, 120)],
    *[Spec(f"atr{n}", "osc", f"Wilder(TR,{n})", "price", lambda x, n=n: x.wilder("TR", n)) for n in (6, 14)],
    Spec("aroon_up", "osc", "100*(25-days since max H)/25, 26 bars", "0-100", lambda x: 100.0 * (25.0 - x.since_max("H", 26)) / 25.0),
    Spec("aroon_dn", "osc", "100*(25-days since min L)/25, 26 bars", "0-100", lambda x: 100.0 * (25.0 - x.since_min("L", 26)) / 25.0),
    Spec("ar26", "osc", "100*sum(H-O)/sum(O-L), 26", "plain", lambda x: _ratio100(x, "AR_U", "AR_D")),
    Spec("br26", "osc", "100*sum max(H-PC,0)/sum max(PC-L,0), 26", "plain", lambda x: _ratio100(x, "BR_U", "BR_D")),
    Spec("arbr", "osc", "ar26-br26", "plain", lambda x: _ratio100(x, "AR_U", "AR_D") - _ratio100(x, "BR_U", "BR_D")),
    Spec("cr26", "osc", "br26 around yesterday's TP", "plain", lambda x: _ratio100(x, "CR_U", "CR_D")),
    Spec("mass", "osc", "sum of EMA9(H-L)/EMA9(EMA9(H-L)), 25", "plain", lambda x: x.rsum(safe_div(x.ema("HL", 9), x.ema(x.ema("HL", 9), 9)), 25)),
    Spec("bull_power", "osc", "H-EMA(C,13)", "price", lambda x: c("H") - x.ema("C", 13)),
    Spec("bear_power", "osc", "L-EMA(C,13)", "price", lambda x: c("L") - x.ema("C", 13)),
    Spec("wvad", "osc", "sum of (C-O)/(H-L)*V, 24", "shares", lambda x: x.rsum("WVAD", 24)),
    Spec("wvad_ma6", "osc", "MA of the daily WVAD term, 6", "shares", lambda x: x.ma("WVAD", 6)),
    Spec("psy12", "osc", "100*count(R>0)/12", "0-100", lambda x: 100.0 * x.rsum("UP", 12) / 12.0),
]
RECURSIVE = frozenset(
    "ema5 ema10 ema12 ema20 ema26 ema120 macd vmacd trix5 trix10 v_ema5 v_ema10 v_ema26 vmacd_dif vmacd_dea atr6 atr14 mass "
    "bull_power bear_power".split()
)


def b(name: str) -> Column:
    return c(f"b_{name}")


def t(name: str) -> Column:
    return c(f"t_{name}")


def _debt() -> Column:
    return z(b("shortterm_loan")) + z(b("longterm_loan")) + z(b("bonds_payable")) + z(b("non_current_liability_in_one_year"))


def _fin_assets() -> Column:
    return z(b("cash_equivalents")) + z(b("trading_assets")) + z(b("hold_to_maturity_investments"))


def _fin(id: str, group: str, formula: str, unit: str, make: Callable[[], Column]) -> Spec:
    return Spec(id, group, formula, unit, lambda _x: make())


def _over(num: Callable[[], Column], den: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: safe_div(num(), den())


TTM_FIELDS = {
    "ttm_np": "net_profit", "ttm_np_parent": "np_parent_company_owners", "ttm_tp": "total_profit", "ttm_op": "operating_profit",
    "ttm_rev": "operating_revenue", "ttm_trev": "total_operating_revenue", "ttm_cost": "operating_cost",
    "ttm_tcost": "total_operating_cost", "ttm_fin_exp": "financial_expense", "ttm_adm_exp": "administration_expense",
    "ttm_sale_exp": "sale_expense", "ttm_ocf": "net_operate_cash_flow", "ttm_icf": "net_invest_cash_flow",
    "ttm_fcf": "net_finance_cash_flow", "ttm_goods_cash": "goods_sale_and_service_render_cash", "ttm_impair": "asset_impairment_loss",
}


def _financial() -> list[Spec]:
    ta, tl, te = (lambda: b("total_assets")), (lambda: b("total_liability")), (lambda: b("total_owner_equities"))
    ca, cl = (lambda: b("total_current_assets")), (lambda: b("total_current_liability"))
    ncl = lambda: z(b("total_non_current_liability"))
    mv = lambda: c("totalmv")
    ocf = lambda: t("net_operate_cash_flow")
    one_year = lambda: z(b("shortterm_loan")) + z(b("non_current_liability_in_one_year"))
    lev = [
        ("curr_ratio", "current assets / current liabilities", "times", _over(ca, cl)),
        ("quick_ratio", "(current assets - inventories) / current liabilities", "times", _over(lambda: ca() - b("inventories"), cl)),
        ("superquick_ratio", "(cash + trading + receivables) / current liabilities", "times",
         _over(lambda: z(b("cash_equivalents")) + z(b("trading_assets")) + z(b("account_receivable")), cl)),
        ("cash_ratio", "cash / current liabilities", "times", _over(lambda: b("cash_equivalents"), cl)),
        ("debt_asset", "liabilities / assets", "fraction", _over(tl, ta)),
        ("equity_ratio_a", "equity / assets", "fraction", _over(te, ta)),
        ("debt_equity", "liabilities / equity", "times", _over(tl, te)),
        ("book_lev", "(equity + non-current liabilities) / equity", "times", _over(lambda: te() + ncl(), te)),
        ("mkt_lev", "(market value + preferred + non-current liabilities) / market value", "times",
         _over(lambda: mv() + z(b("preferred_shares_equity")) + ncl(), mv)),
        ("fixed_ratio", "fixed assets / assets", "fraction", _over(lambda: b("fixed_assets"), ta)),
        ("intang_ratio", "intangible assets / assets", "fraction", _over(lambda: b("intangible_assets"), ta)),
        ("noncurr_ratio", "non-current assets / assets", "fraction", _over(lambda: b("total_non_current_assets"), ta)),
        ("debt_to_asset2", "interest-bearing debt / assets", "fraction", _over(_debt, ta)),
        ("lt_loan_asset", "long-term loans / assets", "fraction", _over(lambda: b("longterm_loan"), ta)),
        ("lt_liab_asset", "non-current liabilities / assets", "fraction", _over(ncl, ta)),
        ("equity_fixed", "equity / fixed assets", "times", _over(te, lambda: b("fixed_assets"))),
        ("tangible_debt", "liabilities / (equity - intangibles)", "times", _over(tl, lambda: te() - z(b("intangible_assets")))),
        ("lt_liab_wc", "non-current liabilities / working capital", "times",
         _over(lambda: b("total_non_current_liability"), lambda: ca() - cl())),
        ("net_debt", "interest-bearing debt - cash", "money", lambda: _debt() - z(b("cash_equivalents"))),
        ("fin_liab", "interest-bearing debt", "money", _debt),
        ("fin_asset", "cash + trading + held-to-maturity", "money", _fin_assets),
        ("oper_asset", "assets - financial assets", "money", lambda: ta() - _fin_assets()),
        ("oper_liab", "liabilities - interest-bearing debt", "money", lambda: tl() - _debt()),
        ("net_wc", "current assets - current liabilities", "money", lambda: ca() - cl()),
        ("int_curr_liab", "short-term loans + current part of non-current", "money", one_year),
        ("no_int_curr_liab", "current liabilities without interest", "money",
         lambda: cl() - z(b("shortterm_loan")) - z(b("non_current_liability_in_one_year"))),
        ("retained", "surplus reserve + retained profit", "money", lambda: z(b("surplus_reserve_fund")) + z(b("retained_profit"))),
    ]
    out = [_fin(i, "lev", f, u, m) for i, f, u, m in lev]
    out += [_fin(i, "ttm", f"TTM {f}", "money", lambda f=f: t(f)) for i, f in TTM_FIELDS.items()]
    ttm = [
        ("ttm_gross", "TTM revenue - TTM cost", "money", lambda: t("operating_revenue") - t("operating_cost")),
        ("ttm_nonop", "TTM non-operating result", "money", lambda: t("non_operating_revenue") - t("non_operating_expense")),
        ("ttm_value_chg", "TTM fair value change + investment income", "money", lambda: t("fair_value_variable_income") + t("investment_income")),
        ("ttm_ocf_ev", "TTM operating cash flow / enterprise value", "fraction",
         _over(ocf, lambda: mv() + _debt() - z(b("cash_equivalents")))),
    ]
    out += [_fin(i, "ttm", f, u, m) for i, f, u, m in ttm]
    val = [
        ("mv", "total market value", "money", mv),
        ("mv_float", "float market value", "money", lambda: c("floatmv")),
        ("ln_mv", "log of market value", "log money", lambda: log(mv())),
        ("ep", "TTM profit / market value", "fraction", _over(lambda: t("net_profit"), mv)),
        ("sp", "TTM revenue / market value", "fraction", _over(lambda: t("operating_revenue"), mv)),
        ("cfp", "TTM operating cash flow / market value", "fraction", _over(ocf, mv)),
        ("fcfp", "TTM free cash flow / market value", "fraction", _over(lambda: ocf() - t("fix_intan_other_asset_acqui_cash"), mv)),
        ("peg", "panel peg", "times", lambda: c("peg")),
    ]
    out += [_fin(i, "val", f, u, m) for i, f, u, m in val]
    cfq = [
        ("ocf_np", "operating cash flow / profit", _over(ocf, lambda: t("net_profit"))),
        ("ocf_rev", "operating cash flow / revenue", _over(ocf, lambda: t("operating_revenue"))),
        ("ocf_ta", "operating cash flow / assets", _over(ocf, ta)),
        ("ocf_liab", "operating cash flow / liabilities", _over(ocf, tl)),
        ("ocf_cl", "operating cash flow / current liabilities", _over(ocf, cl)),
        ("ocf_netdebt", "operating cash flow / net debt", _over(ocf, lambda: _debt() - z(b("cash_equivalents")))),
        ("goods_rev", "cash from sales / revenue", _over(lambda: t("goods_sale_and_service_render_cash"), lambda: t("operating_revenue"))),
        ("ocf_opinc", "operating cash flow / operating income", _over(ocf, lambda: t("total_operating_revenue") - t("total_operating_cost"))),
        ("cfroa_gap", "operating cash flow / assets - profit / assets",
         lambda: safe_div(ocf(), ta()) - safe_div(t("net_profit"), ta())),
    ]
    out += [_fin(i, "cfq", f, "fraction", m) for i, f, m in cfq]
    return out


FINANCIAL = _financial()
ALL = [*PRICE_VOLUME, *FINANCIAL]


def check_ids(specs: Sequence[Spec]) -> None:
    ids = [s.id for s in specs]
    twice = sorted({i for i in ids if ids.count(i) > 1})
    if twice:
        raise ValueError(f"factor ids used twice: {twice}")


check_ids(ALL)


def by_code(df: DataFrame, parts: int | None = None) -> DataFrame:
    """The one exchange of the factor job.

    The partition number is given, so adaptive execution does not merge partitions by their (small) size:
    this stage is bound by computation, not by bytes.
    """
    return spread(df, "jq_code", parts=parts)


def references(df: DataFrame, columns: Sequence[Column]) -> list[set[str]]:
    """For each expression the columns of ``df`` that it reads, from Spark's analysis of it."""
    if not columns:
        return []
    plan = df.select(*[x.alias(f"__k{i}") for i, x in enumerate(columns)])._jdf.queryExecution().analyzed()
    listed, known = plan.expressions(), set(df.columns)
    out = []
    for i in range(len(columns)):
        found = listed.apply(i).references().toSeq()
        out.append({found.apply(k).name() for k in range(found.size())})
    if any(not names <= known for names in out):
        raise ValueError("a formula may use windows through the operators of Ctx only")
    return out


def plain(df: DataFrame, columns: Sequence[Column]) -> list[str | tuple[str, str] | None]:
    """For each expression the column that it is, or the two (a, b) if it is a - b; None for all others."""
    if not columns:
        return []
    listed = df.select(*[x.alias(f"__k{i}") for i, x in enumerate(columns)])._jdf.queryExecution().analyzed().expressions()
    kind = lambda x: x.getClass().getSimpleName()

    def told(x) -> str | tuple[str, str] | None:
        if kind(x) == "Subtract" and kind(x.left()) == kind(x.right()) == "AttributeReference":
            return x.left().name(), x.right().name()
        return x.name() if kind(x) == "AttributeReference" else None

    return [told(listed.apply(i).child()) for i in range(len(columns))]


BLOCK = "struct<n:bigint,sum:double,low:double,high:double,m2:double,m3:double,m4:double>"


def repeated_starts(day: np.ndarray, place: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose frame of ``rows`` rows starts on a day that its code has more than once, that first row, and from where to where the
    day goes. Frames cross the blocks of ``rows`` rows that a code is cut into, except whole blocks; days end with their block."""
    at = np.arange(len(day))
    new = (place % rows == 0) | np.concatenate([[True], day[1:] != day[:-1]])
    begin = np.maximum.accumulate(np.where(new, at, 0))
    end = np.concatenate([np.flatnonzero(new), [len(day)]])[np.cumsum(new)]
    some = np.flatnonzero((place >= rows) & ((place + 1) % rows != 0))
    some = some[end[some - rows + 1] - begin[some - rows + 1] > 1]
    return some, some - rows + 1, begin[some - rows + 1], end[some - rows + 1]


def block_statistics(x: np.ndarray, valid: np.ndarray, place: np.ndarray, rows: int, asks: set[str], day: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """What is asked of each row's frame of ``rows`` rows, as (values, rows without one). Every row reads its own frame.

    Of a repeated ``day`` that a frame starts with, the rows up to the first one belong to it, not those after it: the end of a block
    is counted from its last day back, rows of a day as they come.
    """
    n = in_frame(valid, place, rows)
    odd, first, begin, end = repeated_starts(day, place, rows)
    longest = rows + int((first - begin).max(initial=0))
    special = np.zeros(len(x), bool)
    special[odd] = True
    nth = np.cumsum(special) - 1
    for part, own, (ok,) in frames(odd, place, longest, valid):
        n[odd[part]] = (own & ok & _of_day(odd[part], longest, first[part], begin[part], end[part])).sum(axis=1)
    names = [k for k in ("sum", "low", "high", "m2", "m3", "m4") if k in {q for a in asks for q in STATISTICS[a]}]
    out = {k: np.zeros(len(x)) for k in names}
    x = np.where(valid, x, 0.0)
    whole = (n == rows) & ~special
    for full, at, most in ((True, np.flatnonzero(whole), rows), (False, np.flatnonzero(~whole & ~special), rows), (False, odd, longest)):
        for part, own, (v, ok) in frames(at, place, most, x, valid):
            to = at[part]
            if not full:
                own = own & ok
                if at is odd:
                    own &= _of_day(to, most, *(y[nth[to]] for y in (first, begin, end)))
                v = np.where(own, v, 0.0)
            total = v.sum(axis=1)
            if "sum" in out:
                out["sum"][to] = total
            if "low" in out:
                out["low"][to] = np.fmin.reduce(v if full else np.where(own, v, np.inf), axis=1)
                out["high"][to] = (v if full else np.where(own, v, -np.inf)).max(axis=1)
            if "m2" in out:
                d = v - (total / n[to])[:, None]
                d = d if full else np.where(own, d, 0.0)
                # values that do not differ have no moments; their mean may be off by a rounding
                v = v if full else np.where(own, v, np.nan)
                d[np.fmin.reduce(v, axis=1) == np.fmax.reduce(v, axis=1)] = 0.0
                square = d * d
                out["m2"][to] = square.sum(axis=1)
                if "m4" in out:
                    out["m3"][to], out["m4"][to] = np.einsum("ij,ij->i", square, d), np.einsum("ij,ij->i", square, square)
    none, never = n == 0, np.zeros(len(x), bool)
    return {"n": (n, never), **{k: (v, never if k == "sum" else none) for k, v in out.items()}}


def _of_day(at: np.ndarray, rows: int, first: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of the last ``rows`` rows up to ``at`` those from ``begin`` to ``first`` and from ``end`` on."""
    k = at[:, None] - np.arange(rows - 1, -1, -1)
    return ((k >= begin[:, None]) & (k <= first[:, None])) | (k >= end[:, None])


#: What the statistics that a window is asked for are made of.
STATISTICS = {"sum": ["sum"], "ends": ["low", "high"], "m2": ["m2"], "m4": ["m2", "m3", "m4"]}


def telling_blocks(asked: dict[str, tuple[str, int, set[str]]]) -> tuple[list[StructField], Tell]:
    """The columns of long windows, name -> (column, rows, statistics asked), and how a pass over whole groups makes them."""
    fields = []
    for name, (_, _, asks) in asked.items():
        told = [k for k in ("sum", "low", "high", "m2", "m3", "m4") if k in {q for a in asks for q in STATISTICS[a]}]
        fields.append(StructField(name, StructType([StructField("n", LongType()), *(StructField(k, DoubleType()) for k in told)])))

    def tell(batch: pa.RecordBatch, place: np.ndarray) -> list[pa.Array]:
        out = []
        day = batch.column("date").dictionary_encode().indices.fill_null(-1).to_numpy()
        for column, rows, asks in asked.values():
            valid = batch.column(column).is_valid().to_numpy(zero_copy_only=False)
            got = block_statistics(numbers(batch, column), valid, place, rows, asks, day)
            out.append(pa.StructArray.from_arrays([pa.array(v, mask=none) for v, none in got.values()], list(got)))
        return out

    return fields, tell


def merge_blocks(df: DataFrame, rows: int, asked: dict[str, tuple[str, set[str]]]) -> DataFrame:
    """``df`` (jq_code, date, ...) with windows of ``rows`` rows: name -> (column, statistics asked). A value that has left a window
    leaves nothing behind."""
    fields, tell = telling_blocks({n: (column, rows, asks) for n, (column, asks) in asked.items()})
    return over_histories(df, "jq_code", "date", fields, [tell])


@dataclass
class Plan:
    """What a set of factors needs: operators by round, and the daily columns that everything is made of."""

    ctx: Ctx
    columns: list[Column]
    #: name -> names that it reads, for inputs, operators and (as "=id") every factor
    reads: dict[str, set[str]]
    rounds: dict[str, int]
    base: set[str]
    #: smoothers that read what others leave, or the difference of two: they are told in the same pass
    chained: dict[str, Smooth]
    #: ``rounds`` as they are run, chained smoothers with those that they read
    passes: dict[str, int]

    @classmethod
    def of(cls, specs: Sequence[Spec], base: Sequence[str]) -> Plan:
        """``base`` are the daily columns that exist; the formulas are analysed against them and the operators' results."""
        ctx = Ctx()
        columns = [s.calc(ctx) for s in specs]
        ops = [n for n in ctx.reads]
        kind = lambda n: "array<double>" if n.startswith("__list_") else BLOCK if n.startswith("__block_") else "double"
        blank = SparkSession.getActiveSession().range(0).select(*[F.lit(None).cast(kind(n)).alias(n) for n in dict.fromkeys(["jq_code", "date", *base, *ops])])
        found = references(blank, [*ctx.inputs.values(), *columns])
        reads = dict(zip([*ctx.inputs, *(f"={s.id}" for s in specs)], found))
        reads |= {n: {col} | ({"ord"} if n.startswith("__slope_") else set()) for n, (col, _) in ctx.reads.items()}
        form = dict(zip(ctx.inputs, plain(blank, list(ctx.inputs.values()))))
        chained: dict[str, Smooth] = {}
        for n, x in ctx.smoothers.items():
            src = form.get(x.src)
            if src is not None and all(y in ctx.smoothers for y in ([src] if isinstance(src, str) else src)):
                chained[n] = Smooth(n, src, x.alpha, x.seed)

        def placed(chained: dict[str, Smooth]) -> dict[str, int]:
            rounds: dict[str, int] = {}

            def place(name: str) -> int:
                if name not in ctx.inputs and name not in ctx.reads:
                    return 0
                if name in chained and name not in rounds:
                    src = chained[name].src
                    rounds[name] = max(place(x) for x in ([src] if isinstance(src, str) else src))
                if name not in rounds:
                    rounds[name] = max((place(x) for x in reads[name]), default=0) + (name in ctx.reads)
                return rounds[name]

            for name in [*ctx.inputs, *ops]:
                place(name)
            return rounds

        own = {*ctx.inputs, *ops}
        needed = set().union(*(reads[n] for n in reads)) - own if reads else set()
        return cls(ctx, columns, reads, placed({}), needed, chained, placed(chained))

    def start(self, df: DataFrame, later: Sequence[str] = ()) -> tuple[DataFrame, set[str]]:
        """``df`` with the smoothers and long windows of the first round, and what it now has, so that they pass through Python before
        anything else is there to carry. What reads columns that come ``later`` is left out."""

        def below(name: str) -> set[str]:
            return {name}.union(*(below(x) for x in self.reads.get(name, ())))

        mine = [n for n in (*self.ctx.smoothers, *self.ctx.blocks) if self.passes[n] == 1 and not below(n) & set(later)]
        read = set().union(*(below(n) for n in mine)) if mine else set()
        inputs = [n for n, r in self.passes.items() if r == 0 and n in read]
        return self._step(self._step(df, inputs), mine), {*inputs, *mine}

    def run(self, df: DataFrame, told: Sequence[str] = (), parts: int | None = None) -> DataFrame:
        """``df`` (jq_code, date, daily columns, those ``told`` by ``start``) with every operator's column."""
        left = {n: r for n, r in self.passes.items() if n not in told}
        for k in range(max(left.values(), default=0) + 1):
            df = self._step(df, [n for n, r in left.items() if r == k], parts)
        return df

    def _step(self, df: DataFrame, mine: Sequence[str], parts: int | None = None) -> DataFrame:
        smoothers = [self.chained.get(n, self.ctx.smoothers[n]) for n in mine if n in self.ctx.smoothers]
        long = {n: (self.ctx.reads[n][0], self.ctx.reads[n][1] + 1, self.ctx.blocks[n]) for n in mine if n in self.ctx.blocks}
        if smoothers or long:
            fields, tells = zip(*(x for x in (telling(smoothers), telling_blocks(long)) if x[0]))
            df = over_histories(df, "jq_code", "date", sum(fields, []), tells, LONGEST if smoothers else None)
            df = by_code(df, parts) if parts else df
        df = df.withColumns({n: self.ctx.windows[n] for n in mine if n in self.ctx.windows})
        # a NaN that a formula makes is a missing value
        return df.withColumns({n: F.when(~F.isnan(x), x) for n, x in ((n, self.ctx.inputs[n].cast("double")) for n in mine if n in self.ctx.inputs)})

    def trace(self, name: str) -> tuple[set[str], int | None, bool]:
        """(panel and statement columns below ``name``, rows before today's that it looks back over, recursive). None: all rows."""
        if name in self.reads or name in TERMS:
            below, back = (self.reads[name], self.ctx.reads.get(name, ("", 0))[1]) if name in self.reads else TERMS[name]
            parts = [self.trace(x) for x in below]
            rows = None if back is None or any(r is None for _, r, _ in parts) else back + max((r for _, r, _ in parts), default=0)
            return set().union(*(d for d, _, _ in parts)), rows, name in self.ctx.smoothers or any(r for _, _, r in parts)
        return {name}, 0, False


DAILY = ("C", "V", "A", "TO", "close_bfq", "H", "L", "O", "PC", "totalmv", "floatmv", "peg", "TP", "TR", "HL", "ord", "R", "TP1", "R_prev", "UP", "V_UP", "V_DN", "MF", "MF_UP", "MF_DN", "PVT",
         "WVAD", "AR_U", "AR_D", "BR_U", "BR_D", "CR_U", "CR_D")
STATEMENT = tuple(f"{kind}_{f}" for kind, fields in (("b", BALANCE), ("t", [*INCOME, *CASHFLOW]), ("c", [*INCOME, *CASHFLOW])) for f in fields)


def requirements(specs: Sequence[Spec] = ()) -> list[tuple[str, list[str], int | None, bool]]:
    """(factor, panel and statement columns, rows of warm-up, recursive) of each factor.

    Warm-up is the sum of frames along the longest way down; a smoother of length n counts SETTLED * n rows and makes the factor
    recursive (its exact state reaches back to the first row); None: a running total, which needs every row.
    """
    specs = specs or ALL
    plan = Plan.of(specs, [*DAILY, *STATEMENT])
    return [(s.id, sorted(deps), rows, recursive) for s in specs for deps, rows, recursive in (plan.trace(f"={s.id}"),)]


def by_report(plan: Plan, filed: Sequence[str]) -> list[str]:
    """Factors of ``plan`` that read columns of a report and nothing of the day: they change with reports only."""
    own = set(filed)
    return [name[1:] for name, below in plan.reads.items() if name.startswith("=") and below and below <= own]


def factor_daily(
    panel: DataFrame, statements: DataFrame | None, specs: Sequence[Spec] | None = None, dtype: str | None = "float",
    finish: Callable[[Column], Column] | None = None, parts: int | None = None,
) -> DataFrame:
    """(jq_code, date, one column per factor).  ``statements`` is the output of ``statement_layer``.

    Factors of the report alone are computed once a report and carried to the days; what they are where a code has no report
    yet, one row tells.  ``finish`` is applied to each factor (a rounding, say), ``parts`` is the number of parts by code.
    """
    specs = ALL if specs is None else specs
    check_ids(specs)
    right = newest_report_per_day(statements) if statements is not None else None
    filed = [x for x in right.columns if x[:2] in ("b_", "t_", "c_")] if right is not None else []
    df = daily_terms(by_code(derived(panel), parts))
    plan = Plan.of(specs, [*(x for x in df.columns if x not in ("jq_code", "date")), *filed])
    df = df.select("jq_code", "date", *[x for x in df.columns if x in plan.base])
    cols = [x for x in filed if x in plan.base]
    df, ready = plan.start(df, cols)
    if ready and not cols and any(n not in ready and n in plan.ctx.windows for n in plan.rounds):
        df = by_code(df, parts)
    # cast last, so the stored width does not enter any window
    typed = {s.id: x.cast(dtype) if dtype else x for s, x in zip(specs, plan.columns)}
    typed = {i: finish(x) for i, x in typed.items()} if finish else typed
    if cols:
        told = {i: f"__of_{i}" for i in by_report(plan, cols)}
        told_columns = [typed[i].alias(name) for i, name in told.items()]
        daily = [x for x in cols if any(x in below for name, below in plan.reads.items() if name[1:] not in told)]
        none = right.limit(0).agg(*[F.first(x).alias(x) for x in cols]).select(*told_columns).first() if told else {}
        right = right.select(F.col("code").alias("jq_code"), "pub_date", *daily, *told_columns, F.lit(True).alias("__told"))
        df = asof_join(df, right, ["jq_code"], "date", "pub_date", [*daily, *told.values(), "__told"], left_unique=True, parts=parts)
        blank = lambda name: F.lit(none[name]).cast(right.schema[name].dataType)
        typed |= {i: F.col(name) if none[name] is None else F.when(F.col("__told"), F.col(name)).otherwise(blank(name)) for i, name in told.items()}
    return plan.run(df, ready, parts).select("jq_code", "date", *[typed[s.id].alias(s.id) for s in specs])


def try_factor(panel: DataFrame, name: str, calc: Callable[[Ctx], Column]) -> DataFrame:
    """Trial run of a user factor over the whole history."""
    return factor_daily(panel, None, [Spec(name, "osc", name, "plain", calc)], dtype=None)
