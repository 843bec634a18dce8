"""Technical indicators of the acquisition side (``ind_*``).

They differ from the factor library on purpose: other seeds, sample deviations, percent units, partial windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.recursive import apply_smoothers, ewm_first
from tidemark.functions.scalars import safe_div
from tidemark.functions.windows import Roll

ROLL = Roll("symbol", "date")
MA_DAYS = (5, 10, 20, 60, 200, 250, 500)
EMA_DAYS = (5, 10, 12, 20, 26)
c = F.col


def _span(out: str, src, n: int):
    return ewm_first(out, src, 2.0 / (n + 1))


SMOOTHERS = [
    *[_span(f"ind_ema{n}", "close", n) for n in EMA_DAYS],
    _span("ind_macd_signal", ("ind_ema12", "ind_ema26"), 9),
    ewm_first("ind_kdj_k", "rsv", 1.0 / 3),
    ewm_first("ind_kdj_d", "ind_kdj_k", 1.0 / 3),
]


def _long_mean(x: str, n: int) -> Column:
    """Full-window mean from running totals (one lag per length instead of a re-read frame)."""
    run, cnt = c(f"__sum_{x}"), c("ord")
    return F.when(cnt >= n, (run - F.coalesce(F.lag(run, n).over(ROLL.base()), F.lit(0.0))) / n)


def native_indicators(bars: DataFrame) -> DataFrame:
    """All indicators without recursion.  ``bars``: symbol, date, open, high, low, close, volume (no NULLs)."""
    w, upto = ROLL.base(), ROLL.upto()
    df = bars.withColumns({
        "ord": F.row_number().over(w), "pc": F.lag("close").over(w), "ph": F.lag("high").over(w), "pl": F.lag("low").over(w),
        "tp": (c("high") + c("low") + c("close")) / 3.0,
    })
    delta = c("close") - c("pc")
    up_move, dn_move = c("high") - c("ph"), c("pl") - c("low")
    df = df.withColumns({
        "ret": safe_div(c("close"), c("pc")) - 1,
        "gain": F.when(delta > 0, delta).otherwise(0.0), "loss": F.when(delta < 0, -delta).otherwise(0.0),
        "tr": F.greatest(c("high") - c("low"), F.abs(c("high") - c("pc")), F.abs(c("low") - c("pc"))),  # the first day is high - low
        "pdm": F.when(up_move > dn_move, F.greatest(up_move, F.lit(0.0))).otherwise(0.0),
        "mdm": F.when(dn_move > up_move, F.greatest(dn_move, F.lit(0.0))).otherwise(0.0),
        "flow": F.coalesce(F.signum(delta) * c("volume"), F.lit(0.0)),
        "__sum_close": F.sum("close").over(upto), "ind_obv": F.sum(F.coalesce(F.signum(delta) * c("volume"), F.lit(0.0))).over(upto),
        "ind_vwap": safe_div(F.sum((c("high") + c("low") + c("close")) * c("volume")).over(upto) / 3.0, F.sum(c("volume").cast("double")).over(upto)),
    })
    ma20, sd20 = ROLL.ma(c("close"), 20), ROLL.std(c("close"), 20)

    def rsi(n: int) -> Column:
        g, l = ROLL.ma(c("gain"), n), ROLL.ma(c("loss"), n)
        # no losses: the ratio is infinite and the index 100; neither gains nor losses: undefined
        return F.when(l > 0, 100 - 100 / (1 + g / l)).when(g > 0, 100.0)

    def bias(ma: Column) -> Column:
        return safe_div(c("close") - ma, ma) * 100

    def back(n: int) -> Column:
        p = F.lag("close", n).over(w)
        return safe_div(c("close") - p, p) * 100

    def drawdown(n: int) -> Column:
        top = F.max("close").over(ROLL.last(n))
        return safe_div(c("close") - top, top) * 100

    def cci(n: int) -> Column:
        return safe_div(c("tp") - ROLL.ma(c("tp"), n), 0.015 * c(f"__mad{n}"))

    def abs_dev(n: int) -> Column:
        mean = c(f"__m{n}")
        total = F.aggregate(f"__l{n}", F.lit(0.0), lambda acc, v: acc + F.abs(v - mean))
        return F.when(mean.isNotNull(), total / n)

    df = df.withColumns({f"__m{n}": ROLL.ma(c("tp"), n) for n in (10, 20)} | {f"__l{n}": ROLL.frame(c("tp"), n) for n in (10, 20)})
    df = df.withColumns({f"__mad{n}": abs_dev(n) for n in (10, 20)})
    hi, lo = F.max("high").over(ROLL.last(9)), F.min("low").over(ROLL.last(9))
    df = df.withColumns({
        **{f"ind_ma{n}": _long_mean("close", n) for n in MA_DAYS},
        **{f"ind_rsi{n}": rsi(n) for n in (6, 14, 24)},
        "rsv": safe_div(c("close") - lo, hi - lo) * 100,
        "ind_boll_mid": ma20, "ind_boll_up": ma20 + 2 * sd20, "ind_boll_dn": ma20 - 2 * sd20,
        "ind_atr": ROLL.ma(c("tr"), 14),
        "ind_cci10": cci(10), "ind_cci20": cci(20), "ind_roc12": back(12),
        "ind_wr": safe_div(ROLL.rmax(c("high"), 14) - c("close"), ROLL.rmax(c("high"), 14) - ROLL.rmin(c("low"), 14)) * -100,
        "__pdi": safe_div(ROLL.ma(c("pdm"), 14), ROLL.ma(c("tr"), 14)) * 100, "__mdi": safe_div(ROLL.ma(c("mdm"), 14), ROLL.ma(c("tr"), 14)) * 100,
        "ind_bias6": bias(ROLL.ma(c("close"), 6)), "ind_bias20": bias(ma20), "ind_bias60": bias(_long_mean("close", 60)),
        "ind_vol20": ROLL.std(c("ret"), 20) * (252**0.5) * 100, "ind_vol60": ROLL.std(c("ret"), 60) * (252**0.5) * 100,
        **{f"ind_ret{n}": back(n) for n in (5, 10, 20, 60)}, "ind_dd20": drawdown(20), "ind_dd60": drawdown(60),
        "ind_high20": F.max("high").over(ROLL.before(20)),
        **{f"ind_vma{n}": ROLL.ma(c("volume").cast("double"), n) for n in (5, 10, 20)},
    })
    df = df.withColumns({
        "ind_pdi": c("__pdi"), "ind_mdi": c("__mdi"),
        "__dx": safe_div(F.abs(c("__pdi") - c("__mdi")), c("__pdi") + c("__mdi")) * 100,
        "ind_trailing_stop": c("ind_high20") - 3 * c("ind_atr"),
    })
    df = df.withColumn("ind_adx", ROLL.ma(c("__dx"), 14))
    return df.select(*bars.columns, "rsv", *[x for x in df.columns if x.startswith("ind_")])


def indicators(bars: DataFrame) -> DataFrame:
    """Every indicator, the recursive ones last (one pass over each symbol's rows)."""
    df = native_indicators(bars)
    df = apply_smoothers(df, "symbol", "date", SMOOTHERS, df.columns)
    dif = c("ind_ema12") - c("ind_ema26")
    return df.withColumns({
        "ind_macd": dif, "ind_macd_hist": dif - c("ind_macd_signal"), "ind_kdj_j": 3 * c("ind_kdj_k") - 2 * c("ind_kdj_d"),
    }).drop("rsv")
