"""Point-in-time share counts from change events.

A count may be used once it is both announced and effective.  B and H shares are not part of the tradable
A shares: they are carried forward over blanks until the tradable total drops by about their size, and stay
removed until a new explicit value appears.  Periodic-report rows may not push the tradable count below the
last event.  Every stage partitions by code, so the whole chain runs behind one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIODIC = "定期报告"  # fixed value: change_reason of periodic-report rows
REMOVAL_SHARE = 0.9
TEN_THOUSAND = 1e4


def share_asof_rows(changes: DataFrame) -> DataFrame:
    """(code, eff_date, float_sh, total_sh): the right side of a daily as-of, unique on (code, eff_date)."""
    rows = changes.where(
        (F.col("share_trade_total") > 0) & F.col("pub_date").isNotNull() & F.col("change_date").isNotNull()
    )
    upto = Window.partitionBy("code").orderBy("change_date", "pub_date").rowsBetween(Window.unboundedPreceding, 0)
    step = Window.partitionBy("code").orderBy("change_date", "pub_date")
    tradable, periodic = F.col("share_trade_total"), F.col("change_reason") == PERIODIC
    moment = F.struct("change_date", "pub_date")

    def named(k: str) -> Column:
        """The last explicit count of a share kind and when it was named."""
        return F.max(F.when(F.col(f"share_{k}").isNotNull(), F.struct(moment.alias("at"), F.col(f"share_{k}").alias("count")))).over(upto)

    rows = rows.withColumns({
        "__b": named("b"), "__h": named("h"), "__before": F.lag("share_trade_total").over(step),
        "__floor": F.max(F.when(~periodic, F.struct(moment.alias("at"), tradable.alias("count")))).over(upto)["count"],
    })

    def fell(k: str) -> Column:
        """When the tradable total last dropped by about this kind's count without naming a new one."""
        kind = F.col(f"__{k}")
        drop = (kind["at"] < moment) & (kind["count"] > 0) & (tradable <= F.col("__before") - REMOVAL_SHARE * kind["count"])
        return F.max(F.when(drop, moment)).over(upto)

    rows = rows.withColumns({"__fell_b": fell("b"), "__fell_h": fell("h")})

    def held(k: str) -> Column:
        kind = F.col(f"__{k}")
        return F.when(F.col(f"__fell_{k}") > kind["at"], 0.0).otherwise(F.coalesce(kind["count"], F.lit(0.0)))

    whole = F.when(periodic, F.greatest(tradable, "__floor")).otherwise(tradable)
    facts = rows.select(
        "code", F.greatest("change_date", "pub_date").alias("eff_date"), moment.alias("at"),
        (F.greatest(whole - held("b") - held("h"), F.lit(0.0)) * TEN_THOUSAND).alias("float_sh"),
        (F.col("share_total") * TEN_THOUSAND).alias("total_sh"),
    )
    # Per effective date only the best row can win, then the best row up to that date wins: both steps are
    # a maximum of the same ordering key, so equal dates enter together.
    daily = facts.groupBy("code", "eff_date").agg(F.max(F.struct("at", "float_sh", "total_sh")).alias("top"))
    w = Window.partitionBy("code").orderBy("eff_date").rowsBetween(Window.unboundedPreceding, 0)
    best = F.max("top").over(w)
    return daily.withColumn("best", best).select(
        "code", "eff_date", F.col("best.float_sh").alias("float_sh"), F.col("best.total_sh").alias("total_sh")
    )
