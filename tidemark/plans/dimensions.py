"""Dimension history: universe, names, industries, status, index membership, kinds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import keep_max, keep_min
from tidemark.operators.intervals import close_with_next, compress_changes, day_islands, gap_segments

MEMBER_GAP_DAYS = 100
# Fund kinds from most to least specific.
KIND_ORDER = ("etf", "lof", "index", "fund")


def security_universe(dim: DataFrame, *others: DataFrame) -> DataFrame:
    """All codes of the year-end table and of the other dimensions, the former's attributes where present."""
    codes = dim.select("code")
    for o in others:
        codes = codes.union(o.select("code"))
    codes = codes.where(F.col("code").isNotNull()).distinct()
    return codes.join(dim.withColumn("in_yearend_snapshot", F.lit(True)), "code", "left").withColumn(
        "in_yearend_snapshot", F.coalesce("in_yearend_snapshot", F.lit(False))
    )


def name_intervals(history: DataFrame) -> DataFrame:
    """A name is valid from its start to the next start, and known from its publication."""
    rows = history.select(
        "code", "company_id", F.col("new_name").alias("name"), F.col("start_date").alias("valid_from"),
        F.col("pub_date").alias("known_from"), "reason",
    )
    return close_with_next(rows, ["code"], "valid_from")


INDUSTRY_LEVELS = ("sw_l1_code", "sw_l2_code", "sw_l3_code")


def industry_intervals(snapshots: DataFrame) -> DataFrame:
    """Snapshots compressed to intervals; a change on any of the three levels opens a new one."""
    return compress_changes(snapshots, ["code"], "as_of", INDUSTRY_LEVELS).withColumn("is_backfilled", F.lit(True))


def status_asof(status: DataFrame) -> DataFrame:
    """Right side of the status as-of: effective once valid and known, one row per (code, eff_from)."""
    rows = status.select(
        "code", F.greatest("valid_from", "known_from").alias("eff_from"), "public_status", "name", "valid_from", "known_from"
    )
    return keep_max(rows, ["code", "eff_from"], ["valid_from", "known_from"]).drop("valid_from", "known_from")


def index_members(snapshots: DataFrame) -> DataFrame:
    """Membership snapshots to intervals; more than 100 days apart starts a new segment."""
    return gap_segments(snapshots, ["index_code", "stock_code"], "as_of", MEMBER_GAP_DAYS).withColumn(
        "is_quarterly_inferred", F.lit(True)
    )


def most_specific_kind(rows: DataFrame, order: Sequence[str] = KIND_ORDER) -> DataFrame:
    """One row per code: the most specific kind listed for it."""
    rank = F.array_position(F.array(*[F.lit(k) for k in order]), F.col("kind"))
    rank = F.when(rank == 0, len(order) + 1).otherwise(rank)
    return keep_min(rows, ["code"], [rank, F.col("kind")])


def st_periods(days: DataFrame) -> DataFrame:
    """Day list of special treatment to intervals; weekends split them, as the day list does."""
    return day_islands(days, "code", "date")


def newest_share_change(rows: DataFrame) -> DataFrame:
    """Latest publication per (code, change_date)."""
    return keep_max(rows, ["code", "change_date"], ["pub_date", "change_reason", "share_trade_total"])
