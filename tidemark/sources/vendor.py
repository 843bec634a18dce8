"""Vendor results conformed to declared schemas.

The declared schema is a parameter: ``{table: {column: declared type}}`` as the vendor's field list states it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that already name the security, statement and holder type codes, and the columns
# stated in ten thousands of shares while their neighbours are in shares.
CODE_COLUMNS = ("MARKET_CODE", "code", "CON_CODE", "INDEX_CODE", "OLD_CODE", "ETF_CODE")
STATEMENT_TYPES = {"consolidated": 1, "single quarter": 2, "adjusted": 4, "before correction": 5}
HOLDER_TYPES = {"top ten": 10, "top ten of float": 20}
TEN_THOUSAND_SHARE_COLUMNS = ("TOTAL_HOLDING_SHR",)
TEN_THOUSAND = 10_000.0


def spark_type(declared: str) -> str:
    t = declared.lower()
    if t.startswith("float") or t in ("double", "decimal"):
        return "double"
    if t.startswith("int") or t == "long":
        return "bigint"
    return "timestamp" if t == "datetime" else "string"


def to_long(parts: Mapping[str, DataFrame], key: str = "SRC_CODE") -> DataFrame:
    """Stack per-code results; the key becomes a column only where no code column exists."""
    out = None
    for code, df in parts.items():
        if not any(c in df.columns for c in CODE_COLUMNS):
            df = df.withColumn(key, F.lit(code))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def melt_wide(df: DataFrame, day: str = "date", value: str = "factor") -> DataFrame:
    """Days x codes matrix to (date, code, value) without the empty cells."""
    codes = [c for c in df.columns if c != day]
    return df.unpivot([day], codes, "code", value).where(F.col(value).isNotNull())


def conform(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Declared columns in declared order and type, then whatever else arrived."""
    declared = [c for c in fields if c in df.columns]
    extra = [c for c in df.columns if c not in fields]
    return df.select(*[F.col(c).try_cast(spark_type(fields[c])).alias(c) for c in declared], *extra)


def extra_columns(df: DataFrame, fields: Mapping[str, str]) -> list[str]:
    return [c for c in df.columns if c not in fields]


def conform_tables(tables: Mapping[str, DataFrame], schemas: Mapping[str, Mapping[str, str]]) -> dict[str, DataFrame]:
    return {name: conform(df, schemas[name]) for name, df in tables.items()}


def one_statement_type(df: DataFrame, kind: str = "consolidated", column: str = "STATEMENT_TYPE") -> DataFrame:
    """Pick one kind of statement before any join; kinds mixed in one key would multiply rows."""
    return df.where(F.col(column).cast("int") == STATEMENT_TYPES[kind])


def holders(df: DataFrame, kind: str = "top ten", column: str = "HOLDER_TYPE") -> DataFrame:
    """One of the two holder lists that share a table."""
    return df.where(F.col(column).cast("int") == HOLDER_TYPES[kind])


def in_shares(df: DataFrame, columns: Sequence[str] = TEN_THOUSAND_SHARE_COLUMNS) -> DataFrame:
    """Bring the columns stated in ten thousands to shares, so ratios of two columns make sense."""
    return df.select(*[(F.col(c) * TEN_THOUSAND).alias(c) if c in columns else F.col(c) for c in df.columns])
