"""Fixed-width day files: 32-byte little-endian records of one symbol per file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Record layout and price scale.
RECORD = np.dtype([("date", "<i4"), ("open", "<i4"), ("high", "<i4"), ("low", "<i4"), ("close", "<i4"), ("amount", "<f4"), ("volume", "<i4"), ("rest", "<i4")])
PRICE_SCALE = 1000.0
SCHEMA = "symbol string, date date, o double, h double, l double, c double, amt double, volume long"


def decode(files: DataFrame, symbol: Column) -> DataFrame:
    """``files`` has a binary ``content`` column; one file holds one symbol's history (a few hundred KB)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for sym, content in zip(pdf["symbol"], pdf["content"]):
                rec = np.frombuffer(content, dtype=RECORD)
                out = {k[0]: rec[k] / PRICE_SCALE for k in ("open", "high", "low", "close")}
                yield pd.DataFrame({
                    "symbol": sym, "date": pd.to_datetime(rec["date"].astype(str), format="%Y%m%d").date, **out,
                    "amt": rec["amount"].astype("float64"), "volume": rec["volume"].astype("int64"),
                })

    return files.select(symbol.alias("symbol"), "content").mapInPandas(run, SCHEMA)


def read_day_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.day").load(path)
    return decode(files, F.regexp_extract("path", r"([^/]+)\.day$", 1))
