"""Relations that many others are derived from are computed once, and parts keep their number."""

import datetime

from pyspark.sql import functions as F

from tidemark.queries.registry import Inputs
from tidemark.session import spread

RELATIONS = ("bars", "adjust_factor", "basic_daily", "universe", "fin_core", "share_change", "industry_snapshot", "index_member_asof")


def tables(spark, folder):
    """Lines of a few suppliers over two years, with a null key, a null day and repeated lines."""
    day = lambda i: datetime.datetime(1995, 1, 2) + datetime.timedelta(days=i)
    rows = [(i // 3, i % 5, i % 4, i % 3, float(i % 7 + 1), 1000.0 + i % 90, 0.05, day(i * 7 % 700)) for i in range(400)]
    rows += rows[:20] + [(900, 1, None, 1, 1.0, 1000.0, 0.0, day(3)), (901, 1, 2, 1, 1.0, 1000.0, 0.0, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                "l_discount double, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, f"s{i}") for i in range(4)], "s_suppkey long, s_name string").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(i, "SMALL", i, "b") for i in range(5)], "p_partkey long, p_type string, p_size long, p_brand string").write.parquet(f"{folder}/part.parquet")


def test_stored_relations_give_the_same_rows(spark, tmp_path):
    tables(spark, str(tmp_path))
    plain, stored = Inputs(spark, str(tmp_path)), Inputs(spark, str(tmp_path)).store("bars_sk", "filings")
    for name in RELATIONS:
        a, b = plain(name), stored(name)
        assert a.dtypes == b.dtypes and a.count() == b.count() > 0, name
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_derived_relations_read_what_is_stored(spark, tmp_path):
    tables(spark, str(tmp_path))
    r = Inputs(spark, str(tmp_path)).store("bars_sk", "filings")
    again = dict(r.stored)
    assert r.store("bars_sk").stored == again
    for name in ("bars", "basic_daily", "fin_core", "share_change"):
        assert not [f for f in r(name).inputFiles() if "lineitem" in f], name


def test_parts_keep_their_number(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spread(spark.range(100).withColumn("k", F.col("id") % 50), "k")
    assert df.rdd.getNumPartitions() == n
