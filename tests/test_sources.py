import datetime
import struct
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.sources import fixed_bars, merge, sinks, snapshots, text, vendor

HEAD = "1,2,000001.XSHE,n,2020-01-01,1,t,2020-01-02,1,t,0,0,0,0,0"


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def test_repair_damaged_csv(spark, folder):
    body = "id,...\n" + HEAD + ',"open quote\n123,456 items\nend\n' + HEAD.replace("1,2,", "2,2,", 1) + ',"a ""b"" c"\n' + HEAD.replace("1,2,", "3,2,", 1) + ",plain\rtext"
    with open(folder + "/f.csv", "w", newline="") as f:
        f.write(body)
    names = ["id", "company", "code", "name", "end_date", "a", "b", "pub_date", "c", "d", "e", "f", "g", "h", "i", "content"]
    rows = {r.id: r for r in text.repair_records(text.read_lines(spark, folder + "/f.csv"), names).collect()}
    assert rows["1"].content == "open quote\n123,456 items\nend" and rows["1"].n_lines == 3
    assert rows["2"].content == 'a "b" c' and rows["3"].content == "plain\rtext"
    lines = text.strip_carriage_returns(text.read_lines(spark, folder + "/f.csv"))
    assert {r.id: r.content for r in text.repair_records(lines, names).collect()}["3"] == "plaintext"


def test_records_survive_splits(spark, folder):
    """Many small input splits, records crossing their borders."""
    with open(folder + "/big.csv", "w", newline="") as f:
        for i in range(400):
            f.write(HEAD.replace("1,2,", f"{i},2,", 1) + f",line one of {i}\ncontinued, {'x' * (i % 50)}\nlast\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        lines = text.read_lines(spark, folder + "/big.csv")
        assert lines.select("block").distinct().count() > 5
        recs = text.assemble_records(lines)
        got = {int(r.record.split(",")[0]): r.n_lines for r in recs.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: 3 for i in range(400)}


def test_yearly_glob_and_union_by_name(spark, folder):
    for name, body in (("bal_2019.csv", "a,b\n1,002054\n"), ("bal_2020.csv", "b,a,c\n007,2,9\n"), ("bal_q_2020.csv", "a,b\n8,8\n")):
        with open(f"{folder}/{name}", "w") as f:
            f.write(body)
    assert text.read_csv_text(spark, text.yearly_glob(folder, "bal", ".csv")).count() == 2
    df = text.read_csv_text(spark, folder + "/bal_2019.csv", folder + "/bal_2020.csv")
    assert sorted((r.a, r.b, r.c) for r in df.collect()) == [("1", "002054", None), ("2", "007", "9")]
    assert spark.read.text(text.yearly_glob(folder, "bal", ".csv")).count() == 4
    typed = text.typed(df, {"a": "bigint", "c": "date"})
    assert sorted((r.a, r.b, r.c) for r in typed.collect()) == [(1, "002054", None), (2, "007", None)]
    assert {r.column_name: r.lost for r in text.coercion_losses(df, {"a": "bigint", "c": "date"}).collect()} == {"a": 0, "c": 1}


def test_fixed_width_bars(spark, folder):
    rec = struct.Struct("<iiiiifii")
    with open(folder + "/sh510300.day", "wb") as f:
        f.write(rec.pack(20200102, 4100, 4200, 4000, 4150, 1000.0, 5000, 0) + rec.pack(20200103, 4150, 4250, 4100, 4200, 2000.0, 6000, 0))
    rows = sorted(fixed_bars.read_day_files(spark, folder).collect(), key=lambda r: r.date)
    assert [(r.symbol, r.date, r.o, r.h, r.l, r.c, r.amt, r.volume) for r in rows] == [
        ("sh510300", datetime.date(2020, 1, 2), 4.1, 4.2, 4.0, 4.15, 1000.0, 5000), ("sh510300", datetime.date(2020, 1, 3), 4.15, 4.25, 4.1, 4.2, 2000.0, 6000)]


def test_yearly_sink_rebuilds_one_year(spark, folder):
    rows = [("a", datetime.date(2019, 5, 1), 1), ("b", datetime.date(2020, 5, 1), 2)]
    path = folder + "/panel"
    sinks.write_yearly(spark.createDataFrame(rows, "jq_code string, date date, v int"), path)
    sinks.write_yearly(spark.createDataFrame([("b", datetime.date(2020, 5, 1), 9)], "jq_code string, date date, v int"), path, only_years=True)
    assert sorted((r.jq_code, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 9)]


def test_publish_is_all_or_nothing(spark, folder):
    path = folder + "/gold"
    sinks.publish(spark.range(3).toDF("x"), path)
    with pytest.raises(ValueError):
        sinks.publish(spark.range(9).toDF("x"), path, check=lambda df: df.count() < 5)
    assert spark.read.parquet(path).count() == 3
    sinks.publish(spark.range(4).toDF("x"), path, check=lambda df: df.count() == 4)
    assert spark.read.parquet(path).count() == 4


def test_upsert_rules(spark):
    old = spark.createDataFrame([("a", None, 1.0), ("b", "k", 2.0)], "code string, k string, v double")
    inc = spark.createDataFrame([("a", None, "7", "x")], "code string, k string, v string, extra string")
    out = merge.upsert(old, inc, ["code", "k"])
    assert sorted((r.code, r.k, r.v) for r in out.collect()) == [("a", None, 7.0), ("b", "k", 2.0)]
    assert merge.merge_counts(old, out).first().ok
    with pytest.raises(ValueError):
        merge.upsert(old, inc.drop("v"), ["code", "k"])


def test_snapshot_hash(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    first = snapshots.manifest_row(a, "2020-01-01")
    same = snapshots.manifest_row(a.orderBy(F.col("i").desc()), "2020-01-02", first).first()
    other = snapshots.manifest_row(a.withColumn("s", F.lit("y")), "2020-01-02", first).first()
    assert (same.stored, other.stored) == (False, True)
    assert not snapshots.same_content(a, a.union(a)).first().equal


def test_vendor_shapes(spark):
    long = vendor.to_long({"a": spark.createDataFrame([(1,)], "v int"), "b": spark.createDataFrame([("z", 2)], "MARKET_CODE string, v int")})
    assert sorted((r.SRC_CODE or "", r.MARKET_CODE or "", r.v) for r in long.collect()) == [("", "z", 2), ("a", "", 1)]
    df = spark.createDataFrame([("1", 10, 5.0, 50000.0), ("5", 20, 5.0, 25000.0)], "STATEMENT_TYPE string, HOLDER_TYPE int, TOTAL_HOLDING_SHR double, FRO_SHARES double")
    assert vendor.one_statement_type(df).count() == 1 and vendor.one_statement_type(df, "before correction").first().HOLDER_TYPE == 20
    assert vendor.holders(df).first().STATEMENT_TYPE == "1"
    assert vendor.extra_columns(df, {"FRO_SHARES": "float"}) == ["STATEMENT_TYPE", "HOLDER_TYPE", "TOTAL_HOLDING_SHR"]
    assert sorted(r.FRO_SHARES / r.TOTAL_HOLDING_SHR for r in vendor.in_shares(df).collect()) == [0.5, 1.0]
    assert sinks.empty_table(spark, "a string, d date").dtypes == [("a", "string"), ("d", "date")]


def test_damaged_first_record_is_kept(spark, folder):
    with open(f"{folder}/f.csv", "w") as f:
        f.write("id,org,code\nbroken, not a record\nmore of it\n2,9,000002.XSHE,x\ntail\n")
    recs = {r.rec: (r.n_lines, r.record) for r in text.assemble_records(text.read_lines(spark, folder + "/f.csv")).collect()}
    assert recs == {0: (2, "broken, not a record\nmore of it"), 1: (2, "2,9,000002.XSHE,x\ntail")}


def test_hash_tells_where_a_null_stands(spark):
    a, b = (spark.createDataFrame([row], "i int, j int") for row in ((None, 5), (5, None)))
    assert not snapshots.same_content(a, b).first().equal
    assert snapshots.manifest_row(b, "2020-01-02", snapshots.manifest_row(a, "2020-01-01")).first().stored


def test_increment_that_does_not_convert(spark):
    old = spark.createDataFrame([(1, 2.5)], "k int, v double")
    inc = spark.createDataFrame([("1", "--"), ("3", "4")], "k string, v string")
    assert sorted(map(tuple, merge.upsert(old, inc, ["k"]).collect())) == [(1, None), (3, 4.0)]
    assert tuple(merge.increment_losses(old, inc).first()) == (0, 1)


def test_publish_reports_a_failed_swap(spark, folder):
    path = f"{folder}/table"
    sinks.publish(spark.range(2).toDF("v"), path)
    sinks.publish(spark.range(3).toDF("v"), path)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        sinks.publish(spark.range(4).toDF("v"), path, check=lambda df: False)
    assert spark.read.parquet(path).count() == 3
