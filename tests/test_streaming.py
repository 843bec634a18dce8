import datetime
import tempfile

from tidemark.sources.snapshots import content_hash
from tidemark.streaming import jobs


def test_snapshot_stream_hands_over_each_arrival(spark):
    root = tempfile.mkdtemp(prefix="tidemark-test-")
    spark.range(5).write.parquet(root + "/in")
    seen = []
    stream = spark.readStream.schema("id long").parquet(root + "/in")
    jobs.snapshot_stream(stream, lambda df, epoch: seen.append((epoch, content_hash(df).first().n_rows)), root + "/state").awaitTermination()
    assert seen == [(0, 5)]


def test_merge_stream_is_idempotent_and_versioned(spark):
    root = tempfile.mkdtemp(prefix="tidemark-test-")
    rows = "k int, v int"
    spark.createDataFrame([(1, 1), (2, 2)], rows).write.parquet(jobs.version_path(root + "/t", 0))
    for part, data in (("a", [(2, 20)]), ("b", [(3, 30)])):
        spark.createDataFrame(data, rows).coalesce(1).write.mode("append").parquet(root + "/inc")
        stream = spark.readStream.schema(rows).parquet(root + "/inc")
        jobs.merge_stream(stream, root + "/t", ["k"], root + "/state").awaitTermination()
    last = jobs.latest_version(spark, root + "/t")
    assert last == 2
    assert sorted((r.k, r.v) for r in spark.read.parquet(jobs.version_path(root + "/t", last)).collect()) == [(1, 1), (2, 20), (3, 30)]


def test_late_ticks_and_open_windows(spark):
    root = tempfile.mkdtemp(prefix="tidemark-test-")
    ts = lambda s: datetime.datetime.fromisoformat(s)
    rows = [(1, "a", ts("2024-01-01 09:00:00"), 5.0), (2, "a", ts("2024-01-01 15:00:00"), 7.0), (3, "a", ts("2024-01-02 03:00:00"), 9.0)]
    spark.createDataFrame(rows, "id long, k string, ts timestamp, p double").write.parquet(root + "/in")
    ticks = spark.readStream.schema("id long, k string, ts timestamp, p double").parquet(root + "/in")
    jobs.write_bars(jobs.bars_from_ticks(ticks, "k", "ts", "p", "id"), root + "/out", root + "/state").awaitTermination()
    got = spark.read.parquet(root + "/out").collect()
    assert [(str(r.date), r.open, r.close, r.n) for r in got] == [("2024-01-01", 5.0, 7.0, 2)]
