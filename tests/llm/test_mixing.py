import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.queries import QUERIES


def draw(u, mean):
    k, p = 0, math.exp(-mean)
    c = p
    while c < u:
        k += 1
        p = p * mean / k
        c += p
        if k > mean + 12 * math.sqrt(mean) + 30:
            break
    return k


def number(seed, doc_id, mean):
    parts = max(1, math.ceil(mean / mixing.PART))
    u = lambda j: int(hashlib.md5(f"{seed}:copies:{j}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    return sum(draw(u(j), mean / parts) for j in range(1, parts + 1))


def brute(rows, weights=None, amount=1.0, seed=0):
    size = Counter()
    for _, text, source in rows:
        size[source] += len(text or "")
    size = {s: n for s, n in size.items() if n}
    w = {s: math.sqrt(n) if weights is None else weights.get(s, 0) for s, n in size.items()}
    w = {s: x for s, x in w.items() if x and x > 0}
    mean = {s: x / sum(w.values()) * sum(size[t] for t in w) * amount / size[s] for s, x in w.items()}
    return Counter((d, s, k) for d, _, s in rows if s in mean for k in range(1, number(seed, d, mean[s]) + 1))


def got(df):
    return Counter((r.doc_id, r.source, r.copy) for r in df.collect())


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]
    assert got(QUERIES["op3_mix_sources"](spark, sf_dir)) == brute(rows)


@pytest.mark.parametrize("limit", [10_000, 0])
def test_odd_rows_and_both_joins(make, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
    rows = [(i, "x" * 10, "big") for i in range(400)] + [(1000 + i, "y" * 7, None) for i in range(20)] + [(2000, "z", "tiny"), (2001, None, "tiny"), (None, "q" * 9, "big"), (5, "x" * 10, "big"), (3000, None, "blank"), (3001, "", "blank")]
    df = make([(*r, 5, "k") for r in rows], "doc_id long, text string, source string, copy int, row string")
    assert got(mixing.mix(df, seed=3)) == brute(rows, seed=3)
    weights = {"big": 1.0, "tiny": 3.0, None: 0.5, "gone": 9.0}
    w = make([*weights.items(), ("blank", None), ("zero", 0.0)], "source string, weight double")
    assert got(mixing.mix(df, w, amount=2.0)) == brute(rows, weights, 2.0)
    assert got(mixing.mix(df, w, amount=2.0))[(2000, "tiny", 300)] == 1  # a mean of thousands
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "text", "source", "row", "copy", "shuffle_key"] and mixing.mix(df.limit(0)).count() == 0


def test_amounts_meet_the_weights_and_rows_are_shuffled(make):
    rows = [(i, "t" * 20, "abc"[i % 10 // 4]) for i in range(20_000)]
    w = make([("a", 0.2), ("b", 0.3), ("c", 0.5)], "source string, weight double")
    out = mixing.mix(make(rows, "doc_id long, text string, source string"), w).cache()
    share = {r.source: r.n / out.count() for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert all(abs(share[s] - x) < 0.01 for s, x in {"a": 0.2, "b": 0.3, "c": 0.5}.items())
    ids = [r.doc_id for r in out.collect()]
    assert abs(sum(abs(a - b) for a, b in zip(ids, ids[1:])) / len(ids) - 20_000 / 3) < 400


def test_distribution_function(spark):
    for mean in (0.01, 1.0, 37.5, 256.0):
        sums = spark.range(1).select(mixing.poisson_sums(F.lit(mean)).alias("s")).first().s
        assert sums == sorted(sums) and abs(sums[-1] - 1) < 1e-12
        assert abs(sums[1] - math.exp(-mean) * (1 + mean)) < 1e-15
