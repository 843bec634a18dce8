import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tidemark.llm import resample
from tidemark.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, target):
    raw = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in raw for b in f), Counter(b for x in target for b in features(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000)))) for b in s}
    out, fit = [], []
    for k, ((i, _), (words, f)) in enumerate(zip(docs, raw)):
        weight, score = sum(gain[b] for b in f) // len(f) if f else 0, None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if words >= 20:
                fit.append((-score, i, k))
        out.append([i, len(f), weight, score, None])
    for r, (_, _, k) in enumerate(sorted(fit)[: len(fit) * 25 // 100], 1):
        out[k][4] = r
    return sorted(map(tuple, out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_query(spark, sf_dir):
    read = lambda name: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
    docs = [(r[0], r[1]) for r in read("documents")]
    assert got(QUERIES["op13_importance_resample"](spark, sf_dir)) == brute(docs, [r[1] for r in read("benchmark")])


def test_crc_matrices():
    rng = random.Random(3)
    values = [bytes(rng.randrange(256) for _ in range(n)) for n in [0, 0, 1, 2, 3, 3, 3, 7, 8, 9, 40, 40, 1024, 1025, 5000] + [rng.randrange(12) for _ in range(500)]]
    column = pa.array(values, pa.large_binary())
    assert resample.crc32s(column).tolist() == [zlib.crc32(v) for v in values]
    assert resample.crc32s(column.slice(3, 200)).tolist() == [zlib.crc32(v) for v in values[3:203]]


@pytest.fixture(scope="module")
def hard():
    rng = random.Random(4)
    words = ["the", "The", "état", "ß", "日本", "x1", "1", "don't", "a-b", "_", "Ÿ", "\x00", "É", "zz" * 900]
    texts = [None, "", "  \t\n", "one", "A", "...", "x" * 5000, "\x7f[", " ".join("same" for _ in range(40)), "two words"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(60)] + [" ".join(rng.choice(words[:-1]) for _ in range(60_000))]
    rows = list(enumerate(texts))
    return rows + [(None, texts[20]), (None, None), (-5, texts[-1]), (12, texts[12])]


def test_hard_rows(make, hard):
    docs = make([(i, t, 1, "x") for i, t in hard], "doc_id long, text string, rank int, gain string")
    target = [None, "", "the état x1 x1", "one two words"]
    items = make([(t,) for t in target], "text string")
    exact = [r for r in hard]
    rows, want = got(resample.resample(docs, items)), brute(exact, target)
    assert [r[:4] for r in rows] == [r[:4] for r in want]
    # equal rows may swap their ranks and nothing else may differ
    assert sorted((r[3], r[4], r[0]) for r in rows if r[4]) == sorted((r[3], r[4], r[0]) for r in want if r[4])


def test_parts_and_blocks_do_not_matter(make, hard, monkeypatch):
    docs, items = make(hard, "doc_id long, text string").repartition(5), make([("the the état",)], "text string")
    whole = got(resample.resample(docs, items))
    assert whole == got(resample.resample(docs.repartition(1), items))


def test_empty_tables(make):
    docs, items = make([], "doc_id long, text string"), make([], "text string")
    assert got(resample.resample(docs, items)) == []
    assert got(resample.resample(make([(1, "a b")], "doc_id long, text string"), items)) == brute([(1, "a b")], [])
