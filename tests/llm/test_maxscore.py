import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import maxscore
from tidemark.llm.queries import QUERIES

TERM = re.compile("[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, size=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, b in bags if b)
    length = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, want in asked.items():
        scores = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // max(length, 1)
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t, c in want.items() if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:size], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_query(spark, sf_dir):
    read = lambda name: [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
    assert got(QUERIES["op11_maxscore_search"](spark, sf_dir)) == brute(read("documents"), read("benchmark"))


@pytest.fixture(scope="module")
def hard():
    rng = random.Random(8)
    words = ["the"] * 6 + ["of", "Of", "état", "ß", "日本", "x1", "1", "rare", "_", "É", "é", "[a]", "\x00b"]
    texts = [None, "", " \n", "...", "the", "THE", "the " * 4000, "rare", "w" * 100_000, "one.two,three"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(150)] + [" ".join(rng.choice(words) for _ in range(80_000))]
    docs = [*enumerate(texts), (None, texts[20]), (None, texts[30]), (-5, texts[30]), (30, texts[30])] + [(1000 + k, "rare the état") for k in range(60)]
    items = [(1, "the rare état"), (2, None), (3, ""), (None, "of 日本"), (None, "x1"), (4, "absent"), (5, "The the THE of"), (5, "rare"), (6, "w" * 100_000), (7, " ".join(words * 30)), (-1, texts[40])]
    return docs, items


def frames(make, docs, items):
    return make([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, terms string"), make([(i, t, 0) for i, t in items], "item_id long, text string, score int")


def test_hard_rows(make, hard):
    docs, items = frames(make, *hard)
    want = brute(*hard)
    assert got(maxscore.search(docs, items)) == want
    assert got(maxscore.search(docs, items, 3)) == brute(*hard, 3)
    assert got(maxscore.search(docs.limit(0), items)) == got(maxscore.search(docs, items.limit(0))) == []


def test_segments_and_blocks_do_not_matter(make, hard, monkeypatch):
    docs, items = frames(make, *hard)
    monkeypatch.setattr(maxscore, "BLOCK_CHARS", 40_000)
    index = maxscore.build_index(docs.repartition(3))
    assert index.count() >= 3
    assert got(maxscore.search(docs.repartition(3), items)) == brute(*hard)


def test_slices_hold_every_row_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(maxscore, "SEGMENT_DOCS", 7)
    monkeypatch.setattr(maxscore, "SEGMENT_BYTES", 50)
    rng = random.Random(9)
    sizes = [rng.choice([0, 1, 9, 30, 49, 50, 51, 400]) for _ in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(lo, min(lo + 33, 200))), pa.array(["x" * n for n in sizes[lo : lo + 33]])], ["doc_id", "text"]) for lo in range(0, 200, 33)]
    parts = [[i for ids, _ in held for i in ids.to_pylist()] for held in maxscore._slices(batches)]
    assert [i for p in parts for i in p] == list(range(200))
    assert all(len(p) <= 7 and (len(p) == 1 or sum(sizes[i] for i in p) <= 50) for p in parts)


def test_pair_bounds_are_safe_and_tighter(make):
    """Bounds by pairs lie between the best score and the sum of maxima, and skip postings that independent maxima read."""
    rng = random.Random(10)
    docs = [(i, " ".join([rng.choice("abcdefgh") * 3] * rng.randrange(1, 4) + [rng.choice(["red", "blue"])])) for i in range(600)] + [(900, "aaa bbb ccc red blue")]
    items = [(1, "aaa bbb ccc ddd eee red blue"), (2, "aaa hhh"), (3, "red")]
    index = maxscore.build_index(make(docs, "doc_id long, text string").repartition(1))
    rows = {}
    for i, t in items:
        rows[i] = [{"term": x, "times": 1, "weight": w} for x, w in zip(sorted(set(terms(t))), (900, 800, 700, 650, 600, 300, 200))]
    block = maxscore.Block.of([{"item_id": i, "terms": r} for i, r in rows.items()], len(docs), sum(len(terms(t)) for _, t in docs))
    joined = index.join(maxscore.pair_lists(index, block), "segment").toArrow().combine_chunks().to_batches()[0]
    (row,) = list(maxscore._segments(joined))
    s, tops = maxscore.Segment(row, block), row["tops"].to_numpy()
    joint = dict(zip(map(tuple, block.pairs.tolist()), row["joint"].to_pylist()))
    shared = dict(zip(map(tuple, block.pairs.tolist()), row["shared"].to_pylist()))
    less = 0
    for _, t in block.items:
        for (a, b), n in shared.items():
            assert n == len(np.intersect1d(s.impacts(a)[0], s.impacts(b)[0]))
        (order, paired), (same, alone) = maxscore.prefix_bounds(t, tops, joint), maxscore.prefix_bounds(t, tops, {})
        every = maxscore.search_segment(s, order, paired, 1)
        assert order == same and sorted(order) == sorted(x for x in t.tolist() if tops[x])
        assert all(p <= q for p, q in zip(paired, alone)) and paired == sorted(paired)
        for k in range(1, len(order) + 1):  # no document gains more from a prefix than its bound
            assert max(maxscore.search_segment(s, order[:k], alone[:k], 1)[1]) <= paired[k - 1]
        for floor in np.unique(every[1])[-20:].tolist() + alone:
            one, two = maxscore.search_segment(s, order, paired, floor), maxscore.search_segment(s, order, alone, floor)
            want = {(p, v) for p, v in zip(every[0].tolist(), every[1].tolist()) if v >= floor}
            assert set(zip(one[0].tolist(), one[1].tolist())) == set(zip(two[0].tolist(), two[1].tolist())) == want
            less += two[2] - one[2]
            assert one[2] <= two[2]
    assert less > 0


def test_the_index_is_searched_where_it_lies(spark):
    """Rows of megabytes: few to a file, and no shuffle or sort of them."""
    index = maxscore.build_index(spark.range(0, 5 * maxscore.SEGMENT_DOCS, 1, 1).selectExpr("id AS doc_id", "concat('word', id % 5, ' all') AS text"))
    assert index.count() == 5 and len(index.inputFiles()) == 3
    block = maxscore.Block.of([{"item_id": 1, "terms": [{"term": "word1", "times": 1, "weight": 5}, {"term": "all", "times": 2, "weight": 3}]}], 20480, 40960)
    plan = maxscore.search_block(index, block, 20)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and plan.count("MapInArrow") == 2
