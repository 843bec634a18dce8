import hashlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import suffix
from tidemark.llm.queries import QUERIES


def brute(rows, length):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        seen.update(t[p : p + length] for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op5_suffix_dedup"](spark, sf_dir)) == brute(rows, 400)


@pytest.mark.parametrize("length", [9, 24, 60])
def test_planted_cases(make, length):
    rng = np.random.default_rng(length)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    passage = word(3 * length)
    texts = [None, "", "short", passage, word(50) + passage + word(40), passage[1:], passage[: length + 3], "a" * 5 * length, "a" * (length + 1), "ab" * length, word(length) + passage[5:90] + word(7) + passage[40:], passage]
    rows = list(enumerate(texts)) + [(None, passage[3:]), (4, texts[4]), (77, word(20_000)), (78, "")]
    df = make([(i, t, "x", None) for i, t in rows], "doc_id long, text string, tag string, spans int")
    assert rows_of(suffix.remove_repeats(df, length)) == brute(rows, length)


def test_edges_around_every_offset(make):
    rng = np.random.default_rng(5)
    core = "".join(rng.choice(list("xyz"), 80))
    rows = [(i, "".join(rng.choice(list("xyz"), 30)) + core[a:b] + "".join(rng.choice(list("xyz"), 30))) for i, (a, b) in enumerate((a, b) for a in range(0, 30, 3) for b in range(45, 81, 5))]
    assert rows_of(suffix.remove_repeats(make(rows, "doc_id long, text string"), 40)) == brute(rows, 40)


def test_empty_table(make):
    assert suffix.remove_repeats(make([], "doc_id long, text string")).count() == 0
