import zlib

import numpy as np
import pytest

from tidemark.llm import langid
from tidemark.llm.queries import QUERIES

SMALL = langid.Settings(filters=4, per_language=40, epochs=6)


def test_pooled_is_the_convolution():
    rng = np.random.default_rng(3)
    net = langid.ByteNetwork(["a", "b"], 3, 1)
    texts = [b"", b"x", b"abc", bytes(rng.integers(1, 60, 700, dtype=np.uint8))]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    x, n, text = langid.cut_windows(np.frombuffer(b"".join(texts), np.uint8), offsets, 64)
    assert text.tolist() == [1, 2] + [3] * 11 and n.tolist() == [1, 3] + [64] * 10 + [60]
    for row, size, got in zip(x, n, net.pooled(x, n), strict=True):
        want = [max(sum(t[j][row[p + j], f] for j in range(w)) for p in range(max(1, size - 3))) for w, t in zip(langid.WIDTHS, net.tables, strict=True) for f in range(3)]
        assert np.allclose(got, want, atol=1e-5)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op8_language_id"](spark, sf_dir).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 and r.lang_pred in {*truth.values(), "und"} for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [truth[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert np.mean(held) > 0.93


@pytest.fixture(scope="module")
def odd(make):
    rows = [(i, "alpha beta gamma delta " * 3, "aa", 0.5) for i in range(60)] + [(100 + i, "ωμέγα άλφα βήτα " * 4, "bb", 0.5) for i in range(60)]
    rows += [(500, None, "aa", 1.0), (501, "", "bb", 1.0), (502, "123 !?", None, 1.0), (503, "beta alpha", None, None), (None, "βήτα ωμέγα", "zz", 1.0), (503, "beta alpha", None, None), (504, "alpha gamma " * 30_000, "aa", 0.0)]
    return make(rows, "doc_id long, text string, lang string, score double")


def test_odd_rows(odd):
    got = {(r.doc_id, r.lang_pred) for r in langid.predictions(odd, SMALL).where("doc_id is null or doc_id >= 500").collect()}
    assert got == {(500, "und"), (501, "und"), (502, "und"), (503, "aa"), (None, "bb"), (504, "aa")}
    kept = langid.keep_identified(odd, s=SMALL)
    assert kept.schema == odd.schema and kept.count() == odd.count() - 3


def test_prediction_ignores_lang_source_and_held_out_rows(odd, make):
    rows = [tuple(r) for r in odd.collect()]
    other = [(i, t, "qq" if i is not None and zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in rows]
    one = sorted(map(tuple, langid.predictions(odd, SMALL).collect()), key=str)
    assert one == sorted(map(tuple, langid.predictions(make(other, odd.schema.simpleString()[7:-1].replace(":", " ")), SMALL).collect()), key=str)


def test_nothing_to_learn_and_no_rows(make):
    df = make([(1, "abc", None), (2, None, "x")], "doc_id long, text string, lang string")
    assert {tuple(r)[2:] for r in langid.predictions(df, SMALL).collect()} == {("und", 0.0)}
    assert langid.predictions(df.limit(0), SMALL).count() == 0
