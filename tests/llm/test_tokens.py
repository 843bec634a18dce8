import sys
from collections import Counter

import pytest

from tidemark.llm import tokens
from tidemark.llm.queries import QUERIES

DOC = "doc_id long, source string, lang string, text string, n_tokens int"
COUNTED = "doc_id long, source string, lang string, version string, n_chars long, n_tokens long"


def encode():
    sys.path.insert(0, "/opt/tokenizers")
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def brute(rows):
    """Totals of living counts: {(doc_id, version): (source, lang, n_chars, n_tokens)}."""
    out = Counter()
    for (_, version), (source, lang, chars, n) in rows.items():
        for i, x in enumerate((1, chars, n)):
            out[source, lang, version, i] += x
    return {k[:3]: tuple(out[(*k[:3], i)] for i in range(3)) for k in out}


def got(df):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_chars, r.n_tokens) for r in df.collect()}


def test_query_against_another_tokenizer_library(spark, sf_dir):
    count = encode()
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = brute({(r.doc_id, "byte_bpe_50k"): (r.source, r.lang, len(r.text or ""), count(r.text or "")) for r in rows})
    assert got(QUERIES["op6_token_rollup"](spark, sf_dir)) == want


def test_inserts_revisions_deletes_and_replays(spark, make, tmp_path):
    store, living = tokens.Rollups(spark, str(tmp_path)), {}

    def commit(batch, rows=None, gone=None):
        assert store.commit(batch, rows and make(rows, COUNTED), gone and make([(g,) for g in gone], "doc_id long"))
        for d, s, lang, v, c, n in sorted(rows or (), key=lambda r: (r[5], r[4], r[1] or "", r[2] or "")):
            living[d, v] = (s, lang, c, n)
        for k in [k for k in living if k[0] in (gone or ())]:
            del living[k]
        assert got(store.totals()) == brute(living)
        assert {(r.doc_id, r.version): (r.source, r.lang, r.n_chars, r.n_tokens) for r in store.ledger().collect()} == living

    commit("a", [(1, "s", "en", "v1", 10, 3), (2, "s", None, "v1", 5, 2), (3, None, "de", "v1", 0, 0), (1, "s", "en", "v2", 10, 4)])
    commit("b", [(1, "t", "en", "v1", 12, 5), (4, "s", "en", "v1", 7, 7), (4, "s", "en", "v1", 7, 6)], [2, 2, 99, None])
    assert not store.commit("a", make([(1, "s", "en", "v1", 10, 3)], COUNTED))
    assert got(store.totals()) == brute(living)
    commit("c", [(2, "s", "fr", "v1", 1, 1), (5, "s", "en", "v1", 9, 9)], [5, 1])
    commit("d", None, [3])
    commit("e", [(1, "back", "en", "v2", 1, 1)])
    commit("f")


def test_a_lost_attempt_leaves_no_trace(spark, make, tmp_path, monkeypatch):
    store = tokens.Rollups(spark, str(tmp_path))
    store.commit("a", make([(1, "s", "en", "v", 1, 1)], COUNTED))
    write = tokens.Rollups._write
    monkeypatch.setattr(tokens.Rollups, "_write", lambda self, table, batch, rows: write(self, table, batch, rows) if table != "commits" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.commit("b", make([(1, "s", "en", "v", 5, 5), (2, "s", "en", "v", 5, 5)], COUNTED))
    monkeypatch.undo()
    assert got(store.totals()) == {("s", "en", "v"): (1, 1, 1)}
    store.commit("b", make([(1, "s", "en", "v", 2, 2)], COUNTED))
    assert got(store.totals()) == {("s", "en", "v"): (1, 2, 2)}


def test_odd_documents(make):
    count = encode()
    texts = ["", None, "a", "é字😀\x00", "<|endoftext|> it's", " \n\t ", "word " * 20_000, "a" * 30_000]
    rows = [(i, "s" if i % 2 else None, "en", t, 9) for i, t in enumerate(texts)]
    every = [*rows, (None, "s", "en", "lost", 1), (None, "s", "en", "lost", 1), (None, None, "en", "lost", 1), (2, "s", "en", "other text", 1), rows[2], rows[2]]
    want = brute({(n, "byte_bpe_50k"): (s, lang, len(t or ""), count(t or "")) for n, (_, s, lang, t, _) in enumerate(every)})
    assert got(tokens.corpus_totals(make(every, DOC))) == want
    assert tokens.corpus_totals(make([], DOC)).count() == 0


def test_totals_come_out_of_signed_deltas(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "shared_folder", lambda _: str(tmp_path))
    rows = [(i % 37, f"s{i % 3}", "en", f"text number {i} of them", 1) for i in range(200)]
    total = got(tokens.corpus_totals(make(rows, DOC), slices=4))
    assert sum(n for n, _, _ in total.values()) == 200
    folder = next(tmp_path.iterdir())
    moved = {b: spark.read.parquet(f"{folder}/deltas/batch={b}").groupBy().sum("n_docs", "n_chars").first() for b in ("load", "revise", "delete", "restore")}
    assert moved["revise"][0] == 0 and moved["revise"][1] > 0
    assert moved["delete"][0] < 0 and tuple(moved["delete"]) == tuple(-x for x in moved["restore"])


def test_null_id_raises(spark, make, tmp_path):
    with pytest.raises(Exception, match="without doc_id"):
        tokens.Rollups(spark, str(tmp_path)).commit("a", make([(None, "s", "en", "v", 1, 1)], COUNTED))
