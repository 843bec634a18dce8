import hashlib
from collections import Counter

import test_decontaminate
import test_lines
import test_minhash
import test_mixing

import corpus_pipeline
from tidemark.llm import langid


def test_each_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, sf_dir).checkpoint()
        after = docs.collect()
        texts = [(r.doc_id, r.text) for r in before]
        if name != "mix_sources":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "language_id":
            kept = {r.doc_id for r in langid.predictions(spark.createDataFrame(before)).where("lang_pred <> 'und' and score >= 0.3").collect()}
            assert set(after) == {r for r in before if r.doc_id in kept} and len(after) > 0.95 * len(before)
        elif name == "line_dedup":
            want = test_lines.brute(texts)
            got = {r.doc_id: r for r in after}
            for i, t in texts:
                if i in got:
                    assert hashlib.sha256((got[i].text or "").encode()).hexdigest() == want[i][2] and got[i].n_chars == len(got[i].text)
                else:
                    assert want[i][1] == sum(map(test_lines.filled, t.split("\n"))) > 0
        elif name == "minhash_neardup":
            kept = {i for i, (_, root, _) in test_minhash.brute(texts).items() if root == i}
            assert set(after) == {r for r in before if r.doc_id in kept}
        elif name == "decontaminate":
            found = {i for i, t in texts for _, x in items if test_decontaminate.squeeze(x).strip() in test_decontaminate.squeeze(t)}
            gone = {i for i, _ in texts} - {r.doc_id for r in after}
            assert found <= gone and set(after) == {r for r in before if r.doc_id not in gone}
            flat = {i: test_decontaminate.squeeze(t) for i, t in texts}
            for i in gone - found:
                assert any(test_decontaminate.least_edits(test_decontaminate.squeeze(x).strip(), flat[i]) <= 0.1 * len(x) for _, x in items)
        else:
            rows = [(r.doc_id, r.text, r.source) for r in before]
            assert Counter((r.doc_id, r.source, r.copy) for r in after) == test_mixing.brute(rows)
            text = {r.doc_id: r.text for r in before}
            assert all(text[r.doc_id] == r.text for r in after)


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key"} == set(out.columns) and out.count() > 0


def test_odd_documents(spark, make, sf_dir):
    rows = [(i, f"the quick text number {i} with its own words {i * i} and {i * 7 + 1}", "en", "s", 1) for i in range(40)]
    rows += [(None, "a text without an id but with words", "en", None, None), (50, None, "en", "s", 0), (51, "", None, "s", 0), (52, "!!! 123", "en", "s", 7), (3, rows[3][1], "en", "s", 1), (60, "word " * 50_000, "en", "s", 250_000)]
    docs = make(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        df = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, sf_dir).checkpoint()
        assert (df.count() == 0) == empty
