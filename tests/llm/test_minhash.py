import re

import numpy as np

from tidemark.llm import minhash
from tidemark.llm.common import components
from tidemark.llm.queries import QUERIES


def words_set(text, k=5):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows):
    sets = {i: words_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    pairs = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op9_minhash_neardup"](spark, sf_dir).collect()}
    assert got == brute(rows)


def test_chains_copies_and_odd_rows(make):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 9999, 60)]
    chain = [" ".join(base[:60 - 6 * k] + [f"x{j}" for j in range(6 * k)]) for k in range(4)]
    rows = [(i + 10, t) for i, t in enumerate(chain)] + [(i + 50, chain[1].upper()) for i in range(5)]
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (7, "é É"), (8, "é é"), (9, "a b c d e"), (99, "A\x0bb\x0cc\rd e")]
    rows += [(200, "y " * 30_000), (201, "y y y y y")]
    df = make([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, component_id string, n_shingles int")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == brute(rows)
    kept = minhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, c, _) in got.items() if i == c}


def test_empty_null_ids_and_repeats(make):
    schema = "doc_id long, text string"
    assert minhash.near_duplicates(make([], schema)).count() == 0
    rows = [(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "A b c d E")]
    got = sorted(minhash.near_duplicates(make(rows, schema)).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True)]
    assert sorted(map(str, (r.doc_id for r in minhash.drop_near_duplicates(make(rows, schema)).collect()))) == ["1", "None"]


def test_components(make):
    df = make([(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (None, 1), (2, 5)], "a long, b long")
    assert sorted(map(tuple, components(df).collect())) == [(2, 2), (3, 2), (4, 2), (5, 2), (8, 8), (9, 8)]


def test_words_that_fool_polynomial_hashes(make):
    """The Thue-Morse word of 1,024 letters and its complement agree under every multiplier modulo a power of two."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    out = minhash.near_duplicates(make([(1, f"{one} x y z w"), (2, f"{other} x y z w"), (3, f"{one} x y z w")], "doc_id long, text string"))
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == [(1, 1), (2, 2), (3, 1)]


def test_rows_that_share_an_id_keep_their_own_links(make):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, one), (1, two), (2, one + " x"), (3, two + " y"), (1, two + " z"), (1, one), (5, "alone " * 9), (5, "apart " * 9)]
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(make(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (5, 5, True)}
    df = make([(i, t, "s", 1, "x") for i, t in rows], "doc_id int, text string, tag string, row int, root string")
    left = minhash.drop_near_duplicates(df)
    assert left.schema == df.schema
    got = sorted((r.doc_id, r.text) for r in left.collect())
    assert [i for i, _ in got] == [1, 1, 5, 5] and got[0][1] == one and got[1][1] in (two, two + " z")


def test_components_of_pairs_found_late(make):
    """Two roots that a late pair joins become one, and an edge list that is a star already is left as it is."""
    star = make([(2, 1), (3, 1), (5, 4)], "a long, b long")
    assert sorted(map(tuple, components(star).collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    assert components(make([], "a long, b long")).count() == 0
    twice = make([(3, 2), (3, 2), (2, 1), (9, 3)], "a long, b long")
    assert sorted(map(tuple, components(twice).collect())) == [(1, 1), (2, 1), (3, 1), (9, 1)]
