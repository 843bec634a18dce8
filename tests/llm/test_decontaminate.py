import random

import pytest

from tidemark.llm import decontaminate
from tidemark.llm.queries import QUERIES


def least_edits(item, text):
    """Sellers' table: the least edits between item and any substring of text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def flat(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r " else c for c in text or "")


def squeeze(text):
    out = flat(text)
    while "  " in out:
        out = out.replace("  ", " ")
    return out


def brute(docs, items, rate):
    out = set()
    for d, t in docs:
        for i, x in items:
            x = squeeze(x).strip(" ")
            if x:
                budget = max(0, min(int(rate * len(x)), len(x) - 1))
                e = least_edits(x, squeeze(t))
                if e <= budget:
                    out.add((d, i, e))
    return out


@pytest.mark.parametrize("rate", [0.1, 0.2])
def test_edits_within_budget_are_found(make, rate):
    rng = random.Random(int(rate * 10))
    items = [(i, "".join(rng.choice("abcdefgé字 ") for _ in range(n))) for i, n in enumerate([5, 7, 8, 15, 17, 40, 63, 64, 65, 90, 130])]
    items += [(50, None), (51, " \n"), (52, "x"), (53, items[6][1])]
    docs = [(0, None), (1, ""), (2, "a" * 300)]
    for n, (_, x) in enumerate(items * 3):
        x = list(x or "")
        for _ in range(rng.randint(0, int(rate * len(x)) + 2)):
            p = rng.randrange(len(x) + 1)
            rng.choice([lambda: x.insert(p, "z"), lambda: x.__delitem__(slice(p, p + 1)), lambda: x.__setitem__(slice(p, p + 1), "Q")])()
        pad = lambda: "".join(rng.choice("abcdefg ") for _ in range(rng.randint(0, 40)))
        docs.append((10 + n, pad() + "".join(x).replace(" ", "\n \t").upper().lower() + pad()))
    got = {tuple(r) for r in decontaminate.leaks(make([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int"), make([(i, t, "e") for i, t in items], "item_id long, text string, edits string"), rate).collect()}
    assert got == brute(docs, items, rate)


def test_query_and_filter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {tuple(r) for r in QUERIES["op1_decontaminate"](spark, sf_dir).collect()}
    texts = [(r.doc_id, squeeze(r.text)) for r in docs.select("doc_id", "text").collect()]
    exact = {(d, r.item_id, 0) for r in items.collect() for d, t in texts if squeeze(r.text).strip(" ") in t}
    assert exact and exact <= got
    left = decontaminate.drop_leaks(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {d for d, _ in texts} - {d for d, _, _ in got}


def test_clashing_names(make):
    item = "the quick brown fox jumps over the lazy dog and runs away"
    docs = make([(1, item, 1, 2, 3, 4), (2, "something else", 1, 2, 3, 4)], "doc_id long, text string, _leak int, lost int, row int, `item.id` int")
    out = decontaminate.drop_leaks(docs, make([(7, item, 1)], "item_id long, text string, doc_id int"))
    assert out.schema == docs.schema and [tuple(r) for r in out.collect()] == [(2, "something else", 1, 2, 3, 4)]


def test_blocks_long_text_and_empty(make, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog and runs away"
    docs = make([(1, "word " * 200_000 + item.upper() + " word" * 9), (2, item[:40]), (None, item), (2, item[:30] + "X" + item[31:])], "doc_id long, text string")
    items = make([(i, item + " " * i if i % 2 else f"no such thing number {i}") for i in range(6)], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 80)
    assert {tuple(r) for r in decontaminate.leaks(docs, items).collect()} == {(d, i, e) for i in (1, 3, 5) for d, e in ((1, 0), (None, 0), (2, 1))}
    assert decontaminate.drop_leaks(docs, items).count() == 0
    none = make([], "item_id long, text string")
    assert decontaminate.leaks(docs, none).count() == 0 and decontaminate.drop_leaks(docs, none).count() == 4
    assert decontaminate.leaks(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("rate", [0.1, 0.2])
def test_full_budget(make, rate):
    rng = random.Random(9)
    items = [(i, "".join(rng.choice(letters) for _ in range(n))) for i, (n, letters) in enumerate((n, a) for n in (5, 12, 20, 31, 100, 153, 270) for a in ("abcdefgh", "abcdéf字g", "a\U0001d11eb"))]
    docs = []
    for i, x in items:
        for more in (0, 1):
            y = list(x)
            for k in range(int(rate * len(x)) + more):  # spread evenly
                y[int((k + 0.5) * len(x) / (int(rate * len(x)) + more))] = "Z"
            docs.append((2 * i + more, "so " + "".join(y) + " it is"))
    want = {(d, i, e) for d, t in docs for i, x in items if (e := least_edits(x, squeeze(t))) <= int(rate * len(x))}
    assert {(2 * i, i) for i, _ in items} <= {(d, i) for d, i, _ in want}
    d, b = make(docs, "doc_id long, text string"), make(items, "item_id long, text string")
    assert {tuple(r) for r in decontaminate.leaks(d, b, rate).collect()} == want
    assert {r.doc_id for r in decontaminate.drop_leaks(d, b, rate).collect()} == {d for d, _ in docs} - {d for d, _, _ in want}
