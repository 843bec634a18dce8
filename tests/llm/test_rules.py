import math
import random
import re
from collections import Counter

from tidemark.llm import rules
from tidemark.llm.queries import QUERIES

BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base(i, text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    times = Counter(windows)
    inside = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(5)}
    return (i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(w) < 10 or 100 * len(inside) > 20 * len(w))


def told(df):
    return sorted((tuple(r) for r in df.select(BASE).collect()), key=str)


def holds(rule, row):
    return all(row[c.statistic] is not None and (row[c.statistic] >= c.cut) == c.above for c in rule)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op12_quality_rules"](spark, sf_dir)
    assert told(out) == sorted((base(*d) for d in docs), key=str)
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())
    rows = out.collect()
    assert all(r["kept"] == (not r["base_failed"] and r["rule"] == 0) for r in rows)


def test_verdicts_follow_the_list(spark):
    """Every verdict again in plain Python from the learned list, and accuracy on the rows that took no part in growing."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    stats = rules.stored(rules.statistics(docs))
    rows = rules.labelled(stats, labels)
    learned = rules.learn(rows)
    assert learned
    number = {r["doc_id"]: r["rule"] for r in rules.verdicts(docs, labels).collect()}
    for r in stats.collect():
        assert number[r["doc_id"]] == next((k for k, rule in enumerate(learned, 1) if holds(rule, r)), 0)
    held = [r for r in rows.where("not grow").collect()]
    right = sum(any(holds(rule, r) for rule in learned) == bool(r["bad"]) for r in held)
    assert right / len(held) >= 0.95


def test_hard_texts(make):
    rng = random.Random(5)
    texts = [None, "", " \t\n\x0b\x0c\r", "a", "a b c d e", "a b c d e a b c d e", "x " * 3000, "a\n\nb\r\na\n \nb", "é#😀 $ 日本|\x00 \x85 \xa0", "A a " * 7, "l\n" * 40, "w" * 300_000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(80)]
    texts += ["\n".join(rng.choice(["one two", "one two ", "three", "", " "]) for _ in range(12)) for _ in range(20)] + [" ".join(str(rng.randrange(40)) for _ in range(50_000))]
    rows = [*enumerate(texts), (None, texts[9]), (None, None), (5, texts[5]), (5, "other")]
    docs = make([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, rule int, windows string")
    labels = make([(5, 0, 0), (5, 1, 0), (9, None, 1), (None, 0, 1), (7, 2, 0)], "doc_id long, quality int, toxic int")
    out = rules.verdicts(docs, labels)
    assert told(out) == sorted((base(*r) for r in rows), key=str)
    assert out.where("kept = base_failed").count() == 0  # no usable label: the base rule alone
    assert told(rules.verdicts(docs.limit(0), labels)) == []
    assert rules.verdicts(docs, labels.limit(0)).where("rule > 0").count() == 0


def plain(rows, statistics, s):
    """Sequential covering over plain rows, conditions judged one by one."""
    cuts, out = None, []
    grow = [r for r in rows if r["grow"]]

    def quantiles(v):
        v = sorted(x for x in v if x is not None)
        return {v[max(0, math.ceil((k + 0.5) / s.cuts * len(v)) - 1)] for k in range(s.cuts)} if v else set()

    cuts = {f: sorted(quantiles(r[f] for r in grow if r["bad"]) | quantiles(r[f] for r in grow if not r["bad"])) for f in statistics}
    count = lambda rule, of: (sum(r["bad"] for r in of if holds(rule, r)), sum(1 - r["bad"] for r in of if holds(rule, r)))
    while len(out) < s.rules:
        left = [r for r in rows if not any(holds(x, r) for x in out)]
        mine, rule = [r for r in left if r["grow"]], ()
        p, n = count((), mine)
        while p and n and len(rule) < s.conditions:
            best, most = None, 1e-9
            for f in statistics:
                for above in (True, False):
                    for cut in cuts[f]:
                        c = rules.Condition(f, above, cut)
                        a, b = count((*rule, c), mine)
                        gain = a * (math.log2(a / (a + b)) - math.log2(p / (p + n))) if a and a + b >= s.support else 0
                        if gain > most + 1e-9:
                            best, most = (c, a, b), gain
            if best is None:
                break
            rule, p, n = (*rule, best[0]), best[1], best[2]
        if not rule:
            break
        worth = [(a - b) / (a + b) if a + b else -1 for a, b in (count(rule[:k], [r for r in left if not r["grow"]]) for k in range(1, len(rule) + 1))]
        k = max(range(len(worth)), key=lambda j: (worth[j], -j))
        if (1 + worth[k]) / 2 < s.precision:
            break
        out.append(rule[: k + 1])
    return out


def test_covering_equals_a_plain_one(make):
    rng, rows = random.Random(6), []
    for _ in range(400):
        a, b, c = rng.randrange(12), round(rng.random(), 2), rng.choice([None, 0.0, 1.0, 2.5])
        bad = int((a >= 8 and b < 0.5) or c == 2.5) if rng.random() < 0.97 else rng.randrange(2)
        rows.append({"a": float(a), "b": b, "c": c, "bad": bad, "grow": rng.random() < 0.66})
    df = make([tuple(r.values()) for r in rows], "a double, b double, c double, bad int, grow boolean")
    s = rules.Settings(cuts=6, precision=0.8)
    assert rules.learn(df, s, ["a", "b", "c"]) == plain(rows, ["a", "b", "c"], s)
    assert len(plain(rows, ["a", "b", "c"], s)) >= 2
