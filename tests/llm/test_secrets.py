import hashlib
import math
import random
import re
from collections import Counter

from tidemark.llm import secrets
from tidemark.llm.queries import QUERIES

BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def entropy_spans(text, scan):
    out = []
    for a in scan.alphabets:
        for m in re.finditer("[" + re.escape(a.characters) + "]{%d,}" % a.window, text):
            if any(re.search(p.replace("(?i)", ""), m[0], re.I if "(?i)" in p else 0) for p in scan.allowed):
                continue
            for i in range(m.start(), m.end() - a.window + 1):
                counts = Counter(text[i : i + a.window]).values()
                if -sum(c / a.window * math.log2(c / a.window) for c in counts) >= a.bits - 1e-9:
                    out.append((i, i + a.window))
    merged = []
    for s, e in sorted(out):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    return merged


def brute(rows, scan=secrets.Scan()):
    out = []
    for i, text in rows:
        text = text or ""
        found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)]
        told = lambda x: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(x))
        n = Counter(k for _, k, _ in found)
        hot = [(s, 3, e) for s, e in entropy_spans(text, scan)]
        out.append((i, n[0], n[1], n[2], hashlib.sha256(told(found).encode()).hexdigest(), told(found + hot), len(hot)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op7_secret_scan"](spark, sf_dir)) == brute(rows)


def test_patterns_and_entropy(make):
    rng = random.Random(1)
    key = lambda n, a=secrets.Scan().alphabets[1].characters: "".join(rng.choice(a) for _ in range(n))
    texts = [None, "", "token=abc", "token=abc;password = 'hunter2hunter2'", "TOKEN: \"" + key(30) + "\" api_key=" + key(8), "token=token:abcdefghij", "token=secret=abcdefgh",
             "AKIA" + "A" * 11, "AKIA" + "A" * 12, "AKIAAKIA" + "Z9" * 9 + "-AKIA", "é字😀 " + "deadbeef" * 4 + " x " + "0" * 31, "0123456789abcdef" * 3, "f" * 33 + "F" + "a" * 32,
             key(19), key(20), key(60), "ab" * 40, "a" * 25 + key(40) + "a" * 60 + key(22), "thisisaverylongwordwithoutanydigits", "12345678901234567890123456789", key(40) + "example",
             "apikey=😀" + key(25), "paſſword=abcdefghij toKen=abcdefghijk", "x" * 50_000 + key(30), " ".join("token=" + key(12) for _ in range(300)), key(3_000), "\x00token=\n" + key(21), "pass\nword=" + key(9)]
    texts += ["".join(rng.choice(["token", "=", ":", " ", "'", "secret", "AKIA", key(9), key(22), "é", "0123456789abcdef", "\n"]) for _ in range(30)) for _ in range(60)]
    rows = [*enumerate(texts), (None, "token=" + key(10)), (3, texts[3])]
    df = make([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, found string, spans int")
    assert got(secrets.report(df)) == brute(rows)
    assert secrets.report(df.limit(0)).count() == 0


def test_counts_are_incremental_and_native(make):
    scan = secrets.Scan(alphabets=(secrets.Alphabet("abc", 4, 1.5),), allowed=())
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("aabbccd") for _ in range(40))) for i in range(80)]
    df = secrets.report(make(rows, "doc_id long, text string"), scan)
    assert got(df) == brute(rows, scan)
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


def test_columns_that_clash_stay(make):
    df = make([(1, "token=abcdefgh1", 2, 3, 4, "mine")], "doc_id long, text string, _base int, _hot int, row int, found string")
    out = secrets.spans(df, name="hits")
    assert out.columns == [*df.columns, "hits"] and tuple(out.first())[:6] == (1, "token=abcdefgh1", 2, 3, 4, "mine")
    assert [tuple(x) for x in secrets.spans(df).first()["found"]] == [tuple(x) for x in out.first()["hits"]] == [(0, 0, 15)]
