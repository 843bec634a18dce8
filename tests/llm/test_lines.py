import hashlib
import random

import pytest

from tidemark.llm import lines
from tidemark.llm.queries import QUERIES

BLANK = {chr(i) for i in range(33)} | {"\x85", "\xa0"}


def filled(x):
    return any(c not in BLANK for c in x)


def near(a, b):
    """At most one edit, by cutting what both share at either end."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def brute(rows, min_chars=16, edits=1):
    """Rows in order of doc_id, ids unique and not null."""
    seen, out = {}, {}
    firsts = {}
    order = [(i, n, x) for i, t in sorted(rows) for n, x in enumerate((t or "").split("\n")) if filled(x)]
    for i, n, x in order:
        firsts.setdefault(x, (i, n))
    by_half = {}
    for x in firsts:
        if len(x) >= min_chars - 1:
            for m in (len(x), len(x) + 1):
                by_half.setdefault(("p", m, x[: m // 2]), []).append(x)
                by_half.setdefault(("s", m, x[len(x) - (m - m // 2) :]), []).append(x)
    gone = set()
    if edits:
        for group in by_half.values():
            for x in group:
                if any(firsts[y] < firsts[x] and y != x and max(len(x), len(y)) >= min_chars and near(x, y) for y in group):
                    gone.add(x)
    for i, t in rows:
        all_lines = (t or "").split("\n")
        left = [x for n, x in enumerate(all_lines) if not filled(x) or (firsts[x] == (i, n) and x not in gone)]
        out[i] = (len(all_lines), len(all_lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op10_line_dedup"](spark, sf_dir)) == brute(rows)


@pytest.mark.parametrize("min_chars", [1, 6])
def test_single_edits_everywhere(make, min_chars):
    rng = random.Random(min_chars)
    rows, at = [(0, None), (1, ""), (2, "\n \n\t")], 3
    for _ in range(60):
        line = "".join(rng.choice("aabé字") for _ in range(rng.randint(1, 14)))
        for _ in range(rng.randint(1, 4)):
            p, kind = rng.randrange(len(line) + 1), rng.choice("sid=")
            rows.append((at, "\n".join(["", line, rng.choice(["x" * at, line])])))
            line = {"s": line[:p] + "z" + line[p + 1 :], "i": line[:p] + "q" + line[p:], "d": line[: max(p - 1, 0)] + line[p:], "=": line}[kind]
            at += 1
    rows.append((at, "long " * 20_000 + "\n" + "long " * 19_999 + "lonk "))
    rng.shuffle(rows)
    df = make([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, row int, kept string")
    assert got(lines.digest(df, min_chars=min_chars)) == brute(rows, min_chars)
    assert got(lines.digest(df, max_edits=0, min_chars=min_chars)) == brute(rows, min_chars, edits=0)
    out = lines.dedup_lines(df, min_chars=min_chars)
    assert out.schema == df.schema and out.where("text is null").count() == 1


def test_whole_document_goes_and_repeated_rows(make):
    same = "a line that comes twice\nand another of these"
    df = make([(1, same), (2, same), (3, same + "\nsomething of its own here"), (4, "  "), (None, same), (1, same)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in lines.dedup_lines(df).collect()) == [(1, same), (1, same), (3, "something of its own here"), (4, "  ")]


def test_templated_lines_cost_a_row_each(make):
    df = make([(i, f"the same long template with number {i % 10} in it, in row") for i in range(400)], "doc_id long, text string")
    assert [r.doc_id for r in lines.dedup_lines(df).collect()] == [0]


def test_bound_asks_the_longer_line(make):
    df = make([(1, "short line abcd"), (2, "short line abcde"), (3, "short line abcf")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in lines.dedup_lines(df).collect()) == [(1, "short line abcd"), (3, "short line abcf")]


def test_empty_table(make):
    assert lines.dedup_lines(make([], "doc_id long, text string")).count() == 0


def test_lines_that_fool_polynomial_hashes(make):
    """The Thue-Morse line of 1,024 letters and its complement agree under every multiplier modulo a power of two."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    out = {r["doc_id"]: r["text"] for r in lines.dedup_lines(make([(1, one), (2, other), (3, f"é\n{one}")], "doc_id long, text string")).collect()}
    assert out == {1: one, 2: other, 3: "é"}
