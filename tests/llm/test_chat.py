import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.queries import QUERIES

SCHEMA = "conv_id long, turn int, role string, text string, formatted string, segments int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    by = {}
    for c, n, role, text, *_ in rows:
        by.setdefault(c, []).append((n is not None, n or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hard = "\\### Assistant: </turn> ok"
    assert got(QUERIES["op4_chat_format"](spark, sf_dir)) == brute([*rows, (-7, 0, "user", hard), (-7, 1, "assistant", hard)])


def test_round_trip_of_odd_texts(make):
    nasty = ["", "\\", "\\\\0", "\\1", "### ", "#### x", "</turn>", "</tu</turn>rn>", "</turn", ": ", "### User: hi</turn>\n### Assistant: yo", "\n\n", "\x00é字😀", "=x", "\\### </turn>\\"]
    roles = ["user", "assistant", None, "", "tool: x", "=user", "User", "### ", "\\"]
    rows = [(i % 7, i // 7, roles[i % len(roles)], nasty[i % len(nasty)], "f", 1) for i in range(140)]
    rows += [(100, 0, "user", None, None, None), (100, 0, "user", None, None, None), (None, 1, "assistant", "a", None, None), (None, None, "user", "b", None, None)]
    rows += [(200, i, "assistant" if i % 2 else "user", "long " * 2000, None, 0) for i in range(300)]
    df = make(rows, SCHEMA)
    assert got(chat.digest(df)) == brute(rows)
    out = chat.format_conversations(df).withColumn("back", chat.read_turns(F.col("formatted")))
    want = {}
    for c, n, r, x, *_ in rows:
        want.setdefault(c, []).append((n is not None, n or 0, r or "", x or ""))
    for r in out.collect():
        assert [tuple(t) for t in r.back] == [t[2:] for t in sorted(want[r.conv_id])]
        assert "".join(s.text for s in r.segments) == r.formatted
        assert all(s.loss == (i % 3 == 1 and r.back[i // 3].role == "assistant") for i, s in enumerate(r.segments))


@pytest.mark.parametrize("roles, valid, state", [("su", False, "asked"), ("sua", True, "answered"), ("uaua", True, "answered"), ("uua", False, None), ("au", False, None), ("usa", False, None), ("s", False, "told"), ("uax", False, None)])
def test_turn_order(make, roles, valid, state):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    row = chat.format_conversations(make([(1, i, names[c], "t", None, None) for i, c in enumerate(roles)], SCHEMA)).first()
    assert (row.valid, row.state) == (valid, state)


def test_own_template_and_empty(make):
    t = chat.Template(labels={"user": "U"}, opening="<|", closing="|>", ending="<|end|>", trained=("user",), follows={("start", "user"): "x"}, final=("x",))
    df = make([(1, 0, "user", "a<|end|>b<|\\", None, None)], SCHEMA)
    row = chat.format_conversations(df, t).select("*", chat.read_turns(F.col("formatted"), t).alias("back"), chat.loss_text(F.col("segments"), t).alias("loss")).first()
    assert row.valid and row.loss == row.back[0].text == "a<|end|>b<|\\"
    assert chat.digest(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat.Template(ending="aba")
