"""Chat formatting: a declarative template, a finite-state machine over roles, and segments with loss flags."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written and which turns may follow each other.

    A turn is ``opening`` label ``closing`` text ``ending``. Roles without a label are written as ``=`` and their name. In
    texts and names the escape character and every control string are replaced by the escape character and a digit, so no
    control string occurs in them. ``follows`` maps (state, role) to the next state; a conversation is valid if it ends in a
    state of ``final``. Turns of ``trained`` roles carry loss, on their text alone.
    """

    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    opening: str = "### "
    closing: str = ": "
    ending: str = "</turn>\n"
    escape: str = "\\"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    follows: dict[tuple[str, str], str] = field(default_factory=lambda: {("start", "system"): "told", ("start", "user"): "asked", ("told", "user"): "asked", ("asked", "assistant"): "answered", ("answered", "user"): "asked"})
    final: tuple[str, ...] = ("answered",)

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.opening, self.ending.strip())

    def __post_init__(self):
        end = self.ending.strip()
        if any(end[:n] == end[-n:] for n in range(1, len(end))) or len(self.escape) != 1:
            raise ValueError("the ending must not overlap itself; the escape is one character")
        if any(self.escape in c or re.search(r"\d", c) for c in self.controls):
            raise ValueError("control strings hold neither the escape character nor digits")
        if any(x.startswith("=") or self.closing in x for x in self.labels.values()) or len(set(self.labels.values())) < len(self.labels):
            raise ValueError("labels are distinct, do not start with = and do not hold the closing string")


def _escaped(text: Column, t: Template, extra: tuple[str, ...] = ()) -> Column:
    out = F.replace(text, F.lit(t.escape), F.lit(t.escape + "0"))
    for i, c in enumerate((*t.controls, *extra), 1):
        out = F.replace(out, F.lit(c), F.lit(f"{t.escape}{i}"))
    return out


def _plain(text: Column, t: Template, extra: tuple[str, ...] = ()) -> Column:
    out = text
    for i, c in enumerate((*t.controls, *extra), 1):
        out = F.replace(out, F.lit(f"{t.escape}{i}"), F.lit(c))
    return F.replace(out, F.lit(t.escape + "0"), F.lit(t.escape))


def format_conversations(turns: DataFrame, t: Template = Template()) -> DataFrame:
    """(conv_id, n_turns, segments array<struct<text, loss>>, formatted, state, valid) for each conversation.

    ``turns`` holds conv_id, turn, role, text; turns are ordered by turn (null first), role and text, null roles and texts
    count as empty, and repeated rows are turns of their own. All conversations are formatted; ``valid`` tells if the order
    of roles is allowed, ``state`` where the machine ended (null after a turn that may not follow). A null conv_id is a
    conversation. Extra columns are ignored; no rows give no rows.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chat = turns.select("conv_id", row.alias("row")).groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    label = F.create_map(*(F.lit(x) for pair in t.labels.items() for x in pair))
    step = F.create_map(*(F.lit(x) for (state, role), then in t.follows.items() for x in (f"{state}>{role}", then)))

    def turn(r: Column) -> Column:
        name = F.coalesce(F.try_element_at(label, r["role"]), F.concat(F.lit("="), _escaped(r["role"], t, (t.closing,))))
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.concat(F.lit(t.opening), name, F.lit(t.closing)), F.lit(False)),
            piece(_escaped(r["text"], t), r["role"].isin(*t.trained)),
            piece(F.lit(t.ending), F.lit(False)),
        )

    state = F.aggregate("rows", F.lit(t.start), lambda s, r: F.try_element_at(step, F.concat(s, F.lit(">"), r["role"])))
    out = chat.select("conv_id", F.size("rows").cast("long").alias("n_turns"), F.flatten(F.transform("rows", turn)).alias("segments"), state.alias("state"))
    return out.select("conv_id", "n_turns", "segments", F.array_join("segments.text", "").alias("formatted"), "state", F.coalesce(F.col("state").isin(*t.final), F.lit(False)).alias("valid"))


def read_turns(formatted: Column, t: Template = Template()) -> Column:
    """array<struct<role, text>>: the turns that a formatted conversation was made of."""
    names = F.create_map(*(F.lit(x) for role, shown in t.labels.items() for x in (shown, role)))
    parts = F.split(formatted, re.escape(t.ending), -1)

    def turn(part: Column) -> Column:
        body = F.substring(part, len(t.opening) + 1, 2**31 - 1)
        shown = F.substring_index(body, t.closing, 1)
        role = F.coalesce(F.try_element_at(names, shown), _plain(F.substring(shown, 2, 2**31 - 1), t, (t.closing,)))
        text = F.substring(body, F.length(shown) + len(t.closing) + 1, F.lit(2**31 - 1))
        return F.struct(role.alias("role"), _plain(text, t).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def loss_text(segments: Column, t: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: _plain(s["text"], t)), "")


def digest(turns: DataFrame, t: Template = Template()) -> DataFrame:
    """What the formatted output says, read back from it."""
    out = format_conversations(turns, t)
    told = F.array_join(F.transform(read_turns(F.col("formatted"), t), lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), "")
    lost = out.withColumn("loss", loss_text(F.col("segments"), t)).withColumn("turns", read_turns(F.col("formatted"), t))
    return lost.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )
