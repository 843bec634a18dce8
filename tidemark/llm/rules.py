"""Quality rules: a decision list learned from labelled statistics, without Python on the way.

Sequential covering: a rule for poor documents is grown, one threshold at a time, on two thirds of the labelled rows they still
need, pruned from its end on the other third, and the rows that it covers leave.  Spark counts labels by statistic and cut; the
driver sees these counts alone.  The list becomes one ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# Characters between words, symbols, and the shape of the base rule.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

#: Statistics that rules may ask about; null where a text has no words.
STATISTICS = (
    "words", "mean_word", "symbols_a_word", "upper_share", "distinct_share", "duplicate_line_share", "repeated_share", "words_a_line",
)


@dataclass(frozen=True)
class Settings:
    """cuts: thresholds of a statistic from the quantiles of each class; rules, conditions: at most; precision: of a rule on the
    rows that prune it, at least; support: rows that a rule covers, at least."""

    cuts: int = 16
    rules: int = 8
    conditions: int = 4
    precision: float = 0.9
    support: int = 3


@dataclass(frozen=True)
class Condition:
    """``statistic`` is at least ``cut`` (``above``) or below it."""

    statistic: str
    above: bool
    cut: float

    def column(self) -> Column:
        x = F.col(self.statistic)
        return F.coalesce(x >= F.lit(self.cut) if self.above else x < F.lit(self.cut), F.lit(False))

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def first_rule(rules: Sequence[Rule]) -> Column:
    """The number (from 1) of the first rule of the list that holds, 0 if none does."""
    if not rules:
        return F.lit(0)
    out = F.when(holds(rules[0]), 1)
    for k, rule in enumerate(rules[1:], 2):
        out = out.when(holds(rule), k)
    return out.otherwise(0)


def _repeated_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more, from structs (w, i) of a window and its place, in order."""
    same = lambda x, i: (F.get(windows, i + 1)["w"] == x["w"]) | (F.get(windows, i - 1)["w"] == x["w"])
    places = F.sort_array(F.transform(F.filter(windows, lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(places, start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a["n"])


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and STATISTICS) for every row of ``docs`` (doc_id, text).

    A null text is an empty one: counts of 0, the base rule fails it, other statistics are null. Windows are zipped from shifted
    copies of the word array and sorted, so that equal ones are neighbours: whole words are compared, never hashes.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", F.array_remove(F.split("text", SPACES, -1), "").alias("w"), F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD)).alias("lines"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), F.regexp_count("text", F.lit("[A-Z]")).alias("n_upper"),
    )
    many = F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))
    windows = F.arrays_zip(*(F.slice("w", k + 1, many).alias(f"w{k}") for k in range(WINDOW)))
    rows = rows.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols", "n_upper", F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.size(F.array_distinct("w")).alias("n_distinct"),
        windows.alias("w"), F.slice(F.sequence(F.lit(1), many + 1), F.lit(1), many).alias("i"),
    )
    rows = rows.withColumn("windows", F.sort_array(F.arrays_zip("w", "i"))).withColumn("n_repeat_words", _repeated_words(F.col("windows")))
    each = lambda n, of: F.col(n) / F.when(F.col(of) > 0, F.col(of))
    derived = dict(zip(STATISTICS, (
        F.when(F.col("n_words") > 0, F.col("n_words").cast("double")), each("word_chars", "n_words"), each("n_symbols", "n_words"), each("n_upper", "word_chars"),
        each("n_distinct", "n_words"), each("n_dup_lines", "n_lines"), each("n_repeat_words", "n_words"), each("n_words", "n_lines"),
    )))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), *(c.alias(n) for n, c in derived.items()))


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """``stats`` with ``bad`` (1 where quality is 0, 0 where it is 1) and ``grow`` (two thirds of the ids), for rows that passed the base rule.

    Ids that are null, without a label or with labels that disagree are left out; a label counts for every row of its id.
    """
    told = labels.where("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
    told = told.where("least = most").select("doc_id", (1 - F.col("least")).cast("int").alias("bad"))
    grow = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    return stats.where("not base_failed").join(told, "doc_id").withColumn("grow", grow)


def thresholds(rows: DataFrame, statistics: Sequence[str], cuts: int) -> dict[str, list[float]]:
    """For each statistic the quantiles of the poor and of the good rows that grow rules: 2 * ``cuts`` numbers at most."""
    probs = [(k + 0.5) / cuts for k in range(cuts)]
    kinds = [F.when(F.col("bad") == bad, F.col(s)) for s in statistics for bad in (1, 0)]
    row = rows.where("grow").agg(*(F.percentile_approx(c, probs, 10_000).alias(f"q{k}") for k, c in enumerate(kinds))).first()
    return {s: sorted({*(row[2 * k] or []), *(row[2 * k + 1] or [])}) for k, s in enumerate(statistics)}


def counts(rows: DataFrame, cuts: dict[str, list[float]]) -> list[tuple[str, int, int, int]]:
    """(statistic, number of its cuts that a row reaches, poor rows, good rows), counted by Spark."""
    place = lambda s, at: F.size(F.filter(F.array(*(F.lit(c) for c in at)), lambda c: c <= F.col(s)))
    cells = [F.struct(F.lit(s).alias("s"), F.when(F.col(s).isNotNull(), place(s, at)).alias("k")) for s, at in cuts.items() if at]
    if not cells:
        return []
    cell = rows.select("bad", F.explode(F.array(*cells)).alias("c")).where("c.k is not null").groupBy("c.s", "c.k")
    return [tuple(r) for r in cell.agg(F.sum("bad").alias("poor"), F.sum(1 - F.col("bad")).alias("good")).collect()]


def best_condition(cells: list[tuple[str, int, int, int]], cuts: dict[str, list[float]], poor: int, good: int, support: int) -> tuple[Condition, int, int] | None:
    """The condition of the greatest information gain on the counted cells, and what it covers; ties go to the first statistic, above, the lowest cut."""
    best, most, before = None, 1e-9, math.log2(poor / (poor + good)) if poor else 0.0
    for s, at in cuts.items():
        mine = {k: (p, n) for name, k, p, n in cells if name == s}
        for above in (True, False):
            for j in range(len(at)):
                chosen = [v for k, v in mine.items() if (k > j) == above]
                p, n = sum(v[0] for v in chosen), sum(v[1] for v in chosen)
                if p == 0 or p + n < support:
                    continue
                gain = p * (math.log2(p / (p + n)) - before)
                if gain > most + 1e-9:
                    best, most = (Condition(s, above, float(at[j])), p, n), gain
    return best


def _covered(rows: DataFrame, rules: Sequence[Rule]) -> list[tuple[int, int]]:
    """Poor and good rows that each rule covers, in one pass."""
    sums = [F.coalesce(F.sum(F.when(holds(r), of)), F.lit(0)) for r in rules for of in (F.col("bad"), 1 - F.col("bad"))]
    row = rows.agg(*(c.alias(f"n{k}") for k, c in enumerate(sums))).first()
    return [(row[2 * k], row[2 * k + 1]) for k in range(len(rules))]


def learn(rows: DataFrame, settings: Settings = Settings(), statistics: Sequence[str] = STATISTICS) -> list[Rule]:
    """The decision list for ``bad`` rows of ``rows`` (statistics, bad, grow). Without poor or good rows to grow on it is empty."""
    cuts, rules = thresholds(rows, statistics, settings.cuts), []
    while len(rules) < settings.rules:
        left = rows.where(first_rule(rules) == 0)
        rule: Rule = ()
        (poor, good), = _covered(left.where("grow"), [()])
        while poor and good and len(rule) < settings.conditions:
            found = best_condition(counts(left.where("grow").where(holds(rule)), cuts), cuts, poor, good, settings.support)
            if found is None:
                break
            condition, poor, good = found
            rule += (condition,)
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        seen = _covered(left.where("not grow"), prefixes)
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in seen]
        k = max(range(len(prefixes)), key=lambda j: (worth[j], -j))
        if (1 + worth[k]) / 2 < settings.precision:
            break
        rules.append(prefixes[k])
    return rules


def verdicts(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule) for every row of ``docs`` (doc_id, text).

    ``rule`` is the rule of the list that rejects a document (0: none); the base rule comes first. Statistics are written once, then
    the list is learned from those with a label and applied to all. Null or empty text: the base rule fails it. Rows with a null
    doc_id are judged and never learned from; rows that repeat an id are judged by their own text. Extra columns are ignored; an
    empty table gives no rows, and without labels of both kinds the base rule decides alone.
    """
    stats = stored(statistics(docs))
    rules = learn(stored(labelled(stats, labels).select("bad", "grow", *STATISTICS)), settings)
    judged = stats.withColumn("rule", first_rule(rules).cast("int"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
