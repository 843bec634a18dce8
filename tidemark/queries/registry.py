"""Where queries register themselves: a Spark function and, where SQL can say it, an oracle text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import round_half
from tidemark.queries import standin
from tidemark.session import parts_of, store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# DuckDB-only building blocks of oracle texts: name -> (relations it reads, SQL)
ORACLE_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


class Inputs:
    """Relations of one scale directory: ``r("bars")``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self.stored: dict[str, str] = {}

    def __call__(self, name: str) -> DataFrame:
        """Relations that are grouped whole (``standin.DEALT``) are dealt by the rows that they read, counted from footers."""
        source = standin.DEALT.get(name, ("",))[0]
        if name in self.stored or not source:
            parts = None
        else:
            parts = self.parts(source if source in self.stored else "lineitem")
        return standin.relation(self.spark, self.dir, name, self.stored, parts)

    def store(self, *names: str) -> Inputs:
        """Compute these relations once; they and all that is derived from them are read from the shared folder from now on."""
        for name in names:
            if name not in self.stored:
                self.stored[name] = store(self(name))
        return self

    def keep(self, name: str, make: Callable[[Inputs], DataFrame]) -> DataFrame:
        """What ``make`` gives, stored under a name of its own the first time it is asked for."""
        if name not in self.stored:
            self.stored[name] = store(make(self))
        return self.spark.read.parquet(self.stored[name])

    def parts(self, name: str) -> int:
        """Parts for the rows of a relation, which should be stored: then they are read from its footers."""
        return parts_of(self.spark, self(name).count())


def part(name: str, needs: Sequence[str], sql: str) -> None:
    ORACLE_PARTS[name] = (tuple(needs), sql)


def _closure(needs: Sequence[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in standin.BASE or n in out:
            return
        deps, _ = standin.RELATIONS.get(n) or ORACLE_PARTS[n]
        for d in deps:
            visit(d)
        out.append(n)

    for n in needs:
        visit(n)
    return out


def oracle_text(needs: Sequence[str], body: str) -> str:
    body = body.strip()
    names = _closure(needs)
    recursive = body.upper().startswith("WITH RECURSIVE ")
    if not names:
        return body
    head = "WITH RECURSIVE " if recursive else "WITH "
    ctes = ",\n".join(f"{n} AS ({(standin.RELATIONS.get(n) or ORACLE_PARTS[n])[1]})" for n in names)
    if recursive:
        return head + ctes + ",\n" + body[len("WITH RECURSIVE "):]
    if body.upper().startswith("WITH "):
        return head + ctes + ",\n" + body[len("WITH "):]
    return head + ctes + "\n" + body


def query(name: str, needs: Sequence[str] = (), sql: str | None = None):
    def deco(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = oracle_text(needs, sql)
        return fn

    return deco


def rnd(x: Column | str, digits: int = 6) -> Column:
    return round_half(F.col(x) if isinstance(x, str) else x, digits)
