"""Mixing sources to target weights by Poisson replication, without Python on the way.

Each document of a source is repeated a number of times drawn from a Poisson distribution whose mean is the source's target
repetition rate: the inverse of the distribution at a uniform number that a hash of seed and id gives.  Expected amounts meet
the weights exactly, documents decide alone, and a rerun draws the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Larger means are drawn as a sum of parts, whose exponentials do not vanish.
PART = 256
#: Rates are broadcast up to so many sources (names of 256 characters at most); beyond, the join is salted.
BROADCAST_SOURCES = 10_000
SALTS = 64


def uniform(*of: Column) -> Column:
    """A number in [0, 1) of 52 bits from an MD5 of the parts."""
    text = F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit("null")) for c in of))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_sums(mean: Column) -> Column:
    """array<double>: the distribution function at 0, 1, ... to where what is left vanishes."""
    top = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    none = F.exp(-mean)
    step = lambda acc, k: F.struct((acc["p"] * mean / k).alias("p"), (acc["c"] + acc["p"] * mean / k).alias("c"), F.concat(acc["sums"], F.array(acc["c"] + acc["p"] * mean / k)).alias("sums"))
    start = F.struct(none.alias("p"), none.alias("c"), F.array(none).alias("sums"))
    return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda acc: acc["sums"])


def rates(docs: DataFrame, weights: DataFrame | None = None, alpha: float = 0.5, amount: float = 1.0) -> DataFrame:
    """(source, mean): the repetition rate of each source of ``docs``.

    A source's size is the number of its characters. ``weights`` (source, weight) are targets, scaled to a sum of one over the
    sources present; sources it lacks, and weights that are null or not positive, get none. Without it a weight is the size to
    the power of ``alpha``. The mixture is ``amount`` times the characters of these sources. A source without characters gets no rate.
    """
    size = docs.groupBy("source").agg(F.sum(F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))).cast("double").alias("size")).where("size > 0")
    if weights is None:
        size = size.withColumn("weight", F.pow("size", F.lit(alpha)))
    else:
        w = weights.groupBy(F.col("source").alias("s")).agg(F.max("weight").cast("double").alias("weight"))
        size = size.join(w, size.source.eqNullSafe(w.s)).where("weight > 0").drop("s")
    total = size.agg(F.sum("size").alias("all"), F.sum("weight").alias("weights"))
    return size.crossJoin(total).select("source", (F.col("weight") / F.col("weights") * F.col("all") * amount / F.col("size")).alias("mean"))


def mix(docs: DataFrame, weights: DataFrame | None = None, alpha: float = 0.5, amount: float = 1.0, seed: int = 0) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with each row repeated, and ``copy`` (1, 2, ...) and ``shuffle_key`` added.

    Rows are dealt out by a hash of id, copy and seed and ordered by it within partitions, which shuffles them globally. See
    ``rates`` for the means. A null source is a source; rows with a null or repeated doc_id draw the number that this id
    draws. Columns named copy or shuffle_key are replaced; no rows give no rows.
    """
    mean = stored(rates(docs, weights, alpha, amount).withColumn("parts", F.ceil(F.col("mean") / PART)).select("source", "parts", poisson_sums(F.col("mean") / F.greatest("parts", F.lit(1))).alias("sums")))
    small = mean.agg(F.count("*").alias("n"), F.max(F.length("source")).alias("name")).first()
    own = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"))
    mean = mean.withColumnRenamed("source", "of")
    same = F.col("row.source").eqNullSafe(F.col("of"))
    if small.n <= BROADCAST_SOURCES and (small.name or 0) <= 256:
        rows = rows.join(F.broadcast(mean), same)
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("row.doc_id"), F.lit(SALTS)))
        mean = mean.withColumn("salted", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.join(mean, same & (F.col("salt") == F.col("salted")))
    draw = lambda acc, part: acc + F.size(F.filter("sums", lambda c: c < uniform(F.lit(seed), F.lit("copies"), part, F.col("row.doc_id"))))
    count = F.aggregate(F.sequence(F.lit(1), F.col("parts").cast("int")), F.lit(0), draw)
    rows = rows.select("row", count.alias("count")).where("count > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    text = F.concat_ws(":", F.lit(str(seed)), F.lit("order"), F.col("copy"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")))
    key = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    rows = rows.select("row", "copy", key.alias("shuffle_key")).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return rows.select(*(F.col(f"row.`{c}`").alias(c) for c in own), "copy", "shuffle_key")
