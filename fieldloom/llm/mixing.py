"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

Each source's rate is the number of copies of its documents that the target weight asks for.  A
document's copy count inverts the Poisson distribution of that mean at a uniform number made from a
hash of the document, so every run and every executor draws the same copies.  A rate above
``PART_RATE`` is the sum of independent draws of equal smaller rates, which is Poisson again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, skew_safe_join

#: The largest mean that is inverted at once: exp(-mean) must stay far from the least double.
PART_RATE = 600.0
#: Copies that one array holds before they are exploded.
COPIES = 4096


def uniform(seed: int, *cols: str | Column) -> Column:
    """In (0, 1), from 48 bits of the MD5 of the seed and the values."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("~")) for c in cols]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def poisson_cdf(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... until the rest is below 2**-50 or so.

    Each term comes from the one before, and the first is exp(-rate): it would underflow above 700,
    so callers split larger rates into parts of at most ``PART_RATE``.
    """
    top = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(acc["cdf"], F.array(c)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), top), start, step)["cdf"]


def mixing_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, scale: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, rows, bytes, weight, rate): the repetition rate of each source.

    A source's share of the output bytes should be its weight; without ``weights`` a source weighs
    its bytes to the power ``alpha``.  The output's expected bytes are ``scale`` times the input's.
    A source that ``weights`` leaves out gets rate 0; null is a source of its own; a source without
    any bytes keeps its rows once.
    """
    size = F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("long")
    stats = docs.groupBy(F.col(source_col).alias("__source")).agg(F.count("*").alias("__rows"), F.sum(size).alias("__bytes"))
    stats = Scratch(docs.sparkSession, "mixing").result(stats, "sources")
    if weights is None:
        raw = F.pow(F.col("__bytes").cast("double"), F.lit(alpha))
    else:
        table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        raw = F.coalesce(F.try_element_at(table, F.col("__source")), F.lit(0.0))
    stats = stats.withColumn("__raw", raw)
    total = stats.agg(F.sum("__raw").alias("w"), F.sum("__bytes").alias("b")).first()
    w, b = float(total["w"] or 1) or 1.0, float(total["b"] or 0)
    share = F.col("__raw") / F.lit(w)
    rate = F.when(F.col("__bytes") > 0, share * F.lit(b * scale) / F.col("__bytes")).otherwise(F.lit(1.0))
    return stats.select("__source", "__rows", "__bytes", share.alias("__weight"), rate.cast("double").alias("__rate"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, scale: float = 1.0, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Replicate and shuffle: the columns of ``docs`` plus ``replica`` and ``shuffle_key``.

    Documents with equal id and text draw the same number of copies; null ids draw by their text.
    A column of ``docs`` named replica or shuffle_key is replaced.  The rows are dealt by
    ``shuffle_key``, a hash, and sorted on it in each partition.  The counts and keys depend on the seed
    and the rows alone; which partition a row lies in also depends on the number of partitions, so
    order by ``shuffle_key`` where the same global order is wanted.  Rates have no limit but that ``replica`` is an int; the work of drawing grows with
    the copies drawn.  An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("replica", "shuffle_key")]
    rates = mixing_rates(docs, weights, alpha, scale, source_col, text_col)
    total = int(rates.agg(F.sum("__rows")).first()[0] or 0)
    facts = rates.select(F.coalesce(F.concat(F.lit("="), F.col("__source").cast("string")), F.lit("~")).alias("__key"), "__rows", "__rate", F.greatest(F.ceil(F.col("__rate") / PART_RATE), F.lit(1)).cast("int").alias("__parts"))
    facts = facts.select("__key", "__rows", "__parts", poisson_cdf(F.col("__rate") / F.col("__parts")).alias("__cdf"))
    key, text, draw, cdf, parts, first, n = fresh([*docs.columns, "replica", "shuffle_key"], "__key", "__text", "__u", "__cdf", "__parts", "__first", "__n")
    facts = facts.select(F.col("__key").alias(key), "__rows", F.col("__parts").alias(parts), F.col("__cdf").alias(cdf))
    rows = docs.select(*kept).withColumn(key, F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("~")))
    rows = rows.withColumn(text, F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("~"))))
    rows = rows.withColumn(draw, uniform(seed, id_col, text))
    drawn = skew_safe_join(rows, facts.select(key, F.struct(cdf, parts).alias(first), F.col("__rows").alias(n)), [key], n, total).drop(n)
    drawn = drawn.select(*rows.columns, F.col(f"{first}.{cdf}").alias(cdf), F.col(f"{first}.{parts}").alias(parts))

    def count(u: Column) -> Column:
        return F.aggregate(cdf, F.lit(0), lambda n, c: F.when(c < u, n + 1).otherwise(n))

    further = F.aggregate(F.sequence(F.lit(2), F.col(parts)), F.lit(0), lambda n, k: n + count(uniform(seed, id_col, text, k)))
    drawn = drawn.withColumn(n, count(F.col(draw)) + F.when(F.col(parts) > 1, further).otherwise(F.lit(0)))
    # In blocks, so that no array holds all copies of a document.
    blocks = drawn.where(F.col(n) > 0).withColumn(first, F.explode(F.sequence(F.lit(1), F.col(n), F.lit(COPIES))))
    copies = blocks.withColumn("replica", F.explode(F.sequence(F.col(first), F.least(F.col(n), F.col(first) + (COPIES - 1)))))
    copies = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("deal"), F.coalesce(F.col(id_col).cast("string"), F.lit("~")), F.col(text), F.col("replica").cast("string"))))
    return copies.select(*kept, "replica", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key")
