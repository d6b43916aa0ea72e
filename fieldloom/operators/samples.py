"""Samples: labels joined with features, caps, splits, weights, and reports on predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SEED = 42
#: Parts of the hash range by which large classes are counted.
BUCKETS = 1 << 14


def order_hash(key: Column, seed: int = SEED) -> Column:
    """A reproducible order of integer keys, by two rounds of modular multiplication."""
    m = 2147483647
    x = F.pmod(key.cast("long") * 48271 + F.lit(seed) * 16807 + 11, F.lit(m))
    return F.pmod(x * 69621 + 7, F.lit(m))


def training_samples(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labelled pixels (class_id > 0) with their features."""
    return labels.where("class_id > 0").join(features, ["row", "col"])


def drop_incomplete(samples: DataFrame, features: list[str]) -> DataFrame:
    return samples.dropna("any", subset=features)


def incomplete_counts(samples: DataFrame, features: list[str], by: str = "class_id") -> DataFrame:
    """(by, kept, dropped): samples without and with a missing feature."""
    missing = F.lit(False)
    for f in features:
        missing = missing | F.col(f).isNull()
    return samples.groupBy(by).agg(F.count_if(~missing).alias("kept"), F.count_if(missing).alias("dropped"))


def _first_of_class(rows: DataFrame, by: str, key: str, quota: Callable[[Column], Column], seed: int) -> DataFrame:
    """Append ``__first``: whether a row is among the first quota(n) of its class's n rows by hash and key.

    Rows are ranked within class and hash bucket, so no task sees a whole class; counts by bucket, at
    most ``BUCKETS`` a class, tell where the quota ends.
    """
    order = order_hash(F.col(key), seed)
    keyed = rows.withColumn("__bucket", F.floor(order * BUCKETS / F.lit(1 << 31)).cast("int"))
    counts = keyed.groupBy(F.col(by).alias("__class"), F.col("__bucket").alias("__end")).agg(F.count("*").alias("__n"))
    before = W.partitionBy("__class").orderBy("__end").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumns({"__before": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__all": F.sum("__n").over(W.partitionBy("__class"))})
    counts = counts.withColumn("__rest", quota(F.col("__all")) - F.col("__before")).where("__rest >= 0 and __rest < __n")
    ends = counts.select("__class", "__end", "__rest")  # a row per class, or none if all its rows are first
    rank = F.row_number().over(W.partitionBy(by, "__bucket").orderBy(order, key))
    joined = keyed.withColumn("__rank", rank).join(F.broadcast(ends), F.col(by).eqNullSafe(F.col("__class")), "left")
    first = F.col("__end").isNull() | (F.col("__bucket") < F.col("__end")) | ((F.col("__bucket") == F.col("__end")) & (F.col("__rank") <= F.col("__rest")))
    return joined.select(*rows.columns, first.alias("__first"))


def cap_per_class(rows: DataFrame, most: int, by: str = "class_name", key: str = "fid", seed: int = SEED) -> DataFrame:
    """At most ``most`` rows of each class, picked by a hash; smaller classes stay whole."""
    return _first_of_class(rows, by, key, lambda n: F.least(n, F.lit(most)), seed).where("__first").drop("__first")


def stratified_split(rows: DataFrame, by: str, key: str, share: float = 0.25, seed: int = SEED) -> DataFrame:
    """Append ``held_out``: round(share * n) rows of each class, exactly."""
    return _first_of_class(rows, by, key, lambda n: F.floor(n * share + 0.5), seed).withColumnRenamed("__first", "held_out")


def sample_per_tile(cells: DataFrame, total: int, tiles: int, by: tuple[str, ...] = ("tile_row", "tile_col"), seed: int = SEED) -> DataFrame:
    """max(1, total // tiles) cells of each tile, without replacement, as many as there are."""
    order = order_hash(F.col("row").cast("long") * 1_000_003 + F.col("col"), seed)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(order, "row", "col"))
    return cells.withColumn("__k", rank).where(F.col("__k") <= max(1, total // tiles)).drop("__k")


def class_weights(samples: DataFrame, by: str) -> DataFrame:
    """(by, n, weight): n_all / (classes * n)."""
    counts = samples.groupBy(by).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("__all"), F.count("*").alias("__k"))  # one row
    return counts.join(F.broadcast(total), F.lit(True)).select(by, "n", (F.col("__all") / (F.col("__k") * F.col("n"))).alias("weight"))


def class_counts(rows: DataFrame, by: str = "class_name") -> DataFrame:
    """Counts by class, the most frequent first."""
    return rows.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by)


def confusion(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n) in long form."""
    return rows.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def report(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per class: precision, recall, f1 and support, 0 where undefined; then macro and weighted averages and accuracy."""
    cells = confusion(rows, truth, predicted).select(F.col("truth").cast("string").alias("t"), F.col("predicted").cast("string").alias("p"), "n")
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("t").alias("label"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hit"), F.col("n").alias("own"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("own"), F.col("n").alias("said")),
    )).alias("x")).select("x.*")
    sums = sides.groupBy("label").agg(F.sum("hit").alias("hit"), F.sum("own").alias("support"), F.sum("said").alias("said"))
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    per = sums.withColumns({"precision": ratio(F.col("hit"), F.col("said")), "recall": ratio(F.col("hit"), F.col("support"))})
    per = per.withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)))
    names = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(k).alias(k) for k in names], F.sum("support").alias("support")).select(F.lit("macro avg").alias("label"), *names, "support")
    weighted = per.agg(*[(F.sum(F.col(k) * F.col("support")) / F.sum("support")).alias(k) for k in names], F.sum("support").alias("support")).select(F.lit("weighted avg").alias("label"), *names, "support")
    right = per.agg((F.sum("hit") / F.sum("support")).alias("a"), F.sum("support").alias("support")).select(F.lit("accuracy").alias("label"), *[F.col("a").alias(k) for k in names], "support")
    return per.select("label", *names, "support").unionByName(macro).unionByName(weighted).unionByName(right)
