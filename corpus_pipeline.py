"""The corpus pipeline: five stages, each a written Parquet table that the next one reads.

Toxic documents go, one document of each near-copy group stays, documents with benchmark items go,
sources are mixed to target weights, and what is left is cut into balanced shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from fieldloom.llm.common import Scratch
from fieldloom.llm.queries import fold, table

#: SQL cannot express the network of the first stage.  tests/llm/test_brute.py holds run()'s rows against plain
#: Python from the second stage on, and the first stage against held-out labels.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"), keep=fold(3) != 1)
    return toxicity.drop_toxic(docs, net, 0.7)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``.

    Every stage's output is written to the shared folder and goes when the next one stands; the last
    stays with the session.  Null and empty texts pass the first three stages, repeated rows count as
    near copies, columns besides those of documents pass, and empty tables give an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for k, (name, stage) in enumerate(STAGES):
            out = stage(spark, docs, sf_dir)
            docs = scratch.write(out, name) if k + 1 < len(STAGES) else scratch.result(out, name)
            if k:
                scratch.drop(STAGES[k - 1][0])
    return docs
