"""Sharding by global prefix sums of bytes, in DataFrame operations only.

Documents are range-partitioned on one total order.  Each partition's byte and row totals are a
table with one row per partition; its running sums are every partition's starting offset.  The
offset of a document inside its partition completes the global prefix sum, and equal targets of
that sum cut the order into contiguous shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, fresh


#: Text bytes that a file of a written shard holds, about.
FILE_BYTES = 256 << 20


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    size is the text's UTF-8 bytes (null: 0) plus 1.  The order is the first 60 bits of the text's MD5,
    then the id, so equal texts are neighbours and share a shard unless a cut falls among them.  A shard's size
    differs from total / shards by less than two documents.  Slots are gapless from 0 in each shard.
    The law is "bytes", so grown_shard is null.  Null ids come first among equal texts; repeated
    rows get a slot each; an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = ["__h", id_col, "__crc"]
    keyed = docs.select(
        F.col(id_col),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("__crc"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long").alias("__h"),
    )
    # The ranges come from a sample, so they are written once: both passes must see the same.
    ranged = keyed.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    scratch = Scratch(docs.sparkSession, "shards")
    ranged = scratch.write(ranged, "ranges")
    totals = ranged.groupBy("__part").agg(F.sum("size").alias("__bytes"), F.count("*").alias("__rows"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy("__part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # One row per partition of the exchange above: the partition count bounds this broadcast.
    offsets = totals.select(
        "__part",
        F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__b0"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__r0"),
        F.sum("__bytes").over(whole).alias("__total"),
    )
    inside = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.select(
        "*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("__b"), (F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1).alias("__r")
    ).join(F.broadcast(offsets), "__part")
    placed = placed.select(
        id_col,
        "size",
        F.col("__crc").alias("text_crc32"),
        # The middle of the document decides, so both neighbours of a cut bear half of it at most.
        F.least(F.floor((F.col("__b0") + F.col("__b") + F.col("size") / 2) * shards / F.col("__total")), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("__r0") + F.col("__r")).alias("__row"),
    )
    placed = scratch.result(placed, "places")
    scratch.drop("ranges")
    first = placed.groupBy("shard").agg(F.min("__row").alias("__first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        id_col,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("__row") - F.col("__first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents as ``path/shard=K`` Parquet folders, in slot order within each file.

    A shard is cut into ranges of slots of about ``FILE_BYTES``, a task and a file each, so no task holds a
    whole shard.  A column of ``docs`` named shard is replaced by the folder's.  Null texts stay null and
    repeated rows stay; an empty table writes no folder.
    """
    kept = [c for c in docs.columns if c.lower() != "shard"]
    size, crc, copy, slot, part = fresh([*docs.columns, "shard"], "__size", "__crc", "__copy", "__slot", "__part")
    other = fresh([*docs.columns, "shard", size, crc, copy, slot, part], "__id", "__n", "__c", "__other")
    placed = shard_by_bytes(docs, shards, id_col, text_col)
    placed = placed.select(F.col(id_col).alias(other[0]), "shard", F.col("slot").alias(slot), F.col("size").alias(other[1]), F.col("text_crc32").alias(other[2]))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.select(*kept, (F.octet_length(text) + 1).cast("long").alias(size), F.crc32(text.cast("binary")).alias(crc))
    # Rows that agree on id, size and checksum are copies; a copy number pairs them one to one.
    number = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy(F.lit(1)))
    left = marked.withColumn(copy, number(id_col, size, crc))
    right = placed.withColumn(other[3], number(*other[:3]))
    same = F.col(id_col).eqNullSafe(F.col(other[0])) & (F.col(size) == F.col(other[1])) & (F.col(crc) == F.col(other[2])) & (F.col(copy) == F.col(other[3]))
    out = left.join(right, same).select(*kept, "shard", slot, size)
    total, most = out.agg(F.sum(size), F.max(slot)).first()
    files = max(1, -(-int(total or 0) // (shards * FILE_BYTES)))
    out = out.withColumn(part, F.floor(F.col(slot) * files / F.lit((most or 0) + 1)))
    out = out.repartition(shards * files, "shard", part).sortWithinPartitions("shard", slot)
    out.drop(slot, size, part).write.partitionBy("shard").parquet(path)
