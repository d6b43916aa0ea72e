"""A growing scene store as a stream: each (scene, row, col) once, masked on arrival.

The reference data model has no streams; this is an addition for stores that receive scenes daily.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.pixels import with_ndvi


def scene_stream(spark: SparkSession, path: str, schema: str, late: str = "30 days") -> DataFrame:
    """New observations (scene_time, row, col, red_dn, nir_dn, scl) with their index, duplicates dropped."""
    rows = spark.readStream.schema(schema).parquet(path).withWatermark("scene_time", late)
    return with_ndvi(rows.dropDuplicatesWithinWatermark(["scene_time", "row", "col"]))


def daily_quality(stream: DataFrame, width: str = "1 day") -> DataFrame:
    """Per day: cells seen, cells with a valid index, and the mean index."""
    return stream.groupBy(F.window("scene_time", width)).agg(F.count("*").alias("cells"), F.count("ndvi").alias("valid"), F.avg("ndvi").alias("ndvi_mean"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table, exactly once, until all files now present are read."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
