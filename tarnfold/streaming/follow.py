"""Snapshots as a stream, as they are published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.snapshots import snapshot_ts


def follow(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A streaming table of all archived rows with their ``snapshot_ts``; new snapshots come as they appear."""
    read = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    return read.parquet(f"{root}/archive").withColumn("snapshot_ts", snapshot_ts(F.col("_metadata.file_path")))
