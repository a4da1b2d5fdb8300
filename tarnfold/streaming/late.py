"""Event time with a bound on lateness: what comes too late is kept and told, and the rest is counted once.

A stream's rows pass a gate first.  It holds each batch against the latest time
of the batches before: rows within the bound go on, those beyond it go to a table
of late rows, with the watermark that they missed.  What went on is a stream
itself, of which Spark's own watermark, that can't be ahead of the gate's, drops
nothing; repeats are dropped and sessions closed by it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.compare import named
from ..sources.store import names

MARK = "latest timestamp"


def batch_path(folder: str, kind: str, batch: int) -> str:
    return f"{folder}/{kind}/batch={batch:012d}"


def latest_before(spark: SparkSession, folder: str, batch: int) -> datetime | None:
    """The latest event time of the batches before one."""
    done = [n for n in names(spark, f"{folder}/marks") if n.startswith("batch=") and int(n[6:]) < batch]
    if not done:
        return None
    return spark.read.schema(MARK).parquet(f"{folder}/marks/{done[-1]}").first()[0]


def gate(folder: str, time: str, bound: timedelta) -> Callable[[DataFrame, int], None]:
    """What a stream does with each batch: ``on_time``, ``late`` and ``marks`` are tables of batches in the folder.

    A batch that comes again, as after a failure, replaces what it wrote.  A row
    is late if its time is not after the latest time of the batches before, less
    ``bound``.  Rows of null time have no order: they are late.
    """

    def split(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest = latest_before(spark, folder, number)
        at = named(time).cast("timestamp")
        mark = F.lit(None).cast("timestamp") if latest is None else F.lit(latest) - F.lit(bound)
        late = at.isNull() if latest is None else at.isNull() | (at <= mark)
        # The gate's input is read once, whatever it comes from.
        batch = batch.persist()
        try:
            batch.where(~late).write.mode("overwrite").parquet(batch_path(folder, "on_time", number))
            batch.where(late).withColumn("watermark", mark).write.mode("overwrite").parquet(batch_path(folder, "late", number))
            own = batch.agg(F.max(at).alias("m")).select(F.greatest("m", F.lit(latest).cast("timestamp")).alias("latest"))
            own.coalesce(1).write.mode("overwrite").parquet(batch_path(folder, "marks", number))
        finally:
            batch.unpersist()

    return split


def gated(stream: DataFrame, folder: str, time: str, bound: timedelta) -> DataStreamWriter:
    """A writer of a stream through the gate, to be started with any trigger; it goes on where it stopped."""
    return stream.writeStream.foreachBatch(gate(folder, time, bound)).option("checkpointLocation", f"{folder}/gate")


def late_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All rows that came too late, with the ``watermark`` that they missed and their ``batch``."""
    schema = T.StructType([*schema.fields, T.StructField("watermark", T.TimestampType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", f"{folder}/late").parquet(f"{folder}/late")


def on_time(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows that passed the gate, as a stream."""
    return spark.readStream.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).option("basePath", f"{folder}/on_time").parquet(f"{folder}/on_time").drop("batch")


def sessions(stream: DataFrame, on: Sequence[str], time: str, gap: timedelta, bound: timedelta, row_id: Sequence[str]) -> DataFrame:
    """Closed sessions of each key: ``start``, ``end``, which is ``gap`` after the last row, and ``n`` rows.

    Rows that repeat ``row_id`` within ``bound`` count once.  A session is given
    when no row can join it any more, and its state goes.  Null keys are a key.
    """
    micros = lambda span: f"{span // timedelta(microseconds=1)} microseconds"
    rows = stream.withColumn("_at", named(time).cast("timestamp")).withWatermark("_at", micros(bound)).dropDuplicatesWithinWatermark(list(row_id))
    out = rows.groupBy(*[named(c) for c in on], F.session_window("_at", micros(gap)).alias("_session")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*[named(c) for c in on], F.col("_session.start").alias("start"), F.col("_session.end").alias("end"), "n")
