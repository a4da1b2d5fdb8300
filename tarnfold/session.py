"""Sessions and shared storage."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(name: str = "tarnfold", cores: str = "*", shuffle_partitions: int = 4) -> SparkSession:
    """A local session in UTC without a web page; a cluster brings its own."""
    return (
        SparkSession.builder.appName(name)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def own_folder() -> str:
    """A temporary folder of this process, for local sessions that name none."""
    return "file://" + tempfile.mkdtemp(prefix="tarnfold-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder on storage that the driver and all executors share.

    It lies in ``spark.checkpoint.dir``.  Where that is unset, a local session
    gets a temporary folder of this machine; a cluster is refused, as its
    executors couldn't see one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
