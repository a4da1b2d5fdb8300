"""The store: numbered versions of a table, each archived under its minute; the highest is the latest.

A version is one folder, ``archive/<version>/<name>_<minute>``, with a table and
its manifest.  It is written elsewhere, whole, and becomes a version by one
rename, which fails if another writer has taken the number.  So that rename is
the commit: before it nobody sees anything of the result, after it all is there,
and nothing that is there ever moves or changes.  Readers choose a version and
read its folder; a writer beside them, or one killed at any step, can't disturb
them.  It needs a file system whose rename of a folder is atomic, as HDFS's and
a local one's are; on an object store a table format has to do this.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.snapshots import snapshot_key, snapshot_ts
from .sketches import FOLDER, read_sketches, together, write_sketches

VERSION = re.compile(r"\d{12}")
MANIFEST = "_manifest.json"


class Conflict(Exception):
    """Another writer has published since the version that a result was made from."""


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a result is there to be published."""
    target, files = _files(spark, path)
    return files.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder, in order; nothing if there is no such folder."""
    target, files = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def rename_locally(spark: SparkSession, here, there) -> None:
    """Rename a local folder by the operating system, as Hadoop's way would look first and move then."""
    jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
    own = [jvm.java.nio.file.Path.of(p.toUri().getPath(), new_array(jvm.java.lang.String, 0)) for p in (here, there)]
    how = new_array(jvm.java.nio.file.CopyOption, 1)
    how[0] = jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
    jvm.java.nio.file.Files.move(*own, how)


def rename_on_cluster(spark: SparkSession, here, there) -> None:
    """Rename a folder by its file system, which refuses if there is a target."""
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(here.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(here, there, how)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder in one step, unless there is something at ``target``."""
    here, files = _files(spark, source)
    there, _ = _files(spark, target)
    files.mkdirs(there.getParent())
    try:
        at, parent = files.resolvePath(here), files.resolvePath(there.getParent())
        if at.toUri().getScheme() == "file":
            rename_locally(spark, at, spark._jvm.org.apache.hadoop.fs.Path(parent, there.getName()))
        else:
            rename_on_cluster(spark, here, there)
    except Py4JJavaError:
        if files.exists(there):
            return False
        raise
    return True


def version_path(root: str, version: int) -> str:
    return f"{root}/archive/{version:012d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all versions, rising; a gap is a version that was never given."""
    return [int(n) for n in names(spark, f"{root}/archive") if VERSION.fullmatch(n)]


def snapshots(spark: SparkSession, root: str) -> dict[str, int]:
    """The version of each archived ``<name>_<minute>``."""
    _, files = _files(spark, root)
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/archive/*/*_*")) or []
    return {s.getPath().getName(): int(s.getPath().getParent().getName()) for s in found if VERSION.fullmatch(s.getPath().getParent().getName()) and s.isDirectory()}


def manifest(spark: SparkSession, root: str, version: int) -> dict:
    """What a version says of itself: its name, minute, schema and the version that its writer saw."""
    target, files = _files(spark, f"{version_path(root, version)}/{MANIFEST}")
    stream = files.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def stage(df: DataFrame, root: str, ts: datetime, name: str) -> str:
    """Write a result where no reader looks; returns its folder."""
    folder = f"{root}/_staged/{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{name}_{snapshot_key(ts)}")
    return folder


def describe(spark: SparkSession, folder: str, content: dict) -> None:
    """Write a staged result's manifest, again if there is one."""
    target, files = _files(spark, f"{folder}/{MANIFEST}")
    stream = files.create(target, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()


def commit(spark: SparkSession, folder: str, root: str, content: dict, expected: int | None) -> int:
    """Make a staged result the next version; returns its number.

    The commit is optimistic: what could forbid it is looked up, and if another
    writer takes the number meanwhile it is looked up again.  So among all
    versions no minute is there twice, and none follows another than the one it
    ``expected``.
    """
    while True:
        kept = snapshots(spark, root)
        last = max(versions(spark, root), default=0)
        if f"{content['name']}_{content['minute']}" in kept:
            raise FileExistsError(f"[PATH_ALREADY_EXISTS] {content['name']}_{content['minute']} is version {kept[content['name'] + '_' + content['minute']]}")
        if expected is not None and last != expected:
            raise Conflict(f"made from version {expected}, but there is {last}")
        describe(spark, folder, content | {"after": last})
        if move(spark, folder, version_path(root, last + 1)):
            return last + 1


def publish(
    df: DataFrame,
    root: str,
    ts: datetime,
    name: str = "comparison",
    expected: int | None = None,
    sketches: bool | Sequence[str] = False,
) -> str:
    """Archive a result under its minute as the next version, which makes it the latest; returns its path.

    A second result of a name in one minute is refused with a
    ``FileExistsError``, so that history isn't overwritten.  With ``expected``,
    the version that the result was made from (0 for none), a ``Conflict`` is
    raised if another was published since; of several such writers one wins.  A
    refused or failed result leaves at most a staged folder, which ``vacuum``
    removes.  A result read from the latest version itself works.  With
    ``sketches`` the version has those of all columns, or of the named ones.
    """
    spark = df.sparkSession
    folder = stage(df, root, ts, name)
    if sketches is not False:
        # Of what was written, which is read once more and not computed again.
        written = spark.read.schema(df.schema).parquet(f"{folder}/{name}_{snapshot_key(ts)}")
        write_sketches(written, folder, None if sketches is True else sketches)
    content = {"name": name, "minute": snapshot_key(ts), "schema": df.schema.jsonValue()}
    version = commit(spark, folder, root, content, expected)
    return f"{version_path(root, version)}/{name}_{snapshot_key(ts)}"


def publish_result(spark: SparkSession, result: str, root: str, ts: datetime, name: str = "comparison") -> str:
    """``publish`` a result table by its path; without it nothing is written."""
    if not exists(spark, result):
        raise FileNotFoundError(result)
    return publish(spark.read.parquet(result), root, ts, name)


def vacuum(spark: SparkSession, root: str, hours: float = 24) -> int:
    """Delete staged results that no writer has touched for some hours; returns how many."""
    target, files = _files(spark, f"{root}/_staged")
    old = [s.getPath() for s in files.listStatus(target) if s.getModificationTime() <= (time.time() - hours * 3600) * 1000] if files.exists(target) else []
    for path in old:
        files.delete(path, True)
    return len(old)


def archive_path(spark: SparkSession, root: str, ts: datetime, name: str = "comparison") -> str | None:
    """Where a minute's table is, if it is archived."""
    key = f"{name}_{snapshot_key(ts)}"
    version = snapshots(spark, root).get(key)
    return f"{version_path(root, version)}/{key}" if version else None


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """A version as it was published; another schema later doesn't matter."""
    content = manifest(spark, root, version)
    table = spark.read.schema(T.StructType.fromJson(content["schema"]))
    return table.parquet(f"{version_path(root, version)}/{content['name']}_{content['minute']}")


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The latest version at the time of the call."""
    last = versions(spark, root)
    if not last:
        raise FileNotFoundError(f"nothing is published in {root}")
    return read_version(spark, root, last[-1])


def read_history(spark: SparkSession, root: str, until: int | None = None) -> DataFrame:
    """All archived tables with the time of each in ``snapshot_ts``; columns are merged by name.

    With ``until``, what was there when that version was the latest.
    """
    read = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    folders = [f"{root}/archive"] if until is None else [version_path(root, v) for v in versions(spark, root) if v <= until]
    return read.parquet(*folders).withColumn("snapshot_ts", snapshot_ts(F.col("_metadata.file_path")))


def summary(spark: SparkSession, root: str, first: int = 1, until: int | None = None, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Rows, nulls, distinct values and quantiles by column over versions ``first`` to ``until``, from their sketches alone.

    Versions that were published without sketches are a ``ValueError``, as the
    answer would be short of them.
    """
    chosen = [v for v in versions(spark, root) if first <= v and (until is None or v <= until)]
    without = [v for v in chosen if not exists(spark, f"{version_path(root, v)}/{FOLDER}")]
    if without:
        raise ValueError(f"no sketches in versions {without}")
    return together(read_sketches(spark, [version_path(root, v) for v in chosen]), quantiles)
