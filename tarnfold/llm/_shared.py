"""What several operators need: shared storage, text splitting, components."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder as workspace  # noqa: F401

#: Words of a text, as a Java and DuckDB pattern; ``bytes.split()`` splits alike.
WORD = r"[^\x20\x09-\x0D]+"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a table to shared storage and read it back, which cuts lineage."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share(spark: SparkSession, value: object) -> Callable[[], object]:
    """A broadcast of a value of bounded size, and how tasks get it.

    It is pickled as functions are, so that workers need no copy of its class.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def binary(column: pa.Array) -> list[bytes | None]:
    """A string or binary column's values as bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def sliced(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of a column; a longer value is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
    starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def tokens(text: Column) -> Column:
    """The number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def orderable(kind: T.DataType) -> bool:
    """Whether values of a type can be compared, and so chosen from by order."""
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, T.MapType | T.VariantType | T.CalendarIntervalType)


def first_document(id_col: Column | str, text_hash: Column | str) -> Column:
    """Orders documents by id, null ids last, and by their text's hash where ids repeat."""
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(text_hash).alias("th"))


def only_documents(df: DataFrame, kept: DataFrame, docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """The rows of ``df`` whose id and text's hash are in ``kept`` (``id``, ``th``), one of each.

    A document is an id and a text: a repeated id with another text is another
    document, and a null id is an id like any other.  Of rows that repeat both,
    the least by all columns that have an order stays.  ``docs`` has the ``id``
    and ``th`` of every row: only rows that do repeat are aggregated.
    """
    times = docs.groupBy(F.col("id").alias("i"), F.col("th").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    times = kept.join(
        times,
        F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")),
    ).select("id", "th", (F.col("n") > 1).alias("many"))
    times = materialize(times, f"{path}/kept")
    names = [F.col(f"`{c}`") for c in df.columns]
    order = F.struct(
        F.lit(0).alias("first"),
        *[F.col(f"`{f.name}`") for f in df.schema.fields if f.name != text_col and orderable(f.dataType)],
    )
    keyed = df.select(
        F.struct(*names).alias("row"),
        order.alias("by"),
        F.col(f"`{id_col}`").alias("own_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("own_th"),
    )
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_th") == F.col("th"))
    out = keyed.join(times.where("NOT many"), same, "left_semi").select("row.*")
    many = times.where("many")
    if not many.isEmpty():
        found = keyed.join(many, same, "left_semi").groupBy("own_id", "own_th").agg(F.min_by("row", "by").alias("row"))
        out = out.unionByName(found.select("row.*"))
    return out


def connected_components(edges: DataFrame, path: str) -> DataFrame:
    """Smallest node of each node's component, by rounds of graph contraction.

    ``edges`` has two columns of one comparable type.  Returns ``node`` and
    ``label`` for every node that an edge between two different nodes touches;
    null ends and loops are ignored, repeated edges count once.  Each round
    hooks every node to its smallest neighbour, shortens these pointers once,
    and replaces edges by edges between what their ends point at, so that the
    graph shrinks geometrically.  All of it is aggregations and joins; a node
    with very many edges is summed before the shuffle or split by the adaptive
    skew join.  Every round writes its tables to ``path``.
    """
    a, b = edges.columns
    edges = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct()
    edges = materialize(edges, f"{path}/edges-0")
    labels = None
    step = 0
    while step == 0 or not edges.isEmpty():
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        hook = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("to"))
        hook = materialize(hook, f"{path}/hook-{step}")
        ahead = hook.select(F.col("node").alias("to"), F.col("to").alias("next"))
        short = materialize(hook.join(ahead, "to").select("node", F.col("next").alias("to")), f"{path}/short-{step}")
        if labels is None:
            labels = short.select("node", F.col("to").alias("label"))
        else:
            moved = short.select(F.col("node").alias("label"), "to")
            labels = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            labels = materialize(labels, f"{path}/labels-{step}")
        left = short.select(F.col("node").alias("u"), F.col("to").alias("p"))
        right = short.select(F.col("node").alias("v"), F.col("to").alias("q"))
        moved = edges.join(left, "u").join(right, "v").select("p", "q")
        chain = short.select(F.col("to").alias("u")).distinct().join(left, "u").select(F.col("u").alias("p"), F.col("p").alias("q"))
        step += 1
        edges = moved.union(chain).select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).where("u < v").distinct()
        edges = materialize(edges, f"{path}/edges-{step}")
    return labels
