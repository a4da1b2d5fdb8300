"""Filter interaction audit by an incidence matrix product (operator 13).

A document's outcome under any order of the filters depends only on which of
them it fails, its mask of five bits.  So the documents of a part are a
histogram of 32 masks, and one more for each label.  These are rows of an
integer matrix.  A column of an outcome matrix stands for one step of one order,
and has a 1 for each mask that has the outcome there: 32 by 600, as 120 orders
have 5 steps.  Rows times columns are all counts at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._shared import binary, materialize, sliced, workspace

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes that continue a code point in UTF-8; all others are one.
CONTINUED = bytes(range(0x80, 0xC0))
#: Any of these fails filter D.
MARKS = b"#$%&*|"
#: Parts that are multiplied at once.
PARTS = 128


def outcomes() -> dict[str, np.ndarray]:
    """The outcome matrices: masks by steps of orders, 0 or 1, and ``shapley`` with what a step's filter removes over all orders."""
    masks = np.arange(MASKS)
    out = {k: np.zeros((MASKS, len(STEPS)), np.int64) for k in ("kept", "removed", "redundant", "unique")}
    of_filter: dict[str, np.ndarray] = {f: np.zeros(MASKS, np.int64) for f in FILTERS}
    for column, (order, step) in enumerate(STEPS):
        own = 1 << FILTERS.index(order[step - 1])
        before = sum(1 << FILTERS.index(f) for f in order[: step - 1])
        fails, gone = masks & own > 0, masks & before > 0
        out["kept"][:, column] = ~fails & ~gone
        out["removed"][:, column] = fails & ~gone
        out["redundant"][:, column] = fails & gone
        out["unique"][:, column] = masks == own
        of_filter[order[step - 1]] += out["removed"][:, column]
    out["shapley"] = np.stack([of_filter[order[step - 1]] for order, step in STEPS], axis=1)
    return out


def failures(text: bytes) -> int:
    """The bits of filters A to D that a text fails; E, a copy of another document, isn't a matter of the text alone."""
    words = text.split()
    mask = int(len(words) < 50)
    mask |= 2 * (100 * len(set(words)) < 65 * len(words))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text) if text.isascii() else len(text.translate(None, CONTINUED))
    mask |= 4 * (100 * capitals > 5 * points)
    return mask | 8 * (len(text) != len(text.translate(None, MARKS)))


def masks_of(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id``, ``part``, a 128-bit hash of the text, and the mask of filters A to D, of each document."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("part", T.StringType()), T.StructField("hash", T.BinaryType()), T.StructField("mask", T.LongType())])
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole, 2)):
            texts = [t or b"" for t in binary(batch.column(2))]
            hashes = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
            columns = [batch.column(0).cast(id_type), batch.column(1), pa.array(hashes, pa.binary()), pa.array([failures(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), part.alias("part"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def marked(docs: DataFrame, labels: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part``, the whole ``mask``, ``good`` and ``toxic`` (0 or 1) of each document.

    The text is read once; what is shuffled is about 50 bytes a document.  Only
    a document with the smallest id of its text passes filter E.  It is found by
    a join on text and id, and not on the text alone, which a third of the rows
    may share.
    """
    rows = materialize(masks_of(docs, id_col, text_col, part_col), f"{path}/masks")
    own = labels.select(F.col(f"`{id_col}`").alias("own"), "quality", "toxic").where("own IS NOT NULL")
    own = own.groupBy("own").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    firsts = rows.where("id IS NOT NULL").groupBy(F.col("hash").alias("its")).agg(F.min("id").alias("first"))
    known = rows.where("id IS NOT NULL").join(own, F.col("id") == F.col("own"), "left")
    known = known.join(firsts, (F.col("id") == F.col("first")) & (F.col("hash") == F.col("its")), "left")
    copy = F.when(F.col("first").isNull(), MASKS // 2).otherwise(0)
    label = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")]
    out = known.select("part", (F.col("mask") + copy).alias("mask"), *label)
    zero = F.lit(0).cast("long")
    return out.unionByName(rows.where("id IS NULL").select("part", "mask", zero.alias("good"), zero.alias("toxic")))


def multiply(histograms: DataFrame) -> DataFrame:
    """The outcomes of every part, step by step, from ``part`` and its ``cells`` of mask and three counts."""
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names)
    matrices = outcomes()
    orders, steps = pa.array([o for o, _ in STEPS]), pa.array([s for _, s in STEPS], pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, PARTS) for whole in batches for a in range(0, whole.num_rows, PARTS)):
            rows = np.zeros((3, batch.num_rows, MASKS), np.int64)
            for i, cells in enumerate(batch.column(1).to_pylist()):
                for cell in cells:
                    rows[:, i, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
            every, good, toxic = rows
            counts = [every @ matrices[k] for k in ("kept", "removed", "redundant", "unique")]
            counts += [good @ matrices["removed"], toxic @ matrices["removed"], every @ matrices["shapley"]]
            n = batch.num_rows
            at = pa.array(np.tile(np.arange(len(STEPS)), n))
            parts = batch.column(0).take(pa.array(np.repeat(np.arange(n), len(STEPS))))
            yield pa.RecordBatch.from_arrays([parts, orders.take(at), steps.take(at), *(pa.array(c.ravel()) for c in counts)], names=["part", "filter_order", "step", *names])

    return histograms.select("part", "cells").mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """What each of five filters does at each step of each of their 120 orders, part by part.

    A: under 50 words.  B: distinct words below 65 % of them.  C: capitals above
    5 % of the code points.  D: any of ``MARKS``.  E: the text of a smaller id.
    600 rows a part; columns as in ``multiply``.

    A null text is empty and fails A, and E as a copy of other empty texts.  Null
    parts are the empty part.  A null id has no label, is no smaller than
    another, and passes E.  Repeated rows (an id with the same text) count each
    and are no copies of each other.  A label counts if any row of ``labels``
    for the id has it; labels of unknown or null ids count for nothing.  Without
    documents there are no parts.  Other columns are ignored.
    """
    path = workspace(docs.sparkSession, "audit")
    counts = marked(docs, labels, path, id_col, text_col, part_col).groupBy("part", "mask")
    counts = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    # 32 cells a part at most.
    return multiply(counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))
