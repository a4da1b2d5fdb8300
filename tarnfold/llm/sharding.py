"""Sharding by vector bin packing (operator 1)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import materialize, partitions, tokens, workspace

#: Share of any total above which a group is placed before all others, in one place; at most three times its inverse are.
LARGE = 1 / 4096
#: Mean groups of a bucket; a bucket's groups are placed in one task.
BUCKET = 4096
#: Weight of bytes, tokens and rows in the dot product.  Bytes are the law.
WEIGHTS = (1.0, 0.02, 0.002)
#: Pieces of a shard's fair share into which a group larger than a shard is salted.
PIECES = 64
#: Mean rows that are numbered together.
NUMBERED = 100_000


def place(items: np.ndarray, residual: np.ndarray, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """The shard of each item, a row of shares of the total in each dimension; ``residual`` is what shards can hold.

    Largest items first; each goes where the weighted dot product of its vector
    and the shard's residual capacity is highest, the first such shard on ties.
    ``residual`` is left as the items leave it.
    """
    w = np.asarray(weights)
    out = np.zeros(len(items), np.int64)
    for i in np.argsort(-(items * w).sum(1), kind="stable"):
        out[i] = np.argmax(residual @ (items[i] * w))
        residual[out[i]] -= items[i]
    return out


def place_bucket(items: np.ndarray, free: np.ndarray, turn: int) -> np.ndarray:
    """The shard of each item of one bucket.

    A shard's capacity for the bucket is the part of the bucket's total that it
    has of all that is ``free``.  The shards are taken in turn from ``turn`` on,
    so that what buckets leave uneven doesn't meet in one shard.
    """
    share = free / np.maximum(free.sum(0), 1e-300)
    n = len(free)
    return (place(items, np.roll(items.sum(0) * share, -(turn % n), axis=0)) + turn) % n


def _placed_singly(
    rows: DataFrame,
    big: DataFrame,
    share: list[Column],
    n_shards: int,
) -> tuple[list[tuple[bytearray, list[int]]], np.ndarray]:
    """Shards of the large groups, by piece if one is larger than a shard, and what is left free in each shard."""
    hot = F.greatest(*share) > 1.0 / n_shards
    salts = F.when(hot, F.ceil(F.greatest(*share) * n_shards * PIECES)).otherwise(1).cast("int")
    groups = {
        bytes(r["key"]): r
        for r in big.select("key", salts.alias("salts"), *[s.alias(c) for s, c in zip(share, "btr", strict=True)]).collect()
    }
    salted = rows.join(F.broadcast(big.where(hot).select("key", salts.alias("salts"))), "key")
    salted = salted.groupBy("key", F.pmod(F.xxhash64("seq"), "salts").cast("int").alias("salt"))
    salted = salted.agg(F.sum("size").alias("b"), F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("r"))
    found = [((k, 0), [r[c] for c in "btr"]) for k, r in groups.items() if r["salts"] == 1]
    found += [
        ((bytes(r["key"]), r["salt"]), [r[c] for c in "btr"])
        for r in salted.select("key", "salt", *[s.alias(c) for s, c in zip(share, "btr", strict=True)]).collect()
    ]
    found.sort(key=lambda x: x[0])
    free = np.full((n_shards, 3), 1.0 / n_shards)
    shards = place(np.array([v for _, v in found], float).reshape(-1, 3), free).tolist()
    of: dict[bytes, list[int]] = {k: [0] * r["salts"] for k, r in groups.items()}
    for ((k, salt), _), s in zip(found, shards, strict=True):
        of[k][salt] = s
    return [(bytearray(k), at) for k, at in of.items()], np.maximum(free, 0.0)


def shard(
    df: DataFrame,
    n_shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    large: float = LARGE,
    bucket: int = BUCKET,
) -> DataFrame:
    """A shard and a slot for every row, sizes in bytes near equal.

    Columns: ``id_col``, ``size`` (UTF-8 bytes plus 8), ``text_crc32``, ``shard``,
    ``slot`` (gapless from 0 in each shard), ``n_tokens``.  Rows of equal texts
    are a group and share a shard, unless the group is larger than a shard in
    bytes, tokens or rows: it is then salted by row into pieces.  A null text is
    an empty one.  Repeated rows and null ids are placed as any other row.
    Extra columns are ignored.

    Every group is placed by its own vector.  Groups of more than ``large`` of
    all bytes, tokens or rows, ``3 / large`` at most, come first, in one place.
    The others are dealt by hash into buckets of about ``bucket`` groups, as many
    as the input needs, and each bucket is packed in a task into what the large
    ones left free.  Slots come from counts by shard and row, summed up, and a
    numbering within these.
    """
    spark = df.sparkSession
    path = workspace(spark, "shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        tokens(text).alias("n_tokens"),
        F.unhex(F.substring(F.sha2(text, 256), 1, 40)).alias("key"),
        F.monotonically_increasing_id().alias("seq"),
    )
    rows = materialize(rows, f"{path}/rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("b"), F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("r"))
    groups = materialize(groups, f"{path}/groups")
    *sums, n_groups = groups.agg(F.sum("b"), F.sum("t"), F.sum("r"), F.count(F.lit(1))).first()
    total = [float(x or 0) or 1.0 for x in sums]
    share = [F.col(c) / F.lit(x) for c, x in zip("btr", total, strict=True)]
    is_large = F.greatest(*share) > large
    keyed, free = _placed_singly(rows, groups.where(is_large), share, n_shards)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        items = np.stack([table[c].to_numpy() for c in "btr"], axis=1) / total
        return pa.table({"key": table["key"], "own_shard": pa.array(place_bucket(items, free, key[0].as_py()), pa.int32())})

    buckets = max(1, math.ceil(n_groups / bucket))
    dealt = groups.where(~is_large).select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "key", "b", "t", "r")
    small = materialize(dealt.groupBy("bucket").applyInArrow(pack, "key binary, own_shard int"), f"{path}/small")
    keys = spark.createDataFrame(keyed, "key binary, shards array<int>")
    piece = F.element_at("shards", (F.pmod(F.xxhash64("seq"), F.size("shards")) + 1).cast("int"))
    per = max(64, partitions(spark), math.ceil(float(sums[2] or 0) / n_shards / NUMBERED))
    sub = F.pmod(F.xxhash64("seq", F.lit("sub")), F.lit(per)).cast("int").alias("sub")
    columns = [id_col, "size", "text_crc32", "n_tokens", "shard", "seq", sub]
    first = rows.join(F.broadcast(keys), "key").withColumn("shard", piece).select(*columns)
    rest = rows.join(small, "key").withColumn("shard", F.col("own_shard")).select(*columns)
    put = materialize(first.unionByName(rest), f"{path}/placed")
    counts = put.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "sub", (F.sum("n").over(Window.partitionBy("shard").orderBy("sub")) - F.col("n")).alias("base"))
    ranked = put.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "sub").orderBy(id_col, "text_crc32", "seq")) - 1)
    return ranked.join(before, ["shard", "sub"]).select(
        id_col,
        "size",
        "text_crc32",
        "shard",
        (F.col("base") + F.col("rank")).cast("long").alias("slot"),
        "n_tokens",
    )
