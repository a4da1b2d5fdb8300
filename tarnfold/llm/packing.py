"""Conflict-constrained best-fit packing (operator 7)."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import materialize, partitions, tokens, workspace

#: Mean pieces of a packing group, and their mean tokens as a share of that many half-full bins.
GROUP_PIECES, GROUP_BINS = 4096, 512
#: Groups that a task packs, in the mean, where there are many.
GROUPS = 16
#: Fill from which a bin stays as it is; the pieces of others are dealt and packed again.
CLOSED = 0.99
#: Share of the pieces that another round must settle, or it is the last.
PROGRESS = 0.1


def best_fit(sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int) -> list[int]:
    """The bin of each piece; no bin holds a source or a cluster twice.

    Largest pieces first.  Open bins are kept in order of their residual, each
    with a bitmap of its sources and one of its clusters.  The search begins at
    the smallest residual that fits and goes on through its successors until a
    bin has neither bit set: the tightest compatible bin.  Else a bin is opened.
    A null source or cluster conflicts with nothing.

    Pieces of one size, source and cluster are placed in one search: a bin that
    was passed over for one, or took one, can't take the next, so the search
    goes on from there.  That keeps many copies of a text linear.
    """
    seen: tuple[dict, dict] = ({}, {})
    bits = [[0 if x is None else 1 << own.setdefault(x, len(own)) for x in xs] for own, xs in zip(seen, (sources, clusters), strict=True)]
    kinds = list(zip((-n for n in sizes), *bits, strict=True))
    open_bins: list[tuple[int, int]] = []
    maps: list[list[int]] = []
    out = [0] * len(sizes)
    for (_, source, cluster), run in groupby(sorted(range(len(sizes)), key=kinds.__getitem__), key=kinds.__getitem__):
        pieces = list(run)
        size = sizes[pieces[0]]
        # Without a conflict the next piece may go where the last one did, so each is searched for by itself.
        for same in [pieces] if source or cluster else [[i] for i in pieces]:
            found = []
            for at in range(bisect_left(open_bins, (size, -1)), len(open_bins)):
                own = maps[open_bins[at][1]]
                if not (own[0] & source or own[1] & cluster):
                    found.append(at)
                    if len(found) == len(same):
                        break
            taken = [open_bins[at] for at in found]
            for at in reversed(found):
                del open_bins[at]
            for _ in range(len(same) - len(taken)):
                taken.append((capacity, len(maps)))
                maps.append([0, 0])
            for (room, b), i in zip(taken, same, strict=True):
                out[i] = b
                maps[b][0] |= source
                maps[b][1] |= cluster
                if room > size:
                    insort(open_bins, (room - size, b))
    return out


def pieces_of(df: DataFrame, capacity: int, id_col: str, text_col: str, source_col: str, cluster_col: str | None) -> DataFrame:
    """The pieces to pack, with a number of their own in ``seq``."""
    text = F.col(text_col)
    plain = F.trim(F.regexp_replace(text, r"\s+", " "))
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.hex(F.xxhash64(F.lower(plain)))
    cluster = F.when(F.length(plain) > 0, cluster).alias("cluster")
    docs = df.select(F.col(id_col), F.col(source_col).cast("string").alias("source"), cluster, (tokens(text) + 1).alias("size"))
    room = F.lit(capacity).cast("long")
    starts = docs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, room)).alias("piece_start"))
    return starts.select(
        id_col,
        "source",
        "cluster",
        (F.col("piece_start") / capacity).cast("int").alias("piece"),
        "piece_start",
        F.least(F.col("size") - F.col("piece_start"), room).alias("n_tokens"),
        F.monotonically_increasing_id().alias("seq"),
    )


def pack(
    df: DataFrame,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Sequences of at most ``capacity`` tokens that hold every document whole.

    A document has its words and an end as tokens; one longer than ``capacity``
    is cut into pieces.  One row a piece: ``id_col``, ``source``, ``cluster``,
    ``piece``, ``piece_start``, ``n_tokens``, ``bin_id``, ``bin_offset``.  No bin
    has two pieces of one source or of one duplicate cluster.  The cluster is
    ``cluster_col``, or else the text lower-cased with single spaces and none
    about it, by hash, so that near copies are of different clusters.  A null
    source conflicts with nothing; null texts, empty ones and those of white
    space alone have their end as their only token and are of no cluster.
    Repeated rows are packed each; of pieces of one size the order is that of
    source and cluster.  Extra columns are ignored.

    Pieces are dealt by hash into groups of about ``group_pieces``, as many as
    the input needs; a hot source, cluster or repeated row is spread over all of
    them.  A group is packed in one task.  Bins filled to ``CLOSED`` stay; the
    pieces of all others are dealt and packed again, in ever fewer groups, until
    one group is left or a round settles next to nothing.  So what a group
    leaves unfilled is filled from the others.
    """
    spark = df.sparkSession
    path = workspace(spark, "pack")
    left = materialize(pieces_of(df, capacity, id_col, text_col, source_col, cluster_col), f"{path}/pieces")
    columns = [c for c in left.columns if c != "seq"]
    longs = [T.StructField(c, T.LongType()) for c in ("bin_id", "bin_offset", "fill")]
    schema = T.StructType([*left.schema.fields, *longs])
    done = None

    def run(key: tuple, table: pa.Table) -> pa.Table:
        first = key[0].as_py() << 24
        table = table.drop_columns(["pack_group"]).sort_by([(id_col, "ascending"), ("piece", "ascending"), ("cluster", "ascending"), ("seq", "ascending")])
        sizes = table["n_tokens"].to_pylist()
        bins = best_fit(sizes, table["source"].to_pylist(), table["cluster"].to_pylist(), capacity)
        filled: dict[int, int] = {}
        offsets = []
        for b, size in zip(bins, sizes, strict=True):
            offsets.append(filled.get(b, 0))
            filled[b] = offsets[-1] + size
        for name, values in (("bin_id", [first + b for b in bins]), ("bin_offset", offsets), ("fill", [filled[b] for b in bins])):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    total, n = left.agg(F.sum("n_tokens"), F.count(F.lit(1))).first()
    for step in range(64):
        groups = max(1, math.ceil(n / group_pieces), math.ceil((total or 0) / (capacity * group_pieces * GROUP_BINS / GROUP_PIECES)))
        # A task packs a few groups; left to be put together by bytes, all groups would be one task's.
        dealt = left.withColumn("pack_group", F.pmod(F.xxhash64("seq", F.lit(step)), F.lit(groups)))
        dealt = dealt.repartition(max(min(groups, partitions(spark)), math.ceil(groups / GROUPS)), "pack_group")
        packed = dealt.groupBy("pack_group").applyInArrow(run, schema).withColumn("bin_id", F.col("bin_id") + F.lit(step << 56))
        packed = materialize(packed, f"{path}/packed-{step}")
        loose = packed.where(F.col("fill") < CLOSED * capacity)
        total, n_loose = loose.agg(F.sum("n_tokens"), F.count(F.lit(1))).first()
        last = groups == 1 or n_loose == 0 or n_loose > (1 - PROGRESS) * n
        kept = (packed if last else packed.where(F.col("fill") >= CLOSED * capacity)).select(*columns, "bin_id", "bin_offset")
        done = kept if done is None else done.unionByName(kept)
        if last:
            break
        left, n = loose.select(*columns, "seq"), n_loose
    return done
