"""Embedding near-dedup by a random-projection tree forest (operator 9)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._shared import connected_components, materialize, share, workspace

TREES, LEAF, SPILL = 16, 256, 0.1
#: Vectors that the split points of the trees are taken from, in expectation, and their bytes at most.
SAMPLE, SAMPLE_BYTES = 1 << 16, 64 << 20
#: Vectors of a block; a leaf of more than two blocks' size is compared block by block.
BLOCK = 1024


def unit(batch_column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors, and these as unit vectors in double precision."""
    at, out = [], []
    for i, v in enumerate(batch_column.to_pylist()):
        if v and None not in v:
            x = np.array(v, np.float64)
            peak = np.abs(x).max()
            if np.isfinite(peak) and peak > 0:
                x = x / peak
                at.append(i)
                out.append(x / np.sqrt(x @ x))
    return np.array(at, np.int64), out


@dataclass
class Tree:
    """One tree for vectors of one length, as a heap of split points.

    The direction of a node follows from the seed and its place, so that only
    the split interval of each node is kept.
    """

    seed: int
    depth: int
    low: np.ndarray
    high: np.ndarray

    def direction(self, node: int, dim: int) -> np.ndarray:
        d = np.random.default_rng([self.seed, node]).standard_normal(dim)
        return d / np.linalg.norm(d)

    @classmethod
    def grow(cls, x: np.ndarray, depth: int, seed: int, spill: float) -> Tree:
        """Split at the median; ``spill`` of the rows about it go both ways."""
        self = cls(seed, depth, np.zeros(1 << depth), np.zeros(1 << depth))
        rows = {1: np.arange(len(x))}
        for node in range(1, 1 << depth):
            own = rows.pop(node)
            if len(own):
                p = x[own] @ self.direction(node, x.shape[1])
                self.low[node], self.high[node] = np.quantile(p, [0.5 - spill / 2, 0.5 + spill / 2])
                rows[2 * node], rows[2 * node + 1] = own[p <= self.high[node]], own[p >= self.low[node]]
            else:
                rows[2 * node] = rows[2 * node + 1] = own
        return self

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their leaves; a row in a spill interval goes to both sides."""
        rows, nodes = np.arange(len(x)), np.ones(len(x), np.int64)
        for _ in range(self.depth):
            order = np.argsort(nodes, kind="stable")
            rows, nodes = rows[order], nodes[order]
            p = np.empty(len(rows))
            cuts = np.flatnonzero(np.diff(nodes, prepend=0)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(nodes)], strict=True):
                p[a:b] = x[rows[a:b]] @ self.direction(int(nodes[a]), x.shape[1])
            left, right = p <= self.high[nodes], p >= self.low[nodes]
            rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
        return rows, nodes


def opened(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their unit vectors."""
    return table["node"].to_numpy(), np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(table.num_rows, -1)


def close_pairs(
    a: np.ndarray,
    x: np.ndarray,
    b: np.ndarray | None = None,
    y: np.ndarray | None = None,
    threshold: float = 0.9,
) -> tuple[np.ndarray, np.ndarray]:
    """Node pairs of cosine ``threshold`` or more, among nodes ``a`` or between ``a`` and ``b``."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i in range(0, len(a), BLOCK):
        r, c = np.nonzero(x[i : i + BLOCK] @ (x if y is None else y).T >= threshold)
        r = r + i
        if b is None:
            r, c = r[r < c], c[r < c]
        found.append((a[r], (a if b is None else b)[c]))
    left, right = (np.concatenate(f) for f in zip(*found, strict=True))
    return np.minimum(left, right), np.maximum(left, right)


def between_blocks(one: pa.Table, two: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Fewest pairs that connect what links between two blocks do, given that each block's own links are known elsewhere.

    Nodes that a block's own links connect stand for each other, by the smallest
    of them, so that the pairs don't grow with the blocks' nodes.
    """
    (a, x), (b, y) = opened(one), opened(two)
    u, v = close_pairs(a, x, b, y, threshold)
    if len(u):
        for nodes, units in ((a, x), (b, y)):
            root, own = spanning(*close_pairs(nodes, units, threshold=threshold))
            if len(own):
                u, v = (
                    np.where(
                        own[np.minimum(np.searchsorted(own, w), len(own) - 1)] == w,
                        root[np.minimum(np.searchsorted(own, w), len(own) - 1)],
                        w,
                    )
                    for w in (u, v)
                )
        u, v = spanning(np.minimum(u, v), np.maximum(u, v))
    return u, v


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest pairs that connect what the pairs ``a``, ``b`` do: each node with the smallest that it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while (label[u] != label[v]).any():
        low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    own = label != np.arange(len(nodes))
    return nodes[label[own]], nodes[own]


def link_counts(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and how many rows each links to, within one block or, if ``i`` and ``j`` differ, across two.

    Only nodes of one label are held against each other; ``n`` rows are of a node.
    """
    own, i, j = table["own"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
    node, label, n = (table[c].to_numpy() for c in ("node", "label", "n"))
    x = np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(len(node), -1)
    rows, cols = np.flatnonzero(own == i), np.flatnonzero(own == j)
    y, other, weight = x[cols], label[cols], n[cols].astype(np.float64)
    counts = np.zeros(len(node))
    for at in range(0, len(rows), BLOCK):
        r = rows[at : at + BLOCK]
        near = (x[r] @ y.T >= threshold) & (label[r][:, None] == other)
        if i == j:
            near &= r[:, None] < cols
        near = near.astype(np.float32 if weight.sum() < 1 << 24 and n[r].sum() < 1 << 24 else np.float64)
        counts[r] += near @ weight.astype(near.dtype)
        counts[cols] += n[r].astype(near.dtype) @ near
    return node, counts.astype(np.int64)


def _links_within(members: DataFrame, threshold: float, path: str) -> DataFrame:
    """``node`` and ``links``, the rows that each node of a component links to, all pairs of it compared.

    A component of more than ``2 * BLOCK`` nodes is dealt into blocks, and each
    pair of blocks is a task's work; smaller ones share blocks.  What is written
    are counts, so that rows grow with blocks and not with links.
    """
    sizes = materialize(members.groupBy("label").agg(F.count(F.lit(1)).alias("m")), path)
    bundles = max(1, math.ceil((sizes.where(F.col("m") <= 2 * BLOCK).agg(F.sum("m")).first()[0] or 0) / BLOCK))
    blocks = F.when(F.col("m") > 2 * BLOCK, F.ceil(F.col("m") / BLOCK)).otherwise(1).cast("int")
    group = F.when(F.col("m") > 2 * BLOCK, F.col("label")).otherwise(-1 - F.pmod(F.xxhash64("label"), F.lit(bundles)))
    dealt = members.join(sizes.withColumn("blocks", blocks).withColumn("group", group), "label")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn(
        "other",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)),
    )
    dealt = dealt.select(
        "group",
        F.length("unit").alias("dim"),
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "own",
        "node",
        "label",
        "n",
        "unit",
    )

    def count(table: pa.Table) -> pa.Table:
        node, links = link_counts(table, threshold)
        return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(links, pa.int64())})

    return dealt.groupBy("group", "dim", "i", "j").applyInArrow(
        count,
        "node long, links long",
    ).groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    trees: int = TREES,
    leaf: int = LEAF,
    spill: float = SPILL,
    sample: int = SAMPLE,
    seed: int = 7,
) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Two rows link if the cosine of their vectors, in double precision, is
    ``threshold`` or more.  The forest finds what connects each component; then
    all pairs of the component are compared, so that a link can be lost only
    between components, which takes that no tree keeps any link between them.  Vectors that are null, empty,
    zero, or hold null or non-finite components link with nothing, and vectors
    of different lengths don't link.  Equal vectors are one class: the forest
    sees it once, and its members count as links of each other.  ``n_links``
    counts other rows; ``component_id`` is the smallest id that links reach.
    Null ids link but name no component of others.  Extra columns are ignored.

    Trees are grown on a sample of about ``sample`` classes, or of as many as
    ``SAMPLE_BYTES`` hold, and all rows are put into their leaves.  Leaves grow with the input only where the sample is
    too small for more splits; a leaf of more than ``2 * BLOCK`` rows is dealt
    into blocks, and each pair of blocks is a task's work, so that no leaf is
    cut short and none is one task's alone.
    """
    spark = df.sparkSession
    path = workspace(spark, "forest")
    kind = df.schema[id_col].dataType

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = unit(batch.column(1))
            raw: list[bytes | None] = [None] * batch.num_rows
            for i, v in zip(at.tolist(), x, strict=True):
                raw[i] = v.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "unit"])

    rows = df.select(id_col, F.col(vector_col).cast("array<double>")).mapInArrow(
        normal,
        T.StructType([T.StructField("id", kind), T.StructField("unit", T.BinaryType())]),
    )
    rows = materialize(rows, f"{path}/rows")
    classes = rows.where("unit IS NOT NULL").groupBy("unit").agg(
        F.min("id").alias("first_id"),
        F.count(F.lit(1)).alias("n"),
    ).withColumn("node", F.monotonically_increasing_id())
    classes = materialize(classes, f"{path}/classes")
    dims = {
        r["d"]: r["n"]
        for r in classes.groupBy((F.length("unit") / 8).cast("int").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    total = sum(dims.values())
    total_bytes = sum(8 * d * n for d, n in dims.items())
    part = min(1.0, sample / max(1, total), SAMPLE_BYTES / max(1, total_bytes))
    cut = F.pmod(F.xxhash64("unit"), F.lit(1 << 30)) < int((1 << 30) * part)
    drawn = classes.where(cut).select("unit").toArrow()["unit"].to_pylist()
    forest: dict[int, list[Tree]] = {}
    for d, n in dims.items():
        own = sorted(v for v in drawn if len(v) == 8 * d)
        x = np.frombuffer(b"".join(own), np.float64).reshape(len(own), d)
        depth = max(0, min(math.ceil(math.log2(max(1, n / leaf))), int(math.log2(max(1, len(own) / 8)))))
        forest[d] = [Tree.grow(x, depth, seed + t, spill) for t in range(trees if depth else 1)]
    sent = share(spark, forest)
    leaves = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("tree", T.IntegerType()), T.StructField("leaf", T.LongType()), T.StructField("node", T.LongType()), T.StructField("unit", T.BinaryType())])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = sent()
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                raw = batch.column(1).to_pylist()
                sizes = np.array([len(v) // 8 for v in raw])
                for d in np.unique(sizes).tolist():
                    own = np.flatnonzero(sizes == d)
                    x = np.frombuffer(b"".join(raw[i] for i in own), np.float64).reshape(len(own), d)
                    for t, tree in enumerate(grown[d]):
                        at, nodes = tree.route(x)
                        n = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, d), pa.int32()),
                                pa.array(np.full(n, t), pa.int32()),
                                pa.array(nodes, pa.int64()),
                                batch.column(0).take(pa.array(own[at])),
                                batch.column(1).take(pa.array(own[at])),
                            ],
                            names=leaves.names,
                        )

    routed = classes.select("node", "unit").mapInArrow(route, leaves)
    key = ["dim", "tree", "leaf"]
    large = routed.groupBy(key).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 2 * BLOCK).select(
        *key,
        F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"),
    )
    large = materialize(large, f"{path}/large")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = routed.join(large, key, "left").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "unit")

    def compare(table: pa.Table) -> pa.Table:
        if table["i"][0].as_py() == table["j"][0].as_py():
            a, b = spanning(*close_pairs(*opened(table), threshold=threshold))
        else:
            first = np.equal(table["own"].to_numpy(), table["i"].to_numpy())
            a, b = between_blocks(table.filter(pa.array(first)), table.filter(pa.array(~first)), threshold)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    links = dealt.groupBy(*key, "i", "j").applyInArrow(compare, "a long, b long").distinct()
    links = materialize(links, f"{path}/links")
    labels = connected_components(links, f"{path}/components")
    members = materialize(classes.join(labels, "node").select("node", "unit", "n", "label"), f"{path}/found")
    counts = _links_within(members, threshold, f"{path}/sizes")
    rooted = classes.select("node", "unit", "first_id", "n").join(labels, "node", "left").withColumn("root", F.coalesce("label", "node"))
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = rooted.join(first, "root").join(counts, "node", "left").select(
        "unit",
        "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
    )
    known = materialize(known, f"{path}/known")
    out = rows.where("unit IS NOT NULL").join(known, "unit").select("id", "n_links", "component_id")
    out = out.unionByName(rows.where("unit IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
