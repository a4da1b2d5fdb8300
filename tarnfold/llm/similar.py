"""Texts that share 0.8 or more of their five-word shingles, found by multi-index hashing (operator 8)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import binary, connected_components, first_document, materialize, only_documents, sliced, workspace
from .decontaminate import MIX, WordHashes, shingle_hashes

#: Bits of a key, and the share of links at the threshold itself that no key may miss.
WIDTH, MISS = 24, 0.01
#: Longs of a complete fingerprint, at least; the more, the fewer pairs below the threshold are read.
LANES = 16
#: Standard errors by which a distance may exceed its expectation before a pair is refused unread.
SLACK = 3.0
#: Entries of a key compared with each other at once, and up to how many every pair is kept.
BLOCK, SMALL = 512, 8
#: Active entries of a key up to which the second pass reads many keys at once.
FEW = 32
#: Entries, and texts and shingles, of a block in which what nearest pairs left apart is compared.
ENTRIES, TEXTS, SHINGLES = 2048, 256, 1 << 20
#: Shingles of the smaller set up to which the odds of a bit are counted, and not taken from the angle.
COUNTED = 64
#: The bits of each byte value.
BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.float64)


def share_of_bits(similarity: float) -> float:
    """The expected share of differing bits of two sets of one size with a Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def counted_share(m: int, n: int, shared: int) -> float:
    """The share of differing bits of two sets of ``m`` and ``n`` shingles, with ties as in ``long_fingerprint``."""

    def one(size: int) -> np.ndarray:
        own = size - shared
        odds = np.array([math.comb(own, b) for b in range(own + 1)], float) / 2.0**own
        return np.array([odds[max(0, size // 2 + 1 - k) :].sum() for k in range(shared + 1)])

    p, q = one(m), one(n)
    odds = np.array([math.comb(shared, k) / 2**shared for k in range(shared + 1)])
    return float((odds * (p * (1 - q) + q * (1 - p))).sum())


@cache
def shares(similarity: float) -> tuple[float, ...]:
    """The largest expected share of differing bits of similar enough sets, by the shingles of the smaller.

    Sets of more than ``COUNTED`` shingles have the last value, which exceeds
    what their sizes still add to the angle's share.
    """
    out = [0.0]
    for m in range(1, COUNTED + 1):
        sizes = range(m, math.floor(m / similarity + 1e-9) + 1)
        least = [(n, math.ceil(similarity * (m + n) / (1 + similarity) - 1e-9)) for n in sizes]
        out.append(max(counted_share(m, n, k) for n, k in least if k <= m))
    return (*out[:-1], max(out[-1], share_of_bits(similarity)))


@cache
def segments_by_size(similarity: float, width: int, miss: float = MISS) -> np.ndarray:
    """The segments under which a text of so many shingles is entered: enough for all that it may be similar to."""
    need = [n_segments(similarity, width, miss, p) for p in shares(similarity)]
    base = n_segments(similarity, width, miss)
    own = [max([base, *need[math.ceil(similarity * n - 1e-9) : n + 1]]) for n in range(COUNTED + 1)]
    return np.array([*own, *(max([base, *need[math.ceil(similarity * n - 1e-9) :]]) for n in range(COUNTED + 1, math.ceil(COUNTED / similarity) + 1)), base])


def bounds_by_size(similarity: float, bits: int) -> np.ndarray:
    """``farthest`` by the shingles of the smaller set; it never grows with these, so that the larger of two bounds holds for a pair."""
    plain = farthest(similarity, bits)
    own = [max(plain, math.floor(bits * p + SLACK * math.sqrt(bits * p * (1 - p)))) for p in shares(similarity)]
    return np.maximum.accumulate(own[::-1])[::-1]


def entries(fps: np.ndarray, n: np.ndarray, segments: int, width: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and the places of the texts that they are of; texts of few shingles have more."""
    table = segments_by_size(similarity, width)
    own = np.minimum(segments, table[np.minimum(n, len(table) - 1)])
    keys = ball_keys(fps, segments, width)
    at = np.repeat(np.arange(segments), width + 1) < own[:, None]
    return keys[at], np.nonzero(at)[0]


def n_segments(similarity: float, width: int = WIDTH, miss: float = MISS, p: float | None = None) -> int:
    """How many segments it takes that one of them differs in at most two bits, but for the share ``miss``."""
    p = share_of_bits(similarity) if p is None else p
    if p == 0:
        return 1
    meet = sum(math.comb(width, k) * p**k * (1 - p) ** (width - k) for k in range(3))
    return math.ceil(math.log(miss) / math.log(1 - meet))


def farthest(similarity: float, bits: int) -> int:
    """The largest distance over ``bits`` bits at which a pair may still be similar enough."""
    p = share_of_bits(similarity)
    return math.floor(bits * p + SLACK * math.sqrt(bits * p * (1 - p)))


def shingle_set(words: list[bytes], n_words: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of a text's distinct shingles, in order; a shorter text is one shingle, an empty one has none."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return np.unique(shingle_hashes(h, min(n_words, len(words))))


def long_fingerprint(shingles: np.ndarray, lanes: int) -> np.ndarray:
    """A SimHash of ``lanes`` times 64 bits over distinct shingles, as signed longs; zeros if there are none."""
    if not len(shingles):
        return np.zeros(lanes, np.int64)
    salts = np.array([(lane + 1) * 0xD1B54A32D192ED03 % (1 << 64) for lane in range(lanes)], np.uint64)
    offset = np.arange(8 * lanes, dtype=np.int64) * 256
    counts = np.zeros(2048 * lanes, np.int64)
    for at in range(0, len(shingles), 1 << 13):
        h = (shingles[at : at + (1 << 13), None] ^ salts) * MIX
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))).astype("<u8")
        counts += np.bincount((h.view(np.uint8).reshape(-1, 8 * lanes) + offset).ravel(), minlength=2048 * lanes)
    ones = counts.reshape(-1, 256).astype(np.float64) @ BYTE_BITS
    return np.packbits((2 * ones > len(shingles)).astype(np.uint8), axis=1, bitorder="little").ravel().view("<i8")


def parts(fingerprints: np.ndarray, segments: int, width: int) -> np.ndarray:
    """The segments of each fingerprint."""
    bits = np.unpackbits(np.ascontiguousarray(fingerprints).view(np.uint8), axis=1, bitorder="little")
    return bits[:, : segments * width].reshape(len(bits), segments, width).astype(np.int64) @ (np.int64(1) << np.arange(width))


def ball_keys(fingerprints: np.ndarray, segments: int, width: int) -> np.ndarray:
    """Of each fingerprint the keys of the radius-1 balls within its segments, segment number on top."""
    ball = np.concatenate([[0], np.int64(1) << np.arange(width)])
    keys = (parts(fingerprints, segments, width)[:, :, None] ^ ball) | (np.arange(segments) << width)[:, None]
    return keys.reshape(len(keys), -1)


def first_key(x: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """The smallest key that the balls of rows of segments ``x`` and ``y`` share; -1 if there is none."""
    differ = x ^ y
    meet = np.bitwise_count(differ) <= 2
    at = np.argmax(meet, axis=1)
    row = np.arange(len(x))
    px, py, d = x[row, at], y[row, at], differ[row, at]
    low = d & -d
    one, two = np.minimum(px, py), np.minimum(px ^ low, py ^ low)
    none = np.minimum(px, (px[:, None] ^ (np.int64(1) << np.arange(width))).min(axis=1))
    key = np.choose(np.minimum(np.bitwise_count(d), 2), [none, one, two])
    return np.where(meet.any(axis=1), key | at << width, -1)


def close_pairs(key: np.ndarray, fps: np.ndarray, bound: int | np.ndarray, begun: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of close pairs among entries sorted by key.

    Under a key of at most ``SMALL`` entries these are all pairs within
    ``bound`` bits, or the larger of their own bounds; under large ones each entry's nearest within its block.  An
    entry that is alone in its block, but not under its key, is paired with
    itself.  The key ``begun`` has had a block before.
    """
    n = len(key)
    bound = np.broadcast_to(bound, n)
    starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1)) if n else np.zeros(0, np.int64)
    size = np.repeat(np.diff(starts, append=n), np.diff(starts, append=n))
    large = size > SMALL
    if begun is not None:
        large |= key == begun
    place = np.arange(n) - np.repeat(starts, np.diff(starts, append=n))
    left = np.minimum(BLOCK - place % BLOCK, size - place)
    best = np.full(n, np.iinfo(np.int64).max)
    found = []
    at, d = np.flatnonzero(left > 1), 1
    while len(at):
        dist = np.bitwise_count((fps[at] ^ fps[at + d]).view(np.uint64)).sum(axis=1, dtype=np.int64)
        near = dist <= np.maximum(bound[at], bound[at + d])
        i, dist = at[near], dist[near]
        small = ~large[i]
        found.append((i[small], i[small] + d))
        i, dist = i[~small], dist[~small]
        best[i] = np.minimum(best[i], dist << 32 | (i + d))
        best[i + d] = np.minimum(best[i + d], dist << 32 | i)
        d += 1
        at = at[left[at] > d]
    i = np.flatnonzero(best < np.iinfo(np.int64).max)
    found.append((i, best[i] & 0xFFFFFFFF))
    alone = size >= BLOCK
    if begun is not None:
        alone |= key == begun
    alone = np.flatnonzero(alone & (best == np.iinfo(np.int64).max))
    found.append((alone, alone))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of the first column, by which the batches are sorted."""
    held: list[pa.RecordBatch] = []
    value = None
    for batch in batches:
        g = batch.column(0).to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist()] if len(g) else []
        for a, b in zip(starts, [*starts[1:], len(g)], strict=False):
            if held and g[a] != value:
                yield pa.Table.from_batches(held)
                held = []
            value = g[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sketch(df: DataFrame, id_col: str, text_col: str, n_words: int, lanes: int) -> DataFrame:
    """``id``, ``th`` (hash of the text), ``node`` (hash of the shingle set), ``n`` (distinct shingles) and ``fp`` (long fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (part for whole in batches for part in sliced(whole, 1)):
            sets = [shingle_set((t or b"").lower().split(), n_words, hashes) for t in binary(batch.column(1))]
            fps = [long_fingerprint(s, lanes) for s in sets]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array(nodes),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(fps, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    longs = [T.StructField(c, T.LongType()) for c in ("th", "node", "n")]
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), *longs, T.StructField("fp", T.ArrayType(T.LongType()))])
    return df.select(id_col, text_col, F.xxhash64(text_col).alias("th")).mapInArrow(run, schema)


def _candidates(classes: DataFrame, segments: int, width: int, similarity: float) -> DataFrame:
    """Pairs ``a``, ``b`` of classes that meet under a key and are close by the first 128 bits.

    Under a large key these are nearest pairs, and classes paired with
    themselves that have none in their block.
    """

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                node, n, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.array(batch.column(2).to_pylist(), np.int64)
                keys, of = entries(fps, n, segments, width, similarity)
                own = bounds[np.minimum(n, len(bounds) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (keys, node[of], own[of], fps[of, 0], fps[of, 1])],
                    names=["key", "node", "bound", "p", "q"],
                )

    bounds = bounds_by_size(similarity, 128)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(rows: np.ndarray, begun: int | None) -> pa.RecordBatch:
            i, j = close_pairs(rows[:, 0], rows[:, 3:], rows[:, 2], begun)
            p, q = rows[i, 1], rows[j, 1]
            twice = (p == q) & (i != j)
            p, q = p[~twice], q[~twice]
            both = np.unique(np.stack([np.minimum(p, q), np.maximum(p, q)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        held, begun = np.zeros((0, 5), np.int64), None
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], axis=1)])
            if not len(held):
                continue
            last = int(np.searchsorted(held[:, 0], held[-1, 0]))
            last += (len(held) - last) // BLOCK * BLOCK
            yield pairs(held[:last], begun)
            if last and held[last - 1, 0] == held[-1, 0]:
                begun = int(held[-1, 0])
            held = held[last:]
        yield pairs(held, begun)

    keys = classes.select("node", "n", "fp").mapInArrow(enter, "key long, node long, bound long, p long, q long")
    keys = keys.repartition("key").sortWithinPartitions("key", F.xxhash64("key", "node"))
    return keys.mapInArrow(meet, "a long, b long").distinct()


def _sets(df: DataFrame, text_col: str, n_words: int) -> DataFrame:
    """``node`` and its shingle set, of rows ``node`` and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (part for whole in batches for part in sliced(whole, 1)):
            sets = [shingle_set((t or b"").lower().split(), n_words, hashes).tobytes() for t in binary(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "set"])

    return df.select("node", text_col).mapInArrow(run, "node long, set binary")


def _verify(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs that share enough of their shingles, counted exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole, 2)):
            keep = []
            for a, b in zip(binary(batch.column(2)), binary(batch.column(3)), strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= similarity * (len(x) + len(y) - shared) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _apart(active: DataFrame, segments: int, width: int, similarity: float, small: int = SMALL) -> DataFrame:
    """``node``, ``label`` and ``block``: classes and the blocks of other groups that hold a class close to theirs.

    ``active`` (``fp``, ``label``, ``block``, ``size``) holds all classes of
    large keys that are close to another there.  They are entered again, and
    under each key of more than ``small`` of these those that aren't of its most
    frequent group are held against all.  So a key of one group costs nothing, and a hot group isn't
    compared with itself.  Of the keys of a pair the smallest gives it.  A key
    of more than ``ENTRIES`` is dealt into blocks first.  ``node`` and ``n`` of
    ``active`` may be missing: the first of ``fp``, and many shingles.
    """
    for c, missing in (("node", F.col("fp")[0]), ("n", F.lit(1 << 20).cast("long"))):
        if c not in active.columns:
            active = active.withColumn(c, missing)
    lanes = math.ceil(segments * width / 64)
    bounds = bounds_by_size(similarity, 64 * lanes)
    names = ["label", "block", "size", "node", "bound", *(f"f{i}" for i in range(lanes))]
    longs = ", ".join(f"{c} long" for c in names)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                fps = np.array(batch.column(0).to_pylist(), np.int64)[:, :lanes]
                n = batch.column(5).to_numpy()
                keys, of = entries(fps, n, segments, width, similarity)
                own = np.column_stack([*(c.to_numpy() for c in batch.columns[1:5]), bounds[np.minimum(n, len(bounds) - 1)], fps])[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), *(pa.array(own[:, c]) for c in range(own.shape[1]))],
                    names=["key", *names],
                )

    def give(key: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        label, block, size, node, fps = rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 5:]
        less = (size[i] < size[j]) | (size[i] == size[j]) & (label[i] < label[j])
        first = first_key(parts(fps[i], segments, width), parts(fps[j], segments, width), width) == key if len(i) else np.zeros(0, bool)
        i, j = np.where(less, i, j)[first], np.where(less, j, i)[first]
        return np.stack([node[i], label[j], block[j]], axis=1)

    def asks(key: int, rows: np.ndarray, one: np.ndarray, two: np.ndarray) -> Iterator[np.ndarray]:
        label, bound, fps = rows[:, 0], rows[:, 4], np.ascontiguousarray(rows[:, 5:])
        for at in range(0, len(one), 32):
            x = one[at : at + 32]
            dist = np.bitwise_count((fps[x][:, None] ^ fps[two]).view(np.uint64)).sum(axis=2, dtype=np.int64)
            i, j = np.nonzero((dist <= np.maximum(bound[x][:, None], bound[two])) & (label[x][:, None] != label[two]))
            i, j = x[i], two[j]
            if len(i):
                yield give(np.full(len(i), key), rows, i, j)

    def asks_of_few(held: np.ndarray) -> Iterator[np.ndarray]:
        rows, bound, fps = held[:, 1:], held[:, 5], np.ascontiguousarray(held[:, 6:])
        for d in range(1, FEW):
            i = np.flatnonzero((held[d:, 0] == held[:-d, 0]) & (held[d:, 1] != held[:-d, 1]))
            if len(i):
                i = i[np.bitwise_count((fps[i] ^ fps[i + d]).view(np.uint64)).sum(axis=1, dtype=np.int64) <= np.maximum(bound[i], bound[i + d])]
                yield give(held[i, 0], rows, i, i + d)

    def asked(rows: list[np.ndarray]) -> np.ndarray:
        return np.unique(np.concatenate([np.zeros((0, 3), np.int64), *rows]), axis=0)

    def of_keys(held: np.ndarray) -> np.ndarray:
        starts = np.flatnonzero(np.diff(held[:, 0], prepend=held[0, 0] - 1)) if len(held) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(held))
        mixed = ends - starts > small
        if len(starts):
            mixed &= np.minimum.reduceat(held[:, 1], starts) != np.maximum.reduceat(held[:, 1], starts)
        few = mixed & (ends - starts <= FEW)
        out = list(asks_of_few(held[np.repeat(few, ends - starts)]))
        mixed &= ~few
        for a, b in zip(starts[mixed].tolist(), ends[mixed].tolist(), strict=True):
            rows = held[a:b, 1:]
            labels, counts = np.unique(rows[:, 0], return_counts=True)
            out += asks(int(held[a, 0]), rows, np.flatnonzero(rows[:, 0] != labels[np.argmax(counts)]), np.arange(b - a))
        return asked(out)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: np.ndarray, huge: np.ndarray) -> pa.RecordBatch:
            n = len(found)
            columns = [pa.concat_arrays([pa.array(found[:, c]), pa.nulls(len(huge), pa.int64())]) for c in range(3)]
            columns += [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(huge[:, c])]) for c in range(huge.shape[1])]
            return pa.RecordBatch.from_arrays(columns, names=["to_node", "to_label", "to_block", "key", *names])

        held, dealt = np.zeros((0, 6 + lanes), np.int64), None
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], axis=1)])
            if not len(held):
                continue
            first = int(np.searchsorted(held[:, 0], dealt, "right")) if dealt is not None else 0
            last = max(first, int(np.searchsorted(held[:, 0], held[-1, 0])))
            starts = np.flatnonzero(np.diff(held[first:, 0], prepend=-1)) + first
            sizes = np.diff(starts, append=len(held))
            huge = np.repeat(sizes > ENTRIES, sizes)
            if len(starts) and sizes[-1] > ENTRIES:
                last, dealt = len(held), int(held[-1, 0])
            own = held[first:last]
            huge = huge[: last - first]
            yield out(of_keys(own[~huge]), np.concatenate([held[:first], own[huge]]))
            held = held[last:]
        yield out(of_keys(held), held[:0])

    def meet_dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches):
            rows, row, key = np.stack([t[c].to_numpy() for c in names], axis=1), t["row"].to_numpy(), t["key"].to_numpy()
            found = asked([x for k in np.unique(key).tolist() for x in asks(k, rows, np.flatnonzero(row & (key == k)), np.flatnonzero(~row & (key == k)))])
            yield pa.RecordBatch.from_arrays([pa.array(found[:, c]) for c in range(3)], names=["node", "label", "block"])

    met = active.select(
        "fp",
        "label",
        "block",
        "size",
        "node",
        "n",
    ).mapInArrow(enter, f"key long, {longs}").repartition("key").sortWithinPartitions("key")
    met = met.mapInArrow(meet, f"to_node long, to_label long, to_block long, key long, {longs}")
    met = materialize(met, workspace(active.sparkSession, "apart"))
    found = met.where("key IS NULL").select(
        F.col("to_node").alias("node"),
        F.col("to_label").alias("label"),
        F.col("to_block").alias("block"),
    )
    huge = met.where("key IS NOT NULL").select("key", *names)
    shares = huge.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
    keys = shares.groupBy("key").agg(F.sum("k").alias("m"), F.max(F.struct("k", "label")).alias("top")).where("top.k < m")
    keys = keys.select(
        "key",
        F.col("top.label").alias("most"),
        F.ceil(F.col("m") / ENTRIES).cast("int").alias("cols"),
        F.ceil((F.col("m") - F.col("top.k")) / ENTRIES).cast("int").alias("rows"),
    )
    own = huge.join(keys, "key")
    col = own.withColumn("row", F.lit(False)).withColumn(
        "j",
        F.pmod(F.xxhash64("node", F.lit(1)), "cols").cast("int"),
    ).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    row = own.where("label <> most").withColumn("row", F.lit(True)).withColumn(
        "i",
        F.pmod(F.xxhash64("node", F.lit(2)), "rows").cast("int"),
    ).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("cols") - 1)))
    dealt = col.unionByName(row).select(F.xxhash64("key", "i", "j").alias("g"), "row", "key", *names)
    dealt = dealt.repartition("g").sortWithinPartitions("g").mapInArrow(meet_dealt, "node long, label long, block long")
    return found.unionByName(dealt)


def _links_to_blocks(asked: DataFrame, comps: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``a``, ``b``: for each class and block of a group asked for, one to a member that is similar enough, if any is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches):
            asks, node = t["asks"].to_numpy(), t["node"].to_numpy()
            texts = [np.frombuffer(x, np.uint64) for x in t["set"].to_pylist()]
            two = np.flatnonzero(~asks)
            if not len(two):
                continue
            n = np.array([len(texts[j]) for j in two])
            held, owner = np.concatenate([texts[j] for j in two]), np.repeat(np.arange(len(two)), n)
            order = np.argsort(held, kind="stable")
            held, owner = held[order], owner[order]
            a, b = [], []
            for i in np.flatnonzero(asks):
                x = texts[i]
                lo, hi = np.searchsorted(held, x, "left"), np.searchsorted(held, x, "right")
                at = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())
                shared = np.bincount(owner[at], minlength=len(two))
                match = np.flatnonzero(shared >= similarity * (len(x) + n - shared) - 1e-9)
                if len(match):
                    a.append(node[i])
                    b.append(node[two[match[0]]])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    chunks = asked.groupBy("label", "block").agg(F.ceil(F.count(F.lit(1)) / TEXTS).cast("int").alias("chunks"))
    one = asked.join(chunks, ["label", "block"]).select(
        "node",
        "label",
        "block",
        F.pmod(F.xxhash64("node"), "chunks").cast("int").alias("chunk"),
        F.lit(True).alias("asks"),
    )
    two = comps.select("node", "label", "block").join(chunks, ["label", "block"]).select(
        "node",
        "label",
        "block",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.lit(False).alias("asks"),
    )
    dealt = one.unionByName(two).join(sets, "node").select(F.xxhash64("label", "block", "chunk").alias("g"), "asks", "node", "set")
    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(run, "a long, b long")


def _near_pairs(classes: DataFrame, met: DataFrame, lanes: int, similarity: float) -> DataFrame:
    """The pairs of ``met`` that may be similar by their sizes and their complete distance ``d``."""
    one = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("fp").alias("fa"))
    two = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("fp").alias("fb"))
    distance = reduce(lambda x, y: x + y, [F.bit_count(F.col("fa")[i].bitwiseXOR(F.col("fb")[i])) for i in range(lanes)])
    bounds = bounds_by_size(similarity, 64 * lanes).tolist()
    at = F.least(F.least("na", "nb") + 1, F.lit(len(bounds))).cast("int")
    sized = met.where("a <> b").join(one, "a").join(two, "b").where(F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9)
    found = sized.select("a", "b", distance.alias("d"), F.element_at(F.array(*map(F.lit, bounds)), at).alias("bound"))
    return found.where(F.col("d") <= F.col("bound"))


def _nearest(near: DataFrame) -> DataFrame:
    """Of each class the pair with its nearest."""
    pair = F.struct("d", "a", "b")
    by = near.select(F.col("a").alias("node"), pair.alias("e")).union(near.select("b", pair))
    return by.groupBy("node").agg(F.min("e").alias("e")).select("e.a", "e.b").distinct()


def _still_apart(near: DataFrame, chosen: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs not read yet whose ends are in different groups."""
    left = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    rest = near.join(chosen, ["a", "b"], "left_anti").join(left, "a", "left").join(right, "b", "left")
    return rest.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b", "d")


def _blocks_of(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes with their groups, dealt into blocks of bounded texts and shingles."""
    comps = classes.join(labels, "node", "left").select("node", "n", F.coalesce("label", "node").alias("label"))
    sizes = comps.groupBy("label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("size") / TEXTS, F.col("shingles") / SHINGLES, F.lit(1)))
    block = F.pmod(F.xxhash64("node", F.lit(3)), blocks).cast("long")
    return comps.join(sizes, "label").select("node", "label", "size", block.alias("block"), "n")


def _blocks_met(near: DataFrame, comps: DataFrame) -> DataFrame:
    """For each pair the class of the smaller group, and the other's group and block."""
    one, two = (comps.select(*(F.col(c).alias(f"{c}_{end}") for c in comps.columns)).withColumnRenamed(f"node_{end}", end) for end in "ab")
    less = F.struct("size_a", "label_a") < F.struct("size_b", "label_b")
    to = [F.when(less, F.col(f"{c}_b")).otherwise(F.col(f"{c}_a")).alias(c) for c in ("label", "block")]
    return near.join(one, "a").join(two, "b").select(F.when(less, F.col("a")).otherwise(F.col("b")).alias("node"), *to)


def _grouped(df: DataFrame, id_col: str, text_col: str, n_words: int, similarity: float, width: int) -> tuple[DataFrame, DataFrame]:
    """Every row's ``id``, ``th`` and ``node``; and each node's ``first``, the first document of its group."""
    path = workspace(df.sparkSession, "similar")
    segments = int(segments_by_size(similarity, width).max())
    lanes = max(LANES, math.ceil(segments * width / 64))
    docs = materialize(_sketch(df, id_col, text_col, n_words, lanes), f"{path}/sketches")
    by_node = docs.groupBy("node").agg(F.min(F.struct(first_document("id", "th").alias("first"), "n", "fp")).alias("c"))
    classes = materialize(by_node.select("node", "c.first", "c.n", "c.fp"), f"{path}/classes")
    met = materialize(_candidates(classes, segments, width, similarity), f"{path}/candidates")
    near = materialize(_near_pairs(classes, met, lanes, similarity), f"{path}/near")

    def sets_of(nodes: DataFrame, name: str) -> DataFrame:
        # A class's own text, by id and text: a row that only repeats the id is another document.
        ends = nodes.join(classes, "node").select("node", F.col("first.id").alias("first_id"), F.col("first.th").alias("first_th"))
        texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
        own = texts.join(ends, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("th") == F.col("first_th")))
        return materialize(_sets(own.dropDuplicates(["node"]), "text", n_words), f"{path}/{name}")

    sets = sets_of(near.select(F.col("a").alias("node")).union(near.select("b")).distinct(), "sets")
    links = None
    for step in range(2):
        chosen = materialize(_nearest(near), f"{path}/chosen-{step}")
        passed = materialize(_verify(chosen, sets, similarity), f"{path}/passed-{step}")
        links = passed if links is None else links.union(passed)
        labels = connected_components(links, f"{path}/components-{step}")
        near = materialize(_still_apart(near, chosen, labels), f"{path}/near-{step}")
    comps = materialize(_blocks_of(classes, labels), f"{path}/groups")
    active = met.select(F.col("a").alias("node")).union(met.select("b")).distinct()
    active = classes.select("node", "fp").join(active.join(comps, "node"), "node")
    # Keys count active classes only here, so none is too small to be a large one.
    asked = _blocks_met(near, comps).union(_apart(active, segments, width, similarity, small=1)).distinct()
    asked = materialize(asked, f"{path}/asked")
    asked_of = comps.join(asked.select("label", "block").distinct(), ["label", "block"], "left_semi").select("node")
    more = asked.select("node").union(asked_of).distinct().join(sets, "node", "left_anti")
    sets = sets.union(sets_of(more, "more-sets"))
    passed = materialize(_links_to_blocks(asked, comps, sets, similarity), f"{path}/passed-2")
    labels = connected_components(links.union(passed), f"{path}/components-2")
    rooted = classes.select("node", "first").join(labels, "node", "left").withColumn("root", F.coalesce("label", "node"))
    first = rooted.groupBy("root").agg(F.min("first").alias("of_group"))
    members = materialize(rooted.join(first, "root").select("node", F.col("of_group").alias("first")), f"{path}/members")
    return docs.select("id", "th", "node"), members


def similar_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_words: int = 5,
    similarity: float = 0.8,
    width: int = WIDTH,
) -> DataFrame:
    """``id_col`` and ``component_id`` of every row: groups of texts that links connect, by their smallest id.

    Two texts link if their sets of ``n_words``-word shingles have a Jaccard
    similarity of ``similarity`` or more.  Texts are lower-cased in A-Z and cut
    into words; a text of fewer words is one shingle; null and empty texts are
    copies of each other.  A repeated row gives a row each time; a repeated id
    with another text is another document; a null id links as any other and
    names only groups that have no id.  Extra columns are ignored.

    Rows of one shingle set (by a hash of 64 bits) are a class, found by an
    aggregation.  A class is entered under the radius-1 balls of each segment,
    so two meet if a segment of theirs differs in two bits or fewer.  Texts of
    few shingles, whose bits differ more, have more segments and wider bounds.  Under a
    key every pair is taken if there are few, else each entry with its nearest,
    in blocks.  Their complete distance is verified, then the shingles
    themselves: first each class with its nearest, then, where a group is not
    yet connected, the next nearest.  That joins most of each group, and what
    is left is done whole: all pairs not yet read, and all pairs of entries of
    large keys, whose groups still differ.  A class that has such a pair is
    held against the shingles of the block of the other group that the pair
    lies in, so that rows grow with blocks and not with pairs.

    At the threshold ``MISS`` of the links meet under no key, and a few exceed
    ``SLACK``; no other link is lost.  ``width`` should grow with the logarithm
    of the classes: 24 leaves a dozen entries a key at 8 million.
    """
    docs, members = _grouped(df, id_col, text_col, n_words, similarity, width)
    return docs.join(members, "node").select(F.col("id").alias(id_col), F.col("first.id").alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``df`` with one document of each group of similar texts: that of the smallest id.

    A document is an id and a text.  So a repeated id with an unlike text is
    another document and stays, and a null id is an id, after all others.  Of
    rows that repeat both, one stays: the least by all columns.  All columns
    stay, whatever their names.
    """
    docs, members = _grouped(df, id_col, text_col, n_words, similarity, WIDTH)
    return only_documents(df, members.select("first.id", "first.th").distinct(), docs, id_col, text_col, workspace(df.sparkSession, "kept"))
