"""Benchmark decontamination by size-partitioned MinHash containment (operator 3)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._shared import binary, share, sliced

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of test items that are broadcast and held at once.
BLOCK_BYTES = 16 << 20
#: Items whose shingle sets a task remembers at once.
SETS = 20_000
#: Words whose hashes a task remembers at once.
MEMO = 400_000


class WordHashes(dict):
    """Hashes of words; forgets all when full, which costs time only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 17)
        return h


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, from the words' hashes."""
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out = (out ^ (out >> np.uint64(29))) * MIX + h[i : len(h) - n + 1 + i]
    return (out ^ (out >> np.uint64(32))) * MIX


def shingles(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[i:] for i in range(n)), strict=False)) if len(words) >= n else set()


class Hashed:
    """Some documents' words, and the hashes of their shingles, of each width once."""

    def __init__(self, docs: list[list[bytes]], hashes: WordHashes) -> None:
        self.docs = docs
        self.lens = np.array([len(w) for w in docs], np.int64)
        self.ends = np.cumsum(self.lens)
        self.words = np.fromiter((x for w in docs for x in map(hashes.__getitem__, w)), np.uint64, int(self.ends[-1]) if len(docs) else 0)
        self.by_width: dict[int, np.ndarray] = {}

    def shingles(self, width: int) -> np.ndarray:
        """Hashes of all runs of ``width`` words, those across two documents too."""
        if width not in self.by_width:
            self.by_width[width] = shingle_hashes(self.words, width) if len(self.words) >= width else np.zeros(0, np.uint64)
        return self.by_width[width]


@dataclass
class Partition:
    """The sketches of items of one size class: ``keys``, sorted, and the item ``owner`` of each.

    Its items have ``2 ** (k - 1)`` to ``2 ** k - 1`` shingles.  All have sketches
    of one length: the smallest ranks under the partition's own permutation, one
    more than its largest item may miss.  ``least`` is the fewest shingles that
    a document needs to contain any of them.
    """

    width: int
    least: int
    keys: np.ndarray
    owner: np.ndarray


def permutation(h: np.ndarray, size_class: int) -> np.ndarray:
    """Ranks of shingle hashes, different in each size class."""
    rank = (h ^ np.uint64(size_class * int(MIX) % (1 << 64))) * MIX
    return rank ^ (rank >> np.uint64(31))


@dataclass
class Items:
    """A block of test items in size partitions.

    A document that contains the share ``t`` of an item's ``n`` shingles lacks at
    most ``n - ceil(t * n)`` of them.  So of the item's sketch of ``k`` ranks it
    holds at least ``k`` less as many, one at least, and no contained item is
    missed; ``asks`` is that number.  A document is looked up in the partitions
    only whose items it is long enough to contain.
    """

    ids: list
    texts: list[bytes]
    sizes: list[int]
    needs: list[int]
    asks: list[int]
    partitions: list[Partition]
    marks: dict[int, tuple[np.ndarray, int]]

    @classmethod
    def build(cls, rows: list[tuple[object, bytes | None]], n_words: int, threshold: float) -> Items:
        self = cls([], [], [], [], [], [], {})
        hashes = WordHashes()
        sketches: dict[tuple[int, int], list[tuple[int, int]]] = {}

        def need(n: int) -> int:
            return max(1, math.ceil(threshold * n - 1e-9))

        for item, text in rows:
            words = (text or b"").lower().split()
            if not words:
                continue
            width = min(n_words, len(words))
            n = len(shingles(words, width))
            h = np.unique(shingle_hashes(np.array([hashes[w] for w in words], np.uint64), width))
            size_class = n.bit_length()
            most = (1 << size_class) - 1
            k = min(len(h), most - need(most) + 1)
            for x in h[np.argsort(permutation(h, size_class), kind="stable")[:k]].tolist():
                sketches.setdefault((width, size_class), []).append((x, len(self.ids)))
            asks = max(1, k - (n - need(n)))
            for to, x in zip(
                (self.ids, self.texts, self.sizes, self.needs, self.asks),
                (item, b" ".join(words), n, need(n), asks),
                strict=True,
            ):
                to.append(x)
        for (width, size_class), pairs in sorted(sketches.items()):
            pairs.sort()
            keys, owner = np.array([x for x, _ in pairs], np.uint64), np.array([i for _, i in pairs])
            self.partitions.append(Partition(width, need(1 << size_class >> 1), keys, owner))
        for width in {p.width for p in self.partitions}:
            keys = np.concatenate([p.keys for p in self.partitions if p.width == width])
            shift = 64 - max(16, (32 * len(keys)).bit_length())
            marks = np.zeros(1 << (64 - shift), bool)
            marks[keys >> np.uint64(shift)] = True
            self.marks[width] = marks, shift
        return self

    def candidates(self, docs: Hashed) -> Iterator[tuple[int, int, int]]:
        """Document's place, item's place and width, of items of whose sketch a document holds enough."""
        for width, (marks, shift) in self.marks.items():
            s = docs.shingles(width)
            at = np.flatnonzero(marks[s >> np.uint64(shift)])
            doc = np.searchsorted(docs.ends, at, side="right")
            inside = at + width <= docs.ends[doc]
            at, doc = at[inside], doc[inside]
            for part in self.partitions:
                if part.width != width:
                    continue
                long_enough = docs.lens[doc] - width + 1 >= part.least
                h, of = s[at[long_enough]], doc[long_enough]
                lo, hi = np.searchsorted(part.keys, h, "left"), np.searchsorted(part.keys, h, "right")
                found = np.flatnonzero(hi > lo)
                if not len(found):
                    continue
                n = (hi - lo)[found]
                entry = np.repeat(lo[found] - np.cumsum(n) + n, n) + np.arange(n.sum())
                # A shingle that a document repeats counts once.
                held = np.unique(np.stack([np.repeat(of[found], n), part.owner[entry], entry]), axis=1)
                pairs, k = np.unique(held[:2], axis=1, return_counts=True)
                for d, i, m in zip(*pairs.tolist(), k.tolist(), strict=True):
                    if m >= self.asks[i] and docs.lens[d] - width + 1 >= self.needs[i]:
                        yield d, i, width

    def search(self, docs: Hashed, sets: dict[int, set]) -> list[tuple[int, int, int]]:
        """Document's place, item's place and number of shared shingles, of all contained items, counted exactly."""
        found, have = [], (-1, -1, set())
        for d, i, width in sorted(self.candidates(docs), key=lambda c: (c[0], c[2], c[1])):
            if have[:2] != (d, width):
                have = d, width, shingles(docs.docs[d], width)
            if i not in sets:
                if len(sets) >= SETS:
                    sets.clear()
                sets[i] = shingles(self.texts[i].split(), width)
            shared = len(sets[i] & have[2])
            if shared >= self.needs[i]:
                found.append((d, i, shared))
        return sorted(found)


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[object, bytes | None]]]:
    """The test items in blocks of about ``block_bytes``, one at a time on the driver."""
    sized = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("binary").alias("text"))
    total = sized.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        block = sized if n == 1 else sized.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r["item"], None if r["text"] is None else bytes(r["text"])) for r in block.collect()]


class Searcher:
    """Looks for all blocks of items in documents that are cut and hashed once; of several blocks it holds one at a time."""

    def __init__(self, blocks: list) -> None:
        self.blocks = blocks
        self.hashes = WordHashes()
        self.only = (blocks[0](), {}) if len(blocks) == 1 else None
        # Bytes of text that are searched at once: more of them where blocks have to be opened for each.
        self.at_once = (4 if self.only else 16) << 20

    def hits(self, texts: pa.Array) -> Iterator[tuple[Items, list[tuple[int, int, int]]]]:
        docs = Hashed([(t or b"").lower().split() for t in binary(texts)], self.hashes)
        for sent in self.blocks:
            items, sets = self.only or (sent(), {})
            yield items, items.search(docs, sets)


def sent_blocks(
    docs: DataFrame,
    benchmark: DataFrame,
    item_col: str,
    item_text: str,
    n_words: int,
    threshold: float,
    block_bytes: int,
) -> list:
    """Broadcasts of all blocks, each of bounded size."""
    return [
        share(docs.sparkSession, Items.build(rows, n_words, threshold))
        for rows in item_blocks(benchmark, item_col, item_text, block_bytes)
    ]


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    n_words: int = 5,
    threshold: float = 0.8,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every pair of a document and a test item that it contains.

    Columns: ``id_col``, ``item_id``, ``item_shingles``, ``shared`` (distinct
    shingles), ``containment``.  Texts are lower-cased in A-Z and cut into
    words; shingles have ``n_words`` words; an item of fewer words is one
    shingle, searched at its own length.  Null and empty texts and items match
    nothing.  Repeated documents or items give a row each.  Extra columns are
    ignored.  The items go out in blocks of bounded size, and one pass over the
    documents, read whole, searches all of them; nothing is shuffled.
    """
    kinds = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = T.StructType([T.StructField(id_col, kinds[0]), T.StructField("item_id", kinds[1]), T.StructField("item_shingles", T.LongType()), T.StructField("shared", T.LongType()), T.StructField("containment", T.DoubleType())])
    item_type = to_arrow_type(kinds[1])
    blocks = sent_blocks(docs, benchmark, item_col, item_text, n_words, threshold, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(blocks)
        for batch in (part for whole in batches for part in sliced(whole, 1, searcher.at_once)):
            for items, hits in searcher.hits(batch.column(1)):
                columns = [
                    batch.column(0).take(pa.array([d for d, _, _ in hits], pa.int64())),
                    pa.array([items.ids[i] for _, i, _ in hits]).cast(item_type),
                    pa.array([items.sizes[i] for _, i, _ in hits], pa.int64()),
                    pa.array([n for _, _, n in hits], pa.int64()),
                    pa.array([n / items.sizes[i] for _, i, n in hits], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    n_words: int = 5,
    threshold: float = 0.8,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the documents that contain a test item; all columns stay, whatever their names.

    What contains what is as in ``contained_items``: null and empty texts contain
    nothing and stay, and repeated rows go or stay alike.
    """
    place = docs.columns.index(text_col)
    blocks = sent_blocks(docs, benchmark, item_col, item_text, n_words, threshold, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(blocks)
        for batch in (part for whole in batches for part in sliced(whole, place, searcher.at_once)):
            keep = np.ones(batch.num_rows, bool)
            for _, hits in searcher.hits(batch.column(place)):
                keep[[d for d, _, _ in hits]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
