"""Language-model scoring by prediction by partial matching (operator 2).

The model is a byte-context trie of order ``ORDER`` over the canonical bytes of
a text: its words in lower case, joined by one space, and an end byte.  All
counts come from the training documents.  A byte's probability is that of PPM
with escape method D and full symbol exclusion: at a context with ``T`` counts
of ``D`` symbols, without those that a longer context has ruled out, a symbol
seen ``c`` times has ``(c - 1/2) / T`` and the escape to the next shorter context
has ``D / 2T``; after the empty context all bytes not yet ruled out are alike.

With a fixed trie that probability depends on the byte and the ``ORDER`` bytes
before it only.  So each distinct run of ``ORDER + 1`` bytes is evaluated once,
where its context's branch of the trie is, and sent to the batches of documents
that hold it.  Neither the trie nor the word counts are ever in one place:
both are shuffled tables, and a batch gets the part of them that it needs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from ._shared import binary, materialize, partitions, share, sliced, workspace

ORDER = 5
END = b"\n"
#: Canonical bytes of a batch, and of the part of it that is worked on at once.
BATCH_BYTES, STEP = 24 << 20, 1 << 18
#: Highest order whose counts every task gets, and up to how many; beyond, orders 0 and 1 go out, 65,536 counts at most.
LOW, LOW_ROWS = 2, 1 << 22
#: Mean runs of a branch of the trie that a task evaluates at once.
BRANCH = 1 << 19


def held_out(doc_id: object, parts: int = 7, part: int = 2) -> bool:
    """Whether a document is kept from training, by crc32 of its id as text; a null id as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts == part


def windows(data: np.ndarray, starts: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and codes of all runs of ``order + 1`` bytes, with ``order`` end bytes before each document.

    ``data`` holds the documents on end and ``starts`` where each begins.
    """
    for a in range(0, len(data), STEP):
        b = min(len(data), a + STEP)
        at = np.arange(a, b)
        since = at - starts[np.searchsorted(starts, at, side="right") - 1]
        code = data[a:b].astype(np.uint64)
        for k in range(1, order + 1):
            before = np.full(b - a, END[0], np.uint64)
            lo = max(0, k - a)
            before[lo:] = data[a + lo - k : b - k]
            before[since < k] = END[0]
            code |= before << np.uint64(8 * k)
        yield at, code


def tally(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and their numbers."""
    codes = np.sort(codes)
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[at], np.diff(np.append(at, len(codes)))


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of tallies."""
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(n, at) if len(at) else n


class Lookup:
    """A hash table from codes to numbers, built and asked in whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, values.dtype)
        full = np.zeros(1 << self.bits, bool)
        at, left = self.slot(keys), np.arange(len(keys))
        while len(left):
            free = ~full[at]
            _, first = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[at[put]], self.values[at[put]], full[at[put]] = keys[left[put]], values[left[put]], True
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, at = left[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of codes that are all in the table."""
        at = self.slot(keys)
        wrong = np.flatnonzero(self.keys[at] != keys)
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[self.keys[at[wrong]] != keys[wrong]]
        return self.values[at]


class Level:
    """The trie's nodes of one order: counts by run of bytes, and sums by context.

    ``parent`` has, for each run, the count of the run without its first byte.
    """

    def __init__(self, keys: np.ndarray, n: np.ndarray, parent: np.ndarray) -> None:
        self.keys, self.n = keys, n
        contexts = keys >> np.uint64(8)
        at = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.contexts = contexts[at]
        self.total = np.add.reduceat(n, at) if len(at) else n
        self.symbols = np.diff(np.append(at, len(keys)))
        self.excluded = np.add.reduceat(parent, at) if len(at) else parent

    @staticmethod
    def find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return at, keys[at] == asked

    def count(self, asked: np.ndarray) -> np.ndarray:
        at, known = self.find(self.keys, asked)
        return np.where(known, self.n[at] if len(self.n) else 0, 0)


def levels(keys: np.ndarray, n: np.ndarray, top: int, below: list[Level]) -> list[Level]:
    """The levels of a trie, shortest contexts first, on top of those ``below``.

    ``keys`` and ``n`` count the runs of ``top + 1`` bytes.
    """
    tallies = [(keys, n)]
    for order in range(top - 1, len(below) - 1, -1):
        mask = np.uint64((1 << 8 * (order + 1)) - 1)
        tallies.append(merge([(tallies[-1][0] & mask, tallies[-1][1])]))
    out = list(below)
    for k, c in reversed(tallies):
        mask = np.uint64((1 << 8 * len(out)) - 1)
        out.append(Level(k, c, out[-1].count(k & mask) if out else np.zeros(len(k), np.int64)))
    return out


def log_probability(trie: list[Level], codes: np.ndarray) -> np.ndarray:
    """log10 of the probability of each code's last byte after the others."""
    out = np.zeros(len(codes))
    left = np.arange(len(codes))
    gone, gone_symbols = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    for order in range(len(trie) - 1, -1, -1):
        level = trie[order]
        asked = codes[left] & np.uint64((1 << 8 * (order + 1)) - 1)
        at, known = level.find(level.contexts, asked >> np.uint64(8))
        if not len(level.contexts):
            continue
        total = np.where(known, level.total[at] - gone, 0)
        symbols = np.where(known, level.symbols[at] - gone_symbols, 0)
        n = level.count(asked)
        hit = n > 0
        escape = ~hit & (symbols > 0)
        out[left[hit]] += np.log10((n[hit] - 0.5) / total[hit])
        out[left[escape]] += np.log10(symbols[escape] / (2 * total[escape]))
        gone, gone_symbols = np.where(known, level.excluded[at], 0)[~hit], np.where(known, level.symbols[at], 0)[~hit]
        left = left[~hit]
    out[left] -= np.log10(256 - gone_symbols)
    return out


def batches_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The corpus as batches: ids, lengths, held-out marks and canonical bytes of some documents, as ``opened`` reads them.

    They are one value, as Spark takes time with the square of a batch's rows to hand on lists that most rows lack.
    """
    id_type = to_arrow_type(df.schema[id_col].dataType)
    limit = BATCH_BYTES

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[bytes] = []
        size, seq, part = 0, 0, TaskContext.get().partitionId()

        def close() -> pa.RecordBatch:
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            row = [[ids], [[len(t) for t in texts]], [[held_out(i) for i in ids]], [data]]
            kinds = (pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary())
            row = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=["ids", "lens", "held", "data"])
            with pa.BufferOutputStream() as sink:
                with pa.ipc.new_stream(sink, row.schema) as out:
                    out.write_batch(row)
                doc = sink.getvalue().to_pybytes()
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | seq], pa.int64()), pa.array([doc], pa.binary())], names=["batch", "doc"])

        for whole in source:
            for batch in sliced(whole, 1):
                for i, t in zip(batch.column(0).to_pylist(), binary(batch.column(1)), strict=True):
                    ids.append(i)
                    texts.append(b" ".join((t or b"").lower().split()) + END)
                    size += len(texts[-1])
                    if size >= limit:
                        yield close()
                        ids, texts, size, seq = [], [], 0, seq + 1
        if ids:
            yield close()

    return df.select(id_col, text_col).mapInArrow(run, "batch long, doc binary")


def opened(doc: pa.Buffer) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """A batch's document ids, starts, lengths, held-out marks and bytes."""
    ids, lens, held, data = (c.chunk(0) for c in pa.ipc.open_stream(doc).read_all().columns)
    lens = lens.flatten().to_numpy()
    data = zstandard.ZstdDecompressor().decompress(data[0].as_buffer(), max_output_size=int(lens.sum()) or 1)
    return ids.flatten(), np.cumsum(lens) - lens, lens, held.flatten().to_numpy(zero_copy_only=False), data


def words_of(data: np.ndarray, step: int = 1 << 22) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of documents on end and the documents' places, about ``step`` bytes at a time; ends are no words here.

    In canonical bytes a word ends before a space or an end, and only there.
    """
    at = before = 0
    while at < len(data):
        size = step
        # A word may be longer than a step.
        while not len(cuts := np.flatnonzero(((part := data[at : at + size]) == 32) | (part == END[0]))):
            size *= 2
        starts = np.concatenate([[0], cuts[:-1] + 1])
        ends = part[cuts] == END[0]
        doc = before + np.cumsum(ends) - ends
        full = cuts > starts
        part = part[: cuts[-1] + 1]
        letters = part[(part != 32) & (part != END[0])]
        offsets = np.concatenate([[0], np.cumsum((cuts - starts)[full])]).astype(np.int64)
        yield pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]), doc[full]
        at += int(cuts[-1]) + 1
        before += int(ends.sum())


def summed(words: pa.Table) -> pa.Table:
    """Each word once, with the sum of its ``n``."""
    return words.group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])


def words_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each batch and how often its training documents have them; the end is a word."""
    for batch in batches:
        for number, doc in zip(batch.column("batch").to_pylist(), batch.column("doc"), strict=True):
            _, _, _, held, data = opened(doc.as_buffer())
            parts = [pa.table({"word": pa.array([END], pa.large_binary()), "n": pa.array([int((~held).sum())], pa.int64())})]
            for words, at in words_of(np.frombuffer(data, np.uint8)):
                parts.append(summed(pa.table({"word": words, "n": pa.array((~held[at]).astype(np.int64))})))
            found = summed(pa.concat_tables(parts))
            for i in range(0, found.num_rows, 100_000):
                part = found.slice(i, 100_000)
                columns = [part["word"].combine_chunks().cast(pa.binary()), pa.array(np.full(part.num_rows, number), pa.int64()), part["n"].combine_chunks()]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "batch", "n"])


def grams_in(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Distinct runs of ``order + 1`` bytes of each batch and their numbers in its training documents."""
    for batch in batches:
        for number, doc in zip(batch.column("batch").to_pylist(), batch.column("doc"), strict=True):
            _, starts, _, held, data = opened(doc.as_buffer())
            found = []
            for at, codes in windows(np.frombuffer(data, np.uint8), starts, order):
                train = ~held[np.searchsorted(starts, at, side="right") - 1]
                found.append(tally(codes[train]))
                keys, n = tally(codes[~train])
                found.append((keys, n * 0))
                if len(found) > 6:
                    found = [merge(found)]
            keys, n = merge(found)
            for i in range(0, len(keys), 100_000):
                part = keys[i : i + 100_000].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(np.full(len(part), number), pa.int64()), pa.array(n[i : i + 100_000], pa.int64())], names=["gram", "batch", "n"])


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Code lengths of all documents under a trie of the training documents.

    Columns: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one word unigrams), ``score`` (this model), both log10.
    A null text is empty and has its end as its only token.  Repeated rows train
    and are scored each.  Extra columns are ignored.

    A word, the end too, has one row a batch, so that the most frequent one has
    a few million rows at 100 TB.  The trie is dealt into as many branches as its
    runs need; a branch is all that follows two or three bytes, so that the
    largest has 256³ runs at most, whatever the corpus.
    """
    if not LOW < order <= 6:
        raise ValueError(f"order must be {LOW + 1} to 6")
    spark = df.sparkSession
    path = workspace(spark, "ppm")
    batches = materialize(batches_of(df, id_col, text_col), f"{path}/batches")
    words = batches.mapInArrow(words_in, "word binary, batch long, n long")
    of_word = Window.partitionBy("word")
    words = words.select("batch", "word", F.sum("n").over(of_word).alias("c"), (F.min("batch").over(of_word) == F.col("batch")).alias("first"))
    words = materialize(words, f"{path}/words")
    grams = materialize(batches.mapInArrow(lambda it: grams_in(it, order), "gram long, batch long, n long"), f"{path}/grams")

    n_train, n_words = words.where("first").agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    n_train = n_train or 0
    unknown = -float(np.log10(n_train + n_words + 1))

    sums = materialize(grams.groupBy("gram").agg(F.sum("n").alias("n")), f"{path}/sums")
    for low_order in (LOW, 1):
        low_mask = F.lit((1 << 8 * (low_order + 1)) - 1)
        low = sums.groupBy(F.col("gram").bitwiseAND(low_mask).alias("gram")).agg(F.sum("n").alias("n")).where("n > 0")
        low = materialize(low, f"{path}/low-{low_order}")
        if low.count() <= LOW_ROWS:
            break
    low = low.toArrow().sort_by("gram")
    sent = share(spark, levels(low["gram"].to_numpy().astype(np.uint64), low["n"].to_numpy(), low_order, []))
    branch_mask = (1 << 8 * (low_order + 2)) - 256

    def evaluate(table: pa.Table) -> pa.Table:
        table = table.sort_by("gram")
        keys, n = table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy()
        trie = levels(keys[n > 0], n[n > 0], order, sent())
        return pa.table({"gram": table["gram"], "p": pa.array(log_probability(trie, keys), pa.float64())})

    branches = max(4 * partitions(spark), -(-sums.count() // BRANCH))
    branch = F.pmod(F.xxhash64(F.col("gram").bitwiseAND(F.lit(branch_mask))), F.lit(branches))
    known = sums.withColumn("branch", branch).groupBy("branch").applyInArrow(lambda t: evaluate(t.select(["gram", "n"])), "gram long, p double")
    known = materialize(known, f"{path}/known")

    # Rows of a batch: its words, its runs, and one with its documents.
    none = F.lit(None)
    no_doc = none.cast("binary").alias("doc")
    rows = words.select("batch", "word", none.cast("long").alias("gram"), F.col("c").cast("double").alias("v"), no_doc)
    rows = rows.unionByName(grams.join(known, "gram").select("batch", none.cast("binary").alias("word"), "gram", F.col("p").alias("v"), no_doc))
    rows = rows.unionByName(batches.select("batch", none.cast("binary").alias("word"), none.cast("long").alias("gram"), none.cast("double").alias("v"), "doc"))
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")], *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]])

    def measure(doc: pa.Table, grams: pa.Table, words: pa.Table) -> pa.Table:
        ids, starts, _, held, data = opened(doc["doc"][0].as_buffer())
        n = len(starts)
        table = Lookup(grams["gram"].to_numpy().astype(np.uint64), grams["v"].to_numpy())
        scores = np.zeros(n)
        for at, codes in windows(np.frombuffer(data, np.uint8), starts, order):
            first = np.searchsorted(starts, at[0], side="right") - 1
            doc = np.searchsorted(starts, at, side="right") - 1 - first
            sums = np.bincount(doc, weights=table.get(codes))
            scores[first : first + len(sums)] += sums
        del table, grams
        known, count = words["word"].combine_chunks().cast(pa.large_binary()), words["v"].to_numpy()
        end = count[known.index(END).as_py()]
        n_tokens, n_known, base = np.ones(n, np.int64), np.full(n, int(end > 0), np.int64), np.full(n, np.log10(end + 1))
        for words, doc in words_of(np.frombuffer(data, np.uint8)):
            c = count[pc.index_in(words, value_set=known).to_numpy()]
            n_tokens += np.bincount(doc, minlength=n)
            n_known += np.bincount(doc[c > 0], minlength=n)
            base += np.bincount(doc, weights=np.log10(c + 1), minlength=n)
        base += n_tokens * unknown
        columns = [ids, pa.array(held), pa.array(n_tokens), pa.array(n_known), pa.array(np.full(n, n_train), pa.int64()), pa.array(base), pa.array(scores)]
        return pa.table(columns, names=schema.names)

    def measured(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (["doc"], ["gram", "v"], ["word", "v"])
        parts: dict[int, tuple[list, ...]] = {}
        for some in source:
            number = some.column("batch")
            for batch in pc.unique(number).to_pylist():
                for out, names in zip(parts.setdefault(batch, ([], [], [])), kinds, strict=True):
                    mine = pc.and_(pc.equal(number, batch), some.column(names[0]).is_valid())
                    # Filtered rows are a copy, so that what came with them goes.
                    out.append(some.select(names).filter(mine))
        while parts:
            yield from measure(*(pa.Table.from_batches(p) for p in parts.popitem()[1])).to_batches()

    # A batch a task, with no sort and no group held by Spark.  Where partitions differ so much that most
    # places would be empty, a task may get several batches.
    parts, per, n = batches.select((F.shiftright("batch", 32) + 1).alias("part"), (F.col("batch").bitwiseAND(F.lit(0xFFFFFFFF)) + 1).alias("per")).agg(F.max("part"), F.max("per"), F.count(F.lit(1))).first()
    places = max(1, min((parts or 0) * (per or 0), 4 * n))
    place = F.pmod(F.shiftright("batch", 32) * F.lit(per or 0) + F.col("batch").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(places)).cast("int")
    return rows.repartitionById(places, place).mapInArrow(measured, schema)
