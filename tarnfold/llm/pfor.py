"""Token ids in patched frame-of-reference files (operator 5).

A corpus is a Parquet table of segments.  Each is a whole number of documents,
in ascending order, and its ``payload`` is this format, little-endian:

    b"PFR1", then int64: documents, ids, blocks
    int64 document ids, uint8 whether each is present
    int64 ids of the segment before each document, and of all
    by block: uint32 minimum, uint8 width, uint8 exceptions,
              uint32 start of its packed words, uint32 start of its exceptions
    uint32 packed words; by exception: uint8 position, uint32 high bits

A block has 128 ids.  Its minimum is subtracted, the low ``width`` bits of the
differences are packed, and those with more bits are patched by exceptions.
The width is the smallest that holds the ``PERCENTILE`` of the differences.
The starts index the blocks: any one can be read without those before it.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ._shared import binary, partitions, sliced, workspace

BLOCK, LANES, PERCENTILE = 128, 32, 0.95
#: Ids after which a segment is closed; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 20
#: Parts of words whose ids a worker process remembers at once, and bytes of text that are looked up together.
MEMO, TEXT = 600_000, 8 << 20


def bit_width(x: np.ndarray) -> np.ndarray:
    """Bits that each unsigned number needs, 32 at most."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def lanes(w: int) -> Iterator[tuple[int, int, int]]:
    """For each lane of 32: its first word of ``w`` and shift, and the bits that fit there."""
    for i in range(LANES):
        yield i * w // 32, i * w % 32, min(w, 32 - i * w % 32)


def encode(doc_ids: list[int | None], lens: np.ndarray, ids: np.ndarray) -> bytes:
    """The payload of a segment."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    x = np.resize(np.zeros(0, np.uint32), blocks * BLOCK)
    x[:n] = ids
    if n % BLOCK:
        x[n:] = ids[n // BLOCK * BLOCK :].min()
    x = x.reshape(blocks, BLOCK)
    low = x.min(1) if blocks else np.zeros(0, np.uint32)
    x -= low[:, None]
    widths = bit_width(x)
    k = max(0, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    width = np.partition(widths, k, axis=1)[:, k] if blocks else np.zeros(0, np.uint8)
    row, at = np.nonzero(widths > width[:, None])
    high = x[row, at] >> width[row].astype(np.uint32)
    exceptions = np.bincount(row, minlength=blocks).astype(np.uint8)
    starts = np.concatenate([[0], np.cumsum(width.astype(np.int64) * (BLOCK // 32))])
    patches = np.concatenate([[0], np.cumsum(exceptions, dtype=np.int64)])
    words = np.zeros(starts[-1], np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        v = (x[own] & np.uint32((1 << w) - 1)).reshape(len(own), LANES, -1)
        out = np.zeros((len(own), w, BLOCK // LANES), np.uint32)
        for i, (word, shift, fits) in enumerate(lanes(w)):
            out[:, word] |= v[:, i] << np.uint32(shift)
            if fits < w:
                out[:, word + 1] |= v[:, i] >> np.uint32(fits)
        words[starts[own][:, None] + np.arange(w * (BLOCK // LANES))] = out.reshape(len(own), -1)
    parts = [
        np.array([len(lens), n, blocks], "<i8"), np.array([d or 0 for d in doc_ids], "<i8"), np.array(
            [d is not None for d in doc_ids],
            np.uint8,
        ),
        np.concatenate([[0], np.cumsum(lens)]).astype("<i8"), low.astype("<u4"), width, exceptions,
        starts.astype("<u4"), patches.astype("<u4"), words.astype("<u4"), at.astype(np.uint8), high.astype("<u4"),
    ]
    return b"PFR1" + b"".join(p.tobytes() for p in parts)


class Segment:
    """A reader of one payload, which decodes the blocks that are asked for."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != b"PFR1":
            raise ValueError("not a PFR1 segment")
        self.buffer, self.at = payload, 4
        docs, self.n, blocks = self.take("<i8", 3).tolist()
        ids, present = self.take("<i8", docs), self.take("u1", docs)
        self.doc_ids = [d if p else None for d, p in zip(ids.tolist(), present.tolist(), strict=True)]
        self.offsets = self.take("<i8", docs + 1)
        self.low, self.width, self.exceptions = self.take("<u4", blocks), self.take("u1", blocks), self.take("u1", blocks)
        self.starts, self.patches = self.take("<u4", blocks + 1), self.take("<u4", blocks + 1)
        self.words = self.take("<u4", int(self.starts[-1]))
        self.places, self.high = self.take("u1", int(self.patches[-1])), self.take("<u4", int(self.patches[-1]))

    def take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.buffer, kind, n, self.at)
        self.at += out.nbytes
        return out

    def blocks(self, first: int, end: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``end``."""
        width = self.width[first:end]
        x = np.zeros((len(width), BLOCK), np.uint32)
        for w in np.unique(width[width > 0]).tolist():
            own = np.flatnonzero(width == w)
            packed = self.words[self.starts[first + own].astype(np.int64)[:, None] + np.arange(w * (BLOCK // LANES))].reshape(len(own), w, -1)
            v = np.empty((len(own), LANES, BLOCK // LANES), np.uint32)
            for i, (word, shift, fits) in enumerate(lanes(w)):
                v[:, i] = packed[:, word] >> np.uint32(shift)
                if fits < w:
                    v[:, i] |= packed[:, word + 1] << np.uint32(fits)
            x[own] = v.reshape(len(own), BLOCK) & np.uint32((1 << w) - 1)
        a, b = int(self.patches[first]), int(self.patches[end])
        row = np.repeat(np.arange(len(width)), self.exceptions[first:end])
        x[row, self.places[a:b]] |= self.high[a:b] << width[row].astype(np.uint32)
        return (x + self.low[first:end, None]).ravel()

    def ids(self, start: int, end: int) -> np.ndarray:
        first = start // BLOCK
        return self.blocks(first, -(-end // BLOCK))[start - first * BLOCK : end - first * BLOCK] if end > start else np.zeros(0, np.uint32)


class WordIds:
    """Token ids of pieces of text between blanks, as bytes; forgets all when full.

    This holds for tokenizers that drop white space, ignore case and never join
    letters to what isn't a letter, nor across white space.  A piece that is
    letters and then ASCII marks is cut between them.  Pieces and then parts
    are made distinct in whole arrays, so that each is looked up once a batch.
    Parts that aren't known yet are encoded by the library: letters by its model
    alone, spelled as its pre-tokenizer does, as nothing else changes or cuts
    them; others together, many in one text, where the places of the tokens tell
    which are whose.
    """

    #: Letters that have one lower-case form, and marks that join with no letter.
    LETTERS = "".join(chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7))
    LOWER = "".join(c for c in LETTERS if c.islower())
    MARKS = "".join(chr(c) for c in range(0x21, 0x7F) if c != 0x27 and not chr(c).isalnum())
    PARTS = rf"^[{LETTERS}]+[{re.escape(MARKS)}]*$"

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.known: dict[str, bytes] = {"": b""}
        self.lower = re.compile(f"[{self.LOWER}]+")
        before = tokenizer.pre_tokenizer
        self.spelled = str.maketrans({c: "".join(p for p, _ in before.pre_tokenize_str(c)) for c in self.LOWER})
        probe = [*self.LOWER, *(f"{c}a{c}" for c in self.LOWER), self.LOWER]
        self.learn_letters(probe)
        #: Whether the model alone gives the library's ids of letters.
        self.alone = [self.known[w] for w in probe] == [np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in probe]
        self.known = {"": b""}

    @classmethod
    def of_process(cls, path: str, tokenizer) -> WordIds:
        """What this worker process knows from earlier tasks of the tokenizer at ``path``."""
        memo = sys.modules.setdefault("_tarnfold_memo", ModuleType("_tarnfold_memo")).__dict__
        return memo[path] if path in memo else memo.setdefault(path, cls(tokenizer))

    def keep(self, words: list[str], ids: list[int], ends: list[int]) -> None:
        raw = np.array(ids, "<u4").tobytes()
        self.known.update(zip(words, (raw[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)), strict=True))

    def learn_letters(self, words: list[str]) -> None:
        tokenize, spelled = self.tokenizer.model.tokenize, self.spelled
        ids: list[int] = []
        ends = []
        for w in words:
            ids += [t.id for t in tokenize(w.translate(spelled))]
            ends.append(len(ids))
        self.keep(words, ids, ends)

    def learn(self, words: list[str]) -> None:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        places = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
        self.keep(words, found.ids, np.searchsorted(places, ends).tolist())

    def look_up(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts."""
        if len(self.known) > MEMO:
            self.known = {"": b""}
        new = [p for p in parts if p not in self.known]
        letters = {p for p in new if self.lower.fullmatch(p)} if self.alone else set()
        for do, words in ((self.learn_letters, list(letters)), (self.learn, [p for p in new if p not in letters])):
            for i in range(0, len(words), 10_000):
                do(words[i : i + 10_000])
        return [self.known[p] for p in parts]

    def encode(self, docs: pa.Array | list[list[str]]) -> Iterator[bytes]:
        """Ids of each document, which is a list of pieces."""
        if not isinstance(docs, pa.Array):
            docs = pa.array(docs, pa.list_(pa.string()))
        pieces = docs.flatten().dictionary_encode()
        words = pieces.dictionary
        plain = pc.match_substring_regex(words, self.PARTS)
        letters = pc.if_else(plain, pc.utf8_lower(pc.ascii_rtrim(words, self.MARKS)), words)
        marks = pc.if_else(plain, pc.utf8_ltrim(words, self.LETTERS), "")
        parts = pa.concat_arrays([letters, marks]).dictionary_encode()
        ids = pa.array(self.look_up(parts.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(parts.indices)
        ids = pc.binary_join_element_wise(ids[: len(words)], ids[len(words) :], pa.scalar(b"", pa.large_binary()))
        ids = ids.take(pieces.indices)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy())])
        ends = ends[docs.offsets.to_numpy() - docs.offsets[0].as_py()].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        return (bytes(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False))


SEGMENTS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()), T.StructField("first_id", T.LongType()), T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("payload", T.BinaryType())])


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize whole texts and write them to ``path`` in ascending id order.

    ``tokenizer_path`` is a file of the tokenizers library whose pre-tokenizer
    drops white space and case and
    cuts between letters and marks (checked on a sample text); every executor can open it.
    ``end_id`` ends each document.  A null text is empty; rows of null id come
    first; rows that repeat an id are ordered by text.  Extra columns are ignored.
    One range shuffle orders the texts; a task then encodes as it reads, so that
    its memory is a segment and a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        probe = " Ab,  b\nc\td\re\vf\fg. "
        if tokenizer.encode(probe, add_special_tokens=False).ids != [
            i
            for w in ("ab", ",", *"bcdefg", ".") for i in tokenizer.encode(w, add_special_tokens=False).ids
        ]:
            raise ValueError("the tokenizer doesn't drop white space and case or joins words and marks")
        known, part, seq = WordIds.of_process(tokenizer_path, tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        doc_ids: list = []
        texts: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            lens = np.array([len(t) // 4 for t in texts], np.int64)
            payload = encode(doc_ids, lens, np.frombuffer(b"".join(texts), "<u4"))
            row = [[part], [seq], [doc_ids[0]], [len(doc_ids)], [int(lens.sum())], [payload]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(v, t)
                    for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)
                ],
                names=SEGMENTS.names,
            )

        for batch in (part for whole in batches for part in sliced(whole, 1, TEXT)):
            pieces = pc.ascii_split_whitespace(pc.fill_null(batch.column(1), ""))
            for doc, ids in zip(batch.column(0).to_pylist(), known.encode(pieces), strict=True):
                ids += end
                doc_ids.append(doc)
                texts.append(ids)
                held += len(ids) // 4
                if held >= SEGMENT_IDS:
                    yield close()
                    doc_ids, texts, held, seq = [], [], 0, seq + 1
        if doc_ids:
            yield close()

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(partitions(df.sparkSession), "id").sortWithinPartitions("id", "text")
    rows.mapInArrow(run, SEGMENTS).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents from the files at ``path``: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, and ``ids`` if asked for.

    ``start`` counts the ids of all documents before; it is read from the index
    columns alone, summed by written part, of which there are few.
    """
    index = spark.read.schema(SEGMENTS).parquet(path)
    inner = Window.partitionBy("part").orderBy("seq")
    starts = index.select("part", "seq", (F.sum("n_tokens").over(inner) - F.col("n_tokens")).alias("inside"))
    whole = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = whole.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    starts = starts.join(before, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("at"))
    fields = [
        T.StructField("part", T.IntegerType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("local", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(batch.column(0), batch.column(1), binary(batch.column(2)), strict=True):
                segment = Segment(payload)
                n, offsets = len(segment.doc_ids), segment.offsets.tolist()
                raw = memoryview(segment.ids(0, segment.n).astype("<u4").tobytes())
                docs = [raw[4 * a : 4 * b] for a, b in zip(offsets, offsets[1:], strict=False)]
                columns = [
                    pa.array([part.as_py()] * n, pa.int32()),
                    pa.array([seq.as_py()] * n, pa.int32()),
                    pa.array(segment.doc_ids, pa.int64()),
                    pa.array(offsets[:-1], pa.int64()),
                    pa.array(np.diff(segment.offsets), pa.int64()),
                    pa.array([zlib.crc32(d) for d in docs], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([bytes(d) for d in docs], pa.binary())] * with_ids, names=schema.names)

    docs = index.select("part", "seq", "payload").mapInArrow(run, schema)
    columns = ["doc_id", (F.col("at") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"]
    return docs.join(starts, ["part", "seq"]).select(*columns, *["ids"] * with_ids)


def encode_corpus(df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write a corpus to the shared folder and read its documents back from there."""
    path = workspace(df.sparkSession, "tokens") + "/segments"
    write_tokens(df, path, tokenizer_path, end_id, id_col, text_col)
    return read_tokens(df.sparkSession, path)
