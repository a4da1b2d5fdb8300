"""Quality classifier by co-training of two views (operator 6)."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import binary, materialize, sliced, workspace

#: Expected rows of the labelled sample.  All other rows are unlabelled ones, and all of them are in the exchange.
LABELLED = 8000
#: Rounds of exchange, and the share of rows that a view labels for the other in each, those it is surest of.
ROUNDS, GIVEN = 4, 0.2
#: Sums of tasks that are added up at once.
FAN = 16
META_SLOTS = 128


def text_features(text: bytes) -> np.ndarray:
    """Features of a text's content: byte frequencies and word statistics, 264 in all."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    freq = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / size
    longest, run = 1, 1
    repeats = 0
    for a, b in zip(words, words[1:], strict=False):
        run = run + 1 if a == b else 1
        repeats += a == b
        longest = max(longest, run)
    lines = [x for x in text.split(b"\n") if x]
    extra = [
        len(set(words)) / n,
        repeats / n,
        np.log1p(longest),
        np.log1p(n),
        sum(map(len, words)) / n / 10,
        np.log1p(n / max(1, len(lines))),
        sum(w.isupper() for w in words) / n,
        sum(not w.isalnum() and w.isascii() for w in words) / n,
    ]
    return np.concatenate([np.sqrt(freq), extra]).astype(np.float32)


def meta_features(values: Sequence) -> np.ndarray:
    """One slot for each metadata column's value, by hash; numbers count by their half powers of two."""
    out = np.zeros(META_SLOTS, np.float32)
    for i, v in enumerate(values):
        v = round(2 * np.log2(abs(v) + 1)) if isinstance(v, int | float) and v == v else v
        out[zlib.crc32(f"{i}={v}".encode()) % META_SLOTS] = 1
    return out


@dataclass
class Logistic:
    """Logistic regression on standardized features with Platt calibration."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    platt: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, steps: int = 25) -> Logistic:
        x = x.astype(np.float64)
        mean, scale = x.mean(0), x.std(0)
        scale[scale < 1e-6] = 1.0
        self = cls(mean, scale, np.zeros(x.shape[1] + 1))
        for _ in range(steps):
            if np.abs(self.step(*self.sums(x, y, np.ones(len(x)), 1e-5))).max() < 1e-4:
                break
        return self

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def sums(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, least: float = 0.25) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of the weighted log loss; they add up over rows, wherever these are.

        A row's curvature is ``p * (1 - p)``, but ``least`` at least.  With a
        quarter it is a bound of the true one everywhere, so that a step on it
        never overshoots, however sure the model is of a row with another label.
        """
        z = self.standard(x)
        p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
        return z.T @ (weight * (p - y)), (z * (weight * np.maximum(p * (1 - p), least))[:, None]).T @ z

    def step(self, gradient: np.ndarray, hessian: np.ndarray, ridge: float = 1.0) -> np.ndarray:
        """One Newton step on a curvature."""
        reg = np.full(len(self.w), ridge)
        reg[-1] = 1e-6
        step = np.linalg.solve(hessian + np.diag(reg), gradient + reg * self.w)
        self.w = self.w - step
        return step

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.w

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling on held-out rows, with Platt's smoothed targets."""
        s, pos = self.raw(x), y.sum()
        t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
            v = np.maximum(p * (1 - p), 1e-6)
            g = np.array([((p - t) * s).sum() + 1e-3 * (a - 1), (p - t).sum()])
            h = np.array([[(v * s * s).sum() + 1e-3, (v * s).sum()], [(v * s).sum(), v.sum() + 1e-6]])
            da, db = np.linalg.solve(h, g)
            a, b = max(a - da, 0.0), b - db
            if abs(da) + abs(db) < 1e-6:
                break
        self.platt = float(a), float(b)

    def loss(self, x: np.ndarray, y: np.ndarray) -> float:
        """The mean log loss of the calibrated view."""
        z = self.logit(x)
        return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean())

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.platt[0] * self.raw(x) + self.platt[1], -30, 30)


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


@dataclass
class Round:
    """One exchange: good and bad pseudo-labels that the text view gave, and the metadata view; their weights; and which views learnt from it."""

    by_text: tuple[int, int]
    by_meta: tuple[int, int]
    weight_by_text: float
    weight_by_meta: float
    learnt: tuple[bool, ...] = ()


@dataclass
class CoTrained:
    """Two calibrated views and the prior log odds; ``views`` is empty without both classes."""

    views: list[Logistic]
    prior: float
    rounds: list[Round]

    def scores(self, views: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each view's calibrated probability and the combined one, views taken as independent given the class."""
        if not self.views:
            one = np.ones(len(views[0]))
            return one, one, one
        a, b = (m.logit(x) for m, x in zip(self.views, views, strict=True))
        return tuple(probability(z) for z in (a, b, np.clip(a + b - self.prior, -30, 30)))


@dataclass
class Exchange:
    """What a round needs to know to give pseudo-labels: the views, and from which logits each is sure.

    A view gives a label where its calibrated logit is beyond a quantile of its
    logits on held-out labelled rows: the share ``GIVEN`` of rows that it is
    surest of, in the classes' proportion.  So a weak view, too, has rows that
    it is surest of.  A label weighs the square of what its calibrated probability
    exceeds the class's share by, as a part of what it could, so that a view
    that knows little says little: the noise of weak labels grows as that square.
    """

    views: list[Logistic]
    share: float
    bounds: list[tuple[float, float]]

    @classmethod
    def plan(cls, views: list[Logistic], aside: Sequence[np.ndarray], share: float, given: float) -> Exchange:
        logits = [cls.settled(m.logit(x)) for m, x in zip(views, aside, strict=True)]
        return cls(views, share, [(float(np.quantile(z, given * (1 - share))), float(np.quantile(z, 1 - given * share))) for z in logits])

    @staticmethod
    def settled(logits: np.ndarray) -> np.ndarray:
        """Without the last digits, in which equal rows may differ by the batch they are in."""
        return np.round(logits, 7)

    def labels(self, v: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, labels and weights of the rows that view ``v`` is sure of."""
        z, (low, high) = self.settled(self.views[v].logit(x)), self.bounds[v]
        good, bad = z >= high, z <= low
        at = np.flatnonzero(good ^ bad)
        p, y = probability(z[at]), good[at].astype(np.float64)
        sure, prior = np.where(y > 0, p, 1 - p), np.where(y > 0, self.share, 1 - self.share)
        return at, y, np.maximum(0.0, (sure - prior) / (1 - prior)) ** 2

    def sums(self, batches: Iterator[Sequence[np.ndarray]]) -> np.ndarray:
        """Over unlabelled rows, in one array: labels given and their weight by view, and what they add to the other view."""
        sizes = [len(m.w) for m in self.views]
        counts = np.zeros(6)
        parts = [(np.zeros(n), np.zeros((n, n))) for n in sizes]
        for x in batches:
            for v, other in ((0, 1), (1, 0)):
                at, y, weight = self.labels(v, x[v])
                counts[3 * v : 3 * v + 3] += (y > 0).sum(), (y <= 0).sum(), weight.sum()
                for total, more in zip(parts[other], self.views[other].sums(x[other][at], y, weight), strict=True):
                    total += more
        return np.concatenate([counts, *(a.ravel() for pair in parts for a in pair)])

    def opened(self, sums: np.ndarray) -> tuple[Round, list[tuple[np.ndarray, np.ndarray]]]:
        """The round's numbers, and each view's gradient and Hessian."""
        c, at, parts = sums[:6], 6, []
        for m in self.views:
            n = len(m.w)
            parts.append((sums[at : at + n], sums[at + n : at + n + n * n].reshape(n, n)))
            at += n + n * n
        return Round((int(c[0]), int(c[1])), (int(c[3]), int(c[4])), float(c[2]), float(c[5])), parts


def co_train(
    views: Sequence[np.ndarray],
    y: np.ndarray,
    unlabelled: Callable[[Exchange], np.ndarray],
    rounds: int = ROUNDS,
    given: float = GIVEN,
) -> CoTrained:
    """Fit both views on the labelled rows, then exchange pseudo-labels over rounds.

    ``views`` are each view's features of the labelled rows, ``unlabelled`` sums
    an exchange over all others.  A quarter of the labelled rows is set aside
    for calibration.  In a round each view labels for the other the rows that it
    is surest of; each takes a step on its labelled rows and what it was
    given, which together weigh no more than the labelled ones; and both are
    calibrated again.  A step after which a view's log loss is higher on the rows
    set aside is taken back, so that no exchange makes a view worse there.
    """
    y = y.astype(np.float64)
    aside = np.arange(len(y)) % 4 == 3
    if min((y[aside] > 0).sum(), (y[aside] <= 0).sum(), (y[~aside] > 0).sum(), (y[~aside] <= 0).sum()) < 1:
        return CoTrained([], 0.0, [])
    share, told = float(y.mean()), []
    own, own_y, held, held_y = [x[~aside] for x in views], y[~aside], [x[aside] for x in views], y[aside]
    fitted = [Logistic.fit(x, own_y) for x in own]
    for m, x in zip(fitted, held, strict=True):
        m.calibrate(x, held_y)
    for _ in range(rounds):
        exchange = Exchange.plan(fitted, held, share, given)
        told_now, parts = exchange.opened(unlabelled(exchange))
        told.append(told_now)
        for m, x, x_held, (gradient, hessian), weight in zip(
            fitted,
            own,
            held,
            parts,
            (told_now.weight_by_meta, told_now.weight_by_text),
            strict=True,
        ):
            scale = len(own_y) / max(len(own_y), weight)
            before, loss = (m.w, m.platt), m.loss(x_held, held_y)
            g, h = m.sums(x, own_y, np.ones(len(x)))
            m.step(g + scale * gradient, h + scale * hessian)
            m.calibrate(x_held, held_y)
            better = m.loss(x_held, held_y) <= loss
            if not better:
                m.w, m.platt = before
            told_now.learnt += (better,)
    return CoTrained(fitted, float(np.log(share / (1 - share))), told)


def features(batch: pa.RecordBatch, text_at: int, meta_at: Sequence[int]) -> list[np.ndarray]:
    text = np.array([text_features(t or b"") for t in binary(batch.column(text_at))], np.float32).reshape(batch.num_rows, -1)
    meta = np.array(
        [meta_features(v) for v in zip(*(batch.column(i).to_pylist() for i in meta_at), strict=True)],
        np.float32,
    ) if meta_at else np.zeros((batch.num_rows, META_SLOTS), np.float32)
    return [text, meta.reshape(batch.num_rows, META_SLOTS)]


def unpacked(batch: pa.RecordBatch, columns: Sequence[str] = ("text", "meta")) -> list[np.ndarray]:
    """The views' features of packed rows."""
    return [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float32).reshape(batch.num_rows, -1) for c in columns]


def summed(rows: DataFrame, exchange: Exchange) -> np.ndarray:
    """An exchange over all packed rows: summed in each task, then ``FAN`` tasks at a time until few are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = exchange.sums(unpacked(b.slice(at, 4096)) for b in batches for at in range(0, b.num_rows, 4096))
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())],
            names=["part", "sums"],
        )

    def add(table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(x.as_py(), np.float64) for x in table["sums"]]
        return pa.table({"part": table["part"][:1], "sums": pa.array([np.sum(arrays, axis=0).tobytes()], pa.binary())})

    parts, n = rows.mapInArrow(run, "part long, sums binary"), rows.rdd.getNumPartitions()
    while n > 1:
        n = math.ceil(n / FAN)
        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("of")).applyInArrow(add, "part long, sums binary").select(
            F.floor(F.col("part") / FAN).alias("part"),
            "sums",
        )
    found = [np.frombuffer(r["sums"], np.float64) for r in parts.collect()]
    return np.sum(found, axis=0) if found else exchange.sums(iter(()))


def packed_rows(
    docs: DataFrame,
    labels: DataFrame,
    path: str,
    id_col: str,
    text_col: str,
    meta_cols: Sequence[str],
    label_col: str,
    labelled: int,
) -> DataFrame:
    """Every document's ``id``, packed features ``text`` and ``meta``, and its label ``y`` if it is in the labelled sample."""
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("double").alias("y"))
    cut = 1 << 30
    at = F.pmod(F.xxhash64("id", F.lit("labelled")), F.lit(cut))
    chosen = marks.where(at < int(cut * min(1.0, labelled / max(1, marks.count())))).withColumn("y", F.when(F.col("y") > 0, 1.0).otherwise(0.0))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        *[F.col(c).alias(f"m{i}") for i, c in enumerate(meta_cols)],
    )
    rows = rows.join(F.broadcast(chosen), "id", "left")
    n_meta = len(meta_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 1):
                views = features(batch, 1, range(2, 2 + n_meta))
                packed = [pa.array([x.tobytes() for x in v], pa.binary()) for v in views]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *packed, batch.column(batch.num_columns - 1)],
                    names=["id", "text", "meta", "y"],
                )

    binaries = [T.StructField(c, T.BinaryType()) for c in ("text", "meta")]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *binaries, T.StructField("y", T.DoubleType())])
    return materialize(rows.mapInArrow(run, schema), f"{path}/features")


def fit(rows: DataFrame, rounds: int = ROUNDS) -> CoTrained:
    """Co-train on packed rows; those with a label come to the driver, of the others only sums."""
    found = rows.where("y IS NOT NULL").toArrow()
    if not found.num_rows:
        return CoTrained([], 0.0, [])
    found = found.set_column(0, "id", found["id"].cast(pa.string())).sort_by([("id", "ascending"), ("text", "ascending"), ("meta", "ascending")])
    rest = rows.where("y IS NULL").select("text", "meta")
    return co_train(unpacked(found), found["y"].to_numpy(), lambda exchange: summed(rest, exchange), rounds)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta_cols: Sequence[str] = ("lang", "source", "n_chars"),
    label_col: str = "quality",
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
) -> CoTrained:
    """Co-train on about ``labelled`` labelled rows, chosen by hash of the id, and all others.

    A document with several labels has the least; null labels and ids don't
    count.  Rows that repeat an id are rows each; ties at a bound are all given.
    Extra columns are ignored.  Without rows of both classes the model has no
    views and scores all rows 1.  Features are written once; a round reads them
    in parallel and adds up gradients, so that the driver sees sums only.
    """
    path = workspace(docs.sparkSession, "cotraining")
    return fit(packed_rows(docs, labels, path, id_col, text_col, meta_cols, label_col, labelled), rounds)


def score_schema(kind: T.DataType, id_col: str) -> T.StructType:
    scores = [T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "quality_score")]
    return T.StructType([T.StructField(id_col, kind), *scores, T.StructField("kept", T.BooleanType())])


def train_and_score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta_cols: Sequence[str] = ("lang", "source", "n_chars"),
    label_col: str = "quality",
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
    threshold: float = 0.5,
) -> DataFrame:
    """``score`` of the documents that the model is trained on, as ``train`` does, from features that are made once."""
    rows = packed_rows(docs, labels, workspace(docs.sparkSession, "cotraining"), id_col, text_col, meta_cols, label_col, labelled)
    model = fit(rows, rounds)
    schema = score_schema(docs.schema[id_col].dataType, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 4096) for b in batches for at in range(0, b.num_rows, 4096)):
            found = model.scores(unpacked(batch))
            columns = [batch.column(0), *[pa.array(s, pa.float64()) for s in found], pa.array(found[2] >= threshold)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select("id", "text", "meta").mapInArrow(run, schema)


def score(
    docs: DataFrame,
    model: CoTrained,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta_cols: Sequence[str] = ("lang", "source", "n_chars"),
    threshold: float = 0.5,
) -> DataFrame:
    """``id_col``, ``text_score``, ``meta_score``, ``quality_score``, ``kept`` of every row.

    Scores are probabilities of good quality; a score of ``threshold`` is kept.
    Null and empty texts are scored by what they are: a text without bytes.
    Null metadata is a value of its own.  Texts are read whole, however long.
    Repeated rows and null ids are scored each; extra columns are ignored.
    """
    schema = score_schema(docs.schema[id_col].dataType, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 1):
                found = model.scores(features(batch, 1, range(2, batch.num_columns)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(s, pa.float64()) for s in found], pa.array(found[2] >= threshold)],
                    names=schema.names,
                )

    return docs.select(id_col, text_col, *meta_cols).mapInArrow(run, schema)


def keep_good(
    docs: DataFrame,
    model: CoTrained,
    text_col: str = "text",
    meta_cols: Sequence[str] = ("lang", "source", "n_chars"),
    threshold: float = 0.5,
) -> DataFrame:
    """``docs`` without those scored below ``threshold``; all columns stay, whatever their names.

    Nulls, empty and long texts and repeated rows are as in ``score``.
    """
    text_at, meta_at = docs.columns.index(text_col), [docs.columns.index(c) for c in meta_cols]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, text_at):
                yield batch.filter(pa.array(model.scores(features(batch, text_at, meta_at))[2] >= threshold))

    return docs.mapInArrow(run, docs.schema)
