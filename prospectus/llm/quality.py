"""Operator 7: quality classifier, random Fourier features and ridge regression.

Every whole text is described by ``STATS`` (byte classes, word lengths,
repetition).  The standardised statistics go through ``FEATURES`` random Fourier
features, which approximate a Gaussian kernel; ridge regression on the label is
solved from normal equations.  Tasks sum their share of the equations in numpy
and Spark adds the shares entry by entry, so the driver gets one matrix of fixed
size however many rows are labelled.  Scores are calibrated by isotonic
regression over a histogram of fixed size, also added up by Spark.

Only the text is an input of a score.  Labels are learned from rows outside the
held-out fold.

Defined cases: null and empty texts have all-zero statistics and are scored like
any other; labelled rows with null id or label are not learned from; several
labels of one document all count, and of several texts of an id all are learned from; with
no labelled row every score is 0.5; repeated rows get a score each; very long texts are
described whole, one at a time; columns beyond doc_id and text are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum
from .common import fold, held_out, read_table, text_marks, without, written

FEATURES = 192
RIDGE = 1e-3
#: width of the Gaussian kernel, in units of standardised statistics, per square root of their number
WIDTH = 1.0
BINS = 1000
SEED = 7

STATS = ("log_bytes", "log_words", "upper", "digit", "space", "line_end", "bar", "sentence_mark", "other_ascii",
         "high_bytes", "letters", "mean_word", "sd_word", "distinct_words", "top_word", "repeats_last",
         "distinct_pairs", "distinct_triples", "marked_words", "long_words")


def _classes() -> np.ndarray:
    c = np.full(256, 7, dtype=np.uint8)  # other ASCII
    c[[32, 9, 11, 12, 13]] = 3
    c[10] = 4
    c[65:91], c[97:123], c[48:58] = 0, 1, 2
    c[ord("|")] = 5
    c[[ord(x) for x in ".,;:'\"?-()"]] = 6
    c[128:] = 8
    return c


_CLASS = _classes()


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """One row of ``STATS`` per text."""
    out = np.zeros((len(texts), len(STATS)))
    for lo, hi in textnum.slices(texts):
        out[lo:hi] = _statistics([t or b"" for t in texts[lo:hi]])
    return out


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values per text, count of the commonest value per text)."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))))
    runs = np.diff(np.concatenate((first, [len(h)])))
    top = np.zeros(n)
    np.maximum.at(top, doc[first], runs)
    return np.bincount(doc[first], minlength=n).astype(float), top


def _statistics(texts: list[bytes]) -> np.ndarray:
    n = len(texts)
    size = np.fromiter(map(len, texts), dtype=np.int64, count=n)
    ends = np.concatenate(([0], np.cumsum(size)))
    cls = _CLASS[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    share = [_per_text(cls == k, ends) / np.maximum(size, 1) for k in range(9)]
    h, off, length = textnum.words(texts)
    m = np.diff(off)
    some = np.maximum(m, 1)
    doc = np.repeat(np.arange(n), m)
    mean = _per_text(length, off) / some
    sd = np.sqrt(np.maximum(_per_text(length.astype(float) ** 2, off) / some - mean**2, 0))
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    words, top = _distinct(h, doc, n)
    follow = []
    joined = h
    for k in (1, 2):
        joined = textnum.mix(joined[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[k:]) if len(joined) > 1 else joined[:0]
        ok = doc[: len(joined)] == doc[k:k + len(joined)]
        count = np.maximum(m - k, 1)
        follow.append(_distinct(joined[ok], doc[: len(joined)][ok], n)[0] / count)
    # words whose last byte is ASCII punctuation beyond sentence marks
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    last = np.flatnonzero((_CLASS[buf[:-1]] == 7) & np.isin(_CLASS[buf[1:]], (3, 4)))
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    marked = np.diff(np.searchsorted(last, begin))
    return np.column_stack([
        np.log1p(size), np.log1p(m), share[0], share[2], share[3], share[4], share[5], share[6], share[7], share[8],
        share[1], mean, np.minimum(sd, 50), words / some, top / some, _per_text(same, off) / some, follow[0], follow[1],
        marked / some, _per_text(length > 25, off) / some])


def document_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, text, ...) -> the columns to keep (of type long) and stats array<double>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = statistics(b.column("text").cast(pa.binary()).to_pylist())
            flat = pa.ListArray.from_arrays(np.arange(len(s) + 1, dtype=np.int32) * len(STATS), pa.array(s.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), flat], names=[*keep, "stats"])

    return docs.select(*keep, "text").mapInArrow(run, "".join(f"{c} long, " for c in keep) + "stats array<double>")


@dataclass
class Model:
    """A fitted classifier: fixed size, whatever it was fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    knots: np.ndarray
    values: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights + self.bias

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def fourier(x: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    w = rng.normal(0.0, 1.0 / (WIDTH * np.sqrt(len(STATS))), (len(STATS), FEATURES))
    return np.sqrt(2.0 / FEATURES) * np.cos(np.clip(x, -8, 8) @ w + rng.uniform(0, 2 * np.pi, FEATURES))


def isotonic(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing fit to ``y`` with weights ``w``."""
    blocks: list[list[float]] = []
    for v, k in zip(y, w):
        blocks.append([v, k, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, k2, n2 = blocks.pop()
            v1, k1, n1 = blocks.pop()
            blocks.append([(v1 * k1 + v2 * k2) / (k1 + k2), k1 + k2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def _matrix(batches: Iterator[pa.RecordBatch], sums) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        stats = np.array(b.column("stats").flatten()).reshape(-1, len(STATS))
        s = sums(stats, np.array(b.column("label"), dtype=float))
        total = s if total is None else total + s
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())],
                                         names=["i", "v"])


def _added(rows: DataFrame, sums, shape: tuple[int, ...]) -> np.ndarray:
    """Sum ``sums(stats, label)`` over all rows: tasks add their own, Spark adds the tasks'."""
    out = np.zeros(int(np.prod(shape)))
    got = (rows.mapInArrow(lambda it: _matrix(it, sums), "i int, v double")
           .groupBy("i").agg(F.sum("v").alias("v")).toPandas())
    out[got["i"].to_numpy(dtype=int)] = got["v"].to_numpy()
    return out.reshape(shape)


def fit(rows: DataFrame) -> Model:
    """rows (stats, label 0/1), best a written table -> Model."""
    k = len(STATS)
    first = _added(rows, lambda s, y: np.vstack([s.sum(0), (s**2).sum(0), np.full(k, len(s)), np.full(k, y.sum())]), (4, k))
    n, ones = first[2, 0], first[3, 0]
    if not n:
        return Model(np.zeros(k), np.ones(k), np.zeros(FEATURES), 0.0, np.array([0.0]), np.array([0.5]))
    mean = first[0] / n
    scale = np.sqrt(np.maximum(first[1] / n - mean**2, 1e-12)) + 1e-6
    # the classes weigh the same, so that a rare one counts
    weigh = (n / (2 * max(n - ones, 1)), n / (2 * max(ones, 1)))

    def equations(s: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = np.column_stack([fourier((s - mean) / scale), np.ones(len(s))])
        wz = z * np.where(y > 0, weigh[1], weigh[0])[:, None]
        return np.column_stack([wz.T @ z, wz.T @ y])

    m = _added(rows, equations, (FEATURES + 1, FEATURES + 2))
    ridge = np.eye(FEATURES + 1) * RIDGE * n
    ridge[-1, -1] = 0
    sol = np.linalg.solve(m[:, :-1] + ridge, m[:, -1])
    model = Model(mean, scale, sol[:-1], sol[-1], np.array([0.0]), np.array([0.5]))

    def histogram(s: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(np.floor((model.raw(s) + 0.5) * BINS / 2), 0, BINS - 1).astype(int)
        return np.vstack([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    hist = _added(rows, histogram, (2, BINS))
    used = np.flatnonzero(hist[0])
    model.knots = (used + 0.5) * 2 / BINS - 0.5
    model.values = isotonic(hist[1, used] / hist[0, used], hist[0, used])
    return model


def score_documents(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs (doc_id, text), labels (doc_id, quality) -> doc_id, held_out, score, predicted for every row of docs.

    ``keep`` names further columns of type long to be returned.
    """
    stats = written(document_statistics(docs, keep), "quality-stats")
    learn = (labels.filter((fold("doc_id") != 1) & F.col("quality").isNotNull())
             .select("doc_id", F.col("quality").cast("int").alias("label")))
    model = fit(written(stats.join(learn, "doc_id").select("stats", "label"), "quality-learn"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # rounded, as the model's sums depend on the order in which Spark adds them
            s = np.round(shared.value.score(np.array(b.column("stats").flatten()).reshape(-1, len(STATS))), 9)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=[*keep, "score", "predicted"])

    return (stats.mapInArrow(run, "".join(f"{c} long, " for c in keep) + "score double, predicted int")
            .withColumn("held_out", held_out("doc_id"))
            .select("doc_id", "held_out", "score", "predicted", *(c for c in keep if c != "doc_id")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, each by its own text's score, whatever its id."""
    own = docs.select("doc_id", "text", *text_marks(docs["text"]))
    bad = score_documents(own, labels, ("doc_id", "m1", "m2")).filter("predicted = 0").select("doc_id", "m1", "m2").distinct()
    return without(docs, bad)


def op7_quality(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, read_table(spark, sf_dir, "labels"))
