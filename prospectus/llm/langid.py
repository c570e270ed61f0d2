"""Operator 9: language identification, multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; every run of non-letters is one blank, and all 1- to
3-grams with a letter are hashed into ``BUCKETS`` buckets.  Counting is one pass
over the learning rows: tasks sum dense counts per language in numpy and hand
Spark the buckets they met, so a language that holds most rows is pre-added
before the shuffle.  The model is a matrix of log probabilities, ``BUCKETS`` x
languages of doubles; its size does not depend on the number of documents, and
it is broadcast.  Batches are scored by gathering matrix rows.  More than
``BLOCK_LANGUAGES`` languages make a model for each block of them, and a pass over the
texts for each model, which carries the best language so far.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows with a null lang or id are never learned from; without any learned
language all texts are ``und``; the first language by code point wins ties; repeated
rows are learned from and judged each; very long texts are read whole; columns beyond
doc_id, text and lang are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, held_out, read_table, written

BUCKETS = 1 << 17
ORDERS = (1, 2, 3)
#: added to each bucket's count
SMOOTHING = 0.1
#: languages of one model, which is broadcast (1 MB each); more languages take more passes
BLOCK_LANGUAGES = 256
SLICE_CHARS = 1 << 20

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)
    return _letters


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, blanks for non-letters; each text has a blank before and two after it, so that
    no n-gram with a letter and single blanks belongs to two texts; offsets."""
    low = [t.lower() for t in texts]
    arr = np.frombuffer((" " + "   ".join(low) + "  ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([0] + [len(t) + 3 for t in low])
    letter = _letter_table()[arr]
    return np.where(letter, arr, np.uint32(32)), ends


def _grams(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, whether it counts) of the n-gram that starts at each position."""
    m = len(codes)
    h = np.full(m, n, dtype=np.uint64)
    blank = np.ones(m, dtype=bool)
    doubled = np.zeros(m, dtype=bool)
    padded = np.concatenate((codes, np.full(n, 32, dtype=np.uint32)))
    for j in range(n):
        c = padded[j:j + m]
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        blank &= c == 32
        if j:
            doubled |= (c == 32) & (padded[j - 1:j - 1 + m] == 32)
    return (h >> np.uint64(20)) % np.uint64(BUCKETS), ~(blank | doubled)


def _slices(texts: list[str | None]) -> Iterator[list[int]]:
    part, size = [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        if part and size + len(t) > SLICE_CHARS:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(t)
    if part:
        yield part


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for b in batches:
        texts, langs = b.column("text").to_pylist(), b.column("lang").to_pylist()
        for lang in set(langs):
            own = [t for t, x in zip(texts, langs) if x == lang]
            into = total.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            for part in _slices(own):
                codes, _ = _codes([own[i] for i in part])
                for n in ORDERS:
                    bucket, ok = _grams(codes, n)
                    into += np.bincount(bucket[ok].astype(np.int64), minlength=BUCKETS)
    for lang, c in total.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                          pa.array(c[at], pa.int64())], names=["lang", "bucket", "n"])


def train(rows: DataFrame) -> Iterator[tuple[list[str], np.ndarray]]:
    """(text, lang) of all learning rows -> blocks of (languages, log probabilities by bucket and language).

    Languages come in order, at most ``BLOCK_LANGUAGES`` a block."""
    counts = (rows.select("text", "lang").filter("lang is not null and text is not null")
              .mapInArrow(_count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # at most BUCKETS rows a language, whatever the number of documents
    counts = written(counts, "langid-counts")
    after = F.lit(True)
    while True:
        names = [r[0] for r in counts.filter(after).select("lang").distinct().orderBy("lang").limit(BLOCK_LANGUAGES).collect()]
        if not names:
            return
        own = counts.filter((F.col("lang") >= names[0]) & (F.col("lang") <= names[-1]))
        at = {lang: j for j, lang in enumerate(names)}
        model = np.full((BUCKETS, len(names)), SMOOTHING)
        for r in own.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c")).toLocalIterator():
            c = np.array([(x[0], x[1]) for x in r["c"]], dtype=np.int64)
            model[c[:, 0], at[r["lang"]]] += c[:, 1]
        yield names, np.log(model) - np.log(model.sum(axis=0, keepdims=True))
        after = F.col("lang") > names[-1]


_JUDGED = "doc_id long, lang_pred string, top double, total double"


def _judge(shared, carry: bool):
    """The best language so far of each text, its log probability, and the sum of all probabilities over it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, model = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            if "top" in b.schema.names:
                pred, top, total = (b.column(c).to_pylist() for c in ("lang_pred", "top", "total"))
            else:
                pred, top, total = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            for part in _slices(texts):
                codes, ends = _codes([texts[i] for i in part])
                logp = np.zeros((len(part), len(names)))
                seen = np.zeros(len(part), dtype=bool)
                for n in ORDERS:
                    bucket, ok = _grams(codes, n)
                    bucket = bucket.astype(np.int64)
                    if n == 1:
                        seen = np.logical_or.reduceat(ok, ends[:-1])
                    for j in range(len(names)):
                        logp[:, j] += np.add.reduceat(np.where(ok, model[bucket, j], 0.0), ends[:-1])
                best = logp.argmax(axis=1)
                high = logp.max(axis=1)
                over = np.exp(logp - high[:, None]).sum(axis=1)
                for k, i in enumerate(part):
                    if not seen[k]:
                        continue
                    if total[i] and top[i] >= high[k]:  # an earlier block's language stays on ties
                        total[i] += over[k] * np.exp(high[k] - top[i])
                    else:
                        total[i] = over[k] + (total[i] * np.exp(top[i] - high[k]) if total[i] else 0.0)
                        pred[i], top[i] = names[best[k]], high[k]
            cols = [b.column("doc_id"), pa.array(pred, pa.string()), pa.array(top, pa.float64()), pa.array(total, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols + ([b.column("text")] if carry else []),
                                             names=["doc_id", "lang_pred", "top", "total"] + (["text"] if carry else []))

    return run


def predict(docs: DataFrame, blocks: Iterable[tuple[list[str], np.ndarray]]) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, lang_pred, score (posterior of the predicted language, flat prior).

    One pass for each block of languages; what a pass finds goes on with the texts to the next."""
    spark, rows, blocks = docs.sparkSession, docs.select("doc_id", "text"), iter(blocks)
    block = next(blocks, None)
    if block is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    while block is not None:
        shared, block = spark.sparkContext.broadcast(block), next(blocks, None)
        rows = rows.mapInArrow(_judge(shared, block is not None), _JUDGED + (", text string" if block is not None else ""))
        if block is not None:
            rows = written(rows, "langid-judged")
    score = F.when(F.col("total") > 0, 1 / F.col("total")).otherwise(0.0)
    return rows.select("doc_id", "lang_pred", score.alias("score"))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the learning fold of ``docs`` (doc_id, text, lang) and predict every row."""
    return predict(docs, train(docs.filter(fold("doc_id") != 1))).withColumn("held_out", held_out("doc_id"))


def op9_langid(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
