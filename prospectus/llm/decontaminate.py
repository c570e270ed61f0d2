"""Operator 4: benchmark decontamination by rare n-gram seeds and local alignment.

A document holds an item when some local alignment over words has matched words,
less words put in between, of at least ``MIN_SIMILARITY`` of the item's words; that
number itself is maximised.  What is reported is the same number of the alignment
of the best Smith-Waterman score, which may be smaller.  An alignment that counts has
at most e = m - ceil(0.8 m) edits of the item's m words, so of e + 1 disjoint n-grams
of the item one occurs whole in the document.  Each item
is seeded with the e + 1 disjoint n-grams that are rarest in the corpus (a first
pass counts all the items' n-grams over all documents); n is at most ``SEED_WORDS``
and smaller for items that leave no room.  A second pass looks the seeds up in
every document, and aligns the item with the words around each hit.

Items are broadcast in blocks of at most ``ITEM_WORDS`` words; more items take more
passes, not more memory.  Documents never move: both passes are narrow, and only
counts and hits are shuffled.

Words are runs of letters, digits and non-ASCII characters of the lower-cased
text.  Items of fewer than five words are too short to tell a leak from common
speech and match only documents that consist of them.

Defined cases: null and empty texts and items without words match nothing; null
doc_ids are reported as null; rows that repeat an id are reported once per item with
the best alignment; equal items are reported each; of equally good alignments the one
that ends last is reported; long texts and items are taken whole; other columns than ids
and texts are ignored; empty tables give an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum
from .common import read_table, text_marks, without, written

MIN_SIMILARITY = 0.8
SEED_WORDS = 5
SHORT_ITEM = 5
ITEM_WORDS = 500_000
#: seeds chosen at once
STRETCH = 2000
MATCH, MISMATCH, GAP = 2, 1, 1
_FILTER_BITS = 22

_PLAIN = np.full(256, 32, dtype=np.uint8)
_PLAIN[128:] = np.arange(128, 256)
for _lo, _hi in ((48, 58), (97, 123)):
    _PLAIN[_lo:_hi] = np.arange(_lo, _hi)
_PLAIN = _PLAIN.tobytes()


def plain(text: str | None) -> bytes:
    """Lower-cased bytes with ASCII punctuation as blanks."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on."""
    m = max(len(h) - n + 1, 0)
    out = np.full(m, n, dtype=np.uint64)
    for j in range(n):
        out = textnum.mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + m])
    return out


@dataclass
class Item:
    item_id: int
    words: np.ndarray

    @property
    def edits(self) -> int:
        m = len(self.words)
        return m - int(np.ceil(MIN_SIMILARITY * m - 1e-9))

    @property
    def n(self) -> int:
        return min(SEED_WORDS, len(self.words) // (self.edits + 1))

    def seeds(self, count: dict[int, int]) -> list[tuple[int, int]]:
        """(hash, offset) of e + 1 disjoint n-grams, of the least total count in each stretch of ``STRETCH`` seeds.

        Seed j lies j * n words after the start plus a shift, and shifts do not fall; so the best
        shifts follow from cumulative minima over an array of the words left over, once a seed.
        Any choice of disjoint n-grams finds the same leaks; rare ones find them with fewer hits."""
        g = [int(x) for x in grams(self.words, self.n)]
        need, n = self.edits + 1, self.n
        cost = np.array([1 + count.get(x, 0) for x in g], dtype=np.int64)
        out, spare = [], len(self.words) - need * n
        for lo in range(0, need, STRETCH):
            k = min(STRETCH, need - lo)
            first, last = (x * spare // need for x in (lo, lo + k))  # this stretch's share of the words left over
            shifts, total, better = last - first + 1, None, []
            for j in range(k):
                at = first + (lo + j) * n
                total = cost[at:at + shifts] + (0 if total is None else np.minimum.accumulate(total))
                low = np.minimum.accumulate(total)
                better.append(np.packbits(np.append(True, low[1:] < low[:-1])))
            s = shifts - 1
            for j in range(k - 1, -1, -1):  # the last place up to s where the minimum fell
                s = int(np.flatnonzero(np.unpackbits(better[j], count=shifts)[:s + 1])[-1])
                i = first + (lo + j) * n + s
                out.append((g[i], i))
        return out[::-1] if need <= STRETCH else sorted(out, key=lambda x: x[1])


class Seeds:
    """Seeds of a block of items: bounded by ``ITEM_WORDS``, broadcast."""

    def __init__(self, items: list[Item], seeds: list[list[tuple[int, int]]]):
        self.items = items
        rows = sorted((it.n, h, i, off) for i, it in enumerate(items) for h, off in seeds[i])
        self.by_n = {}
        for n in {r[0] for r in rows}:
            own = [r for r in rows if r[0] == n]
            h = np.array([r[1] for r in own], dtype=np.uint64)
            self.by_n[n] = (h, np.array([r[2] for r in own]), np.array([r[3] for r in own]), _filter(h))


def _filter(h: np.ndarray) -> np.ndarray:
    f = np.zeros(1 << _FILTER_BITS, dtype=bool)
    f[h >> np.uint64(64 - _FILTER_BITS)] = True
    return f


def _look_up(g: np.ndarray, known: np.ndarray, flt: np.ndarray) -> np.ndarray:
    """Positions of g whose hash is in sorted ``known``."""
    at = np.flatnonzero(flt[g >> np.uint64(64 - _FILTER_BITS)])
    if not len(at):
        return at
    i = np.minimum(np.searchsorted(known, g[at]), len(known) - 1)
    return at[known[i] == g[at]]


def most_matched(item: np.ndarray, words: np.ndarray) -> int:
    """Most matched words less words put in between, over all local alignments."""
    step = np.arange(len(words) + 1, dtype=np.int64)
    row = np.zeros(len(words) + 1, dtype=np.int64)
    for w in item:
        new = row.copy()  # the item's word left out
        new[1:] = np.maximum(new[1:], row[:-1] + (words == w))
        row = np.maximum.accumulate(new + step) - step  # words put in
    return int(row.max())


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Local alignments: (most matched words less words put in between, where that one ends in ``words``).

    A cell packs the score and that number in one integer, so that the path of
    the best score wins and, among equals, the one with fewer edits.
    """
    one, half = 1 << 20, 1 << 19
    put_in = GAP * one + 1
    step = np.arange(len(words) + 1, dtype=np.int64) * put_in
    row = np.zeros(len(words) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in item:
        new = np.zeros_like(row)
        diag = row[:-1] + np.where(words == w, MATCH * one + 1, -MISMATCH * one)
        new[1:] = np.maximum(diag, row[1:] - GAP * one)
        new[new < half] = 0
        new = np.maximum.accumulate(new + step) - step  # words put in
        new[new < half] = 0
        row = new
        net = ((row + half) & (one - 1)) - half
        i = int(net.argmax())
        if net[i] > best:
            best, end = int(net[i]), i
    return best, end


def _windows(starts: np.ndarray, m: int, n_words: int) -> Iterator[tuple[int, int]]:
    """Ranges of words around the places where an item might start."""
    slack = m // 4 + 4
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > m + 2 * slack) + 1
    for part in np.split(starts, cut):
        yield max(int(part[0]) - slack, 0), min(int(part[-1]) + m + slack, n_words)


def _hits(h: np.ndarray, off: np.ndarray, seeds: Seeds) -> list[tuple[int, int, int]]:
    """(text, item, place where the item would start) of all seeds met in the texts."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    out = []
    for n, (known, item, offset, flt) in seeds.by_n.items():
        g = grams(h, n)
        at = _look_up(g, known, flt)
        at = at[doc[at] == doc[at + n - 1]]
        lo, hi = np.searchsorted(known, g[at], "left"), np.searchsorted(known, g[at], "right")
        for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist()):
            out += [(int(doc[p]), int(item[k]), p - int(offset[k])) for k in range(a, b)]
    return out


def _match(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: Seeds = shared.value
        for b in batches:
            texts = [plain(t) for t in b.column("text").to_pylist()]
            rows = []
            for lo, hi in textnum.slices(texts):
                h, off, _ = textnum.words(texts[lo:hi])
                by_pair: dict[tuple[int, int], list[int]] = {}
                for d, i, start in _hits(h, off, seeds):
                    by_pair.setdefault((d, i), []).append(start - int(off[d]))
                for (d, i), starts in by_pair.items():
                    it, own = seeds.items[i], h[off[d]:off[d + 1]]
                    m = len(it.words)
                    if m < SHORT_ITEM:
                        if len(own) == m and (own == it.words).all():
                            rows.append((lo + d, it.item_id, 1.0, m))
                        continue
                    spans = list(_windows(np.array(starts), m, len(own)))
                    if max(most_matched(it.words, own[frm:upto]) for frm, upto in spans) < m - it.edits:
                        continue
                    best, end = 0, 0
                    for frm, upto in spans:
                        got, at = align(it.words, own[frm:upto])
                        if got > best:
                            best, end = got, frm + at
                    rows.append((lo + d, it.item_id, best / m, end))
            cols = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64())],
                                             names=["doc_id", "item_id", "similarity", "end_word"])

    return run


def _gram_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {n: np.zeros(len(known), dtype=np.int64) for n, (known, _) in shared.value.items()}
        for b in batches:
            texts = [plain(t) for t in b.column("text").to_pylist()]
            for lo, hi in textnum.slices(texts):
                h, off, _ = textnum.words(texts[lo:hi])
                doc = np.repeat(np.arange(hi - lo), np.diff(off))
                for n, (known, flt) in shared.value.items():
                    g = grams(h, n)
                    at = _look_up(g, known, flt)
                    at = at[doc[at] == doc[at + n - 1]]
                    total[n] += np.bincount(np.searchsorted(known, g[at]), minlength=len(known))
        for n, c in total.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(shared.value[n][0][some].view(np.int64)), pa.array(c[some])],
                                             names=["gram", "n"])

    return run


def _item_blocks(benchmark: DataFrame) -> Iterator[list[Item]]:
    """Items in blocks of at most ``ITEM_WORDS`` words, read one partition at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        h, _, _ = textnum.words([plain(r["text"])])
        if not len(h):
            continue
        if block and size + len(h) > ITEM_WORDS:
            yield block
            block, size = [], 0
        block.append(Item(r["item_id"], h))
        size += len(h)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs (doc_id, text), benchmark (item_id, text) -> one row per document and item it holds:
    doc_id, item_id, similarity (share of the item's words that edits leave in the alignment of the best score),
    end_word (where that ends)."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text").filter("length(text) > 0")
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, item_id long, similarity double, end_word long"
    found = None
    for items in _item_blocks(benchmark):
        by_n: dict[int, list[np.ndarray]] = {}
        for it in items:
            by_n.setdefault(it.n, []).append(grams(it.words, it.n))
        known = {n: np.unique(np.concatenate(g)) for n, g in by_n.items()}
        shared = spark.sparkContext.broadcast({n: (k, _filter(k)) for n, k in known.items()})
        counts = (texts.mapInArrow(_gram_counts(shared), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
                  .toPandas())  # at most one row for each n-gram of this block of items
        count = dict(zip(counts["gram"].to_numpy(dtype=np.int64).view(np.uint64).tolist(), counts["n"].tolist()))
        seeds = spark.sparkContext.broadcast(Seeds(items, [it.seeds(count) for it in items]))
        part = texts.mapInArrow(_match(seeds), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    return (found.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", "end_word")).alias("m"))
            .select("doc_id", "item_id", "m.similarity", "m.end_word"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose own text holds no item, whatever their id."""
    own = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), *text_marks(docs["text"])).alias("doc_id"), "text")
    return without(docs, written(leaks(own, benchmark).select("doc_id.*").distinct(), "leaks"))


def op4_decontaminate(spark, sf_dir) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
