"""Operator 5: near-duplicate documents by circulant MinHash.

Two permutations make all signature coordinates: the first places every shingle
on a ring of ``RING`` cells, the second, shifted by k cells, gives coordinate k.
Coordinate 0..K-1 of a shingle are then K neighbouring cells of one array, so a
signature is the column-wise minimum of array windows.  Bands of ``ROWS``
coordinates make the buckets; links are confirmed on the full shingle sets
(exact Jaccard, in integers).

Texts of equal word sequence form a class and stand for one document, so
thousands of copies cost one signature row each and no pair.  Candidates, links and
components are found between classes; ids come in at the end.  In each bucket one
member, another for each band, is compared with the others first: the members of
a large group meet up to ``BANDS`` such leaders and mostly end in one component.
Buckets whose members are then still in different components are joined to
families, and a family's documents are compared block by block, on their full sets
and inside the task: no candidate pair is written, only links.  So every bucket
pair is decided, without a cap on the size of a bucket.  This last step alone is
quadratic, in the documents of a family of near copies most of which miss the
threshold.

A pair at the threshold shares a band with probability 1 - (1 - s**ROWS)**BANDS,
over 0.9999995 for s = 0.85.

Defined cases: null texts and texts without words have an empty set and link
with nothing; fewer words than a shingle make one shingle; rows that repeat an
id are one document, which all of their texts link, so an id has one component;
``keep_one_each`` judges each text by itself and keeps one that is like no other
document's.  Rows with a null id are kept, and stand in the component of equal
texts.  Which of several like texts of one id stays is not defined, only that one does.  A text is taken
whole, one at a time where it is longer than ``textnum.SLICE_BYTES``; columns beyond
doc_id and text are ignored or, by ``keep_one_each``, kept; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum
from .common import read_table, text_marks, without, written
from .components import components

RING = 1 << 20
BANDS, ROWS = 20, 4
#: shingles whose windows are held at once
CHUNK = 1 << 14
#: ids of documents with candidates up to which they are broadcast; a shuffle join beyond
BROADCAST_IDS = 1_000_000
#: documents and bytes of a family per block, and shingles per matrix product
BLOCK, BLOCK_BYTES, COLUMNS = 512, 16 << 20, 4096

_tables: tuple[np.ndarray, np.ndarray] | None = None


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The placing permutation, and the windows of the shifted one."""
    global _tables
    if _tables is None:
        rng = np.random.default_rng(5)
        place = rng.permutation(RING).astype(np.uint32)
        ring = rng.permutation(RING).astype(np.uint32)
        k = BANDS * ROWS
        _tables = place, np.lib.stride_tricks.sliding_window_view(np.concatenate((ring, ring[:k - 1])), k)
    return _tables


def signatures(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, BANDS * ROWS) minima; rows of empty sets are the largest value."""
    place, window = _permutations()
    n = np.diff(offsets)
    out = np.full((len(n), BANDS * ROWS), np.iinfo(np.uint32).max, dtype=np.uint32)
    at = place[(sets >> np.uint64(44)).astype(np.int64) % RING]
    for lo in range(0, len(at), CHUNK):
        hi = min(lo + CHUNK, len(at))
        first = int(np.searchsorted(offsets, lo, side="right")) - 1
        last = int(np.searchsorted(offsets, hi, side="left"))
        docs = np.arange(first, last)
        docs = docs[n[docs] > 0]
        starts = np.maximum(offsets[docs], lo) - lo
        out[docs] = np.minimum(out[docs], np.minimum.reduceat(window[at[lo:hi]], starts, axis=0))
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    s = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03), s.shape[:2])
    for j in range(ROWS):
        h = textnum.mix(h ^ s[:, :, j] * np.uint64(0x9E3779B97F4A7C15))
    return h.view(np.int64)


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for lo, hi in textnum.slices(texts):
                h, off, _ = textnum.words(texts[lo:hi])
                sets, ends = textnum.shingles(h, off, k)
                a, c = textnum.sequence_hash(h, off)
                keys = band_keys(signatures(sets, ends))
                n = np.diff(ends)
                bands = pa.ListArray.from_arrays(np.arange(hi - lo + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(lo, hi - lo) for c in ("doc_id", "m1", "m2")), pa.array(n),
                     pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), bands],
                    names=["doc_id", "m1", "m2", "n_shingles", "h1", "h2", "bands"])

    return run


def jaccard_counts(a: list[bytes], b: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of intersection and union of the shingle sets of each pair of texts."""
    both = [t for pair in zip(a, b) for t in pair]
    h, off, _ = textnum.words(both)
    sets, ends = textnum.shingles(h, off, k)
    pair = np.repeat(np.arange(len(both)), np.diff(ends)) // 2
    order = np.lexsort((sets, pair))
    s, p = sets[order], pair[order]
    twice = (s[1:] == s[:-1]) & (p[1:] == p[:-1])
    inter = np.bincount(p[1:][twice], minlength=len(a))
    return inter, np.bincount(pair, minlength=len(a)) - inter


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ta, tb = (b.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b"))
            for lo, hi in textnum.slices([x + y for x, y in zip(ta, tb)]):
                inter, union = jaccard_counts(ta[lo:hi], tb[lo:hi], k)
                ok = pa.array(100 * inter >= percent * union)
                part = pa.RecordBatch.from_arrays([b.column("a").slice(lo, hi - lo), b.column("b").slice(lo, hi - lo)],
                                                  names=["a", "b"])
                yield part.filter(ok)

    return run


def confirm(pairs: DataFrame, own: DataFrame, k: int, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of classes -> those whose full sets reach the threshold; own: (node, text)."""
    full = (pairs.join(own.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(own.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return full.mapInArrow(_confirm(k, percent), "a long, b long")


def classes_and_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, text, ...) -> rows and groups.

    rows: doc_id, m1, m2, n_shingles, and the ``node`` and ``class_id`` of the class of the row's
    text, its number and its smallest id (null for no words or no id); one row per row of docs.
    groups: (node, leader, group) of the classes that have links: the group's smallest id and
    the class that holds it.  Everything is decided by classes, so that several texts of one id are
    compared each by itself.
    """
    texts = docs.select("doc_id", "text", *text_marks(F.col("text")))
    schema = "doc_id long, m1 long, m2 long, n_shingles long, h1 long, h2 long, bands array<long>"
    sketch = written(texts.mapInArrow(_sketch(k), schema), "minhash-sketch")
    # numbered once, as they are written: readers see the same numbers
    classes = written(sketch.filter("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2")
                      .agg(F.min("doc_id").alias("class_id")).withColumn("node", F.monotonically_increasing_id()),
                      "minhash-classes")
    reps = (sketch.join(classes.withColumn("doc_id", F.col("class_id")), ["doc_id", "h1", "h2"])
            .select("node", "doc_id", "m1", "m2", F.col("n_shingles").alias("n"), "bands").dropDuplicates(["node"]))
    cells = reps.select("node", "doc_id", "m1", "m2", "n", F.explode("bands").alias("band")).withColumn("turn", F.xxhash64("node", "band"))
    shared = cells.groupBy("band").agg(F.count("*").alias("c"), F.min("turn").alias("first")).filter("c > 1")
    cells = written(cells.join(shared.select("band", "first"), "band"), "minhash-cells")

    fits = lambda m, n: 100 * F.least(m, n) >= percent * F.greatest(m, n)
    pair = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    own = _texts_of(texts, cells.select("node", "doc_id", "m1", "m2").distinct())
    lead = cells.filter("turn = first").select("band", F.col("node").alias("a"), F.col("n").alias("na"))
    star = written(cells.select("band", F.col("node").alias("b"), "n").join(lead, "band").filter("a != b")
                   .filter(fits(F.col("na"), F.col("n"))).select(*pair).distinct(), "minhash-star")
    links = written(confirm(star, own, k, percent), "minhash-links")
    found = components(links, "minhash-components")
    placed = written(cells.select("band", F.col("node").alias("id"), "n").join(found, "id", "left")
                     .withColumn("component", F.coalesce("component", "id")), "minhash-placed")
    apart = (placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("id").alias("a"))
             .filter("lo < hi").select("band", "a"))
    still_open = written(placed.join(apart, "band"), "minhash-open")
    family = components(still_open.select("a", F.col("id").alias("b")), "minhash-families").withColumnRenamed("component", "family")
    rest = (still_open.select("id", "component").distinct().join(family, "id")
            .join(own.withColumnRenamed("node", "id"), "id"))
    more = written(_between(written(rest, "minhash-rest"), k, percent), "minhash-more")
    joined = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more), "minhash-components")
    joined = written(joined.withColumnRenamed("id", "node").join(classes.select("node", "class_id"), "node"), "minhash-joined")
    least = joined.groupBy("component").agg(F.min("class_id").alias("group"))
    leader = (joined.join(least, "component").filter(F.col("class_id") == F.col("group"))
              .groupBy("component", "group").agg(F.min("node").alias("leader")))
    groups = joined.select("node", "component").join(leader, "component").select("node", "leader", "group")
    rows = sketch.drop("bands").join(classes, ["h1", "h2"], "left").select("doc_id", "m1", "m2", "n_shingles", "node", "class_id")
    return written(rows, "minhash-rows"), written(groups, "minhash-groups")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_shingles, class_id, component_id, kept; one row per row of docs.

    Two documents link when their sets of ``k``-word shingles have
    100 * intersection >= percent * union.  class_id is the smallest id with the
    same word sequence; component_id the smallest id reachable by links.  An id with
    several texts is one document, linked by each of them.
    """
    rows, groups = classes_and_groups(docs, k, percent)
    own = F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    out = (rows.withColumn("class_id", own).join(groups.select("node", "group"), "node", "left")
           .withColumn("group", F.coalesce("group", "class_id")))
    # ids with texts of several groups join these
    several = written(out.filter("node is not null and doc_id is not null").groupBy("doc_id")
                      .agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi").select("doc_id"), "minhash-several")
    if not several.isEmpty():
        met = (out.filter("node is not null").join(several, "doc_id")
               .select(F.col("doc_id").alias("a"), F.col("group").alias("b")))
        by_id = components(met, "minhash-ids").select(F.col("id").alias("group"), F.col("component").alias("joined"))
        out = out.join(by_id, "group", "left").withColumn("group", F.coalesce("joined", "group"))
    return out.select("doc_id", "n_shingles", "class_id", F.col("group").alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("group"), F.lit(True)).alias("kept"))


def _blocks_linked(k: int, percent: int):
    """Links between two blocks of a family whose documents are in different components."""

    def run(t: pa.Table) -> pa.Table:
        ids, comp = t["id"].to_numpy(), t["component"].to_numpy()
        # both blocks of a pair, or the one block twice
        left = np.flatnonzero(t["block"].to_numpy() == t["p"][0].as_py())
        right = np.flatnonzero(t["block"].to_numpy() == t["q"][0].as_py())
        texts = t["text"].cast(pa.binary()).to_pylist()
        sets, sizes = [], []
        for lo, hi in textnum.slices(texts):
            h, off, _ = textnum.words(texts[lo:hi])
            s, ends = textnum.shingles(h, off, k)
            sets.append(s)
            sizes.append(np.diff(ends))
        n = np.concatenate(sizes)
        doc = np.repeat(np.arange(len(n)), n)
        value, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        often = (count > 1)[at]
        doc, at = doc[often], (np.cumsum(count > 1) - 1)[at[often]]
        order = np.argsort(at, kind="stable")
        doc, at = doc[order], at[order]
        inter = np.zeros((len(left), len(right)), dtype=np.float32)
        for lo in range(0, int((count > 1).sum()), COLUMNS):  # counts below 2**24 are exact in float32
            a, z = np.searchsorted(at, [lo, lo + COLUMNS])
            m = np.zeros((len(n), COLUMNS), dtype=np.float32)
            m[doc[a:z], at[a:z] - lo] = 1
            inter += m[left] @ m[right].T
        both = inter.astype(np.int64)
        union = n[left][:, None] + n[right][None, :] - both
        i, j = np.nonzero((100 * both >= percent * union) & (comp[left][:, None] != comp[right][None, :]))
        # one link is enough for two components
        pair = np.column_stack((np.minimum(comp[left[i]], comp[right[j]]), np.maximum(comp[left[i]], comp[right[j]])))
        _, one = np.unique(pair, axis=0, return_index=True)
        return pa.table({"a": pa.array(ids[left[i[one]]], pa.int64()), "b": pa.array(ids[right[j[one]]], pa.int64())})

    return run


def _between(rest: DataFrame, k: int, percent: int) -> DataFrame:
    """rest (id, component, family, text) -> links between components of a family.

    A family is cut into blocks; each pair of blocks is a group of bounded size whose
    intersections are counted by matrix products, so no pair leaves a task but links.
    """
    size = F.greatest(F.count("*") / F.lit(BLOCK), F.sum(F.octet_length("text").cast("long")) / F.lit(BLOCK_BYTES))
    blocks = rest.groupBy("family").agg(F.ceil(size).cast("int").alias("blocks"))
    dealt = (rest.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select("family", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "id",
                     "component", "text"))
    return dealt.groupBy("family", "p", "q").applyInArrow(_blocks_linked(k, percent), "a long, b long")


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted classes, written; few are broadcast, so that the texts stay where they are."""
    wanted = written(wanted, "minhash-wanted")
    small = wanted.count() <= BROADCAST_IDS
    own = texts.join(F.broadcast(wanted) if small else wanted, ["doc_id", "m1", "m2"]).select("node", "text")
    return written(own.dropDuplicates(["node"]), "minhash-texts")


def keep_one_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose text is the first of its group, and those that have none or no id.

    Each text of an id is judged by itself: where one goes, another that is like no
    other document's stays.
    """
    rows, groups = classes_and_groups(docs, k, percent)
    gone = (rows.filter("node is not null and doc_id is not null").join(groups, "node", "left")
            .filter((F.col("node") != F.coalesce("leader", "node")) | (F.col("doc_id") != F.col("class_id")))
            .select("doc_id", "m1", "m2").distinct())
    return without(docs, gone)


def op5_minhash(spark, sf_dir) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), k=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")
