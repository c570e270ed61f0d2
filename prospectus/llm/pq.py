"""Operator 10: embedding near-duplicates by product quantisation.

Unit vectors go to the nearest of ``lists`` coarse centroids (inverted lists);
what is left is cut into ``PARTS`` subspaces of ``CODES`` codewords each.  Every
vector is also a query: it probes its ``probes`` nearest lists, looks up the
distance to each member's code in a table per subspace (asymmetric distance) and
leaves out members for which that distance less the member's own coding error
exceeds the threshold: by the triangle inequality no linked member is lost there.
The rest is decided by exact cosine in double precision.

Centroids and codewords are fitted on a bounded sample (``SAMPLE`` vectors by
hash of the id); every vector is indexed.  The number of lists follows the number
of vectors up to ``MAX_LISTS``.

A list is cut into blocks of about ``BLOCK`` members, and its queries likewise;
a pair of blocks is one group, so a list with a third of all vectors is many
groups of bounded size.  Groups return, per vector, a number of links, and a
spanning forest of their links rather than the links themselves.  A pair may be
met from both sides; each group knows the lists that both probe and counts a pair
for the far side only if the far side won't meet it.

Equal vectors form a class that stands for them.  Defined cases: null, empty and
zero vectors and those with null or non-finite components link with nothing; vectors of
different lengths have no cosine and an index of their own for each length; rows that
repeat an id are vectors of their own in counts but share the id's component; a cosine
of exactly the threshold links; other columns than id and vector are ignored; an empty
table gives an empty table.

Probes are a fixed number, and lists end at ``MAX_LISTS``: beyond about a million vectors
of one length lists grow with the table, the work of a list with its square, and recall
is not measured there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, written, written_twice
from .components import components

SAMPLE = 20_000
PER_LIST = 256
MAX_LISTS = 4096
PROBES = 24
PARTS, CODES = 8, 128
BLOCK = 4096
ROUNDS = 8
#: queries compared with a block at a time
SLAB = 256


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        at = nearest(x, c, 1)[:, 0]
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        n = np.bincount(at, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k nearest rows of c for each row of x, nearest first."""
    out = np.empty((len(x), min(k, len(c))), dtype=np.int32)
    half = (c**2).sum(1) / 2
    for lo in range(0, len(x), 2048):
        d = half - x[lo:lo + 2048] @ c.T
        if out.shape[1] < len(c):
            part = np.argpartition(d, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
        else:
            part = np.broadcast_to(np.arange(len(c)), d.shape)
        rank = np.argsort(np.take_along_axis(d, part, 1), axis=1, kind="stable")
        out[lo:lo + 2048] = np.take_along_axis(part, rank, 1)
    return out


class Index:
    """Coarse centroids and codewords; a few MB at most, whatever the number of vectors."""

    def __init__(self, sample: np.ndarray, n_vectors: int):
        lists = int(np.clip(n_vectors // PER_LIST, 1, min(MAX_LISTS, max(1, len(sample) // 4))))
        self.coarse = kmeans(sample, lists, 1)
        rest = sample - self.coarse[nearest(sample, self.coarse, 1)[:, 0]]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(PARTS, sample.shape[1]))
        self.words = [kmeans(rest[:, p], CODES, 2 + i) for i, p in enumerate(self.parts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probed lists, nearest first; codes; coding error)."""
        probes = nearest(x, self.coarse, PROBES)
        rest = x - self.coarse[probes[:, 0]]
        codes = np.empty((len(x), len(self.parts)), dtype=np.uint8)
        err = np.zeros(len(x))
        for i, (p, w) in enumerate(zip(self.parts, self.words)):
            codes[:, i] = nearest(rest[:, p], w, 1)[:, 0]
            err += ((rest[:, p] - w[codes[:, i]]) ** 2).sum(1)
        return probes, codes, np.sqrt(err)

    def lookup(self, q: np.ndarray, l: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries to the coded members of list l."""
        rest = q - self.coarse[l]
        d = np.zeros((len(q), len(codes)))
        for i, (p, w) in enumerate(zip(self.parts, self.words)):
            table = ((rest[:, p][:, None, :] - w[None]) ** 2).sum(2)
            d += table[:, codes[:, i]]
        return np.sqrt(d)


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indexes of links that keep the components of links (a, b) of small integers."""
    n = int(max(a.max(), b.max())) + 1 if len(a) else 0
    label, use = np.arange(n), []
    while len(a):
        cut = label[a] != label[b]
        if not cut.any():
            break
        at = np.flatnonzero(cut)
        lo, hi = np.minimum(label[a[at]], label[b[at]]), np.maximum(label[a[at]], label[b[at]])
        # each component takes one link to a smaller one, so no circle arises
        _, one = np.unique(hi, return_index=True)
        use.append(at[one])
        label[hi[one]] = lo[one]
        while (label[label] != label).any():
            label = label[label]
    return np.concatenate(use) if use else np.zeros(0, dtype=int)


def _blob(col: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=dtype).reshape(-1, width)


def _group(shared, dim: int, kind: type, min_cosine: float):
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        if not len(members) or not len(queries):
            return none
        index: Index = shared.value
        width = min(PROBES, len(index.coarse))
        reach = np.sqrt(2 - 2 * min_cosine) + 1e-9
        m_id, q_id = members["id"].to_numpy(), queries["id"].to_numpy()
        m_w, q_w = members["w"].to_numpy(), queries["w"].to_numpy()
        m_x = unit(_blob(members["x"], kind, dim), dim)
        q_x = unit(_blob(queries["x"], kind, dim), dim)
        codes = _blob(members["codes"], np.uint8, len(index.parts))
        err = members["err"].to_numpy()
        m_probes = _blob(members["probes"], np.int32, width)
        q_home = _blob(queries["probes"], np.int32, width)[:, 0]
        l = members["list"][0].as_py()
        ids = np.unique(np.concatenate((m_id, q_id)))
        m_at, q_at = np.searchsorted(ids, m_id), np.searchsorted(ids, q_id)
        n = np.zeros(len(ids), dtype=np.int64)
        kept_a, kept_b = [], []
        for lo in range(0, len(q_id), SLAB):
            near = index.lookup(q_x[lo:lo + SLAB], l, codes) - err <= reach
            qi, mi = np.nonzero(near)
            qi += lo
            ok = q_id[qi] != m_id[mi]
            qi, mi = qi[ok], mi[ok]
            for at in range(0, len(qi), 1 << 16):
                q, m = qi[at:at + (1 << 16)], mi[at:at + (1 << 16)]
                hit = np.einsum("ij,ij->i", q_x[q], m_x[m]) >= min_cosine
                q, m = q[hit], m[hit]
                np.add.at(n, q_at[q], m_w[m])
                far = ~(m_probes[m] == q_home[q][:, None]).any(1)
                np.add.at(n, m_at[m][far], q_w[q][far])
                a, b = q_at[q], m_at[m]
                use = forest(a, b)
                kept_a.append(a[use])
                kept_b.append(b[use])
        a = np.concatenate(kept_a) if kept_a else np.zeros(0, dtype=int)
        b = np.concatenate(kept_b) if kept_b else np.zeros(0, dtype=int)
        use = forest(a, b)
        some = np.flatnonzero(n)
        return pa.table({"a": pa.array(np.concatenate((ids[some], ids[a[use]])), pa.int64()),
                         "b": pa.array(np.concatenate((ids[some], ids[b[use]])), pa.int64()),
                         "n": pa.array(np.concatenate((n[some], np.zeros(len(use), dtype=np.int64))), pa.int64())})

    return run


def near_vectors(vectors: DataFrame, min_cosine: float = 0.9) -> DataFrame:
    """vectors (vec_id, embedding array<float or double>) -> vec_id, n_links, component_id, kept; one row per row."""
    double = vectors.schema["embedding"].dataType.elementType == T.DoubleType()
    number = "double" if double else "float"
    v = vectors.select("vec_id", F.col("embedding").cast(f"array<{number}>").alias("x"))
    fine = F.expr(f"forall(x, c -> c is not null and not isnan(c) and abs(c) < {number}('infinity')) "
                  "and exists(x, c -> c != 0) and vec_id is not null")
    v = written(v.withColumn("ok", F.coalesce(fine, F.lit(False)))
                .withColumn("key", F.when(F.col("ok"), F.sha2(F.array_join(F.expr(
                    f"transform(x, c -> cast(c + {number}(0) as string))"), ","), 256))), "pq-vectors")
    classes = (v.filter("ok").groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("w"), F.any_value("x").alias("x"))
               .withColumn("dim", F.size("x")))
    classes = written(classes, "pq-classes")
    # an index for each length, as vectors of different lengths have no cosine
    met = None
    for dim, n in sorted(tuple(r) for r in classes.groupBy("dim").count().collect()):
        own = _met(classes.filter(F.col("dim") == dim), dim, n, np.float64 if double else np.float32, min_cosine)
        met = own if met is None else met.unionByName(own)
    if met is None:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.lit(True).alias("kept"))
    counts = met.filter("a = b").groupBy(F.col("a").alias("id"), "dim").agg(F.sum("n").alias("n"))
    found = components(met.filter("a != b").select("a", "b"), "pq-components")
    by_class = (classes.select("key", "id", "dim", "w").join(counts, ["id", "dim"], "left").join(found, "id", "left")
                .select("key", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n"),
                        F.coalesce("component", "id").alias("c")))
    out = v.join(by_class, "key", "left")
    comp = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp, F.lit(True)).alias("kept"))


def _met(classes: DataFrame, dim: int, n: int, kind: type, min_cosine: float) -> DataFrame:
    """Links among the ``n`` classes of one length: (a, b, n, dim), a = b for numbers of links."""
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("x").toArrow()
    index = Index(unit(np.array(sample["x"].combine_chunks().flatten()), dim), n)
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("x").flatten(), dtype=kind).reshape(-1, dim)
            probes, codes, err = shared.value.encode(unit(x, dim))
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * probes.shape[1], pa.array(probes.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("w"), pa.array([r.tobytes() for r in x], pa.binary()), lists,
                 pa.array([r.tobytes() for r in probes], pa.binary()), pa.array([r.tobytes() for r in codes], pa.binary()),
                 pa.array(err)], names=["id", "w", "x", "lists", "probes", "codes", "err"])

    coded, again = written_twice(classes.select("id", "w", "x").mapInArrow(
        encode, "id long, w long, x binary, lists array<int>, probes binary, codes binary, err double"), "pq-coded")
    # one row a list: how many blocks its members and its queries make
    members = coded.withColumn("list", F.col("lists")[0])
    queries = again.select("id", "w", "x", "probes", F.explode("lists").alias("list"))
    blocks = lambda c: F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias(c)
    plan = F.broadcast(members.groupBy("list").agg(blocks("mb")).join(queries.groupBy("list").agg(blocks("qb")), "list"))
    part = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    members = (members.join(plan, "list").withColumn("m", part(F.col("mb")))
               .withColumn("q", F.explode(F.expr("sequence(0, qb - 1)")))
               .select("list", "m", "q", "id", "w", "x", "probes", "codes", "err"))
    queries = (queries.join(plan, "list").withColumn("q", part(F.col("qb")))
               .withColumn("m", F.explode(F.expr("sequence(0, mb - 1)")))
               .select("list", "m", "q", "id", "w", "x", "probes"))
    keys = ["list", "m", "q"]
    return written(members.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        _group(shared, dim, kind, min_cosine), "a long, b long, n long").withColumn("dim", F.lit(dim)), "pq-met")


def op10_vectors(spark, sf_dir) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
