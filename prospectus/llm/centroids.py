"""Operator 12: clustering by centroids, with a bisector tournament for each vector.

Vectors are turned into integers, floor(``SCALE`` * x), so that all distances, sums
and ties are exact and a result does not depend on the order of rows.  For each pair
of centroids i < j the bisector is an integer normal and threshold: j is strictly
nearer than i where 2 * x . (cj - ci) > |cj|^2 - |ci|^2.  A vector starts with centroid 0
and meets 1, 2, ...; each sign test eliminates one of the two, and on zero
the smaller number stays, so k-1 tests leave the nearest centroid.  Only to the winner
is the distance computed.

A round is one job over the written vectors: tasks add up their own vectors by
centroid, and k * dimension sums a task are added up by Spark.  The driver sees the k
centroids, nothing else.  Products are taken as doubles where their size proves them
exact (below 2**53), as 64-bit integers otherwise.

Defined cases: a vector is left out that is null, has another number of components, or
one that is null, not finite, or so large that distances would not fit 64 bits
(``largest``, after scaling).  Rows that repeat an id are vectors of their own; vectors
with a null id come last in the choice of centroids and are assigned like others; ties
of hashes go by components.  With fewer vectors than k there are as many centroids as
vectors; an empty centroid stays as it is; an empty table gives an empty table.  An
inertia that does not fit 64 bits is null.  Columns beyond id and vector are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, written

#: production parameters
CLUSTERS, ROUNDS, DIMENSION, SCALE, SALT = 8, 10, 64, 1024, "3"
#: rows handled in one go
ROWS = 1 << 14


def largest(dimension: int) -> int:
    """The largest component for which 2 * x . normal and squared distances stay below 2**63."""
    return 1 << (30 - (dimension.bit_length() + 1) // 2)


class Bisectors:
    """Normals and thresholds of all centroid pairs, and the tournament over them."""

    def __init__(self, centroids: list[list[int]]):
        self.c = np.array(centroids, dtype=np.int64)
        self.size = int(np.abs(self.c).max())
        square = (self.c * self.c).sum(axis=1)
        self.normal = 2 * (self.c[None, :, :] - self.c[:, None, :])
        self.threshold = square[None, :] - square[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row; the smaller number on ties."""
        bound = int(np.abs(x).max(initial=0))
        exact = 4 * x.shape[1] * max(bound, 1) * max(self.size, 1) < 1 << 53
        rows, normal = (x.astype(np.float64), self.normal.astype(np.float64)) if exact else (x, self.normal)
        best = np.zeros(len(x), dtype=np.int64)
        for j in range(1, len(self.c)):
            before = best.copy()
            for i in np.unique(before):
                at = np.flatnonzero(before == i)
                best[at[rows[at] @ normal[i, j] > self.threshold[i, j]]] = j
        return best

    def distance(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        d = x - self.c[cluster]
        return np.einsum("ij,ij->i", d, d)


def integers(df: DataFrame, vector: str, id_col: str, dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<int>) of the rows that hold ``dimension`` finite components."""
    top = largest(dimension)
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    ok = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * scale < top))
    return (df.filter(F.col(vector).isNotNull() & (F.size(vector) == dimension)).filter(ok)
            .select(F.col(id_col).cast("long").alias("vec_id"), scaled.cast("array<int>").alias("x")))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, salt: str = SALT) -> list[list[int]]:
    """The k vectors with the smallest hash of salt and id, in ascending order."""
    order = F.sha2(F.concat(F.lit(salt + ":"), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    return [list(r.x) for r in vectors.orderBy(order, "x").select("x").limit(k).collect()]


def _rows(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    if not b.num_rows:
        return
    flat = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1).astype(np.int64)
    for lo in range(0, b.num_rows, ROWS):
        hi = min(lo + ROWS, b.num_rows)
        yield lo, hi, flat[lo:hi]


def _sums(centroids: list[list[int]]):
    """Number and sums of a task's vectors by centroid and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bisectors(centroids)
        k, dim = own.c.shape
        n, total = np.zeros(k, dtype=np.int64), [[0] * dim for _ in range(k)]
        for b in batches:
            for _, _, x in _rows(b):
                best = own.nearest(x)
                n += np.bincount(best, minlength=k)
                for i in np.unique(best):  # a slice's sums fit 64 bits
                    total[i] = [a + c for a, c in zip(total[i], x[best == i].sum(axis=0).tolist())]
        if not len(used := np.flatnonzero(n)):
            return
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dim), pa.int32()), pa.array(list(range(dim)) * len(used), pa.int32()),
             pa.array(np.repeat(n[used], dim), pa.int64()),
             pa.array([Decimal(v) for i in used for v in total[i]], pa.decimal128(38, 0))],
            names=["cluster", "component", "n", "total"])

    return run


def next_centroids(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid replaced by the floor of its vectors' mean; those without vectors stay."""
    parts = vectors.mapInArrow(_sums(centroids), "cluster int, component int, n long, total decimal(38,0)")
    out = [list(c) for c in centroids]
    for r in parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r.cluster][r.component] = int(r.total) // r.n
    return out


def _assign(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bisectors(centroids)
        for b in batches:
            for lo, hi, x in _rows(b):
                best = own.nearest(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").slice(lo, hi - lo), pa.array(best, pa.int32()), pa.array(own.distance(x, best))],
                    names=["vec_id", "cluster", "distance"])

    return run


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of each vector: its nearest centroid and the squared distance."""
    return vectors.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long")


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT) -> list[list[int]]:
    """The centroids after ``rounds`` rounds, or fewer once they no longer change."""
    centroids = first_centroids(vectors, k, salt)
    for _ in range(rounds if centroids else 0):
        last, centroids = centroids, next_centroids(vectors, centroids)
        if last == centroids:
            break
    return centroids


_PLACED = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clusters(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", k: int = CLUSTERS, rounds: int = ROUNDS,
             dimension: int = DIMENSION, salt: str = SALT) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector kept."""
    spark = df.sparkSession
    vectors = written(integers(df, vector, id_col, dimension), "centroid-vectors")
    centroids = fit(vectors, k, rounds, salt)
    if not centroids:
        return spark.createDataFrame([], _PLACED)
    placed = written(assign(vectors, centroids), "centroid-assigned")
    inertia = dict(placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # k rows
    fits = lambda n: int(n) if n < 1 << 63 else None
    about = spark.createDataFrame(
        [(i, fits(n), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest())
         for i, n in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (placed.join(F.broadcast(about), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def op12_centroids(spark, sf_dir) -> DataFrame:
    return clusters(read_table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """Rounds written out one after the other."""
    ctes = [f"""v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {DIMENSION}
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {DIMENSION}),
c0 AS (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS cluster, x AS c
  FROM (SELECT x, sha256('{SALT}:' || vec_id) AS h FROM v ORDER BY h NULLS LAST, x LIMIT {CLUSTERS}))"""]
    near = """SELECT r, min(struct_pack(d := d, cluster := cluster)) AS best FROM (
    SELECT r, cluster, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM v, c{i}) GROUP BY r"""
    for i in range(ROUNDS):
        ctes.append(f"""a{i} AS ({near.format(i=i)}),
s{i} AS (
  SELECT cluster, list(m ORDER BY k) AS c FROM (
    SELECT best.cluster AS cluster, k, (sum(e) - ((sum(e) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS m
    FROM (SELECT r, unnest(x) AS e, unnest(range({DIMENSION})) AS k FROM v) JOIN a{i} USING (r) GROUP BY ALL) GROUP BY cluster),
c{i + 1} AS (SELECT cluster, coalesce(s{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN s{i} USING (cluster))""")
    return f"""WITH {', '.join(ctes)},
a AS MATERIALIZED ({near.format(i=ROUNDS)})
SELECT vec_id, best.cluster::INT AS cluster, best.d AS distance,
  (sum(best.d) OVER (PARTITION BY best.cluster))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a JOIN v USING (r) JOIN c{ROUNDS} ON cluster = best.cluster"""


ORACLE_SQL = _oracle()
