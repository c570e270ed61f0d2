import hashlib
import math
import random

from prospectus.llm import centroids
from prospectus.sources.tables import read_table

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k, rounds, dim):
    """Rounds of exact integer arithmetic, every distance computed."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    c = [v for _, _, v in sorted((i is None, sha(f"3:{i}"), v) for i, v in kept)[:k]]
    dist = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    near = lambda v: min((dist(v, m), j) for j, m in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                c[j] = [sum(p) // len(mine) for p in zip(*mine)]
    placed = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in placed)
    return sorted(((i, j, d, sum(e for _, e, o in placed if o == j), total, sha(",".join(map(str, c[j]))))
                   for i, d, j in placed), key=str)


def run(spark, rows, k=8, rounds=10, dim=4, schema=SCHEMA):
    df = centroids.clusters(spark.createDataFrame(rows, schema), k=k, rounds=rounds, dimension=dim)
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_matches_plain_rounds(spark):
    rng = random.Random(12)
    rows = [(i, [rng.gauss(rng.choice([-2, 0, 2]), 1) for _ in range(4)]) for i in range(300)]
    assert run(spark, rows) == plain(rows, 8, 10, 4)
    assert run(spark, rows, k=1, rounds=2) == plain(rows, 1, 2, 4)


def test_ties_repeated_rows_and_empty_clusters(spark):
    # a grid of few points: many equal distances, equal vectors as centroids, centroids that lose all vectors
    rows = [(i, [float(i % 3), float(i % 2), 0.0, -0.0]) for i in range(60)] + [(5, [1.0, 1.0, 0.0, 0.0])] * 3
    for k in (2, 5, 8):
        assert run(spark, rows, k=k) == plain(rows, k, 10, 4)


def test_vectors_left_out(spark):
    rows = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0] * 5), (5, [1.0, None, 0.0, 0.0]), (6, [float("nan"), 0.0, 0.0, 0.0]),
            (7, [float("inf"), 0.0, 0.0, 0.0]), (8, [1.5, -1.5, 0.0001, -0.0001]), (9, [0.0] * 4), (None, [3.0] * 4)]
    assert run(spark, rows) == plain(rows, 8, 10, 4)
    assert run(spark, [(1, [1e300, 0.0, 0.0, 0.0])]) == []
    assert run(spark, rows[:7]) == run(spark, []) == []


def test_large_components_take_the_integer_path(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-60000, 60000) for _ in range(4)]) for i in range(100)]
    rows += [(200 + i, [65535.9, -65535.9, 65535.9, -65535.9]) for i in range(3)]
    assert run(spark, rows, k=5) == plain(rows, 5, 10, 4)


def test_clashing_columns_and_floats(spark):
    rows = [(1, [0.25, 0.5, 0.0, 1.0], 7, "z", 2), (2, [0.25, 0.5, 0.0, 0.0], 8, None, 3)]
    schema = "vec_id long, embedding array<float>, cluster int, x string, inertia int"
    assert run(spark, rows, schema=schema) == plain([r[:2] for r in rows], 8, 10, 4)


def test_table(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, sf_small, "embeddings").collect()]
    assert sorted((tuple(r) for r in centroids.op12_centroids(spark, sf_small).collect()), key=str) == plain(rows, 8, 10, 64)
