import numpy as np

from brute import component_of
from prospectus.llm import pq
from prospectus.sources.tables import read_table

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, least=0.9, kind=np.float32):
    """Vectors of each length among themselves."""
    n, links = [0] * len(rows), []
    fine = lambda v: v and all(c is not None and np.isfinite(c) for c in v) and any(v)
    for dim in {len(v) for _, v in rows if fine(v)}:
        ok = [k for k, (_, v) in enumerate(rows) if fine(v) and len(v) == dim]
        x = np.array([rows[k][1] for k in ok], dtype=kind).astype(float)
        x /= np.sqrt((x**2).sum(1, keepdims=True))
        for i, j in zip(*np.nonzero(x @ x.T >= least)):
            if i != j:
                n[ok[i]] += 1
                links.append((rows[ok[i]][0], rows[ok[j]][0]))
    comp = component_of({i for i, _ in rows}, links)
    return [(i, n[k], comp[i], comp[i] == i) for k, (i, _) in enumerate(rows)]


def run(spark, rows, schema=SCHEMA):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept)
                  for r in pq.near_vectors(spark.createDataFrame(rows, schema)).collect())


def test_clusters_match_brute_force(spark):
    rng = np.random.default_rng(0)
    x = []
    for size in (1, 1, 40, 300, 7, 1, 90):
        c = rng.normal(size=16)
        x += [c + rng.normal(size=16) * 0.22 for _ in range(size)]
    x += x[50:60] * 3
    rows = [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got, want = run(spark, rows), sorted(brute(rows))
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.9 * there and all(a[1] <= b[1] for a, b in zip(got, want))
    assert np.mean([a[2] == b[2] for a, b in zip(got, want)]) > 0.95


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1.0, -0.0]), (12, [0.0, 3.0])]
    assert run(spark, rows) == sorted(brute(rows))


def test_each_length_by_itself_and_doubles(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.1, 0.0]), (3, [0.0, 0.0, 1.0]), (4, [1.0] * 4), (5, [1.0] * 4), (6, [1.0, 1.0, 1.0, 0.9]),
            (7, [2.0]), (8, [-1.0]), (9, [0.5])]
    assert run(spark, rows) == sorted(brute(rows))
    assert [r[1] for r in run(spark, rows)] == [1, 1, 0, 2, 2, 2, 1, 0, 1]
    # 0.9 is missed by less than a float can tell
    near = [(1, [1.0, 0.0]), (2, [0.9, float(np.sqrt(1 - 0.81) + 3e-9)]), (3, [0.9, float(np.sqrt(1 - 0.81) - 3e-9)])]
    schema = "vec_id long, embedding array<double>"
    assert run(spark, near, schema) == sorted(brute(near, kind=np.float64)) and run(spark, near, schema)[0][1] == 1


def test_empty_table_and_extra_columns(spark):
    assert run(spark, []) == []
    rows = [(4, [1.0, 1.0], "a", 1), (4, [1.0, 1.0], "b", 2), (2, [1.0, 1.01], None, 3)]
    assert run(spark, rows, SCHEMA + ", key string, w int") == [(2, 2, 2, True), (4, 2, 2, False), (4, 2, 2, False)]


def test_recall_on_the_table(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, sf_small, "embeddings").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in pq.op10_vectors(spark, sf_small).collect())
    want = sorted(brute(rows))
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want))


def test_forest_keeps_components():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 50, 80), rng.integers(0, 50, 80)
    use = pq.forest(a, b)
    full = component_of(range(50), zip(a.tolist(), b.tolist()))
    assert component_of(range(50), zip(a[use].tolist(), b[use].tolist())) == full and len(use) < 50
