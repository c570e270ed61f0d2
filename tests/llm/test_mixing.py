import duckdb
import pytest

from prospectus.llm import mixing
from prospectus.sources.tables import read_table
from tools.compare_oracle import rows_of

SCHEMA = "doc_id long, text string, source string"


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, stop at the cap, share the excess again until none is above."""
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), float(total)
    while open_:
        share = left / sum(w[s] for s in open_)
        over = {s for s in open_ if share * w[s] > cap * sizes[s] + 1e-9}
        if not over:
            return out | {s: share * w[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def report(spark, rows, schema=SCHEMA):
    return mixing.mix_report(spark.createDataFrame(rows, schema)).collect()


def test_targets_copies_and_sizes(spark):
    rows = [(i, "w " * (1 + i * i % 17), ["a", "b", "é", None, "z"][i % 5 if i < 60 else 0]) for i in range(200)]
    got = report(spark, rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = targets(sizes)
    taken = {}
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 17
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, report(spark, rows)), key=str)


def test_the_mix_repeats_rows_as_reported(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2 and i > 20], i) for i in range(50)] + [(7, "w w", "a", 1), (7, "w x", "a", 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", size int")
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    by_id, want = {}, {}
    for r in mixed.collect():
        by_id[r.doc_id] = by_id.get(r.doc_id, 0) + 1
    for r in mixing.mix_report(df).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    assert by_id == {k: v for k, v in want.items() if v}


def test_nulls_empty_texts_and_tables(spark):
    assert report(spark, []) == []
    got = report(spark, [(1, None, "a"), (2, "", "a"), (None, "x y", None), (3, " \n", None)])
    assert [(r.size, r.taken) for r in got if r.source == "a"] == [(0, 0), (0, 0)]
    assert {r.size for r in got if r.source is None} == {2, 0}


def test_one_hot_source_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ID_BLOCK", 7)
    rows = [(i * 3, "w w", "hot") for i in range(300)] + [(9000 + i, "w", "cold") for i in range(30)]
    got = report(spark, rows)
    monkeypatch.undo()
    assert sorted(map(tuple, got)) == sorted(map(tuple, report(spark, rows)))


def test_matches_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet')")
    df, res = mixing.op1_mix(spark, sf_small), con.execute(mixing.ORACLE_SQL)
    cols = [d[0] for d in res.description]
    assert rows_of(df.columns, list(map(tuple, df.collect()))) == rows_of(cols, res.fetchall())
    total = read_table(spark, sf_small, "documents").count()
    assert df.count() == total
