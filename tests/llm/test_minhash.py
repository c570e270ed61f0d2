import random

import pytest

from brute import near_duplicates as brute
from brute import one_of_each
from prospectus.llm import minhash
from prospectus.sources.tables import read_table


def run(spark, rows, schema="doc_id long, text string", **kw):
    df = minhash.near_duplicates(spark.createDataFrame(rows, schema), **kw)
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = "x%d" % rng.randrange(10**6)
    return " ".join(w)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_groups_at_the_threshold_match_brute_force(spark, k, percent):
    rng = random.Random(k)
    rows = []
    for g in range(12):
        words = ["w%d" % rng.randrange(300) for _ in range(rng.choice([8, 60, 200]))]
        for _ in range(rng.randrange(1, 14)):
            rows.append((len(rows) * 3, edited(rng, words, rng.randrange(0, max(2, len(words) // 25)))))
    rng.shuffle(rows)
    assert run(spark, rows, k=k, percent=percent) == brute(rows, k, percent)


def test_copies_case_and_spacing(spark):
    rows = [(5, "A b  C d"), (2, "a\tb c D"), (9, "a b"), (4, "A B"), (7, "a"), (8, "\x0b a \r\n"), (1, "é B c d"), (3, "É b c d")]
    assert run(spark, rows, k=3, percent=85) == brute(rows, 3, 85)


def test_null_empty_long_and_repeated_rows(spark):
    long = " ".join("t%d" % (i * i % 7919) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "  \n"), (4, long), (6, long + " end"), (6, long + " end"), (8, "one two"), (8, "one two")]
    got = run(spark, rows, k=3, percent=85)
    assert [r for r in got if r[0] < 4] == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    assert got == brute(rows, 3, 85)
    df = minhash.near_duplicates(spark.createDataFrame([(None, "a b c"), (1, "a b c")], "doc_id long, text string"), 3, 85)
    assert {(r.doc_id, r.n_shingles, r.kept) for r in df.collect()} == {(None, 1, True), (1, 1, True)}


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = [(1, "a b c d e f", 5, "z"), (2, "a b c d e f", 6, None)]
    assert run(spark, rows, "doc_id long, text string, component_id long, band string", k=3, percent=85) == [
        (1, 4, 1, True), (2, 4, 1, False)]


def test_tables(spark, sf_small):
    docs = read_table(spark, sf_small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.op5_minhash(spark, sf_small).collect())
    assert got == brute(rows, 3, 85)
    kept = minhash.keep_one_each(docs, 5, 80)
    assert kept.columns == docs.columns and kept.count() == sum(r[3] for r in brute(rows, 5, 80))


def mixed_ids(seed):
    """Few ids with many texts each, near copies among them and without an id."""
    rng = random.Random(seed)
    rows = []
    for g in range(9):
        words = ["w%d" % rng.randrange(300) for _ in range(60)]
        rows += [(rng.choice([None, *range(14)]), edited(rng, words, rng.randrange(0, 3))) for _ in range(4)]
    return rows + [(3, None), (3, ""), (None, ""), (20, "all by itself"), (21, "all BY itself")]


@pytest.mark.parametrize("seed", [0])
def test_ids_with_several_texts(spark, seed):
    for rows in (mixed_ids(seed), mixed_ids(seed)[::-1]):
        known = [r for r in rows if r[0] is not None]
        assert run(spark, known, k=3, percent=85) == brute(known, 3, 85)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        kept = [tuple(r) for r in minhash.keep_one_each(df, 3, 85).collect()]
        # which of several near texts of one id stays is a matter of their hashes
        near = {i for i, _ in rows if len(one_of_each([r for r in rows if r[0] == i], 3, 85)) < sum(r[0] == i for r in rows)}
        plain = lambda rs: sorted((r for r in rs if r[0] not in near), key=str)
        assert plain(kept) == plain(one_of_each(rows, 3, 85)) and len(kept) == len(one_of_each(rows, 3, 85))


def test_a_text_of_its_own_survives_a_copy_under_the_same_id(spark):
    c, a, b = ("%s " * 30 % tuple(x + str(i) for i in range(30)) for x in "cab")
    rows = [(3, c), (5, c), (5, a), (6, a + "x"), (7, b), (5, b + "y")]
    for order in (rows, rows[::-1]):
        assert run(spark, order, k=5, percent=80) == brute(order, 5, 80)
        assert {r[2] for r in run(spark, order, k=5, percent=80)} == {3}
        kept = minhash.keep_one_each(spark.createDataFrame(order, "doc_id long, text string"), 5, 80)
        assert sorted(map(tuple, kept.collect())) == sorted([(3, c), (5, a), (5, b + "y")])
