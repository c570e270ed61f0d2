import random

import numpy as np
import pytest

from brute import suffix_dedup as brute
from prospectus.llm import suffix_dedup as S
from prospectus.sources.tables import read_table


def run(spark, rows, schema="doc_id long, text string"):
    df = S.repeated_spans(spark.createDataFrame(rows, schema))
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("depth", [2, 3, 7, 50])
def test_suffix_order_is_lexicographic(depth):
    rng = np.random.default_rng(depth)
    for n, letters in ((1, 2), (2, 2), (5, 1), (40, 2), (300, 2), (300, 30), (200, 1)):
        x = rng.integers(1, letters + 1, n)
        got = S.suffix_order(x.astype(np.int64), depth)
        pre = [tuple(x[i:i + depth]) for i in range(n)]
        for i in range(n):
            for j in range(n):
                if pre[i] < pre[j]:
                    assert got[i] < got[j]


def test_minimizers_agree_on_equal_windows():
    a, b = b"x" * 7 + bytes(range(100, 200)) + b"tail", bytes(range(90, 190))
    doc, h, s, e = S.runs([a, b, b"short"], 50)
    at = {0: {}, 1: {}}
    for d, m, lo, hi in zip(doc.tolist(), h.tolist(), s.tolist(), e.tolist()):
        for i in range(lo, hi + 1):
            at[d][(a, b)[d][i:i + 50]] = m
    both = at[0].keys() & at[1].keys()
    assert both and all(at[0][w] == at[1][w] for w in both)
    assert len(at[0]) == len(a) - 49 and len(at[1]) == len(b) - 49


def test_overlaps_and_passages_match_brute_force(spark):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefé \n") for _ in range(n))
    passages = [text(rng.choice([30, 49, 50, 51, 90, 300])) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 80)) for _ in range(4)]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 10)
            parts.insert(rng.randrange(len(parts)), p[a:len(p) - rng.randrange(0, 10)])
        rows.append((i * 5 - 40, "".join(parts)))
    rows += [(400 + i, rng.choice(rows)[1]) for i in range(10)]
    rows += [(500, "ab" * 200), (501, "ba" * 100), (502, "a" * 49), (503, "a" * 50), (504, "a" * 51), (505, "a" * 500)]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_null_empty_long_repeated_rows(spark):
    long = " ".join("k%d" % (i * i % 99991) for i in range(40_000))
    rows = [(1, None), (2, ""), (5, long), (9, long[1000:200_000]), (7, "x" + long), (8, "same text " * 9), (8, "same text " * 9)]
    assert run(spark, rows) == brute(rows)
    # an id with two texts doesn't remove from itself; a null id neither removes nor loses
    other = [(3, "p" * 30 + "shared passage of more than fifty bytes, for sure it is."), (3, "shared passage of more than fifty bytes, for sure it is."),
             (None, "shared passage of more than fifty bytes, for sure it is.")]
    assert sorted(r[2] for r in spark_rows(spark, other)) == [0, 0, 0]


def spark_rows(spark, rows):
    return list(map(tuple, S.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()))


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    t = "a passage that is long enough to be seen as a repeat by all means"
    rows = [(1, t, 1, "a"), (2, "then " + t, 2, "b")]
    assert [r[:4] for r in run(spark, rows, "doc_id long, text string, row long, sha string")] == [
        (1, len(t), 0, 0), (2, len(t) + 5, len(t), 1)]


def test_kept_text(spark):
    t = "a passage that is long enough to be seen as a repeat by all means"
    df = S.repeated_spans(spark.createDataFrame([(1, t), (2, "then " + t + " end")], "doc_id long, text string"), keep_text=True)
    assert {r.doc_id: r.kept for r in df.collect()} == {1: None, 2: bytearray(b"then  end")}


def test_table(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in read_table(spark, sf_small, "documents").collect()]
    assert sorted(map(tuple, S.op2_suffix_dedup(spark, sf_small).collect())) == brute(rows)


def test_texts_that_share_the_bits_of_their_names(spark):
    rng = random.Random(15)
    parts = ["".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(8)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) + str(i)) for i in range(40)] + [(50, None), (51, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, S.repeated_spans(df, key_digits=1).collect()))
    assert got == brute(rows)


def hot_rows(n):
    """A short passage in every text between other words, a longer one in some, and copies."""
    rng = random.Random(21)
    word = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))
    least = lambda t: S.textnum.mix(S._sum_of(S._BYTE[np.frombuffer(t.encode(), dtype=np.uint8)], S.GRAM)).min()
    short, longer = min((word(30) for _ in range(30)), key=least), word(46)  # one that is the minimizer of what is around it
    rows = []
    for i in range(n):
        parts = [word(rng.randrange(5, 60)), short, word(rng.randrange(5, 60))]
        if i % 10 == 3:
            parts += [longer, word(3), short]
        if i % 10 == 0 and rows:
            parts.append(rng.choice(rows)[1])
        rows.append((i, "".join(parts)))
    return rows


def test_hot_minimizers_are_cut(spark, monkeypatch):
    rows = hot_rows(300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, S.repeated_spans(df).collect())) == brute(rows)
    texts = [t.encode() for _, t in rows]
    doc, h, first, last = S.runs(texts, 50)
    value, n = np.unique(h, return_counts=True)
    hot = np.sort(value[n >= 100])
    assert len(hot)  # the short passage's
    d2, key, h2, f2, l2 = S._longer(texts, 50, doc, h, first, last, hot)
    windows = lambda d, f, l: sorted((a, s) for a, x, y in zip(d.tolist(), f.tolist(), l.tolist()) for s in range(x, y + 1))
    assert windows(d2, f2, l2) == windows(doc, first, last) and (h2 == key)[~np.isin(h2, hot)].all()
    assert np.unique(key[np.isin(h2, hot)], return_counts=True)[1].max() < n.max() / 3
    of = {}  # equal windows still have one key
    for a, x, y, k in zip(d2.tolist(), f2.tolist(), l2.tolist(), key.tolist()):
        for s in range(x, y + 1):
            assert of.setdefault(texts[a][s:s + 50], k) == k
