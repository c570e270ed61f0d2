import random

import numpy as np

from prospectus.llm import decontaminate as D
from prospectus.sources.tables import read_table

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def run(spark, docs, items, ds=DOCS, its=ITEMS):
    df = D.leaks(spark.createDataFrame(docs, ds), spark.createDataFrame(items, its))
    return sorted((r.doc_id, r.item_id, round(r.similarity, 6)) for r in df.collect())


def brute(docs, items):
    """Smith-Waterman of every item with every whole document, cell by cell."""
    out = []
    for i, t in items:
        item = D.plain(t).split()
        for d, text in docs:
            words = D.plain(text).split()
            if not item or len(item) < D.SHORT_ITEM:
                if item and item == words:
                    out.append((d, i, 1.0))
                continue
            row, best = [(0, 0)] * (len(words) + 1), 0
            for w in item:
                new = [(0, 0)]
                for j, x in enumerate(words, 1):
                    s, n = row[j - 1]
                    got = max((s + 2, n + 1) if x == w else (s - 1, n), (row[j][0] - 1, row[j][1]),
                              (new[-1][0] - 1, new[-1][1] - 1))
                    new.append(got if got[0] > 0 else (0, 0))
                row = new
                best = max(best, max(n for _, n in row))
            if best >= D.MIN_SIMILARITY * len(item) - 1e-9:
                out.append((d, i, round(best / len(item), 6)))
    return sorted(out)


def test_edited_copies_match_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "v%d" % rng.randrange(400)
    items = [(k, " ".join(word() for _ in range(rng.choice([5, 9, 15, 30, 50])))) for k in range(20)]
    docs = []
    for d in range(150):
        w = items[d % 20][1].split()
        for _ in range(rng.randrange(0, len(w) // 3 + 2)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[word()], [], [w[at], word()]]) or [word()]
        pad = lambda: [word() for _ in range(rng.randrange(0, 60))]
        docs.append((d, " ".join(pad() + w + pad())))
    got, want = run(spark, docs, items), brute(docs, items)
    assert {r[:2] for r in got} == {r[:2] for r in want}
    assert got == want


def test_case_punctuation_and_repeats(spark):
    item = [(1, "One two, three four five six seven EIGHT nine ten.")]
    docs = [(1, "x ONE two three -- four five six seven eight nine ten y"), (2, "one two three four"), (3, None), (4, ""),
            (5, "one two three four five six seven eight nine ten " * 400), (1, "nothing here"), (6, "a" * 200_000)]
    assert run(spark, docs, item) == [(1, 1, 1.0), (5, 1, 1.0)]


def test_short_null_and_equal_items(spark):
    items = [(1, "of the"), (2, None), (3, ""), (4, "a b c d e f"), (5, "a b c d e f")]
    docs = [(1, "all of the words"), (2, "Of the."), (3, "x a b c d e f x"), (None, "a b c d e f")]
    assert sorted(run(spark, docs[:3], items)) == [(2, 1, 1.0), (3, 4, 1.0), (3, 5, 1.0)]
    assert D.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).count() == 5


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, [], [(1, "a b c d e")]) == [] and run(spark, [(1, "a b c d e")], []) == []
    docs = spark.createDataFrame([(1, "a b c d e", 7, 0.5), (2, "x", 8, None)], DOCS + ", item_id long, similarity double")
    items = spark.createDataFrame([(1, "a b c d e", 3)], ITEMS + ", doc_id long")
    left = D.decontaminated(docs, items)
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [2]


def test_item_blocks_give_the_same(spark, sf_small, monkeypatch):
    docs, items = read_table(spark, sf_small, "documents"), read_table(spark, sf_small, "benchmark")
    one = sorted(map(tuple, D.leaks(docs, items).collect()))
    assert one and one == sorted(map(tuple, D.op4_decontaminate(spark, sf_small).collect()))
    want = brute([(r.doc_id, r.text) for r in docs.filter("length(text) < 2500").collect()],
                 [(r.item_id, r.text) for r in items.collect()][:8])
    short = {r.doc_id for r in docs.filter("length(text) < 2500").collect()}
    assert [r[:2] for r in one if r[0] in short and r[1] in {w[0] for w in [(i,) for i in range(8)]}] == [r[:2] for r in want]
    monkeypatch.setattr(D, "ITEM_WORDS", 300)
    assert sorted(map(tuple, D.leaks(docs, items).collect())) == one


def most_net(item, words):
    """Most matched words less words put in of any local alignment, cell by cell."""
    row = [0] * (len(words) + 1)
    for w in item:
        new = [0]
        for j, x in enumerate(words, 1):
            new.append(max(row[j - 1] + (x == w), row[j], new[-1] - 1))
        row = new
    return max(row)


def test_a_longer_alignment_of_higher_score_hides_nothing(spark):
    item = ["i%d" % k for k in range(100)]
    tail = item[10:]
    for k in range(5, 85, 10):
        tail[k] = "other%d" % k
    words = item[:10] + ["between%d" % k for k in range(15)] + tail
    assert run(spark, [(1, " ".join(words)), (2, " ".join(tail))], [(7, " ".join(item))]) == [(1, 7, 0.77), (2, 7, 0.82)]
    rng = random.Random(9)
    items = [(k, " ".join("v%d" % rng.randrange(400) for _ in range(rng.choice([20, 60, 100])))) for k in range(8)]
    docs = []
    for d in range(120):
        w = items[d % 8][1].split()
        cut = rng.randrange(len(w) // 5)
        keep = [x if rng.random() < 0.9 else "z%d" % d for x in w[cut:]]
        docs.append((d, " ".join(w[:cut] + ["y%d" % k for k in range(rng.randrange(20))] + keep)))
    plain = [(i, t.split()) for i, t in items]
    want = [(d, i) for d, t in docs for i, w in plain if most_net(w, t.split()) >= 0.8 * len(w) - 1e-9]
    assert [r[:2] for r in run(spark, docs, items)] == sorted(want)


def test_leaks_in_rows_with_null_ids(spark):
    docs = spark.createDataFrame([(None, "x a b c d e f x"), (None, "clean words only"), (None, None), (1, "a b c d e f"), (2, "z")], DOCS)
    left = D.decontaminated(docs, spark.createDataFrame([(1, "a b c d e f")], ITEMS))
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, ""), (0, "clean words only"), (2, "z")]


def test_rows_that_share_an_id_go_by_their_own_text(spark):
    leak, items = "so a b c d e f g", spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    rows = [(1, leak), (1, "clean words of its own"), (1, None), (None, leak), (None, "clean too"), (2, "clean words of its own")]
    for order in (rows, rows[::-1]):
        left = D.decontaminated(spark.createDataFrame(order, DOCS), items).select("doc_id", "text").collect()
        assert sorted(map(tuple, left), key=str) == sorted((r for r in rows if r[1] != leak), key=str)


def test_seeds_are_disjoint_and_the_rarest():
    rng = np.random.default_rng(4)

    def least(g, need, n, count):
        best = [[0] * (len(g) + n + 1)] + [[float("inf")] * (len(g) + n + 1) for _ in range(need)]
        for k in range(1, need + 1):
            for i in range(len(g) - 1, -1, -1):
                best[k][i] = min(best[k][i + 1], 1 + count[g[i]] + best[k - 1][i + n])
        return best[need][0]

    for m in (5, 6, 9, 10, 11, 25, 26, 60, 101):
        it = D.Item(0, rng.integers(0, 6, m).astype(np.uint64))
        g = [int(x) for x in D.grams(it.words, it.n)]
        count = {x: int(rng.integers(0, 50)) for x in g}
        seeds = it.seeds(count)
        assert len(seeds) == it.edits + 1 and all(g[i] == h for h, i in seeds)
        assert all(b[1] - a[1] >= it.n for a, b in zip(seeds, seeds[1:]))
        assert sum(1 + count[h] for h, _ in seeds) == least(g, it.edits + 1, it.n, count)
    long = D.Item(0, rng.integers(0, 2**60, 50_000).astype(np.uint64)).seeds({})  # several stretches
    assert len(long) == 10_001 and all(b[1] - a[1] >= 4 for a, b in zip(long, long[1:]))


def test_a_very_long_item(spark):
    words = [f"w{i}" for i in range(6000)]
    copy = [w if i % 7 else "other" for i, w in enumerate(words)]
    got = run(spark, [(1, "before " + " ".join(copy) + " after"), (2, " ".join(words[:3000]))], [(5, " ".join(words))])
    assert [r[:2] for r in got] == [(1, 5)]
