import random
import zlib

import numpy as np

from prospectus.llm import langid, quality
from prospectus.sources.tables import read_table

ALPHABET = {"xa": "abcde", "xb": "fghij", "xc": "çéèêà"}


def text(rng, lang, n=30):
    return " ".join("".join(rng.choice(ALPHABET[lang]) for _ in range(rng.randrange(2, 7))) for _ in range(n))


def test_languages_of_held_out_rows(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang), lang) for i in range(300) for lang in [rng.choice(list(ALPHABET))]]
    rows += [(1000, None, "xa"), (1001, "", "xa"), (1002, "12 !! --", "xb"), (1003, text(rng, "xb", 60_000), None),
             (None, text(rng, "xa"), "xa"), (1004, "A B C", "xa"), (1004, "A B C", "xa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1000, 1001, 1002))
    assert by[1003].lang_pred == "xb" and by[None].lang_pred == "xa" and by[None].held_out is False
    assert by[1004].lang_pred == "xa"
    for i, _, lang in rows[:300]:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert by[i].lang_pred == lang


def test_scores_match_a_plain_naive_bayes(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, 6), lang) for i in range(30) for lang in [rng.choice(list(ALPHABET))]]
    (names, model), = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = np.full((langid.BUCKETS, len(names)), langid.SMOOTHING)
    for _, t, lang in rows:
        for n in langid.ORDERS:
            codes, _ = langid._codes([t])
            b, ok = langid._grams(codes, n)
            np.add.at(counts[:, names.index(lang)], b[ok].astype(int), 1)
    assert np.allclose(model, np.log(counts / counts.sum(0)))


def test_blocks_of_languages_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    langs = [f"x{c}" for c in "abcdefg"]
    rows = [(i, "".join(rng.choice("abcdefg"[k:k + 4] + " ") for _ in range(30)), lang)
            for i in range(80) for k, lang in [rng.choice(list(enumerate(langs)))]] + [(90, "12", "xa"), (91, None, None), (92, "aaa", "same"), (93, "aaa", "samf")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = lambda: sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify(df).collect())
    whole = found()
    for n in (1, 3):
        monkeypatch.setattr(langid, "BLOCK_LANGUAGES", n)
        assert found() == whole


def test_no_learning_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, score double"
    assert langid.identify(spark.createDataFrame([], schema)).count() == 0
    got = langid.identify(spark.createDataFrame([(1, "abc", None, 0.1)], schema)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_language_accuracy_on_the_table(spark, sf_small):
    docs = {r.doc_id: r.lang for r in read_table(spark, sf_small, "documents").collect()}
    got = [r for r in langid.op9_langid(spark, sf_small).collect() if r.held_out]
    assert np.mean([docs[r.doc_id] == r.lang_pred for r in got]) > 0.95


def test_quality_accuracy_on_the_table(spark, sf_small):
    labels = {r.doc_id: r.quality for r in read_table(spark, sf_small, "labels").collect()}
    got = quality.op7_quality(spark, sf_small).collect()
    assert len(got) == read_table(spark, sf_small, "documents").count()
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([labels[r.doc_id] == r.predicted for r in held]) > 0.9


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 4), (None, "word " * 50, 5), (3, "x " * 200_000, 6), (3, "again", 7)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.score_documents(docs, none).collect()
    assert len(got) == 5 and {(r.score, r.predicted) for r in got} == {(0.5, 1)}
    assert quality.score_documents(spark.createDataFrame([], docs.schema), none).count() == 0
    learned = [i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 3 != 1]
    one = spark.createDataFrame([(i, 1, None) for i in learned] + [(learned[0], None, 0), (None, 0, 0)], none.schema)
    assert all(r.score == 1.0 for r in quality.score_documents(docs, one).collect())
    kept = quality.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 5


def test_scores_match_a_plain_restatement(spark, sf_small):
    """Kernel features, weighted ridge by least squares and the min-max form of the isotonic fit, in one place."""
    docs = [(r.doc_id, r.text) for r in read_table(spark, sf_small, "documents").collect()]
    text = dict(docs)
    learn = [(text[r.doc_id], r.quality) for r in read_table(spark, sf_small, "labels").collect()
             if r.doc_id in text and r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    stats = lambda ts: quality.statistics([(t or "").encode() for t in ts])
    x, y = stats([t for t, _ in learn]), np.array([q for _, q in learn], dtype=float)
    mean, scale = x.mean(0), np.sqrt(np.maximum(x.var(0), 1e-12)) + 1e-6
    z = lambda s: np.column_stack([quality.fourier((s - mean) / scale), np.ones(len(s))])
    w = np.sqrt(np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))))
    penalty = np.eye(quality.FEATURES + 1)[:-1] * np.sqrt(quality.RIDGE * len(y))
    beta = np.linalg.lstsq(np.vstack([z(x) * w[:, None], penalty]), np.concatenate([y * w, np.zeros(len(penalty))]), rcond=None)[0]
    cell = np.clip(np.floor((z(x) @ beta + 0.5) * quality.BINS / 2), 0, quality.BINS - 1)
    used = np.unique(cell)
    total = lambda a, b: y[(cell >= used[a]) & (cell <= used[b])].mean()
    fit = [max(min(total(j, k) for k in range(i, len(used))) for j in range(i + 1)) for i in range(len(used))]
    want = np.interp(z(stats([t for _, t in docs])) @ beta, (used + 0.5) * 2 / quality.BINS - 0.5, fit)
    got = {r.doc_id: r.score for r in quality.op7_quality(spark, sf_small).collect()}
    near = np.abs(np.array([got[i] for i, _ in docs]) - want) < 1e-6
    assert near.mean() > 0.98  # a text may fall on the other side of a cell's edge


def test_rows_go_by_their_own_text(spark, sf_small):
    docs, labels = (read_table(spark, sf_small, t) for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    text = {r.doc_id: r.text for r in docs.collect()}
    said = {r.doc_id: r.predicted for r in quality.op7_quality(spark, sf_small).collect()}
    good, bad = ([text[i] for i in sorted(said) if said[i] == v and text[i]][:3] for v in (1, 0))
    more = [(i, t) for i in (None, 10**9, 10**9 + 1) for t in (*good, *bad)]
    for rows in (more, more[::-1]):
        kept = quality.keep_good(docs.unionByName(spark.createDataFrame(rows, docs.schema)), labels).collect()
        new = sorted((tuple(r) for r in kept if r.doc_id not in text), key=str)
        assert new == sorted(((i, t) for i, t in rows if t in good), key=str)
        assert len(kept) - len(new) == sum(said.values())


def test_statistics_by_hand():
    s = dict(zip(quality.STATS, quality.statistics([b"Ab ab, 12\nab"])[0]))
    assert s["log_words"] == np.log1p(4) and s["upper"] == 1 / 12 and s["digit"] == 2 / 12 and s["line_end"] == 1 / 12
    assert s["distinct_words"] == 3 / 4 and s["top_word"] == 2 / 4 and s["mean_word"] == (2 + 3 + 2 + 2) / 4
    assert not quality.statistics([None, b""]).any()


def test_isotonic_and_kernel():
    fit = quality.isotonic(np.array([0.1, 0.5, 0.3, 0.9]), np.array([1.0, 1, 3, 1]))
    assert np.allclose(fit, [0.1, 0.35, 0.35, 0.9])
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, len(quality.STATS)))
    z = quality.fourier(x)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    width = quality.WIDTH * np.sqrt(len(quality.STATS))
    assert np.abs(z @ z.T - np.exp(-d / (2 * width**2))).mean() < 0.1
