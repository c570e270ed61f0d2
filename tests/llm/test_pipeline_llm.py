import random
import sys

from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from brute import near_duplicates, tokens
from prospectus.llm import decontaminate, mixing, quality, token_output
from prospectus.llm.common import written
from prospectus.sources.tables import read_table


def test_stages_match_plain_restatements(spark, sf_small):
    docs = read_table(spark, sf_small, "documents")
    cols, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "near-duplicates", "decontamination", "mixing", "token output"]
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}

    good = written(corpus_pipeline.drop_low_quality(spark, docs, sf_small), "test")
    accepted = {r.doc_id for r in quality.op7_quality(spark, sf_small).collect() if r.predicted}
    assert good.columns == cols and set(rows(good)) == accepted and 0 < len(accepted) < docs.count()

    one = written(corpus_pipeline.drop_near_duplicates(spark, good, sf_small), "test")
    want = {r[0] for r in near_duplicates(sorted(rows(good).items()), 5, 80) if r[3]}
    assert one.columns == cols and set(rows(one)) == want

    clean = written(corpus_pipeline.drop_leaks(spark, one, sf_small), "test")
    bad = {r.doc_id for r in decontaminate.leaks(one, read_table(spark, sf_small, "benchmark")).collect()}
    assert clean.columns == cols and set(rows(clean)) == want - bad

    mixed = written(corpus_pipeline.mix_sources(spark, clean, sf_small), "test")
    copies = {r.doc_id: r.copies for r in mixing.mix_report(clean).collect() if r.copies}
    ids = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == cols and {i: ids.count(i) for i in set(ids)} == copies

    out = corpus_pipeline.write_tokens(spark, mixed, sf_small)
    plain = tokens([(r.doc_id, r.text) for r in mixed.collect()], Tokenizer.from_file(token_output.default_tokenizer()))
    assert sorted(tuple(r) for r in out.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == sorted(plain)
    assert sorted(map(tuple, E.queries()["pipeline"](spark, sf_small).collect())) == sorted(map(tuple, out.collect()))


def test_odd_rows_through_all_stages(spark, sf_small):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(50)) for _ in range(n))
    a, b, leak, long = text(80), text(80), read_table(spark, sf_small, "benchmark").first().text, text(30_000)
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, m1 int, _range int"
    row = lambda i, t, s="s": (i, t, None, s, None, "x", 1, 2)
    rows = [row(1, a), row(1, b), row(None, a), row(None, text(60), None), row(3, None), row(3, ""), row(4, a + " more"), row(5, long),
            row(6, leak + " " + leak), row(None, leak), row(7, text(50), "t"), row(7, text(50), "t")]
    docs = spark.createDataFrame(rows, schema)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    # no labels: every text stays
    good = written(quality.keep_good(docs, empty), "test")
    assert good.count() == len(rows)
    one = written(corpus_pipeline.drop_near_duplicates(spark, good, sf_small), "test")
    assert sorted((r.doc_id or 0, r.text or "") for r in one.collect()) == sorted((r[0] or 0, r[1] or "") for r in rows if r[0] != 4)
    clean = written(corpus_pipeline.drop_leaks(spark, one, sf_small), "test")
    assert clean.count() == one.count() - 2 and clean.columns == docs.columns
    mixed = written(corpus_pipeline.mix_sources(spark, clean, sf_small), "test")
    assert mixed.columns == docs.columns and 0 < mixed.count()
    out = corpus_pipeline.write_tokens(spark, mixed, sf_small).collect()
    assert len(out) == mixed.count() and sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


def test_empty_documents_through_all_stages(spark, sf_small):
    docs = read_table(spark, sf_small, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_small), "test")
        assert docs.isEmpty(), name
    assert corpus_pipeline.write_tokens(spark, docs, sf_small).isEmpty()


def test_registered_queries():
    ops = sorted(n for n in E.queries() if n.startswith("op") and n[2].isdigit())
    assert [int(n[2:].split("_")[0]) for n in sorted(ops, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert "pipeline" in E.queries() and "prospectus.llm" in sys.modules
