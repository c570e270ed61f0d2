import random

import pytest

from brute import added_spans
from brute import personal_data as brute
from prospectus.llm import pii
from prospectus.sources.tables import read_table


def joined(by_kind):
    return ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in by_kind[k])


def run(spark, rows, schema="doc_id long, text string"):
    return {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, schema)).collect()}


def check(got, rows):
    for i, t in rows:
        want = brute(t)
        assert got[i].base_spans == joined(want), (i, t)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [len(want[k]) for k in pii.KINDS]
        assert set(filter(None, got[i].base_spans.split(","))) <= set(got[i].spans.split(","))


ODD = ["a@b.c", "a@b.c_d@e.f", "x..y%+@-.-", "a@b", "a@b.c@d.e", "é@b.cé x@y.z.", "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255",
       "0001.02.3.00000255", "99999999999999999999.1.1.1", "1.2.3", "4111 1111-1111 1111", "4111111111111111 5500000000000004",
       "411111111111111", "4111  1111 1111 1111", "12345678901234567890", "+1 (956) 555-0122 +44 20", "+1 2", "+12345678",
       "+1.2.3.4.5.6.7.8.9 ", "++15551234567", "+1 555 123 4567 4111111111111111", "\U0001f600 \U0001f600 me@x.io +49 30 1234567",
       "mail:a@b.co,b@c.co;1.1.1.1", "0000000000000", "- 1-2-3-4-5-6-7-8-9-0-1-2-3"]


def test_base_spans_match_brute_force(spark):
    rng = random.Random(8)
    rows = list(enumerate(ODD + ["".join(rng.choice("a@.1 25-+()é0_ ") for _ in range(60)) for _ in range(500)]))
    check(run(spark, rows), rows)


def test_long_texts_need_no_stack(spark):
    rows = [(1, "a" * 100_000), (2, "a@b" + ".c" * 50_000), (3, "1" * 50_000), (4, "1 " * 20_000), (5, "+1" + " " * 20_000),
            (6, "x " * 20_000 + "me@x.org"), (7, "1." * 3000)]
    check(run(spark, rows), rows)


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"w{chr(97 + i)} then reach me: user{i}@mail.org today") for i in range(8)]
    rows += [(i, f"please reach me: nick_{i}x7, today") for i in range(20, 23)]
    rows += [(i, f"some other words id{i} follow") for i in range(30, 40)]
    got = run(spark, rows)
    check(got, rows)
    assert got[20].spans == "email:17:26" and rows[8][1][17:26] == "nick_20x7"
    assert all(got[i].spans == "" for i in range(30, 40))


@pytest.mark.parametrize("seed", [1, 2])
def test_added_spans_match_plain_dictionaries(spark, seed):
    rng = random.Random(seed)
    base = ["a%d@mail.org", "10.0.0.%d", "+49 30 12345%d", "nick_%d", "id%d,", "(x%d)", "no", "word"]
    lead = ["reach me:", "my Address", "call on", "of the", "server at", "REACH me:"]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            k = rng.randrange(len(lead))
            item = rng.choice(base[:4] if rng.random() < 0.7 and k != 3 else base)
            parts.append(f"{lead[k]} {item % rng.randrange(30) if '%' in item else item}")
        rows.append((i, rng.choice([" ", ". so "]).join(parts)))
    want, got = added_spans(rows), run(spark, rows)
    check(got, rows)
    found = 0
    for r, (i, t) in enumerate(rows):
        spans = brute(t)
        every = {(k, a, b) for k in pii.KINDS for a, b in spans[k]} | want[r]
        found += len(want[r])
        assert set(filter(None, got[i].spans.split(","))) == {f"{k}:{a}:{b}" for k, a, b in every}, t
    assert found > 10


def test_common_contexts_add_nothing(spark):
    rows = [(i, f"of the a{i}@mail.org") for i in range(5)] + [(i, "of the king and of the queen") for i in range(5, 40)]
    rows += [(50, "of the x99 sort")]
    assert run(spark, rows)[50].spans == ""


def test_null_empty_repeated_rows_and_columns(spark):
    assert run(spark, []) == {}
    rows = [(1, None, "a"), (2, "", "b"), (None, "a@b.c", "c"), (3, "a@b.c", None), (3, "a@b.c", None), (3, "none", None)]
    df = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, email string"))
    got = sorted((str(r.doc_id), r.n_email, r.spans) for r in df.collect())
    assert got == [("1", 0, ""), ("2", 0, ""), ("3", 0, ""), ("3", 1, "email:0:5"), ("3", 1, "email:0:5"), ("None", 1, "email:0:5")]


@pytest.mark.parametrize("kind", pii.KINDS)
def test_regexes_agree_on_tables(spark, sf_small, kind):
    rows = [(r.doc_id, r.text) for r in read_table(spark, sf_small, "documents").collect()]
    if kind == "email":
        check(run(spark, rows), rows)
