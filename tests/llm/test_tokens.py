import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from brute import tokens as brute
from prospectus.llm import token_output as T
from prospectus.llm.common import run_path
from prospectus.sources.tables import read_table

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b ", "\n", "a\n b", "a \n\n b", "it's  we'll 's", "　x y z",
       "<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>", "\u0000\u001f b", "é \U0001f600  \U0001f600", "12 34  !!  ##", " \t a"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(T.default_tokenizer())


def run(spark, rows, schema="doc_id long, text string"):
    df = T.tokenize(spark.createDataFrame(rows, schema), T.default_tokenizer())
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_pieces_give_the_ids_of_the_whole_text(tokenizer):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(["a", "B", " ", "  ", "\n", "'s", "1", "é", ".", "\t", " "]) for _ in range(40))
                   for _ in range(300)]
    enc = T.Encoder(T.default_tokenizer())
    for _ in range(2):  # from the library, then from memory
        for t, b in zip(texts, enc.encode(texts)):
            assert np.frombuffer(b, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_odd_texts_round_trip(spark, tokenizer):
    rows = [(i * 7 % 23 - 5, t) for i, t in enumerate(ODD)] + [(100, None), (101, "word " * 50_000)]
    assert run(spark, rows) == brute(rows, tokenizer)


def test_empty_table_null_ids_and_clashing_columns(spark):
    assert run(spark, []) == []
    got = run(spark, [(None, "b", 1), (3, "a", 2), (3, "a", 2)], "doc_id long, text string, shard int")
    assert [r[0] for r in got] == [None, 3, 3] and [r[1] for r in got] == [0, 2, 4]


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(5000, int), rng.integers(0, 5, 4000), np.tile(rng.integers(0, 900, 37), 120), np.array([3])):
        cuts = np.sort(rng.integers(0, len(ids), 3))
        tokens = np.diff(np.concatenate(([0], cuts, [len(ids)])))
        tokens = tokens[tokens > 0]
        symbols, per_doc, rules = T.compress(ids, tokens, 1000)
        assert T.expand(symbols, rules, 1000).tolist() == ids.tolist()
        lengths = T.expansion_lengths(rules, 1000)
        at = tok = 0
        for s, n in zip(per_doc, tokens):
            own = symbols[at:at + s]
            assert T.expand(own, rules, 1000).tolist() == ids[tok:tok + n].tolist()
            for k in {0, n // 2, n - 1}:
                assert T.id_at(own, rules, lengths, 1000, int(k)) == ids[tok + k]
            at, tok = at + s, tok + n
    assert len(T.compress(np.tile([1, 2, 3, 4], 1000), np.array([4000]), 10)[0]) <= 1000


def test_rules_until_no_pair_is_frequent():
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 50_000, 400)
    repeated = np.concatenate([np.concatenate([passage, rng.integers(0, 50_000, 20)]) for _ in range(1000)])
    many = rng.permutation(np.repeat(np.arange(6000), 10).reshape(-1, 10), axis=0)  # runs of 10, each id in its own
    many = np.concatenate([many[:, :5].ravel(), many[:, 5:].ravel(), np.tile(np.arange(7000, 13000), 8)])
    small = np.concatenate([np.array([5, 6, 100 + i]) for i in range(T.MIN_PAIRS)])
    for ids in (repeated, many, small, np.full(100_000, 3)):
        symbols, per_doc, rules = T.compress(ids, np.array([len(ids)]), 50_000)
        assert T.expand(symbols, rules, 50_000).tolist() == ids.tolist() and per_doc.tolist() == [len(symbols)]
        places = {}
        for i, p in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist())):
            if not places.get(p) or places[p][-1] < i - 1 or p[0] != p[1]:
                places.setdefault(p, []).append(i)
        assert max(map(len, places.values()), default=0) < T.MIN_PAIRS
    assert len(T.compress(repeated, np.array([len(repeated)]), 50_000)[0]) < 25_000


def test_files_hold_documents_in_order(spark, sf_small, tokenizer):
    docs = read_table(spark, sf_small, "documents")
    path = run_path(spark, "tokens-test")
    T.write_tokens(docs, path, T.default_tokenizer())
    rows = {r.doc_id: r.text for r in docs.collect()}
    blocks = sorted((r.asDict() for r in spark.read.parquet(path).collect()), key=lambda r: (r["shard"], r["block"]))
    assert [i for r in blocks for i in r["doc_ids"]] == sorted(rows)
    for r in blocks:
        for k in (0, len(r["doc_ids"]) // 2, len(r["doc_ids"]) - 1):
            want = tokenizer.encode(rows[r["doc_ids"][k]], add_special_tokens=False).ids + [0]
            assert T.decode_document(r, k).tolist() == want


def test_query_matches_brute_force(spark, sf_small, tokenizer):
    rows = [(r.doc_id, r.text) for r in read_table(spark, sf_small, "documents").collect()]
    got = sorted(tuple(r) for r in T.op6_tokens(spark, sf_small).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == brute(rows, tokenizer)
