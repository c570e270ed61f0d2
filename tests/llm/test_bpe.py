import hashlib
import random

import pytest

from prospectus.llm import bpe
from prospectus.sources.tables import read_table

RANKS = bpe.default_ranks()
PIECES = ["'s", "'re", "''ll", " ", "  ", "\n", "\t\r\n", "don't", "x" * 700, "word ", " Éa", "9", "½", "漢字", "😀",
          " ", "\x85", "\x1c", "!?", "-" * 600, "ࢉ", "\U00010d4a", " " * 900]


def plain(rows):
    """What the library makes of whole texts."""
    enc = bpe.bpe(*RANKS).encoding
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    return sorted(out, key=str)


def run(spark, rows, schema="doc_id long, text string", **kw):
    df = bpe.digests(spark.createDataFrame(rows, schema), *RANKS, **kw)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_pieces_are_the_librarys():
    own, rng = bpe.bpe(*RANKS), random.Random(11)
    for _ in range(3000):
        t = "".join(rng.choice(PIECES)[:rng.randrange(1, 5)] for _ in range(rng.randrange(12)))
        ids = memoryview(own.text_ids(t)).cast("I").tolist()
        assert ids == own.encoding.encode_ordinary(t) and own.decode(ids) == t.encode()
    for c in own.newer.pattern[1:200] + "\x1c\x85᠎​":
        for t in ("a" + c + "b", "1" + c + " ", " " + c):
            assert memoryview(own.text_ids(t)).cast("I").tolist() == own.encoding.encode_ordinary(t)


def test_null_empty_repeated_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = [(1, None), (2, ""), (3, "it's a cat"), (3, "it's a cat"), (None, "x"), (None, None), (-5, " \n ")]
    assert run(spark, rows) == plain(rows)
    schema = "doc_id long, text string, row long, part int, ids string, seam string, at int"
    assert run(spark, [(7, "abc " * 9, 1, 2, "z", None, 3)], schema) == plain([(7, "abc " * 9)])


@pytest.mark.parametrize("chunk,overlap", [(64, 24), (50, 8)])
def test_long_texts_are_stitched(spark, chunk, overlap):
    rng = random.Random(chunk)
    rows = [(i % 40, "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    rows += [(100, "a" * 5000), (101, " " * 1000 + "b"), (102, "ab " * 21 + "c"), (103, "'re" * 400), (None, "né " * 300)]
    lengths = [chunk, chunk + 1, 2 * chunk, 2 * chunk + 1, 2 * chunk + overlap, 2 * chunk + overlap + 1]
    rows += [(200 + n, ("we'll see  " * chunk)[:n]) for n in lengths]
    assert run(spark, rows, chunk=chunk, overlap=overlap) == plain(rows)


def test_a_pre_token_longer_than_the_overlap(spark):
    text = "start " + "y" * (3 * bpe.CHUNK) + " end " * bpe.CHUNK
    rows = [(1, text), (2, text[:-1]), (1, text)]
    assert run(spark, rows) == plain(rows)
    parts = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), *RANKS)
    assert parts.groupBy("row").count().filter("count > 2").count() == 3  # other chunks are still apart


def test_decode_gives_the_bytes_back(spark, sf_small):
    docs = read_table(spark, sf_small, "documents")
    back = {}
    for r in sorted(bpe.decode(bpe.encode(docs, *RANKS), *RANKS).collect(), key=lambda r: (r.doc_id, r.part)):
        back[r.doc_id] = back.get(r.doc_id, b"") + bytes(r.bytes)
    assert back == {r.doc_id: (r.text or "").encode() for r in docs.collect()}


def test_table(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in read_table(spark, sf_small, "documents").collect()]
    assert sorted((tuple(r) for r in bpe.op11_bpe(spark, sf_small).collect()), key=str) == plain(rows)
