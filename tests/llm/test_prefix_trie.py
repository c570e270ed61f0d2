import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from prospectus.llm import prefix_trie as T
from prospectus.sources.tables import read_table

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_convs(rows):
    """Rebuilt conversations as {id: ((role, text), ...)}."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by = hashlib.sha256((text or "").encode()).hexdigest()
            turns[c].append((turn is not None, turn, role or "", by, text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
    return out


def plain(rows):
    """A row per node, by a dictionary of all prefixes."""
    members = defaultdict(list)
    for c, turns in plain_convs(rows).items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append((c, d == len(turns)))
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    low = {p: min(c for c, _ in m) for p, m in members.items()}
    sha = lambda m: hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in m if end)).encode()).hexdigest()
    return sorted(((low[p], len(p), low[p[:-1]] if p else None, len(m), len(children[p]), leaves[p], saved[p], sha(m))
                   for p, m in members.items()), key=str)


def run(spark, rows, limit=T.BLOCK_TURNS, schema=SCHEMA):
    df = T.trie(T.rebuilt(T.sequences(spark.createDataFrame(rows, schema))), limit)
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def talk(rng, n, kinds, longest):
    """Conversations over few texts, so that many share their first turns and many are equal."""
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(400), 100 * rng.randrange(6), -rng.randrange(150)])
        rows += [(c, t, rng.choice(["user", "user", None]), rng.choice("abé" * kinds + "漢")[:1] * rng.randrange(1, 3))
                 for t in range(rng.randrange(1, longest))]
    return rows


@pytest.mark.parametrize("limit", [1, 7, 40, 10**6])
def test_matches_a_plain_trie_at_every_block_size(spark, limit):
    rng = random.Random(limit)
    rows = talk(rng, 120, 1, 9)
    seen, once = set(), []
    for r in rows:  # one row a turn
        if r[:2] not in seen:
            seen.add(r[:2])
            once.append(r)
    once += [(1000 + i, t, "user", "same") for i in range(60) for t in range(8)]  # copies over many blocks
    once += [(2000 + 100 * i, t, "user", "same") for i in range(5) for t in range(20 * i)]
    assert run(spark, once, limit) == plain(once)


def test_null_empty_repeated_and_tied_turns(spark):
    assert run(spark, []) == []
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "bot", "b"),
            (2, None, "", ""), (3, 1, "user", "x" * 100_000), (3, 1, "user", "a"), (7, 0, "user", "only a first turn")]
    for limit in (1, 100):
        assert run(spark, rows, limit) == plain(rows)
    assert run(spark, rows[:1]) == []


def test_only_turnless_conversations(spark):
    """Conversations shorter than what their absent base replaces."""
    ids = [i for i in range(101, 160) if zlib.crc32(str(i).encode()) % 6]
    rows = [(i, 0, "user", "gone") for i in ids]
    for limit in (1, 5, 1000):
        got = run(spark, rows, limit)
        assert got == plain(rows) and len(got) == 1 and got[0][1:7] == (0, None, len(ids), 0, 1, 0)


def test_a_long_conversation_and_clashing_columns(spark):
    rows = [(i, t, "user", "t%d" % (t if t < 700 else t * i)) for i in (300, 301, 302) for t in range(800)]
    assert run(spark, rows, 64) == plain(rows)
    schema = SCHEMA + ", node string, part int, turns int, h int, base long"
    assert run(spark, [r + ("z", 1, 2, 3, 4) for r in rows[:90]], 8, schema) == plain(rows[:90])


def test_searches_against_scans():
    rng = np.random.default_rng(13)
    for n in (1, 2, 3, 8, 37):
        v = rng.integers(0, 5, n)
        m = T.Minima(v)
        for depth in range(7):
            start = np.arange(n)
            want = [next((j for j in range(s, n) if v[j] < depth), n) for s in start]
            assert m.right(start, np.full(n, depth)).tolist() == want
            want = [next((j for j in range(s, -1, -1) if v[j] < depth), -1) for s in start]
            assert m.left(start, np.full(n, depth)).tolist() == want
        lo, hi = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
        lo, hi = lo[lo <= hi], hi[lo <= hi]
        assert m.over(lo, hi).tolist() == [v[a:b + 1].min() for a, b in zip(lo, hi)]


def test_table(spark, sf_small):
    rows = [tuple(r) for r in read_table(spark, sf_small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in T.op13_prefix_trie(spark, sf_small).collect()), key=str) == plain(rows)
