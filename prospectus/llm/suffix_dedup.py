"""Operator 2: repeated substrings, by a distributed difference-cover suffix sort.

A byte is removed when some ``LENGTH``-byte window that covers it also starts in a
document with a smaller id.  Windows are compared by sorting suffixes:

1. Equal texts form a class; only its smallest id's text goes on (the other
   members, if long enough, are repeats as a whole).
2. Every window has a minimizer: the least hash of its ``GRAM``-byte substrings.
   Equal windows have equal minimizers, so a window can only repeat in another
   document if its minimizer occurs there.  One shuffle of minimizers finds those
   that two documents have; all other windows are out, without loss.
3. Runs of windows with one shared minimizer are shipped, with their bytes, to the
   minimizer's group.  A group's bytes are suffix-sorted to the depth of a window
   by the difference cover of 3: triples at positions 1 and 2 mod 3 are sorted
   and named, the string of names is sorted by the same method, the remaining
   suffixes are merged in, and adjacent prefixes are compared byte by byte.  A
   class of equal windows is owned by its smallest id; all others are repeats.
4. Repeats go back to their documents, which are cut and hashed.

Equal windows always meet in one group, so groups are sorted apart from each other
and none needs the whole text.  A minimizer that many documents share would make one large
group of unlike windows; its runs are cut by a second, longer minimizer, and a group is
made by both, so that only windows that share more bytes still meet.  A task sends each minimizer, and each run of
bytes, once: a passage shared by a third of all documents reaches its group once
per batch of documents, and its other copies are decided where they are.

Only minimizers with several distinct runs are sorted; equal runs are known as byte strings
before that, within a batch and within a group.

Defined cases: a null text is empty; shorter texts than a window stay; rows that
repeat an id with other texts never remove each other; rows with a null id stay
whole and remove nothing; very long texts are taken whole; columns beyond doc_id and text
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum
from .common import read_table, written

LENGTH = 50
#: bytes of a minimizer, and of the second one that cuts the runs of a hot minimizer
GRAM, LONG_GRAM = 26, 42
#: a minimizer is hot that so many rows of a task share; so many hot ones are broadcast at most (8 bytes each), the rest is as others
HOT_ROWS, HOT_SHARE, HOT_MOST = 64, 0.002, 1_000_000
#: input bytes per group of minimizers, and bytes suffix-sorted at once
GROUP_BYTES = 2 << 20
SORT_BYTES = 1 << 18
#: input bytes per part in which answers are gathered by row
PART_BYTES = 8 << 20
#: bytes of a batch looked at together: a minimizer is sent once for each
SLICE_BYTES = 1 << 21
#: hexadecimal digits of a text's hash that name it
KEY_DIGITS = 15
_ODD = 0x9E3779B97F4A7C15


# ---- difference cover ----

def _dense(key: np.ndarray) -> np.ndarray:
    """Order-preserving names 1, 2, ... of keys."""
    return np.unique(key, return_inverse=True)[1].astype(np.int64) + 1


def _packed(*cols: np.ndarray) -> np.ndarray:
    """One order-preserving key per row of small non-negative columns."""
    key = cols[0]
    for c in cols[1:]:
        top = int(c.max(initial=0)) + 1
        if (int(key.max(initial=0)) + 1) * top >= 1 << 62:
            key = _dense(key)
        key = key * top + c
    return key


def suffix_order(x: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix of x (integers above 0), how many suffixes are smaller, by the first ``depth`` symbols.

    Suffixes that differ within ``depth`` symbols get different numbers in the right
    order, and those alike lie together.
    """
    n = len(x)
    p = np.concatenate((x, np.zeros(3, dtype=np.int64)))
    if depth <= 3 or n < 4:
        if depth > 3:
            p = np.concatenate((p, np.zeros(depth, dtype=np.int64)))
            return _dense(_packed(*[p[j:j + n] for j in range(min(depth, n + 1))])) - 1
        return _dense(_packed(p[:n], p[1:n + 1], p[2:n + 2])) - 1
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    name = _dense(_packed(p[sample], p[sample + 1], p[sample + 2]))
    if int(name.max()) < len(sample):  # equal triples: sort the string of names; a 0 keeps its halves apart
        inner = suffix_order(np.concatenate((name[:len(one)] + 1, [1], name[len(one):] + 1)), -(-depth // 3))
        name = _dense(np.delete(inner, len(one)))
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample] = name
    # merge: suffixes at 0 mod 3 against the others, by one or two symbols and the rank that follows
    zero = np.arange(0, n, 3)
    top = int(rank.max()) + 1
    lead = lambda at: p[at] * top + rank[at + 1]
    k0, k1 = lead(zero), lead(one)
    deep = lambda at: _packed(p[at], p[at + 1], rank[at + 2])
    d = deep(np.concatenate((zero, two)))
    d0, d2 = d[:len(zero)], d[len(zero):]
    less = np.zeros(n, dtype=np.int64)
    s0, s1, sd0, sd2, ranks = np.sort(k0), np.sort(k1), np.sort(d0), np.sort(d2), np.sort(name)
    less[zero] = np.searchsorted(s0, k0) + np.searchsorted(s1, k0) + np.searchsorted(sd2, d0)
    less[one] = np.searchsorted(ranks, rank[one]) + np.searchsorted(s0, k1)
    less[two] = np.searchsorted(ranks, rank[two]) + np.searchsorted(sd0, d2)
    return less


def window_classes(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts in suffix order, whether each begins a new class of equal ``length``-byte windows)."""
    order = suffix_order(data.astype(np.int64) + 2, length)
    at = starts[np.argsort(order[starts], kind="stable")]
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    new = np.ones(len(at), dtype=bool)
    for lo in range(1, len(at), 1 << 16):
        hi = min(lo + (1 << 16), len(at))
        new[lo:hi] = (view[at[lo:hi]] != view[at[lo - 1:hi - 1]]).any(axis=1)
    return at, new


# ---- minimizers ----

def _powers() -> list[np.uint64]:
    return [np.uint64(pow(_ODD, 1 << j, 2**64)) for j in range(6)]


def _sum_of(values: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of each k-byte substring, by doubling."""
    power = _powers()
    total, done, block, width = None, 0, values, 1
    for j in range(k.bit_length()):
        if k >> j & 1:
            if total is None:
                total, done = block, width
            else:
                m = len(block) - done
                total = total[:m] * np.uint64(pow(_ODD, width, 2**64)) + block[done:]
                done += width
        if k >> (j + 1):
            block = block[:-width] * power[j] + block[width:]
            width *= 2
    return total


def _least_of(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours."""
    m, width = h, 1
    while width * 2 <= w:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    rest = w - width
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


_BYTE = np.random.default_rng(2).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)


def runs(texts: list[bytes], length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimizer of ``gram`` bytes: (text, minimizer, first start, last start)."""
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begin = np.concatenate(([0], np.cumsum(size)))
    none = np.zeros(0, dtype=np.int64)
    if begin[-1] < length:
        return none, none.astype(np.uint64), none, none
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    least = _least_of(textnum.mix(_sum_of(_BYTE[buf], gram)), length - gram + 1)
    at = np.arange(len(least))
    doc = np.searchsorted(begin, at, side="right") - 1
    ok = at + length <= begin[doc + 1]
    at, doc, least = at[ok], doc[ok], least[ok]
    if not len(at):
        return none, none.astype(np.uint64), none, none
    cut = np.flatnonzero((least[1:] != least[:-1]) | (doc[1:] != doc[:-1])) + 1
    lo, hi = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1
    return doc[lo], least[lo], at[lo] - begin[doc[lo]], at[hi] - begin[doc[lo]]


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _split(by: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, positions) of an integer array, positions ascending."""
    order = np.argsort(by, kind="stable")
    cut = np.flatnonzero(by[order][1:] != by[order][:-1]) + 1
    for part in np.split(order, cut) if len(order) else ():
        yield int(by[part[0]]), part


_MET = "kind int, bucket int, row long, rows binary, counts binary, hashes binary"


def _send_minimizers(buckets: int, length: int):
    """Each minimizer of a batch once: with its row, or as shared (row 0) if the batch has it in two rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            rows = b.column("row").to_numpy(zero_copy_only=False)
            for lo, hi in textnum.slices(texts, SLICE_BYTES):
                doc, h, _, _ = runs(texts[lo:hi], length)
                order = np.lexsort((doc, h))
                doc, h = doc[order], h[order]
                one = np.ones(len(h), dtype=bool)
                one[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                doc, h = doc[one], h[one]
                first = np.ones(len(h), dtype=bool)
                first[1:] = h[1:] != h[:-1]
                shared = ~first
                shared[:-1] |= ~first[1:]
                out = []
                row = np.where(shared, 0, rows[lo:hi][doc])
                send_h, send_row = h[first], row[first]
                for k, at in _split(_bucket(send_h, buckets)):
                    at = at[np.argsort(send_row[at], kind="stable")]
                    value, count = np.unique(send_row[at], return_counts=True)
                    out.append((0, k, 0, value.tobytes(), count.astype(np.uint32).tobytes(), send_h[at].tobytes()))
                for d, at in _split(doc[shared]):
                    r = int(rows[lo + d])
                    out.append((1, r % buckets, r, b"", b"", h[shared][at].tobytes()))
                if out:
                    yield _batch(out, _MET)

    return run


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, _ARROW[k]) for n, c, k in zip(names, cols, kinds)})


def _bytes(col: pa.ChunkedArray) -> bytes:
    return b"".join(col.to_pylist())


_PACKED = "part int, rows binary, counts binary, first binary, second binary"


def _pack(rows: np.ndarray, first: np.ndarray, second: np.ndarray, parts: int) -> pa.Table:
    """Values of many rows as one record per part of the rows."""
    out = []
    for part, at in _split(rows % parts):
        at = at[np.argsort(rows[at], kind="stable")]
        value, count = np.unique(rows[at], return_counts=True)
        out.append((part, value.tobytes(), count.tobytes(), first[at].tobytes(), second[at].tobytes()))
    return _table(out, _PACKED)


def _by_row(t: pa.Table) -> pa.Table:
    """Packed records of one part -> one record per row."""
    rows, counts, first, second = (np.frombuffer(_bytes(t[c]), dtype=np.int64) for c in ("rows", "counts", "first", "second"))
    second = second if len(second) else first
    rows = np.repeat(rows, counts)
    order = np.argsort(rows, kind="stable")
    cut = np.flatnonzero(rows[order][1:] != rows[order][:-1]) + 1
    return _table([(int(rows[p[0]]), first[p].tobytes(), second[p].tobytes()) for p in np.split(order, cut) if len(p)],
                  "row long, first binary, second binary")


def _answer_minimizers(parts: int):
    """Rows and their minimizers that another row has too."""

    def run(t: pa.Table) -> pa.Table:
        local = t.filter(pc.equal(t["kind"], 1))
        known = [np.frombuffer(x, dtype=np.uint64) for x in local["hashes"].to_pylist()]
        known_rows = np.repeat(local["row"].to_numpy(), np.fromiter(map(len, known), dtype=np.int64, count=len(known)))
        met = t.filter(pc.equal(t["kind"], 0))
        h = np.frombuffer(_bytes(met["hashes"]), dtype=np.uint64)
        row = np.repeat(np.frombuffer(_bytes(met["rows"]), dtype=np.int64),
                        np.frombuffer(_bytes(met["counts"]), dtype=np.uint32))
        order = np.argsort(h, kind="stable")
        h, row = h[order], row[order]
        many = np.zeros(len(h), dtype=bool)
        many[1:] |= h[1:] == h[:-1]
        many[:-1] |= h[1:] == h[:-1]
        at = np.flatnonzero(many & (row != 0))
        rows, hashes = np.concatenate((known_rows, row[at])), np.concatenate([*known, h[at]]).view(np.int64)
        return _pack(rows, hashes, np.zeros((len(rows), 0), dtype=np.int64), parts)

    return run


_RUNS = "kind int, bucket int, row long, hashes binary, rows binary, ids binary, starts binary, sizes binary, data binary"


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minimizers that many of a task's rows share."""
    rows, count = 0, {}
    for b in batches:
        rows += b.num_rows
        value, n = np.unique(np.frombuffer(_bytes(b.column("hashes")), dtype=np.int64), return_counts=True)
        for v, k in zip(value[n > 1].tolist(), n[n > 1].tolist()):
            count[v] = count.get(v, 0) + k
    some = [v for v, k in count.items() if k >= max(HOT_ROWS, rows * HOT_SHARE)]
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64())], names=["h"])


def _longer(texts: list[bytes], length: int, doc: np.ndarray, h: np.ndarray, first: np.ndarray, last: np.ndarray,
            hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs with hot minimizers cut where the minimizer of ``LONG_GRAM`` bytes changes: (text, key, minimizer, first, last).

    The key of a piece is made of both minimizers, which equal windows have in common."""
    is_hot = np.isin(h, hot)
    if not is_hot.any():
        return doc, h, h, first, last
    at = np.flatnonzero(is_hot)
    of, longer, frm, upto = runs([texts[doc[k]][first[k]:last[k] + length] for k in at], length, LONG_GRAM)
    at, rest = at[of], ~is_hot
    key = textnum.mix(h[at] ^ textnum.mix(longer))
    cols = [(doc[rest], doc[at]), (h[rest], key), (h[rest], h[at]), (first[rest], first[at] + frm), (last[rest], first[at] + upto)]
    doc, key, h, first, last = (np.concatenate(c) for c in cols)
    order = np.lexsort((first, doc))
    return doc[order], key[order], h[order], first[order], last[order]


def _send_runs(buckets: int, length: int, shared):
    """The bytes of runs with a shared minimizer, equal ones once; copies in larger ids are decided here (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            rows, ids, known = (b.column(c).to_pylist() for c in ("row", "doc_id", "hashes"))
            found = []  # (id, row, minimizer, start, bytes)
            for lo, hi in textnum.slices(texts, SLICE_BYTES):
                doc, key, h, first, last = _longer(texts[lo:hi], length, *runs(texts[lo:hi], length), hot)
                at_doc = np.searchsorted(doc, np.arange(hi - lo + 1))
                for d in range(hi - lo):
                    a, z = at_doc[d], at_doc[d + 1]
                    own = np.frombuffer(known[lo + d], dtype=np.uint64)
                    for i in np.flatnonzero(np.isin(h[a:z], own)) + a:
                        s, e = int(first[i]), int(last[i])
                        found.append((ids[lo + d], rows[lo + d], int(key[i]), s, texts[lo + d][s:e + length]))
            found.sort(key=lambda f: (f[0], f[1], f[3]))
            owner: dict[bytes, int] = {}
            gone: dict[int, list[tuple[int, int]]] = {}
            send = []
            for f in found:
                if owner.setdefault(f[4], f[0]) < f[0]:
                    gone.setdefault(f[1], []).append((f[3], f[3] + len(f[4]) - length))
                else:
                    send.append(f)
            out = [(1, r % buckets, r, b"", b"", b"", np.array([g[0] for g in v]).tobytes(), np.array([g[1] for g in v]).tobytes(),
                    b"") for r, v in gone.items()]
            if send:
                h = np.array([f[2] for f in send], dtype=np.uint64)
                for k, at in _split(_bucket(h, buckets)):
                    part = [send[i] for i in at]
                    col = lambda j: np.array([f[j] for f in part], dtype=np.int64).tobytes()
                    out.append((0, k, 0, h[at].tobytes(), col(1), col(0), col(3),
                                np.array([len(f[4]) for f in part], dtype=np.int64).tobytes(), b"".join(f[4] for f in part)))
            if out:
                yield _batch(out, _RUNS)

    return run


def _repeats(data: list[bytes], ids: np.ndarray, length: int) -> list[np.ndarray]:
    """For each byte string, which of its windows also start in a string with a smaller id."""
    size = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
    begin = np.concatenate(([0], np.cumsum(size)))
    windows = size - length + 1
    owner = np.repeat(np.arange(len(data)), windows)
    ends = np.concatenate(([0], np.cumsum(windows)))
    starts = np.arange(len(owner)) - ends[owner] + begin[owner]
    at, new = window_classes(np.frombuffer(b"".join(data), dtype=np.uint8), starts, length)
    own = np.searchsorted(begin, at, side="right") - 1
    first = np.flatnonzero(new)
    least = np.repeat(np.minimum.reduceat(ids[own], first), np.diff(np.concatenate((first, [len(at)]))))
    flag = np.zeros(begin[-1], dtype=bool)
    flag[at] = ids[own] > least
    return [flag[b:b + w] for b, w in zip(begin, windows)]


def _judge_runs(length: int, parts: int):
    """Window starts to remove, packed by row: first and last start of each stretch."""

    def run(t: pa.Table) -> pa.Table:
        local = t.filter(pc.equal(t["kind"], 1))
        known = [np.frombuffer(_bytes(local[c]), dtype=np.int64) for c in ("starts", "sizes")]
        known_rows = np.repeat(local["row"].to_numpy(), [len(x) // 8 for x in local["starts"].to_pylist()])
        met = t.filter(pc.equal(t["kind"], 0))
        h = np.frombuffer(_bytes(met["hashes"]), dtype=np.uint64)
        row, ids, start, size = (np.frombuffer(_bytes(met[c]), dtype=np.int64) for c in ("rows", "ids", "starts", "sizes"))
        data = _bytes(met["data"])
        begin = np.concatenate(([0], np.cumsum(size)))
        gone: list[tuple[int, int, int]] = []
        texts: list[bytes] = []  # distinct byte strings to be sorted, with their smallest id and their runs
        who: list[int] = []
        users: list[list[int]] = []

        def add(i: int, first: int, last: int) -> None:
            s = int(start[i])
            gone.append((int(row[i]), s + first, s + last))

        def judge() -> None:
            for k, f in enumerate(_repeats(texts, np.array(who, dtype=np.int64), length)):
                if f.any():
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], f.view(np.int8), [0]))))
                    for i in users[k]:
                        for a, z in zip(edge[0::2].tolist(), edge[1::2].tolist()):
                            add(i, a, z - 1)

        held = 0
        by_hash = np.lexsort((start, row, ids, h))
        cut = np.flatnonzero(h[by_hash][1:] != h[by_hash][:-1]) + 1
        for part in np.split(by_hash, cut) if len(h) else ():
            seen: dict[bytes, list[int]] = {}
            for i in part.tolist():  # ascending ids: the first of equal runs owns them
                own = seen.setdefault(data[begin[i]:begin[i + 1]], [])
                if own and ids[i] > ids[own[0]]:
                    add(i, 0, int(size[i]) - length)
                else:
                    own.append(i)
            if len(seen) > 1:  # a minimizer with one distinct run has nothing to be sorted
                for b, own in seen.items():
                    texts.append(b)
                    who.append(int(ids[own[0]]))
                    users.append(own)
                    held += len(b)
                if held >= SORT_BYTES:  # all runs of a minimizer are sorted together
                    judge()
                    held, texts, who, users = 0, [], [], []
        if texts:
            judge()
        found = np.array(gone, dtype=np.int64).reshape(-1, 3)
        return _pack(np.concatenate((known_rows, found[:, 0])), np.concatenate((known[0], found[:, 1])),
                     np.concatenate((known[1], found[:, 2])), parts)

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for r, t, s, e in zip(b.column("row").to_pylist(), texts, b.column("first").to_pylist(), b.column("second").to_pylist()):
                first = np.frombuffer(s, dtype=np.int64)
                last = np.frombuffer(e, dtype=np.int64) + length
                step = np.zeros(len(t) + 1, dtype=np.int64)
                np.add.at(step, first, 1)
                np.add.at(step, last, -1)
                gone = np.cumsum(step[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
                out.append((r, int(gone.sum()), spans, kept, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (
                pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()))], names=["row", "n_removed", "n_spans", "kept", "sha"])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep_text: bool = False,
                   key_digits: int = KEY_DIGITS) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per row.

    With ``keep_text`` also ``kept``, the remaining bytes of rows that lost some but not all.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    all_rows = docs.select("doc_id", text.alias("text")).withColumn("sha", F.sha2("text", 256))
    narrow = written(all_rows.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "suffix-rows")
    classes = written(narrow.filter("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("least"),
                                                                             F.max("n_bytes").alias("size")), "suffix-classes")
    # 60 bits of its hash name a text; texts that share them have numbers of their own
    key = F.greatest(F.conv(F.substring("sha", 1, key_digits), 16, 10).cast("long"), F.lit(1).cast("long"))
    alike = classes.groupBy(key.alias("name")).agg(F.count("*").alias("n")).filter("n > 1")
    clashes = written(classes.select("sha", key.alias("name")).join(alike, "name")
                      .select("sha", (-1 - F.monotonically_increasing_id()).alias("own")), "suffix-clashes")
    n_clashes = clashes.count()

    def with_row(df: DataFrame) -> DataFrame:
        if not n_clashes:
            return df.withColumn("row", key)
        few = F.broadcast(clashes) if n_clashes <= 200_000 else clashes
        return df.join(few, "sha", "left").withColumn("row", F.coalesce("own", key)).drop("own")

    copies = written(narrow.join(classes.select("sha", "least"), "sha").filter("doc_id > least").select("doc_id", "sha").distinct(),
                     "suffix-copies")
    few = F.broadcast(copies) if copies.count() <= 200_000 else copies
    long_rows = all_rows.filter((F.octet_length("text") >= length) & F.col("doc_id").isNotNull())
    reps = with_row(long_rows.join(few, ["doc_id", "sha"], "left_anti")).select("row", "doc_id", "text")
    spark = docs.sparkSession
    size = classes.agg(F.sum("size")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // GROUP_BYTES))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    one_row = "row long, first binary, second binary"
    answers = written(reps.mapInArrow(_send_minimizers(buckets, length), _MET).groupBy("bucket")
                      .applyInArrow(_answer_minimizers(parts), _PACKED).groupBy("part").applyInArrow(_by_row, one_row),
                      "suffix-shared").select("row", F.col("first").alias("hashes"))
    # any set that all tasks agree on gives the same result; a common one spreads the runs of common minimizers
    hot = [r[0] for r in answers.select("hashes").mapInArrow(_common, "h long").distinct().limit(HOT_MOST).collect()]
    hot = spark.sparkContext.broadcast(np.sort(np.array(hot, dtype=np.int64).view(np.uint64)))
    gone = written(reps.join(answers, "row").mapInArrow(_send_runs(buckets, length, hot), _RUNS).groupBy("bucket")
                   .applyInArrow(_judge_runs(length, parts), _PACKED).groupBy("part").applyInArrow(_by_row, one_row), "suffix-gone")
    ids = gone.select("row")
    cut_rows = reps.join(F.broadcast(ids), "row", "left_semi") if ids.count() <= 1_000_000 else reps
    schema = "row long, n_removed long, n_spans long, kept binary, sha string"
    done = cut_rows.dropDuplicates(["row"]).join(gone, "row").mapInArrow(_cut(length), schema)
    done = written(done if keep_text else done.drop("kept"), "suffix-cut")
    out = (with_row(narrow.join(classes.select("sha", "least"), "sha", "left"))
           .join(done.withColumnRenamed("sha", "cut_sha"), "row", "left"))
    whole = F.coalesce((F.col("doc_id") > F.col("least")) & (F.col("n_bytes") >= length), F.lit(False))
    mine = F.coalesce((F.col("doc_id") == F.col("least")) & F.col("n_removed").isNotNull(), F.lit(False))
    pick = lambda all_gone, part, none: F.when(whole, all_gone).when(mine, part).otherwise(none)
    zero = F.lit(0).cast("long")
    cols = ["doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("n_removed"), zero).alias("n_removed"),
            pick(F.lit(1).cast("long"), F.col("n_spans"), zero).alias("n_spans"),
            pick(F.sha2(F.lit(""), 256), F.col("cut_sha"), F.col("sha")).alias("kept_sha256")]
    if keep_text:
        cols.append(F.when(mine, F.col("kept")).alias("kept"))
    return out.select(*cols)


def op2_suffix_dedup(spark, sf_dir) -> DataFrame:
    return repeated_spans(read_table(spark, sf_dir, "documents"))
