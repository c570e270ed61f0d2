"""Operator 6: token ids on disk, compressed per block by a Re-Pair grammar.

Documents are put in ascending order of doc_id by a range partitioning, so every
partition is one shard of the order.  Its documents are encoded, get an end id
each, and are cut into blocks of about ``BLOCK_IDS`` ids.  In a block the
frequent pairs of neighbouring symbols are replaced by nonterminals, again and
again, until none occurs ``MIN_PAIRS`` times; nonterminals never span documents.

File format: a Parquet table with one row per block -
``shard, block, n_ids``, ``doc_ids`` and per document ``doc_tokens`` (ids with the
end id) and ``doc_symbols`` (symbols of the compressed sequence), ``base`` (the
first nonterminal), ``rules`` (pairs, little-endian uint32), ``lengths`` (the ids
each rule expands to, uint32) and ``symbols`` (uint16 or uint32, see ``width``).
A document is decoded from its own symbols alone; ``lengths`` lead to the n-th id
of a document without expanding the others.  Spark's committer makes sure that
each block is there once, also after lost executors.

The tokenizer is the library's; as a text falls into pieces that it treats alone
(at a blank that follows no white space), the ids of short pieces are remembered in
a dictionary of bounded size, and unknown pieces are encoded many at a time.

Defined cases: a null or empty text has only the end id; null ids come first;
rows that repeat an id are documents of their own, ordered by their texts' hash;
a very long text is a block of its own; columns beyond doc_id and text are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, run_path

END_ID = 0
BLOCK_IDS = 1 << 19
#: texts encoded in one go
SLICE_CHARS = 1 << 19
#: pieces remembered by a worker, and their longest
MEMO_PIECES, MEMO_CHARS = 500_000, 40
#: a pair becomes a rule where that makes the file smaller: a rule takes 12 bytes, each place it replaces saves 2 or more
MIN_PAIRS = 7
_BIN_BITS = 20


class Encoder:
    """ids of texts, by the tokenizers library, with remembered pieces.

    ``memo`` has the ids of a blank followed by the key; keys are not empty and do
    not end with white space, so the next blank always begins a new piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {}
        # a special token between pieces lets many be encoded as one text
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items()
                   if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark = special[0] if special else None

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _many(self, keys: list[str]) -> list[bytes]:
        """ids of each key after a blank."""
        if not self.mark:
            return self._library([" " + k for k in keys])
        number, mark = self.mark
        out: list[bytes] = []
        for lo in range(0, len(keys), 512):
            part = keys[lo:lo + 512]
            ids = np.frombuffer(self._library([" " + (mark + " ").join(part)])[0], dtype="<u4")
            cut = np.flatnonzero(ids == number)
            if len(cut) != len(part) - 1:  # a piece holds the mark itself
                out += self._library([" " + k for k in part])
                continue
            raw, lo_at = ids.tobytes(), 0
            for c in cut.tolist():
                out.append(raw[4 * lo_at:4 * c])
                lo_at = c + 1
            out.append(raw[4 * lo_at:])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        look = self.memo.get
        cut = [t.split(" ") for t in texts]
        got = [[look(p) for p in c] for c in cut]
        gaps = [[k for k, b in enumerate(g) if b is None] for g in got]
        whole = self._library([c[0] for c in cut])  # what comes before the first blank
        new: dict[str, bytes] = {}
        for i, (c, gap) in enumerate(zip(cut, gaps)):
            own = [c[k] for k in gap if k]
            if any(not p or p[-1].isspace() for p in own):
                whole[i], got[i] = self._library([texts[i]])[0], []
            else:
                new.update(dict.fromkeys(own))
        keys = list(new)
        new = dict(zip(keys, self._many(keys)))
        room = MEMO_PIECES - len(self.memo)
        self.memo.update((p, new[p]) for p in keys[:max(room, 0)] if len(p) <= MEMO_CHARS)
        for i, (c, g, gap) in enumerate(zip(cut, got, gaps)):
            if g:
                for k in gap:
                    g[k] = new[c[k]] if k else b""
                g[0] = whole[i]
                whole[i] = b"".join(g)
        return whole


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _frequent(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs met at least ``MIN_PAIRS`` times, the rarest first, and for each place the rank of its pair (0: none)."""
    cell = ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BIN_BITS)).astype(np.int64)
    often = np.flatnonzero(np.bincount(cell, minlength=1 << _BIN_BITS)[cell] >= MIN_PAIRS)
    value, inv, count = np.unique(pair[often], return_inverse=True, return_counts=True)
    best = np.flatnonzero(count >= MIN_PAIRS)
    best = best[np.argsort(count[best], kind="stable")]
    of = np.zeros(len(value), dtype=np.int64)
    of[best] = np.arange(1, len(best) + 1)
    rank = np.zeros(len(pair), dtype=np.int64)
    rank[often] = of[inv]
    return value[best], rank


def compress(ids: np.ndarray, doc_tokens: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, symbols per document, rules): Re-Pair over one block.

    Rounds go on until no pair occurs ``MIN_PAIRS`` times without overlap; in a round
    all pairs that do are candidates.  Where they overlap the more frequent
    one is replaced, in a run of one symbol every other pair, and a pair that keeps
    fewer than ``MIN_PAIRS`` places waits for the next round.  The most frequent pair
    keeps all of its places, so each round adds a rule.
    """
    seq = ids.astype(np.uint32)
    doc = np.repeat(np.arange(len(doc_tokens), dtype=np.int32), doc_tokens)
    rules = [np.zeros((0, 2), dtype=np.uint32)]
    n_rules = 0
    # a pair of old symbols never gets more frequent: a rare one's places are looked at again only when a symbol there is new
    live = np.append(doc[1:] == doc[:-1], False)[:len(seq)]
    while len(at := np.flatnonzero(live)):
        pair = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
        follows = np.zeros(len(at), dtype=bool)  # the same pair one place on: a run of one symbol
        follows[1:] = (at[1:] == at[:-1] + 1) & (pair[1:] == pair[:-1])
        first = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
        free = np.flatnonzero((np.arange(len(at)) - first) % 2 == 0)
        value, rank = _frequent(pair[free])
        if not len(value):
            break
        prio = np.zeros(len(seq) + 1, dtype=np.int64)
        prio[at[free]] = rank
        live[at] = np.isin(pair, value)
        wins = prio > np.concatenate(([0], prio[:-1]))
        wins[:-1] &= prio[:-1] > prio[1:]
        use = np.flatnonzero(wins)
        n = np.bincount(prio[use], minlength=len(value) + 1)
        use = use[n[prio[use]] >= MIN_PAIRS]
        chosen, rule = np.unique(prio[use], return_inverse=True)
        new = value[chosen - 1]
        seq[use] = (base + n_rules + rule).astype(np.uint32)
        n_rules += len(chosen)
        rules.append(np.column_stack((new >> np.uint64(32), new & np.uint64(0xFFFFFFFF))).astype(np.uint32))
        live[use] = True
        live[use[use > 0] - 1] = True
        keep = np.ones(len(seq), dtype=bool)
        keep[use + 1] = False
        seq, doc, live = seq[keep], doc[keep], live[keep]
        live[:-1] &= doc[1:] == doc[:-1]
        live[-1] = False
    return seq, np.bincount(doc, minlength=len(doc_tokens)), np.concatenate(rules)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    n = np.ones(len(rules), dtype=np.uint32)
    for i, (a, b) in enumerate(rules.tolist()):  # a rule only uses earlier ones
        n[i] = (n[a - base] if a >= base else 1) + (n[b - base] if b >= base else 1)
    return n


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    seq = symbols.astype(np.uint32)
    while len(rules) and (rule := seq >= base).any():
        out = np.repeat(seq, 1 + rule)
        at = np.flatnonzero(rule) + np.arange(int(rule.sum()))
        pair = rules[seq[rule] - base]
        out[at], out[at + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


def id_at(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, k: int) -> int:
    """The k-th id of a document, by expansion lengths: one path down the grammar."""
    n = np.where(symbols >= base, lengths[np.maximum(symbols.astype(np.int64) - base, 0)] if len(lengths) else 1, 1)
    ends = np.cumsum(n)
    i = int(np.searchsorted(ends, k, side="right"))
    k -= int(ends[i] - n[i])
    s = int(symbols[i])
    while s >= base:
        a, b = (int(x) for x in rules[s - base])
        left = int(lengths[a - base]) if a >= base else 1
        s, k = (a, k) if k < left else (b, k - left)
    return s


_SCHEMA = ("shard int, block int, n_ids long, doc_ids array<long>, doc_tokens array<long>, doc_symbols array<long>, "
           "base int, width int, rules binary, lengths binary, symbols binary")


def _block(shard: int, block: int, doc_ids: list, parts: list[bytes], base: int) -> pa.RecordBatch:
    tokens = np.fromiter((len(p) // 4 for p in parts), dtype=np.int64, count=len(parts))
    ids = np.frombuffer(b"".join(parts), dtype="<u4")
    base = max(base, int(ids.max()) + 1)
    symbols, per_doc, rules = compress(ids, tokens, base)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    row = [shard, block, len(ids), doc_ids, tokens.tolist(), per_doc.tolist(), base, width,
           rules.astype("<u4").tobytes(), expansion_lengths(rules, base).astype("<u4").tobytes(),
           symbols.astype(f"<u{width}").tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()),
             pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, shard, block = encoder(path), TaskContext.get().partitionId(), 0
        base = enc.tokenizer.get_vocab_size()
        end = np.array([end_id], dtype="<u4").tobytes()
        doc_ids, parts, size = [], [], 0
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            lo = 0
            while lo < len(texts):
                hi, n = lo, 0
                while hi < len(texts) and (hi == lo or n + len(texts[hi] or "") <= SLICE_CHARS):
                    n += len(texts[hi] or "")
                    hi += 1
                for i, got in zip(ids[lo:hi], enc.encode([t or "" for t in texts[lo:hi]])):
                    doc_ids.append(i)
                    parts.append(got + end)
                    size += len(got) // 4 + 1
                    if size >= BLOCK_IDS:
                        yield _block(shard, block, doc_ids, parts, base)
                        block, doc_ids, parts, size = block + 1, [], [], 0
                lo = hi
        if parts:
            yield _block(shard, block, doc_ids, parts, base)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode docs (doc_id, text, ...) and write the block table at ``path``."""
    ordered = (docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    ordered.mapInArrow(_encode(tokenizer, end_id), _SCHEMA).write.parquet(path)


def decode_block(r: dict) -> np.ndarray:
    """All ids of a block."""
    return expand(np.frombuffer(r["symbols"], dtype=f"<u{r['width']}"),
                  np.frombuffer(r["rules"], dtype="<u4").reshape(-1, 2), r["base"])


def decode_document(r: dict, k: int) -> np.ndarray:
    """The ids of the block's k-th document, from its own symbols."""
    at = int(np.sum(r["doc_symbols"][:k], dtype=np.int64))
    own = np.frombuffer(r["symbols"], dtype=f"<u{r['width']}")[at:at + r["doc_symbols"][k]]
    return expand(own, np.frombuffer(r["rules"], dtype="<u4").reshape(-1, 2), r["base"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            ids = decode_block(r).astype("<u4")
            tokens = np.array(r["doc_tokens"], dtype=np.int64)
            ends = np.cumsum(tokens)
            if len(ids) != r["n_ids"] or ends[-1] != len(ids):
                raise ValueError(f"block {r['shard']}/{r['block']} does not decode to its size")
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), tokens.tolist())]
            k = len(crc)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["shard"]] * k, pa.int32()), pa.array([r["block"]] * k, pa.int32()),
                 pa.array(r["doc_ids"], pa.int64()), pa.array(ends - tokens), pa.array(tokens),
                 pa.array(crc, pa.int64())], names=["shard", "block", "doc_id", "inner", "n_tokens", "ids_crc32"])


def read_documents(spark, path: str) -> DataFrame:
    """Read the block table back: doc_id, start, n_tokens, ids_crc32 per document."""
    blocks = spark.read.parquet(path)
    size = blocks.select("shard", "block", "n_ids")
    shards = size.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row a shard
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before(Window.orderBy("shard"))), F.lit(0)).alias("shard_at"))
    at = size.withColumn("block_at", F.coalesce(F.sum("n_ids").over(
        before(Window.partitionBy("shard").orderBy("block"))), F.lit(0))).join(shards, "shard")
    own = (blocks.select("shard", "block", "n_ids", "doc_ids", "doc_tokens", "base", "width", "rules", "symbols")
           .mapInArrow(_digest, "shard int, block int, doc_id long, inner long, n_tokens long, ids_crc32 long"))
    return (own.join(at.select("shard", "block", (F.col("shard_at") + F.col("block_at")).alias("at")), ["shard", "block"])
            .select("doc_id", (F.col("at") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"))


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write docs' ids in the file format and return what the files say of each document."""
    spark = docs.sparkSession
    path = run_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_documents(spark, path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_tokens(spark, sf_dir) -> DataFrame:
    return tokenize(read_table(spark, sf_dir, "documents"), default_tokenizer())
