"""Operator 11: byte-level BPE by overlapping chunks, and its decoding.

A text of up to ``CHUNK`` code points is split into pre-tokens, and these are
encoded, where it is read.  A longer one is cut into chunks that are dealt out to
tasks.  A chunk also sees the ``OVERLAP`` code points after it and splits its text
from its own start, which may lie inside a pre-token.  Splitting only looks ahead, so
as soon as two neighbours have a boundary in common where they overlap, they agree on
all later ones: this boundary is the seam, up to which the left chunk's pieces count
and from which the right one's do.  Chunks without a common boundary (a pre-token
longer than the overlap) are joined and split again, until every seam is found.
The pieces between seams are then encoded chunk by chunk, and decoding concatenates
the bytes of the ids.

A boundary counts only where the text after it, which may be cut off by the chunk's
end, can't move it: ``AHEAD`` code points, as no pre-token of the pattern depends on
more than the three characters of a contraction.

The merges are those of the tiktoken library, one pre-token at a time; the ids of
short pieces are remembered in a dictionary of bounded size.  Letters and digits
that are newer than the library's own Unicode tables count as it counts them.

Defined cases: a null or empty text has no ids; each row is a document of its own,
also rows that repeat an id or have none; texts are never cut or dropped, however
long; columns beyond doc_id and text are ignored; an empty table gives an empty table.
A document's parts are hashed in order by one task, which holds one part at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, written

#: code points of a chunk, of what it sees of the next one, and of what can move a boundary
CHUNK, OVERLAP, AHEAD = 1 << 15, 512, 3
#: code points encoded before a batch is handed on
SLICE = 1 << 19
#: pieces remembered by a worker, and their longest
MEMO_PIECES, MEMO_CHARS = 500_000, 40
#: seams up to which they are broadcast; a shuffle join beyond
BROADCAST_SEAMS = 500_000


class Bpe:
    """Pre-tokens, ids and bytes by a rank file and the pattern that splits text."""

    def __init__(self, ranks: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.bytes_of = {i: b for b, i in table.items()}
        self.pieces_of = regex.compile(pattern).findall
        newer = _newer_letters(pattern)
        self.newer = re.compile("[%s]" % "".join(newer)) if newer else None
        self.maybe_newer = re.compile("[%s-\U0010ffff]" % newer[0]).search if newer else None
        self.memo: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        plain = self.newer.sub("\ufffd", text) if self.newer and self.maybe_newer(text) else text
        out = self.pieces_of(plain)
        if sum(map(len, out)) != len(text):
            raise ValueError("the pattern leaves characters out")
        return out if plain is text else cut(text, [0, *np.cumsum([len(p) for p in out]).tolist()])

    def boundaries(self, text: str) -> np.ndarray:
        """Ends of the pre-tokens of a text, in code points."""
        return np.cumsum(np.fromiter(map(len, self.pieces(text)), dtype=np.int64))

    def encode(self, pieces: list[str]) -> bytes:
        """Little-endian uint32 ids of pre-tokens in a row."""
        memo = self.memo
        new = {p: array("I", self.encoding.encode_ordinary(p)).tobytes() for p in set(pieces) if p not in memo}
        if len(memo) + len(new) <= MEMO_PIECES:
            memo.update((p, b) for p, b in new.items() if len(p) <= MEMO_CHARS)
        if not new:
            return b"".join([memo[p] for p in pieces])
        return b"".join([new[p] if p in new else memo[p] for p in pieces])

    def text_ids(self, text: str) -> bytes:
        return self.encode(self.pieces(text))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


def cut(text: str, at: list[int]) -> list[str]:
    """The pieces between neighbouring positions."""
    return [text[a:b] for a, b in zip(at, at[1:])]


def _newer_letters(pattern: str) -> list[str]:
    """Characters that the regex module takes for letters or digits and the tokenizer's tables don't, in order.

    The tokenizer is asked by ranks in which a letter or digit merges with the first
    byte of what follows it in the same pre-token.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = {bytes([b]): b for b in range(256)}
    for a in b"a1":
        for b in range(128, 256):
            table[bytes([a, b])] = len(table)
    ask = tiktoken.Encoding("ask", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return sorted(c for kind, a in ((r"\p{L}", "a"), (r"\p{N}", "1")) for c in regex.findall(kind, every)
                  if c > "\x7f" and ask.encode_ordinary(a + c)[0] < 256)


_loaded: dict[tuple[str, str], Bpe] = {}


def bpe(ranks: str, pattern: str) -> Bpe:
    if (ranks, pattern) not in _loaded:
        _loaded[ranks, pattern] = Bpe(ranks, pattern)
    return _loaded[ranks, pattern]


def _ids_column(parts: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))


_TOKENS = "row long, part int, doc_id long, ids array<int>"


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``SLICE`` code points."""
    lo = n = 0
    for i, s in enumerate(sizes):
        if n and n + s > SLICE:
            yield lo, i
            lo, n = i, 0
        n += s
    if lo < len(sizes):
        yield lo, len(sizes)


def _encode_whole(ranks: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(ranks, pattern)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in _slices([len(t) for t in texts]):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(hi - lo, pa.int64()), pa.array([0] * (hi - lo), pa.int32()),
                     b.column("doc_id").slice(lo, hi - lo).cast(pa.int64()),
                     _ids_column([own.text_ids(t) for t in texts[lo:hi]])], names=["row", "part", "doc_id", "ids"])

    return run


def encode_short(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK) -> DataFrame:
    """Texts of one chunk -> (row null, part 0, doc_id, ids)."""
    return (docs.filter(f"text is null or char_length(text) <= {chunk}").select("doc_id", "text")
            .mapInArrow(_encode_whole(ranks, pattern), _TOKENS))


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                row += 1
                starts = range(0, len(text), chunk)
                for lo, hi in _slices([chunk + overlap] * len(starts)):
                    at = list(starts[lo:hi])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(at), pa.int64()), pa.array(range(lo, hi), pa.int32()),
                         pa.array([i] * len(at), pa.int64()), pa.array(at, pa.int64()),
                         pa.array([min(chunk, len(text) - a) for a in at], pa.int64()),
                         pa.array([a + chunk + overlap < len(text) for a in at]),
                         pa.array([text[a:a + chunk + overlap] for a in at], pa.string())],
                        names=["row", "part", "doc_id", "at", "size", "more", "text"])

    return run


def _split(ranks: str, pattern: str, overlap: int):
    """Boundaries of a chunk, and those in its first and after its last code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(ranks, pattern)
        for b in batches:
            for lo in range(b.num_rows):  # a chunk a batch, as they are large
                r = b.slice(lo, 1)
                text, at, size, more = (r.column(c)[0].as_py() for c in ("text", "at", "size", "more"))
                ends = own.boundaries(text)
                if more:
                    ends = ends[ends <= len(text) - AHEAD]
                marks = np.concatenate(([0], ends))
                head, tail = marks[marks <= overlap], marks[(marks >= size) & (len(text) > size)]
                yield pa.RecordBatch.from_arrays(
                    [*(r.column(c) for c in ("row", "part", "doc_id", "at", "size", "more", "text")),
                     pa.array([ends.astype("<i4").tobytes()]), pa.array([(head + at).tolist()], pa.list_(pa.int64())),
                     pa.array([(tail + at).tolist()], pa.list_(pa.int64()))],
                    names=["row", "part", "doc_id", "at", "size", "more", "text", "ends", "head", "tail"])

    return run


_CHUNKS = "row long, part int, doc_id long, at long, size long, more boolean, text string"
_SPLIT = _CHUNKS + ", ends binary, head array<long>, tail array<long>"


def seams(chunks: DataFrame) -> DataFrame:
    """(row, part, seam) for each chunk that has a next one: their first common boundary, null where there is none."""
    right = chunks.select("row", (F.col("part") - 1).alias("part"), "head")
    return (chunks.select("row", "part", "tail").join(right, ["row", "part"])
            .select("row", "part", F.array_min(F.array_intersect("tail", "head")).alias("seam")))


def _joined(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """Chunks of documents with lost seams, with neighbours that don't meet made one; parts are numbered anew."""
    from pyspark.sql import Window

    by_row = Window.partitionBy("row").orderBy("part")
    lost = found.filter("seam is null")
    runs = (chunks.select("row", "part")
            .join(lost.select("row", (F.col("part") + 1).alias("part"), F.lit(0).alias("starts")), ["row", "part"], "left")
            .select("row", "part", (F.sum(F.coalesce("starts", F.lit(1))).over(by_row) - 1).cast("int").alias("run")))
    own = F.sort_array(F.collect_list(F.struct("part", "doc_id", "at", "size", "more", "text")))
    nominal = F.transform(F.slice("own", 1, F.size("own") - 1),
                          lambda c: F.substr(c["text"], F.lit(1), c["size"].cast("int")))
    last = F.element_at("own", -1)
    return (chunks.join(runs, ["row", "part"]).groupBy("row", "run").agg(own.alias("own"))
            .select("row", F.col("run").alias("part"), F.col("own")[0]["doc_id"].alias("doc_id"),
                    F.col("own")[0]["at"].alias("at"), F.aggregate("own", F.lit(0).cast("long"), lambda a, c: a + c["size"]).alias("size"),
                    last["more"].alias("more"), F.concat(F.array_join(nominal, ""), last["text"]).alias("text")))


def stitched(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK,
             overlap: int = OVERLAP) -> list[tuple[DataFrame, DataFrame]]:
    """Chunks of long texts and their seams, each pair of frames for documents of their own."""
    split = lambda c: written(c.mapInArrow(_split(ranks, pattern, overlap), _SPLIT), "bpe-chunks")
    cuts = (docs.filter(f"char_length(text) > {chunk}").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_cut(chunk, overlap), _CHUNKS).repartition("row", "part"))
    todo, out = split(cuts), []
    while True:
        found = written(seams(todo), "bpe-seams")
        out.append((todo, found))
        lost = found.filter("seam is null").select("row").distinct()
        if lost.isEmpty():
            return out
        out[-1] = (todo.join(lost, "row", "left_anti"), found.join(lost, "row", "left_anti"))
        todo = split(_joined(todo.join(lost, "row", "left_semi"), found.join(lost, "row", "left_semi")))


def _encode_between(ranks: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(ranks, pattern)
        for b in batches:
            for lo in range(b.num_rows):
                r = b.slice(lo, 1)
                text, at, first, upto = (r.column(c)[0].as_py() for c in ("text", "at", "first", "upto"))
                ends = np.frombuffer(r.column("ends")[0].as_py(), dtype="<i4") + at
                first = at if first is None else first
                inside = ends[(ends > first) & (ends <= (ends[-1] if upto is None else upto))] - at
                ids = own.encode(cut(text, [first - at, *inside.tolist()]))
                yield pa.RecordBatch.from_arrays([*(r.column(c) for c in ("row", "part", "doc_id")), _ids_column([ids])],
                                                 names=["row", "part", "doc_id", "ids"])

    return run


def encode_long(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Texts of several chunks -> (row, part, doc_id, ids), one row a chunk; ``row`` tells documents apart."""
    out = None
    for chunks, found in stitched(docs, ranks, pattern, chunk, overlap):
        ends = found.select("row", "part", F.col("seam").alias("upto"))
        bounds = ends.join(found.select("row", (F.col("part") + 1).alias("part"), F.col("seam").alias("first")),
                           ["row", "part"], "full")
        if found.count() <= BROADCAST_SEAMS:
            bounds = F.broadcast(bounds)
        ids = (chunks.select("row", "part", "doc_id", "at", "text", "ends").join(bounds, ["row", "part"], "left")
               .mapInArrow(_encode_between(ranks, pattern), _TOKENS))
        out = ids if out is None else out.unionByName(ids)
    return out


def encode(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """docs (doc_id, text, ...) -> (row, part, doc_id, ids array<int>).

    A text of one chunk is one row, with a null ``row``; a longer one has a row for each
    part, in the order of ``part``, and all of them share the ``row`` that names the document.
    """
    return (encode_short(docs, ranks, pattern, chunk)
            .unionByName(encode_long(docs, ranks, pattern, chunk, overlap)))


def _bytes_of(ranks: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(ranks, pattern)
        for b in batches:
            for lo, hi in _slices([len(i) for i in b.column("ids")]):
                part = b.slice(lo, hi - lo)
                out = [own.decode(i) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "part", "doc_id")), pa.array(out, pa.binary())],
                                                 names=["row", "part", "doc_id", "bytes"])

    return run


def decode(tokens: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(row, part, doc_id, ids) -> (row, part, doc_id, bytes); a document's bytes are its parts' in order."""
    return tokens.select("row", "part", "doc_id", "ids").mapInArrow(_bytes_of(ranks, pattern),
                                                                    "row long, part int, doc_id long, bytes binary")


class _Digest:
    def __init__(self, row: int | None, doc_id: int | None):
        self.row, self.doc_id, self.n = row, doc_id, 0
        self.ids, self.decoded = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, own: Bpe) -> None:
        if len(ids):
            listed = ids.tolist()
            self.ids.update(("," if self.n else "").encode() + ",".join(map(str, listed)).encode())
            self.decoded.update(own.decode(listed))
            self.n += len(listed)

    @staticmethod
    def batch(done: list[_Digest]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d.doc_id for d in done], pa.int64()), pa.array([d.n for d in done], pa.int64()),
             pa.array([d.ids.hexdigest() for d in done], pa.string()),
             pa.array([d.decoded.hexdigest() for d in done], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _digests(ranks: str, pattern: str):
    """Digests of documents whose parts come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = bpe(ranks, pattern), None
        for b in batches:
            done = []
            lists = b.column("ids")
            flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
            for k, (row, doc_id) in enumerate(zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist())):
                if last is None or row is None or row != last.row:
                    if last:
                        done.append(last)
                    last = _Digest(row, doc_id)
                last.add(flat[at[k]:at[k + 1]], own)
            if done:
                yield _Digest.batch(done)
        if last:
            yield _Digest.batch([last])

    return run


def digests(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of docs, by encoding its text and decoding the ids."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    parts = (encode_long(docs, ranks, pattern, chunk, overlap).repartition("row")
             .sortWithinPartitions("row", "part"))
    return (encode_short(docs, ranks, pattern, chunk).mapInArrow(_digests(ranks, pattern), schema)
            .unionByName(parts.mapInArrow(_digests(ranks, pattern), schema)))


def default_ranks() -> tuple[str, str]:
    """(rank file, pattern) of the many-language vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op11_bpe(spark, sf_dir) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"), *default_ranks())
