"""Operator 13: the prefix trie of conversations, by range minima over sorted LCPs.

A conversation becomes a key, the SHA-256 of each of its turns one after the
other.  Keys are sorted by a range partitioning, then cut into blocks of about
``BLOCK_TURNS`` turns.  In the sorted order the members of a trie node of depth d
are an interval in which neighbours have at least d turns in common.  A block has a
sparse table of the minima of these common lengths over 1, 2, 4, ... places; every
candidate prefix (a conversation and a depth) searches the ends of its interval
by itself, left and right, in steps of halving size, without a stack.  Everything a node
reports follows from its interval by prefix sums:

* members and the smallest id: its length, and a second sparse table;
* children: the candidates of the next depth whose left search ends in it;
* childless nodes: places whose sequence the next place does not continue;
* saved tokens: a place repeats the turns it shares with the one before it, so a
  node's subtree saves what these hold beyond the node's own ancestors.

An interval that meets an edge of its block may go on in the next one.  Such nodes
contain a block's first or last conversation, so a block has few of them; they
are known by a hash of their turns, and their sums are added up over blocks.
No group is gathered: a node of a third of all conversations costs a row a block.
Its members' ids, in ascending order, are hashed as they pass, one chunk a block.

Defined cases: null roles and texts are empty; turns are ordered by turn (null
first), then role, then hash of the text; repeated rows are turns of their own; rows
with a null conv_id belong to no conversation and are left out; other columns are ignored;
an empty table has no nodes, not even a root.  A conversation is one row of 40
bytes a turn, whatever the length of its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, written

#: turns of a block; a longer conversation is a block of its own
BLOCK_TURNS = 1 << 17
#: nodes that meet an edge up to which they are broadcast; a shuffle join beyond
BROADCAST_NODES = 100_000
#: production parameters: ids per base conversation, and one more than the most turns taken from it
GROUP, TAKEN = 100, 6
MARK = 32


def sequences(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) -> (conv_id, turns array<struct<mark, chars>>) in order of turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    mark = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(F.col("turn"), role.alias("role"), F.sha2(text, 256).alias("by"), mark.alias("mark"),
                    F.char_length(text).alias("chars"))
    return (rows.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda t: F.struct(t["mark"].alias("mark"), t["chars"].alias("chars"))).alias("turns")))


def rebuilt(convs: DataFrame, group: int = GROUP, taken: int = TAKEN) -> DataFrame:
    """(conv_id, turns): each conversation's first h turns replaced by those of its base, h = crc32(id) % taken."""
    base = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, taken - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % taken).cast("int")
    own = convs.withColumns({"base": F.expr(f"conv_id - conv_id % {group}"), "h": h})
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return (own.join(base, "base", "left")
            .select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0)), rest).alias("turns")))


def common_lengths(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Leading turns that each conversation has in common with the one before it (0 for the first).

    ``marks`` (turns, 4) are the 256-bit marks, ``at`` the offsets of the conversations.
    """
    n = np.diff(at)
    least = np.minimum(n[1:], n[:-1])
    pair = np.repeat(np.arange(len(least)), least)
    pos = np.arange(len(pair)) - np.repeat(np.cumsum(least) - least, least)
    differ = (marks[at[:-2][pair] + pos] != marks[at[1:-1][pair] + pos]).any(axis=1) if len(pair) else np.zeros(0, bool)
    out = least.copy()
    np.minimum.at(out, pair[differ], pos[differ])
    return np.concatenate(([0], out))


def shared(a: bytes, b: bytes) -> int:
    """Leading turns in common of two keys."""
    n = min(len(a), len(b)) // MARK
    x, y = (np.frombuffer(k, dtype="<u8", count=4 * n).reshape(n, 4) for k in (a, b))
    differ = (x != y).any(axis=1)
    return int(differ.argmax()) if differ.any() else n


class Minima:
    """Sparse table: minima over 2**k places from each place on."""

    def __init__(self, values: np.ndarray):
        self.n, self.rows = len(values), [values]
        while 1 << len(self.rows) <= self.n:
            last, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def right(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from ``start`` on whose value is below ``depth`` (n where there is none)."""
        at = start.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            go = at + (1 << k) <= self.n
            go[go] = row[at[go]] >= depth[go]
            at[go] += 1 << k
        return at

    def left(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to ``start`` whose value is below ``depth`` (-1 where there is none)."""
        at = start + 1  # places before ``at`` are open
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            go = at >= 1 << k
            go[go] = row[at[go] - (1 << k)] >= depth[go]
            at[go] -= 1 << k
        return at - 1

    def over(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of the places lo..hi, both included."""
        k = np.frexp(hi - lo + 1)[1] - 1
        out = np.empty(len(lo), dtype=self.rows[0].dtype)
        for j in np.unique(k):
            m = k == j
            out[m] = np.minimum(self.rows[j][lo[m]], self.rows[j][hi[m] - (1 << j) + 1])
        return out


def _chain(key: bytes, depth: int) -> list[bytes]:
    """Hashes of the first 0, 1, ... ``depth`` turns of a key."""
    out = [hashlib.sha256(b"").digest()]
    for d in range(depth):
        out.append(hashlib.sha256(out[-1] + key[MARK * d:MARK * (d + 1)]).digest())
    return out


_BLOCK = ("part int, block int, first_key binary, last_key binary, left int, right int, ids binary, sizes binary, "
          "common binary, chars binary")


def _block(part: int, block: int, left: int | None, ids: list, keys: list[bytes], chars: list[np.ndarray]) -> dict:
    n = np.fromiter((len(k) // MARK for k in keys), dtype=np.int64, count=len(keys))
    at = np.concatenate(([0], np.cumsum(n)))
    marks = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 4)
    return {"part": part, "block": block, "first_key": keys[0], "last_key": keys[-1], "left": left, "right": None,
            "ids": np.array(ids, dtype="<i8").tobytes(), "sizes": n.astype("<i8").tobytes(),
            "common": common_lengths(marks, at).astype("<i8").tobytes(),
            "chars": np.concatenate([np.zeros(0, dtype="<i8"), *chars]).astype("<i8").tobytes()}


def _blocks(limit: int):
    """Cut a sorted partition into blocks, each of which knows what it shares with its neighbours in the partition."""
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _BLOCK.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, held, left = TaskContext.get().partitionId(), 0, None, None
        ids, keys, chars, size = [], [], [], 0
        batch = lambda row: pa.RecordBatch.from_pylist([row], schema=schema)
        for b in batches:
            lists = b.column("chars")
            flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
            for k, (i, key) in enumerate(zip(b.column("conv_id").to_pylist(), b.column("key").to_pylist())):
                if size and size + len(key) // MARK + 1 > limit:
                    new = _block(part, block, left, ids, keys, chars)
                    left = new["right"] = shared(keys[-1], key)
                    yield batch(new)
                    block, ids, keys, chars, size = block + 1, [], [], [], 0
                ids.append(i)
                keys.append(key)
                chars.append(flat[at[k]:at[k + 1]])
                size += len(key) // MARK + 1
        if ids:
            yield batch(_block(part, block, left, ids, keys, chars))

    return run


def blocks_of(convs: DataFrame, limit: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, turns) -> the blocks of the sorted keys, written; ``left`` and ``right`` are -1 at the ends of the order."""
    keyed = written(convs.select("conv_id", F.unhex(F.array_join("turns.mark", "")).alias("key"),
                                 F.col("turns.chars").cast("array<bigint>").alias("chars")), "trie-keys")
    cut = written(keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
                  .mapInArrow(_blocks(limit), _BLOCK), "trie-blocks")
    # neighbours in other partitions: one row a partition
    ends = (cut.filter("left is null").select("part", "first_key")
            .join(cut.filter("right is null").select("part", "last_key"), "part"))
    order = Window.orderBy("part")
    ends = ends.select("part", F.lag("last_key").over(order).alias("before"), F.lead("first_key").over(order).alias("after"))
    return cut.join(F.broadcast(ends), "part")


_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, part int, block int, node binary, parent binary, ends binary")


def _nodes_of(r: dict) -> pa.RecordBatch:
    """The nodes of one block.

    A node inside the block is complete; ``node`` is null.  One that meets an edge has
    the hash ``node`` and this block's share of its numbers and of its ids.  ``parent`` is the hash
    of a parent that meets an edge.
    """
    ids, sizes, common, chars = (np.frombuffer(r[c], dtype="<i8") for c in ("ids", "sizes", "common", "chars"))
    n = len(ids)
    left = r["left"] if r["left"] is not None else -1 if r["before"] is None else shared(r["before"], r["first_key"])
    right = r["right"] if r["right"] is not None else -1 if r["after"] is None else shared(r["last_key"], r["after"])
    common = common.copy()
    common[0] = left
    after = np.concatenate((common[1:], [right]))
    at = np.concatenate(([0], np.cumsum(sizes)))
    total = np.concatenate(([0], np.cumsum(chars)))  # of the turns before a place
    up_to = lambda conv, depth: total[at[conv] + depth] - total[at[conv]]

    # candidates: depths at which a conversation is the first member in the block
    from_depth = np.where(np.arange(n) == 0, 0, common + 1)
    count = sizes - from_depth + 1
    first = np.cumsum(count) - count
    conv = np.repeat(np.arange(n), count)
    depth = np.arange(len(conv)) - np.repeat(first - from_depth, count)

    minima, smallest = Minima(common), Minima(ids)
    end = minima.right(conv + 1, depth)  # one past the last member
    start = np.maximum(minima.left(conv, depth), 0)
    parent_start = np.maximum(minima.left(conv, depth - 1), 0)
    parent = np.where(depth > 0, first[parent_start] + depth - 1 - from_depth[parent_start], -1)

    begun = (depth > common[conv]) & (depth > 0)  # the node begins here, not in an earlier block
    children = np.bincount(parent[begun], minlength=len(conv))
    leaf = np.concatenate(([0], np.cumsum(after < sizes)))
    repeats = np.concatenate(([0], np.cumsum(up_to(np.arange(n), np.maximum(common, 0)))))
    earlier = depth > common[start]  # whether the first member in the block is the node's first
    upper = up_to(start, np.maximum(depth - 1, 0))
    frm = start + earlier
    saved = repeats[end] - repeats[frm] - (end - frm) * upper

    # ids of members with exactly ``depth`` turns: the places from the start on that equal it
    same = np.concatenate((common[1:] == sizes[1:], [False])) & np.concatenate((sizes[1:] == sizes[:-1], [False]))
    stop = np.flatnonzero(~same)
    equal_end = stop[np.searchsorted(stop, np.arange(n))] + 1
    ends = [",".join(map(str, ids[s:equal_end[s]].tolist())).encode() if sizes[s] == d else b""
            for s, d in zip(start.tolist(), depth.tolist())]

    crosses_left, crosses_right = (start == 0) & (depth <= left), (end == n) & (depth <= right)
    edge = crosses_left | crosses_right
    heads = _chain(r["first_key"], max(min(left, int(sizes[0])), 0))
    tails = _chain(r["last_key"], max(min(right, int(sizes[-1])), 0))
    name = [None if not e else heads[d] if f else tails[d]
            for e, f, d in zip(edge.tolist(), crosses_left.tolist(), depth.tolist())]
    low = smallest.over(start, end - 1)
    up = np.maximum(parent, 0)
    inner = (depth > 0) & ~edge[up]
    k = len(conv)
    return pa.RecordBatch.from_arrays(
        [pa.array(low), pa.array(depth), pa.array(low[up], mask=~inner), pa.array(end - start), pa.array(children),
         pa.array(leaf[end] - leaf[start]), pa.array(saved),
         pa.array([None if e else hashlib.sha256(x).hexdigest() for e, x in zip(edge.tolist(), ends)], pa.string()),
         pa.array([r["part"]] * k, pa.int32()), pa.array([r["block"]] * k, pa.int32()), pa.array(name, pa.binary()),
         pa.array([name[p] if p >= 0 else None for p in parent.tolist()], pa.binary()),
         pa.array([x if e else None for e, x in zip(edge.tolist(), ends)], pa.binary())],
        names=[c.split()[0] for c in _NODE.split(", ")])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            yield _nodes_of(b.slice(k, 1).to_pylist()[0])


_NUMBERS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_JOINED = "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shares of nodes, in order of node, part and block -> nodes."""
    done, last, ids, any_id = [], None, None, False

    def close() -> None:
        if last:
            done.append({**last, "ends_sha256": ids.hexdigest()})

    names = [c.split()[0] for c in _JOINED.split(", ")]
    columns = lambda: pa.RecordBatch.from_arrays(
        [pa.array([d[c] for d in done], {"binary": pa.binary(), "string": pa.string(), "long": pa.int64()}[kind])
         for c, kind in (f.split() for f in _JOINED.split(", "))], names=names)
    for b in batches:
        for r in b.to_pylist():
            if last is None or r["node"] != last["node"]:
                close()
                last, ids, any_id = {c: r[c] for c in names if c in r}, hashlib.sha256(), False
            else:
                for c in _NUMBERS:
                    last[c] += r[c]
                last["conv_id"] = min(last["conv_id"], r["conv_id"])
            if r["ends"]:
                ids.update((b"," if any_id else b"") + r["ends"])
                any_id = True
        if done:
            yield columns()
            done.clear()
    close()
    if done:
        yield columns()


def trie(convs: DataFrame, limit: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, turns), ids distinct -> a row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    nodes = written(blocks_of(convs, limit).mapInArrow(_nodes, _NODE), "trie-nodes")
    shares = (nodes.filter("node is not null").select("node", "parent", "depth", "conv_id", *_NUMBERS, "part", "block", "ends")
              .repartition("node").sortWithinPartitions("node", "part", "block"))
    edge = written(shares.mapInArrow(_add_up, _JOINED), "trie-edge")
    few = edge.count() <= BROADCAST_NODES
    named = edge.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    named = F.broadcast(named) if few else named
    out = ["conv_id", "depth", "parent_conv_id", *_NUMBERS, "ends_sha256"]
    inner = nodes.filter("node is null")
    whole = inner.filter("parent is null").select(*out)
    below = (inner.filter("parent is not null").drop("parent_conv_id").join(named, "parent")
             .withColumnRenamed("above", "parent_conv_id").select(*out))
    wide = edge.join(named, "parent", "left").withColumnRenamed("above", "parent_conv_id").select(*out)
    return whole.unionByName(below).unionByName(wide)


def op13_prefix_trie(spark, sf_dir) -> DataFrame:
    return trie(rebuilt(sequences(read_table(spark, sf_dir, "conversations"))))


#: unsigned crc32 of an ASCII string, bit by bit
_CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
  string_split(conv_id::VARCHAR, ''), lambda ch: [(256 + ascii(ch))::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, x: CASE WHEN x >= 256 THEN xor(a, x - 256) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END))"""

ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {_CRC} % {TAKEN} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = base AND pos <= h
  UNION ALL SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
p AS (
  SELECT conv_id, text, row_number() OVER w AS depth,
    string_agg(sha256(length(role) || ':' || role || text), '') OVER (w ROWS UNBOUNDED PRECEDING) AS key
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
m AS (SELECT conv_id, '' AS text, 0::BIGINT AS depth, '' AS key FROM c UNION ALL SELECT conv_id, text, depth, key FROM p),
z AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM m),
n AS (
  SELECT key, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(length(text)) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM z GROUP BY key),
up AS (SELECT key, left(key, 64 * (depth - 1)::BIGINT) AS parent FROM n WHERE depth > 0),
k AS (SELECT parent AS key, count(*) AS n_children FROM up GROUP BY parent),
below AS (
  SELECT a.key, b.chars, b.n_convs, k.key IS NULL AS leaf
  FROM n b LEFT JOIN k ON k.key = b.key, unnest(range(b.depth + 1)) AS u(d) JOIN n a ON a.key = left(b.key, 64 * d)),
s AS (SELECT key, sum(leaf::INT) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens FROM below GROUP BY key)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.key = n.key LEFT JOIN k ON k.key = n.key LEFT JOIN up ON up.key = n.key LEFT JOIN n q ON q.key = up.parent
"""
