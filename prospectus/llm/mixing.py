"""Operator 1: mix sources to target weights by systematic sampling.

Within a source every document expects ``target / source_size`` copies.  The
expected copies are prefix-summed over the source's documents in the order
(size descending, doc_id), one random offset in [0, 1) is added, and a document
is emitted once for every integer boundary its interval crosses.  Sizes fall
along the order, so neighbours stand in for each other and the words taken stay
within about one document of the target.

The prefix sum is built from three levels, none of which puts a source into one
task: counts by (source, size), counts by (source, size, id block) and a running
count inside an id block.  Sources are numbered and their shares added up over ranges of
them, too.  Only DataFrame functions are used.

Defined cases: a null text has size 0; a null source is a source of its own,
after all others; rows that repeat an id count as documents of their own, and which of
those equal in id, source, size and text gets a place of the order is open (they differ in
other columns at most); a source of size 0 takes nothing; very long texts are counted whole;
other columns, whatever their names, stay with their rows; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_SPACE, read_table, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
#: ids per block of the running count: bounds what one window task holds
ID_BLOCK = 1 << 14
#: rows of a per-(source, size) table up to which it is broadcast; a shuffle join beyond
BROADCAST_ROWS = 100_000

_SET = "\\x20\\x09-\\x0D"


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and 9-13; null counts 0."""
    left = F.ltrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE))
    return F.length(F.regexp_replace(left, f"[^{_SET}]++[{_SET}]*+", "x")).cast("long")


def _beside(df: DataFrame, row: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row table."""
    return df.withColumn("_k", F.lit(1)).join(F.broadcast(row.withColumn("_k", F.lit(1))), "_k").drop("_k")


def _running(df: DataFrame, order: list[Column], cols: list[str]) -> DataFrame:
    """``df`` with ``<c>_before``, the sum of each column over the rows before a row in ``order``.

    Rows are put in ranges; sums run inside a range, after those of the ranges before it, one
    row a range."""
    ranged = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "mix-ranges")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    ends = ranged.groupBy("_range").agg(*[F.sum(c).alias(c) for c in cols])
    ends = ends.select("_range", *[F.coalesce(F.sum(c).over(earlier(Window.orderBy("_range"))), F.lit(0)).alias(f"_{c}_at")
                                   for c in cols])
    inside = earlier(Window.partitionBy("_range").orderBy(*order))
    sums = {f"{c}_before": F.col(f"_{c}_at") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in cols}
    return ranged.join(F.broadcast(ends), "_range").withColumns(sums).drop("_range", *[f"_{c}_at" for c in cols])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEAT,
                   seed: str = SEED) -> DataFrame:
    """(source, source_size) -> with target, rate and offset; one row per source.

    Sources are numbered by code point (null last) and take the weights in turn.
    Their targets share the sum of all sizes by weight but stop at ``cap`` times
    the source's size, and what is cut off is shared again.  With sources sorted by
    cap per weight the final share per weight is the largest of the shares that
    remain after each prefix of capped sources.
    """
    w = F.array(*[F.lit(x) for x in weights])
    by_name = [F.col("source").asc_nulls_last()]
    t = (_running(sizes.withColumn("_one", F.lit(1)), by_name, ["_one"])
         .withColumn("_w", F.element_at(w, F.pmod(F.col("_one_before"), F.lit(len(weights))).cast("int") + 1))
         .withColumn("_cap", F.col("source_size") * cap).select("source", "source_size", "_w", "_cap"))
    t = written(_running(t, [(F.col("_cap") / F.col("_w")).asc(), *by_name], ["_cap", "_w"]), "mix-running")
    whole = t.agg(F.sum("source_size").alias("_all"), F.sum("_w").alias("_weights"))  # one row
    share = (F.col("_all") - F.col("_cap_before")) / (F.col("_weights") - F.col("_w_before")).cast("double")
    whole = _beside(t, whole).agg(F.max(share).alias("_top"))
    t = _beside(t, whole).withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_top") * F.col("_w")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
                                      .cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return t.select("source", "source_size", "target", rate.alias("rate"), offset.alias("offset"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond).drop(*[f"_r_{k}" for k in keys])


def mix_ranks(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEAT,
              seed: str = SEED) -> DataFrame:
    """(doc_id, source, size), best a written table -> one row per distinct triple.

    Adds ``n`` (rows with that triple), ``before`` (documents before them in the
    source's order), source_size, target, rate and offset.
    """
    block = F.floor(F.col("doc_id") / F.lit(ID_BLOCK))
    keyed = written(sized.groupBy("source", "size", block.alias("block"), "doc_id").agg(F.count("*").alias("n")),
                    "mix-keyed")
    blocks = written(keyed.groupBy("source", "size", "block").agg(F.sum("n").alias("rows")), "mix-blocks")
    levels = written(blocks.groupBy("source", "size").agg(F.sum("rows").alias("rows")), "mix-levels")
    sizes = levels.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = written(source_targets(sizes, weights, cap, seed), "mix-targets")
    upto = lambda keys, *order: (Window.partitionBy(*keys).orderBy(*order)
                                 .rowsBetween(Window.unboundedPreceding, -1))
    level_at = levels.select("source", "size", F.coalesce(F.sum("rows").over(
        upto(["source"], F.col("size").desc())), F.lit(0)).alias("level_at"))
    level_at = written(_null_safe(level_at, _small(targets), ["source"]), "mix-level-at")
    block_at = blocks.select("source", "size", "block", F.coalesce(F.sum("rows").over(
        upto(["source", "size"], F.col("block").asc_nulls_first())), F.lit(0)).alias("block_at"))
    inside = keyed.withColumn("inside", F.coalesce(F.sum("n").over(
        upto(["source", "size", "block"], F.col("doc_id").asc_nulls_first())), F.lit(0)))
    out = _null_safe(inside, block_at, ["source", "size", "block"])
    out = _null_safe(out, _small(level_at), ["source", "size"])
    return out.select("doc_id", "source", "size", "n", (F.col("level_at") + F.col("block_at") + F.col("inside"))
                      .alias("before"), "source_size", "target", "rate", "offset")


def copies_of(rank: Column) -> Column:
    """Integer boundaries crossed by the document at ``rank`` (1 is the source's first)."""
    at = lambda k: F.floor(F.col("rate") * k + F.col("offset"))
    return (at(rank) - at(rank - 1)).cast("long")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEAT,
                  seed: str = SEED) -> DataFrame:
    """The mix itself: ``docs``' own columns, each row once per copy taken.

    Rows alike in id, source and size are told apart by a hash of their text, so
    that each gets the copies of one place in the order.
    """
    cols = docs.columns
    row = docs.select(F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
                      F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    ranks = mix_ranks(written(row.select("doc_id", "source", "size"), "mix-sized"), weights, cap, seed)
    nth = F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("_row.text")))
    placed = _null_safe(row.withColumn("_nth", nth), ranks, ["doc_id", "source", "size"])
    taken = (placed.withColumn("_copies", copies_of(F.col("before") + F.col("_nth"))).filter("_copies > 0")
             .select(F.explode(F.array_repeat("_row", F.col("_copies").cast("int"))).alias("_row")))
    return taken.select("_row.*")


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEAT,
               seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sized")
    ranks = mix_ranks(sized, weights, cap, seed)
    each = ranks.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return (each.withColumn("copies", copies_of(F.col("before") + F.col("_nth")))
            .select("doc_id", "source", "size", F.col("source_size").cast("long"), "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def op1_mix(spark, sf_dir) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents")).drop("source")


_LITERAL = "[^\\x20\\x09-\\x0D]+"
ORACLE_SQL = f"""
WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_LITERAL}')), 0)::BIGINT AS size FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 3 * source_size AS cap
  FROM src),
sh AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / w::DOUBLE, source NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY cap / w::DOUBLE, source NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share
  FROM w),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, max(share) OVER () * w) AS target,
    ('0x' || substr(md5('{SEED}:' || coalesce('s' || source, 'n')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sh),
r AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size DESC, s.doc_id) AS k
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(rate * k + u) - floor(rate * (k - 1) + u))::BIGINT AS copies,
  (floor(rate * k + u) - floor(rate * (k - 1) + u))::BIGINT * size AS taken
FROM r
"""
