"""Connected components of a table of links, by alternating star contractions.

Each round replaces every node's links by links to the smallest node it sees
(large star, then small star), which keeps components and shrinks paths
geometrically.  All state is a table of links; nothing is gathered on the
driver, and each round is written to the shared folder, so that a lost executor
rereads the last round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .filter("a != b").distinct())
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    small = (down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .unionByName(least.select("a", F.col("m").alias("b"))))
    return small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links`` (a, b) of ids -> (id, component): the smallest id reachable, for linked ids.

    Ids may be of any type with an order.
    Ids without links are absent.  Nulls and self links are ignored; an empty
    table gives an empty table; repeated links count once.
    """
    edges = written(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), name)
    mark = _mark(edges)
    while mark[0]:
        edges = written(_round(edges), name)
        last, mark = mark, _mark(edges)
        if last == mark:
            break
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
