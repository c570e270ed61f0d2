"""Helpers shared by the corpus operators: tables, written steps, folds."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from ..sources.tables import read_table

__all__ = ["read_table", "run_path", "written", "written_twice", "fold", "held_out", "text_marks", "without",
           "WORD_SPACE"]

#: fixed values: the characters that separate words in every word-based contract
WORD_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's tables, under the shared checkpoint folder."""
    return os.path.join(work_path(spark, "llm"), f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage the way ``checkpoint()`` does, but keeps column pruning and
    filter push-down for the readers; a lost executor rereads the files.
    """
    return written_twice(df, name)[0]


def written_twice(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Like ``written``, read as two frames that can be joined or cogrouped without ambiguous columns."""
    spark = df.sparkSession
    path = run_path(spark, name)
    df.write.parquet(path)
    return tuple(spark.read.schema(df.schema).parquet(path) for _ in range(2))


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id's decimal text modulo 3 (null for a null id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % 3


def held_out(doc_id: Column | str) -> Column:
    """Whether a row is in the held-out fold; a null id is not, and is never learned from."""
    return F.coalesce(fold(doc_id) == 1, F.lit(False))



def text_marks(text: Column) -> tuple[Column, Column]:
    """Two hashes (m1, m2) that tell the texts of one id apart; a null text has marks of its own."""
    here = F.when(text.isNull(), F.lit(0)).otherwise(F.lit(1))
    return F.xxhash64(here, text).alias("m1"), F.xxhash64(here + 2, text).alias("m2")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and text are not in ``gone`` (doc_id, m1, m2); a null id is an id like others."""
    m1, m2 = text_marks(docs["text"])
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (m1 == gone["m1"]) & (m2 == gone["m2"])
    return docs.join(gone, same, "left_anti")
