"""From documents to token files: quality, near-duplicates, leaks, mix, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's
docs.  All but the last keep the columns of ``documents``; the last returns what
the token files say of each document (a document that the mix repeats has a row
for each copy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prospectus.llm import decontaminate, minhash, mixing, quality, token_output
from prospectus.llm.common import read_table, written


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier, learned from the labels of these documents, accepts."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by five-word shingles with a similarity of 0.8."""
    return minhash.keep_one_each(docs, k=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    return mixing.mix_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; per document doc_id, start, n_tokens, ids_crc32."""
    return token_output.tokenize(docs, token_output.default_tokenizer())


STAGES = [
    ("quality classifier", drop_low_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token output", write_tokens),
]

#: no SQL has a trained classifier or a tokenizer; tests hold run() against plain restatements
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
