"""The driver contract and the oracle comparison on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare_oracle import rows_of

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "course_count" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


CHEAP = ["university_list", "search_page", "summary_report_lines", "links_dedup", "clean_string",
         "validate_items", "dedup_first_by_url", "upsert_universities", "fulltext_match",
         "course_detail", "extract_fees", "markdown_fields"]


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = E.queries()[name](spark, sf_small)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(ocols, res.fetchall())
