"""Registered catalogue queries (S2, Q1-Q17) and their oracle SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F  # noqa: F401

from ..operators import catalogue as cat
from ..operators.fulltext import search_vector
from ..sources import catalogue as src
from ..streaming import postings as P
from ..streaming.stream import run_dir
from .oracle_base import with_catalogue
from .registry import register
from .report_queries import vector_ctes

# Search parameters used by the registered search queries.
Q_KEYWORD = "red"
Q_STEMS = "The rings of reds"
Q_UNIVERSITY = "supplier#0000000"
Q_DEGREE = "BSc"
Q_LEVEL = "under"
Q_MIN_FEE, Q_MAX_FEE = 9200, 9600
Q_PAGE, Q_PAGE_SIZE = 2, 20


def _cat(spark, d):
    return src.universities(spark, d), src.courses(spark, d)


@register("scan_catalogue", with_catalogue("""
SELECT c.id, c.university_id, c.name, c.degree, c.level, c.department, c.ucas_code, c.study_mode,
       c.duration_years, c.start_month, c.fee_uk_yearly, c.fee_uk_sandwich, c.fee_intl_yearly,
       c.fee_intl_sandwich, c.deadline_main, c.deadline_late, c.ielts_score, c.source_url,
       c.is_active, c.scraped_at, c.created_at, c.updated_at
FROM courses c"""))
def q_scan_catalogue(spark, d):
    return src.courses(spark, d)


@register("search_base", with_catalogue("""
SELECT c.id, c.name, u.name AS uni_name, u.location AS uni_location, c.fee_uk_yearly
FROM courses c JOIN unis u ON c.university_id = u.id
WHERE c.is_active IS TRUE"""))
def q_search_base(spark, d):
    u, c = _cat(spark, d)
    return cat.search_base(c, u).select("id", "name", "uni_name", "uni_location", "fee_uk_yearly")


def _keyword_sql(q: str) -> str:
    return with_catalogue(f"""
SELECT c.id, c.name, c.department, c.degree
FROM courses c JOIN unis u ON c.university_id = u.id
WHERE c.is_active IS TRUE AND (c.id IN (SELECT id FROM found) OR coalesce(c.name ILIKE '%{q}%', false)
                               OR coalesce(c.department ILIKE '%{q}%', false))""", extra=vector_ctes("courses", q))


def _keyword(spark, d, q):
    """Store the courses' search vector, then search it: only the buckets of the terms are read."""
    u, c = _cat(spark, d)
    postings = P.posting_table(spark, run_dir(spark, "postings"))
    postings.commit(search_vector(c))
    return (cat.search_filtered(c, u, q=q, matches=P.matching(postings, q))
            .select("id", "name", "department", "degree"))


@register("search_keyword", _keyword_sql(Q_KEYWORD))
def q_search_keyword(spark, d):
    return _keyword(spark, d, Q_KEYWORD)


@register("search_stems", _keyword_sql(Q_STEMS))
def q_search_stems(spark, d):
    """Q3 where only the stems of the words meet: no name holds the query as it is written."""
    return _keyword(spark, d, Q_STEMS)


@register("search_filters", with_catalogue(f"""
SELECT c.id, c.name, u.name AS uni_name, c.degree, c.level
FROM courses c JOIN unis u ON c.university_id = u.id
WHERE c.is_active IS TRUE AND u.name ILIKE '%{Q_UNIVERSITY}%'
  AND c.degree ILIKE '%{Q_DEGREE}%' AND c.level ILIKE '%{Q_LEVEL}%'"""))
def q_search_filters(spark, d):
    u, c = _cat(spark, d)
    return (cat.search_filtered(c, u, university=Q_UNIVERSITY, degree=Q_DEGREE, level=Q_LEVEL)
            .select("id", "name", "uni_name", "degree", "level"))


@register("search_fee_range", with_catalogue(f"""
SELECT c.id, c.name, c.fee_uk_yearly
FROM courses c JOIN unis u ON c.university_id = u.id
WHERE c.is_active IS TRUE AND c.fee_uk_yearly >= {Q_MIN_FEE} AND c.fee_uk_yearly <= {Q_MAX_FEE}"""))
def q_search_fee_range(spark, d):
    u, c = _cat(spark, d)
    return (cat.search_filtered(c, u, min_fee=Q_MIN_FEE, max_fee=Q_MAX_FEE)
            .select("id", "name", "fee_uk_yearly"))


@register("search_total", with_catalogue(f"""
SELECT count(*) AS total
FROM courses c JOIN unis u ON c.university_id = u.id
WHERE c.is_active IS TRUE AND c.degree ILIKE '%{Q_DEGREE}%'
  AND c.fee_uk_yearly >= {Q_MIN_FEE}"""))
def q_search_total(spark, d):
    u, c = _cat(spark, d)
    return cat.search_total(cat.search_filtered(c, u, degree=Q_DEGREE, min_fee=Q_MIN_FEE))


_LIST_SQL = """
SELECT c.id, c.name, c.degree, c.level, c.department, u.name AS university_name,
       u.location AS university_location,
       CASE WHEN c.duration_years <> 0 THEN CAST(c.duration_years AS DOUBLE) END AS duration_years,
       c.fee_uk_yearly, c.fee_intl_yearly, c.source_url
FROM courses c JOIN unis u ON c.university_id = u.id
WHERE c.is_active IS TRUE"""


@register("search_page", with_catalogue(f"""
{_LIST_SQL} AND c.degree ILIKE '%{Q_DEGREE}%'
ORDER BY c.name NULLS FIRST, c.id
LIMIT {Q_PAGE_SIZE} OFFSET {(Q_PAGE - 1) * Q_PAGE_SIZE}"""))
def q_search_page(spark, d):
    u, c = _cat(spark, d)
    page, _total = cat.search(c, u, page=Q_PAGE, page_size=Q_PAGE_SIZE, degree=Q_DEGREE)
    return page


# the page before the last one, of all active courses
@register("search_deep_page", with_catalogue(f"""
, listed AS ({_LIST_SQL}),
placed AS (SELECT *, row_number() OVER (ORDER BY name NULLS FIRST, id) - 1 AS place, count(*) OVER () AS total FROM listed)
SELECT * EXCLUDE (place, total) FROM placed WHERE place // {Q_PAGE_SIZE} = greatest(total // {Q_PAGE_SIZE} - 1, 0)
""".replace("\n, listed", "listed", 1)).replace("\nlisted AS", ",\nlisted AS", 1))
def q_search_deep_page(spark, d):
    u, c = _cat(spark, d)
    found = cat.search_filtered(c, u)
    total = cat.search_total(found).first().total
    return cat.deep_page(found, max(total // Q_PAGE_SIZE, 1), Q_PAGE_SIZE, range_rows=1_000)


@register("university_list", with_catalogue("""
SELECT u.id, u.name, u.location, u.website, count(c.id) AS course_count
FROM unis u LEFT JOIN courses c ON c.university_id = u.id
GROUP BY u.id, u.name, u.location, u.website"""))
def q_university_list(spark, d):
    u, c = _cat(spark, d)
    return cat.university_list(u, c)


@register("university_detail", with_catalogue("""
SELECT u.id, u.name, u.location, u.website, count(c.id) AS course_count
FROM unis u LEFT JOIN courses c ON c.university_id = u.id
WHERE u.name = 'Supplier#000000001'
GROUP BY u.id, u.name, u.location, u.website"""))
def q_university_detail(spark, d):
    u, c = _cat(spark, d)
    # ids are sha-256 of the natural key, so the parameter is computed, not looked up
    uid = hashlib.sha256("Supplier#000000001".encode()).hexdigest()
    return cat.university_detail(u, c, uid)


@register("totals", with_catalogue("""
SELECT (SELECT count(*) FROM unis) AS total_universities,
       (SELECT count(*) FROM courses) AS total_courses"""))
def q_totals(spark, d):
    u, c = _cat(spark, d)
    return cat.totals(u, c)


@register("counts_desc", with_catalogue("""
SELECT u.id, u.name, u.location, count(c.id) AS course_count
FROM unis u LEFT JOIN courses c ON u.id = c.university_id
GROUP BY u.id, u.name, u.location"""))
def q_counts_desc(spark, d):
    u, c = _cat(spark, d)
    return cat.counts_desc(u, c)


EARLY = "1995-01-05"  # soon after the first observations: not every university has a course yet


@register("universities_without_courses", with_catalogue(f"""
SELECT u.id, u.name, u.location FROM unis u
WHERE NOT EXISTS (SELECT 1 FROM courses c WHERE c.university_id = u.id AND c.created_at < TIMESTAMP '{EARLY}')"""))
def q_universities_without_courses(spark, d):
    """Q16 on the courses that the whole catalogue first saw before an early date."""
    seen = src.courses(spark, d).filter(F.col("created_at") < F.lit(EARLY).cast("timestamp_ntz"))
    return cat.universities_without_courses(src.universities(spark, d), seen)


@register("universities_without_kept_courses", with_catalogue("""
SELECT u.id, u.name, u.location FROM unis u
WHERE NOT EXISTS (SELECT 1 FROM courses c JOIN supplier s ON sha256(s.s_name) = c.university_id
                  WHERE c.university_id = u.id AND s.s_acctbal >= 0)"""))
def q_universities_without_kept_courses(spark, d):
    """Q16 on the whole catalogue, from which the courses of universities that have gone
    (a supplier with a negative balance) are withdrawn."""
    kept = src.universities(spark, d, solvent=True).select(F.col("id").alias("university_id"))
    courses = src.courses(spark, d).join(kept, "university_id", "left_semi")
    return cat.universities_without_courses(src.universities(spark, d), courses)


@register("orphan_courses", with_catalogue("""
SELECT c.id, c.name, c.source_url FROM courses c
WHERE NOT EXISTS (SELECT 1 FROM unis u JOIN supplier s ON s.s_suppkey = u.supplier_key
                  WHERE u.id = c.university_id AND s.s_acctbal >= 0)"""))
def q_orphan_courses(spark, d):
    """Q17: courses whose university has gone (a supplier with a negative balance)."""
    unis = src.universities(spark, d, solvent=True)
    return cat.orphan_courses(src.courses(spark, d), unis).select("id", "name", "source_url")
