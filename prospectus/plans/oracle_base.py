"""DuckDB SQL building blocks for the oracle queries.

They restate the catalogue derivation of ``sources.catalogue`` in plain SQL
over the input tables, so each oracle query is independent of the Spark code.
"""

from __future__ import annotations

from ..sources.catalogue import CATALOGUE_CREATED_AT, FIXTURE_DEGREES

_DEGREES = "[" + ", ".join(f"'{d}'" for d in FIXTURE_DEGREES) + "]"

UNIS_CTE = f"""
unis AS (
  SELECT sha256(s.s_name) AS id, s.s_name AS name, n.n_name AS location,
         CAST(NULL AS VARCHAR) AS website,
         TIMESTAMP '{CATALOGUE_CREATED_AT}' AS created_at, s.s_suppkey AS supplier_key
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

COURSES_CTE = f"""
facts AS (
  SELECT l_partkey, l_suppkey, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen,
         count(*) AS n_obs, max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS any_open
  FROM lineitem {{where}} GROUP BY l_partkey, l_suppkey
),
cbase AS (
  SELECT f.*, p.*, s.s_name,
         'https://www.university-' || CAST(f.l_suppkey AS VARCHAR) || '.example.ac.uk/courses/'
           || CAST(f.l_partkey AS VARCHAR) AS url,
         {_DEGREES}[p.p_size % {len(FIXTURE_DEGREES)} + 1] AS deg
  FROM facts f JOIN part p ON f.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON f.l_suppkey = s.s_suppkey
),
cbase2 AS (
  SELECT *, CASE WHEN deg LIKE 'B%' OR deg LIKE 'LLB%' THEN 'undergraduate'
                 WHEN deg = 'PhD' THEN 'research' ELSE 'postgraduate' END AS lvl
  FROM cbase
),
courses AS (
  SELECT sha256(url) AS id, sha256(s_name) AS university_id, p_name AS name, deg AS degree,
         lvl AS level, p_brand AS department,
         CASE WHEN lvl = 'undergraduate' THEN
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(p_partkey % 26 + 1 AS INTEGER), 1)
           || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') END AS ucas_code,
         CASE WHEN p_size > 25 THEN 'full-time,part-time' ELSE 'full-time' END AS study_mode,
         CAST(CAST(p_size AS DOUBLE) / 10 AS DECIMAL(4,1)) AS duration_years,
         strftime(first_seen, '%B') AS start_month,
         CAST(floor(p_retailprice * 10) AS BIGINT) AS fee_uk_yearly,
         CASE WHEN p_type = 'LARGE' THEN CAST(floor(p_retailprice) AS BIGINT) END AS fee_uk_sandwich,
         CAST(floor(p_retailprice * 25) AS BIGINT) AS fee_intl_yearly,
         CASE WHEN p_type = 'LARGE' THEN CAST(floor(p_retailprice) AS BIGINT) END AS fee_intl_sandwich,
         '15 January ' || CAST(year(last_seen) + 1 AS VARCHAR) AS deadline_main,
         CAST(NULL AS VARCHAR) AS deadline_late,
         CAST(5.5 + (p_size % 4) * 0.5 AS DECIMAL(3,1)) AS ielts_score,
         url AS source_url, any_open = 1 AS is_active,
         last_seen AS scraped_at, first_seen AS created_at, last_seen AS updated_at,
         p_type, p_size, p_retailprice, l_partkey, l_suppkey, n_obs
  FROM cbase2
)"""

DETAILS_CTE = """
details AS (
  SELECT sha256('details:' || id) AS id, id AS course_id,
         concat_ws(' ', name, 'is a', degree, 'course taught by', department) AS description,
         'IELTS ' || CAST(ielts_score AS VARCHAR) || ' overall; UCAS code '
           || coalesce(ucas_code, 'n/a') AS entry_requirements,
         CAST(NULL AS VARCHAR) AS modules, CAST(NULL AS VARCHAR) AS career_prospects
  FROM courses WHERE level <> 'research'
)"""

CATALOGUE = "WITH " + UNIS_CTE.strip() + ",\n" + COURSES_CTE.strip().replace("{where}", "")
CATALOGUE_WITH_DETAILS = CATALOGUE + ",\n" + DETAILS_CTE.strip()


def with_catalogue(body: str, details: bool = False, extra: str = "", before: str | None = None) -> str:
    head = CATALOGUE_WITH_DETAILS if details else CATALOGUE
    if before is not None:
        where = f"WHERE l_shipdate < TIMESTAMP '{before}'"
        head = ("WITH " + UNIS_CTE.strip() + ",\n" + COURSES_CTE.strip().replace("{where}", where)
                + ("," + DETAILS_CTE if details else ""))
    if extra:
        head += ",\n" + extra.strip()
    return head + "\n" + body.strip()
