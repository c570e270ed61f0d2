"""Registered extraction queries (E0-E19) and their oracle SQL.

Spark side: rendered course pages -> tokenizer -> selector expressions.
Oracle side: the value each field must have, computed in SQL from the
catalogue columns the page was rendered from (no HTML parsing in SQL), or,
for the driver ``pages`` table, from a regular expression over the HTML.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import selectors as S
from ..functions.fields import parse_degree
from ..functions.text import py_strip
from ..operators import extract as X
from ..operators.html import DD, parsed_pages
from ..sources.rendered import rendered_pages
from ..sources.tables import scan_pages
from .oracle_base import with_catalogue
from .registry import register


def _pages(spark, d):
    # only the columns that a query returns pass through the tokenizer
    return rendered_pages(spark, d).select("url", "html")


def _selected(spark, d, fields=(), title=False, meta=False, lines=False, words=()):
    """Stages 1-2 for the selectors of ``fields`` (with ``title`` or ``meta`` entries, and the nodes that hold ``words``), or for
    the ``lines`` of the page's whole text, and nothing else."""
    parsed = parsed_pages(_pages(spark, d), texts=False, select=X.selected(fields, title, meta), lines=lines, words=words)
    return X.stage_selected(parsed, ["url"], fields)


def _sql_parse_degree(t: str) -> str:
    arms = " ".join(f"WHEN strpos(lower({t}), '{m.lower()}') > 0 THEN '{m.strip()}'"
                    for m in rules.DEGREE_MARKERS)
    return f"CASE {arms} END"


def _sql_any(t: str, words) -> str:
    return "(" + " OR ".join(f"strpos({t}, '{w}') > 0" for w in words) + ")"


# Expected field values of each rendered page, from the catalogue columns.
EXPECTED_CTE = f"""
rendered AS (
  SELECT c.*, c.name || ' | ' || c.degree AS title,
         CASE WHEN c.level <> 'research' THEN concat_ws(' ', c.name, 'is a', c.degree,
              'course taught by', c.department) END AS description,
         CASE WHEN c.level <> 'research' THEN 'IELTS ' || CAST(c.ielts_score AS VARCHAR)
              || ' overall; UCAS code ' || coalesce(c.ucas_code, 'n/a') END AS entry_text
  FROM courses c
),
expected AS (
  SELECT source_url AS url, name,
         CASE WHEN p_type <> 'PROMO' THEN {_sql_parse_degree('degree')}
              ELSE {_sql_parse_degree('title')} END AS degree,
         CASE WHEN {_sql_any("lower(level || ' ' || title)", rules.LEVEL_POSTGRADUATE_WORDS)} THEN 'postgraduate'
              WHEN {_sql_any("lower(level || ' ' || title)", rules.LEVEL_UNDERGRADUATE_WORDS)} THEN 'undergraduate'
              WHEN {_sql_any("lower(level || ' ' || title)", rules.LEVEL_RESEARCH_WORDS)} THEN 'research'
         END AS level,
         department, ucas_code, study_mode,
         CASE WHEN p_size % 3 = 0 THEN round_even(p_size / 12.0, 1)
              ELSE CAST(duration_years AS DOUBLE) END AS duration_years,
         CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS VARCHAR) || ' months'
              ELSE CAST(duration_years AS VARCHAR) || ' years' END AS duration_text,
         start_month, fee_uk_yearly, fee_intl_yearly,
         coalesce(fee_uk_sandwich, fee_uk_yearly) AS fee_uk_sandwich,
         coalesce(fee_intl_sandwich, fee_uk_yearly) AS fee_intl_sandwich,
         deadline_main,
         CASE WHEN p_type = 'SMALL' THEN 'Late applications through clearing until 31 August '
              || CAST(year(scraped_at) AS VARCHAR) END AS deadline_late,
         CAST(ielts_score AS DOUBLE) AS ielts_score,
         description,
         CASE WHEN entry_text IS NOT NULL THEN 'Entry requirements ' || entry_text END
           AS entry_requirements,
         p_type, title
  FROM rendered
)"""


def _expected(body: str) -> str:
    return with_catalogue(body, extra=EXPECTED_CTE)


def _field_query(name: str, cols: list[str], exprs, staged):
    """Register ``name``: (url, cols...) extracted vs expected, from the pages that ``staged`` gives."""
    sql = _expected("SELECT url, " + ", ".join(cols) + " FROM expected")

    @register(name, sql)
    def q(spark, d):
        return staged(spark, d).select("url", *[e.alias(c) for c, e in zip(cols, exprs())])
    return q


def _reads(*fields: str, **more):
    return lambda spark, d: _selected(spark, d, fields, **more)


FEES = ["fee_uk_yearly", "fee_uk_sandwich", "fee_intl_yearly", "fee_intl_sandwich"]
_field_query("extract_name", ["name"], lambda: [X.extract_name()], _reads("name", meta=True))
_field_query("extract_degree", ["degree"], lambda: [X.extract_degree()], _reads("degree", title=True))
_field_query("extract_level", ["level"], lambda: [X.extract_level()], _reads("level", title=True))
_field_query("extract_department", ["department"], lambda: [X.extract_department()], _reads("department"))
_field_query("extract_ucas", ["ucas_code"], lambda: [X.extract_ucas()],
             _reads("ucas_code", meta=True, words=X.WORDS["ucas_code"]))
_field_query("extract_study_mode", ["study_mode"],
             lambda: [F.concat_ws(",", X.extract_study_mode())], _reads("study_mode"))
_field_query("extract_duration", ["duration_years"], lambda: [X.extract_duration()], _reads("duration", meta=True))
_field_query("extract_start_month", ["start_month"], lambda: [X.extract_start_month()], _reads("start_month"))
_field_query("extract_fees", FEES, lambda: [X.extract_fees()[k] for k in FEES], _reads(lines=True))
_field_query("extract_fee", ["fee_uk_yearly"], lambda: [X.extract_fees()["fee_uk_yearly"]], _reads(lines=True))
_field_query("extract_deadlines", ["deadline_main", "deadline_late"],
             lambda: [X.extract_deadline_main(), X.extract_deadline_late()],
             _reads("deadline_main", words=X.WORDS["deadline_late"]))
_field_query("extract_ielts", ["ielts_score"], lambda: [X.extract_ielts()], _reads(words=X.WORDS["ielts_score"]))
_field_query("extract_long_text", ["description", "entry_requirements"],
             lambda: [X.extract_description(), X.extract_entry_requirements()], _reads("description", "entry_requirements"))


@register("dl_lookup", _expected("SELECT url, duration_text FROM expected"))
def q_dl_lookup(spark, d):
    p = parsed_pages(_pages(spark, d), texts=False, select=(DD,))
    return X.dl_selected(p, "Duration", "duration_text").select("url", "duration_text")


@register("parse_degree", _expected(
    "SELECT url, title, " + _sql_parse_degree("title") + " AS degree_label FROM expected"))
def q_parse_degree(spark, d):
    pages = rendered_pages(spark, d)
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return pages.select("url", title.alias("title"), parse_degree(title).alias("degree_label"))


@register("meta_tags", _expected("""
SELECT url, key, value FROM (
  SELECT url, 'og:title' AS key, e.name || ' | ' || u.name AS value
  FROM expected e JOIN courses c ON c.source_url = e.url JOIN unis u ON u.id = c.university_id
  WHERE e.p_type IN ('STANDARD', 'MEDIUM')
  UNION ALL
  SELECT url, 'twitter:title' AS key, name || ' | Share' AS value FROM expected WHERE p_type = 'SMALL'
  UNION ALL
  SELECT url, 'programme:ucas_code' AS key, ucas_code AS value
  FROM expected WHERE p_type = 'ECONOMY' AND ucas_code IS NOT NULL
)"""))
def q_meta_tags(spark, d):
    return (_selected(spark, d, meta=True)
            .select("url", F.explode(S.meta_map("_meta")).alias("key", "value")))


@register("raw_record", _expected("""
SELECT url, name, degree, level, department, ucas_code, study_mode, duration_years,
       start_month, fee_uk_yearly, fee_uk_sandwich, fee_intl_yearly, fee_intl_sandwich,
       deadline_main, deadline_late, ielts_score, description, entry_requirements
FROM expected"""))
def q_raw_record(spark, d):
    raw = X.extract_fields(X.parsed_for_fields(_pages(spark, d)), keep=["url"])
    return raw.withColumn("study_mode", F.concat_ws(",", "study_mode")).drop("parse_error")


# --- on the driver's own pages table ----------------------------------------

_H1_SQL = """
trim(replace(replace(replace(replace(replace(
  regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1),
  '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&#39;', ''''), '&amp;', '&'))"""


@register("first_match_by_priority", f"""
SELECT page_id, {_H1_SQL} AS name FROM pages""")
def q_first_match(spark, d):
    """E0 on raw pages: the name rules (h1 variants) pick the first h1."""
    p = parsed_pages(scan_pages(spark, d))
    return p.select("page_id", S.first_text(rules.SELECTOR_RULES["name"]).alias("name"))


@register("scan_pages", "SELECT page_id, url, length(html) AS html_chars FROM pages")
def q_scan_pages(spark, d):
    return scan_pages(spark, d).select("page_id", "url", F.length("html").alias("html_chars"))


@register("extract_quarantine", """
SELECT page_id, 'UnicodeDecodeError' AS parse_error FROM (
  SELECT page_id, hex(encode(html)) AS h, octet_length(encode(html)) // 2 AS n FROM pages)
WHERE substr(h, 2 * n + 1, 1) IN ('8', '9', 'A', 'B')""")
def q_extract_quarantine(spark, d):
    """Pages the tokenizer could not handle: of the whole pages, and of fetches that broke off
    after half of a page's bytes, where that is inside a character."""
    whole = scan_pages(spark, d)
    raw_bytes = F.col("html").cast("binary")
    half = whole.withColumn("html", F.substring(raw_bytes, F.lit(1), F.floor(F.length(raw_bytes) / 2).cast("int")))
    raw = X.extract_fields(parsed_pages(whole.withColumn("html", raw_bytes).unionByName(half)), keep=["page_id"])
    _ok, bad = X.split_quarantine(raw)
    return bad.select("page_id", F.substring_index("parse_error", ":", 1).alias("parse_error"))


@register("page_titles", f"""
SELECT page_id,
  trim(replace(replace(replace(replace(replace(
    regexp_extract(html, '<title>(.*?)</title>', 1),
    '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&#39;', ''''), '&amp;', '&')) AS title
FROM pages""")
def q_page_titles(spark, d):
    p = X.stage_inputs(parsed_pages(scan_pages(spark, d)), keep=["page_id"])
    return p.select("page_id", py_strip(X.title_text()).alias("title"))
