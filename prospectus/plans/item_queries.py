"""Registered normalisation / validation / gap-filling / dedup / upsert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions.fields import norm_degree, norm_level, norm_study_modes
from ..functions.text import PY_WS, clean_str, to_float, to_int
from ..operators import extract as X
from ..operators import links as L
from ..operators import normalize as N
from ..operators import quality as Q
from ..operators import upsert as U
from ..operators.html import parsed_pages
from ..operators.markdown import markdown_fields
from ..session import handed_over
from ..sources import catalogue as cat
from ..sources.listing import listing_pages
from ..sources.rendered import course_rows, markdown_pages, raw_from_catalogue
from ..sources.tables import read_table, scan_pages
from .link_queries import LISTED_SQL
from .oracle_base import with_catalogue
from .registry import register

SCRAPED_AT = "2024-01-01T00:00:00+00:00"
RUN_TS = "2024-01-01 00:00:00"
CUTOFF = "1998-01-01"

_WS = PY_WS


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _clean(x: str) -> str:
    return f"nullif({_strip(f'regexp_replace({x}, {chr(39)}{_WS}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}, '')"


def _to_int(x: str) -> str:
    d = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9]', '', 'g')"
    return f"CASE WHEN {d} <> '' THEN TRY_CAST({d} AS BIGINT) END"


def _norm_degree(x: str, compat: bool = False) -> str:
    if compat:
        key = f"lower(regexp_replace({x}, '[{_WS[1:-1]}.()Hons]+', '', 'g'))"
        arms = " ".join(f"WHEN strpos({key}, '{k}') > 0 THEN '{v}'" for k, v in rules.DEGREE_NORMALISATION)
    else:
        key = (f"regexp_replace(regexp_replace(lower({x}), '\\bhons\\b', '', 'g'), "
               f"'[{_WS[1:-1]}.()]+', '', 'g')")
        keys = [(k, v) for k, v in rules.DEGREE_NORMALISATION if "." not in k]
        arms = " ".join(f"WHEN {key} = '{k}' THEN '{v}'" for k, v in keys)
        arms += " " + " ".join(f"WHEN strpos({key}, '{k}') > 0 THEN '{v}'"
                               for k, v in sorted(keys, key=lambda kv: -len(kv[0])))
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL {arms} "
            f"ELSE substr({_strip(x)}, 1, {rules.DEGREE_RAW_MAX_CHARS}) END")


def _norm_level(x: str) -> str:
    key = _strip(f"lower({x})")
    arms = " ".join(f"WHEN {key} = '{k}' THEN '{v}'" for k, v in rules.LEVEL_NORMALISATION)
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL {arms} ELSE {key} END"


def _norm_modes(x: str) -> str:
    low = f"lower(coalesce({x}, ''))"
    return (f"coalesce(nullif(concat_ws(',', CASE WHEN strpos({low}, 'full') > 0 THEN 'full-time' END, "
            f"CASE WHEN strpos({low}, 'part') > 0 THEN 'part-time' END, "
            f"CASE WHEN strpos({low}, 'distance') > 0 THEN 'distance-learning' END), ''), 'full-time')")


ROWS_CTE = """
rows AS (
  SELECT c.*, u.name AS university_name, u.location AS university_location,
         CASE WHEN c.level <> 'research' THEN concat_ws(' ', c.name, 'is a', c.degree,
              'course taught by', c.department) END AS description,
         CASE WHEN c.level <> 'research' THEN 'IELTS ' || CAST(c.ielts_score AS VARCHAR)
              || ' overall; UCAS code ' || coalesce(c.ucas_code, 'n/a') END AS entry_requirements
  FROM courses c LEFT JOIN unis u ON c.university_id = u.id
),
raw AS (
  SELECT source_url AS url, university_name, university_location,
         ' ' || name || '  ' AS name,
         CASE WHEN level <> 'research' THEN degree END AS degree,
         CASE level WHEN 'undergraduate' THEN 'UG' WHEN 'postgraduate' THEN 'pg ' ELSE level END AS level,
         department || chr(10) AS department, ucas_code, study_mode,
         CAST(duration_years AS VARCHAR) AS duration_years, start_month,
         CASE WHEN level <> 'research' THEN format('{:,}', fee_uk_yearly) END AS fee_uk_yearly,
         CAST(fee_uk_sandwich AS VARCHAR) AS fee_uk_sandwich,
         CASE WHEN level <> 'research' THEN format('{:,}', fee_intl_yearly) END AS fee_intl_yearly,
         CAST(fee_intl_sandwich AS VARCHAR) AS fee_intl_sandwich,
         deadline_main, deadline_late, CAST(ielts_score AS VARCHAR) AS ielts_score,
         CASE WHEN level <> 'research' THEN description END AS description,
         CASE WHEN level <> 'research' THEN entry_requirements END AS entry_requirements,
         degree AS true_degree, fee_uk_yearly AS true_fee_uk, fee_intl_yearly AS true_fee_intl,
         level AS true_level
  FROM rows
)"""

ITEMS_CTE = ROWS_CTE + f""",
items AS (
  SELECT url, university_name, university_location,
         {_clean('name')} AS name, {_norm_degree('degree')} AS degree, {_norm_level('level')} AS level,
         {_clean('department')} AS department, {_norm_modes('study_mode')} AS study_mode,
         TRY_CAST(duration_years AS DOUBLE) AS duration_years, {_clean('start_month')} AS start_month,
         {_to_int('fee_uk_yearly')} AS fee_uk_yearly, {_to_int('fee_uk_sandwich')} AS fee_uk_sandwich,
         {_to_int('fee_intl_yearly')} AS fee_intl_yearly,
         {_to_int('fee_intl_sandwich')} AS fee_intl_sandwich,
         {_clean('ucas_code')} AS ucas_code, {_clean('deadline_main')} AS deadline_main,
         {_clean('deadline_late')} AS deadline_late, {_clean('entry_requirements')} AS entry_requirements,
         TRY_CAST(ielts_score AS DOUBLE) AS ielts_score, '{SCRAPED_AT}' AS scraped_at,
         ((CASE WHEN name IS NULL OR name = '' THEN 1 ELSE 0 END)
          + (CASE WHEN degree IS NULL OR degree = '' THEN 1 ELSE 0 END)
          + (CASE WHEN fee_uk_yearly IS NULL OR fee_uk_yearly = '' THEN 1 ELSE 0 END)
          + (CASE WHEN fee_intl_yearly IS NULL OR fee_intl_yearly = '' THEN 1 ELSE 0 END)
          + (CASE WHEN entry_requirements IS NULL OR entry_requirements = '' THEN 1 ELSE 0 END)
          + (CASE WHEN description IS NULL OR description = '' THEN 1 ELSE 0 END))
           >= {rules.FALLBACK_THRESHOLD} AS needs_fallback,
         true_degree, true_fee_uk, true_fee_intl, true_level
  FROM raw
)"""

ITEM_COLS = ["url", "university_name", "university_location", "name", "degree", "level",
             "department", "study_mode", "duration_years", "start_month", "fee_uk_yearly",
             "fee_uk_sandwich", "fee_intl_yearly", "fee_intl_sandwich", "ucas_code",
             "deadline_main", "deadline_late", "entry_requirements", "ielts_score", "scraped_at"]


def _items(spark, d, rows=None):
    raw = raw_from_catalogue(spark, d, rows)
    return N.normalise(raw, scraped_at=SCRAPED_AT, keep=["url"])


def _flat(items):
    return N.flatten_item(items, keep=["url"]).drop("source_url")


# --- N1-N6: scalar rules ------------------------------------------------------

@register("clean_string", f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents")
def q_clean_string(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", clean_str(F.col("text")).alias("cleaned"))


@register("to_int", f"""
SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS price_text,
       {_to_int('CAST(p_retailprice AS VARCHAR)')} AS price_digits,
       {_to_int('p_name')} AS name_digits
FROM part""")
def q_to_int(spark, d):
    p = read_table(spark, d, "part")
    txt = F.col("p_retailprice").cast("string")
    return p.select("p_partkey", txt.alias("price_text"), to_int(txt).alias("price_digits"),
                    to_int(F.col("p_name")).alias("name_digits"))


@register("to_float", """
SELECT p_partkey, TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE) AS size_float,
       TRY_CAST(p_name AS DOUBLE) AS name_float
FROM part""")
def q_to_float(spark, d):
    p = read_table(spark, d, "part")
    return p.select("p_partkey", to_float(F.col("p_size").cast("string")).alias("size_float"),
                    to_float(F.col("p_name")).alias("name_float"))


@register("normalise_degree", with_catalogue(f"""
SELECT id, degree AS raw_degree, {_norm_degree('degree')} AS degree,
       {_norm_degree('degree', True)} AS degree_compat,
       {_norm_degree('lower(degree)')} AS lower_degree
FROM courses"""))
def q_normalise_degree(spark, d):
    c = cat.courses(spark, d)
    return c.select("id", F.col("degree").alias("raw_degree"),
                    norm_degree(F.col("degree")).alias("degree"),
                    norm_degree(F.col("degree"), compat=True).alias("degree_compat"),
                    norm_degree(F.lower("degree")).alias("lower_degree"))


@register("normalise_level", with_catalogue(f"""
SELECT id, {_norm_level('level')} AS level, {_norm_level('upper(p_type)')} AS type_level,
       {_norm_level("CASE level WHEN 'undergraduate' THEN ' UG' WHEN 'postgraduate' THEN 'Pg' ELSE 'Doctoral' END")}
         AS abbrev_level
FROM courses"""))
def q_normalise_level(spark, d):
    c = cat.courses(spark, d, with_part=True)
    ab = (F.when(F.col("level") == "undergraduate", F.lit(" UG"))
          .when(F.col("level") == "postgraduate", F.lit("Pg")).otherwise(F.lit("Doctoral")))
    return c.select("id", norm_level(F.col("level")).alias("level"),
                    norm_level(F.upper("p_type")).alias("type_level"),
                    norm_level(ab).alias("abbrev_level"))


@register("normalise_study_mode", with_catalogue(f"""
SELECT id, {_norm_modes('study_mode')} AS study_mode FROM courses"""))
def q_normalise_study_mode(spark, d):
    c = cat.courses(spark, d)
    return c.select("id", F.concat_ws(",", norm_study_modes(F.col("study_mode"))).alias("study_mode"))


# --- N7-N9: items ---------------------------------------------------------------

@register("build_item", with_catalogue("SELECT " + ", ".join(ITEM_COLS) + " FROM items",
                                       extra=ITEMS_CTE))
def q_build_item(spark, d):
    return _flat(_items(spark, d))


@register("needs_fallback", with_catalogue("SELECT url, needs_fallback FROM items", extra=ITEMS_CTE))
def q_needs_fallback(spark, d):
    return _items(spark, d).select("url", "needs_fallback")


@register("item_to_json", with_catalogue(
    "SELECT url, json_extract_string(item_json, '$.course.name') AS name, "
    "json_extract(item_json, '$.fees.uk.yearly')::BIGINT AS fee_uk_yearly, "
    "json_extract_string(item_json, '$.fees.uk.currency') AS currency, "
    "json_type(item_json, '$.admission.ucas_code') AS ucas_json_type "
    "FROM (SELECT url, json_object('course', json_object('name', name), 'fees', json_object('uk', "
    "json_object('yearly', fee_uk_yearly, 'currency', 'GBP')), 'admission', "
    "json_object('ucas_code', ucas_code)) AS item_json FROM items)", extra=ITEMS_CTE))
def q_item_to_json(spark, d):
    """The item serialised with nulls kept; checked by reading fields back."""
    items = _items(spark, d)
    js = items.select("url", N.item_to_json(items).alias("j"))
    return js.select("url", F.get_json_object("j", "$.course.name").alias("name"),
                     F.get_json_object("j", "$.fees.uk.yearly").cast("bigint").alias("fee_uk_yearly"),
                     F.get_json_object("j", "$.fees.uk.currency").alias("currency"),
                     F.when(F.col("j").contains('"ucas_code":null'), F.lit("NULL"))
                      .otherwise(F.lit("VARCHAR")).alias("ucas_json_type"))


@register("flatten_item", with_catalogue(
    "SELECT url, name, degree, fee_uk_yearly, fee_intl_sandwich, study_mode, ielts_score FROM items",
    extra=ITEMS_CTE))
def q_flatten_item(spark, d):
    return _flat(_items(spark, d)).select("url", "name", "degree", "fee_uk_yearly",
                                          "fee_intl_sandwich", "study_mode", "ielts_score")


# --- M1-M3: markdown fields -----------------------------------------------------

MD_EXPECTED = ROWS_CTE + """,
md AS (
  SELECT source_url AS url, name,
         CASE WHEN regexp_matches(degree, '\\b(BSc|MSc|BA|BEng|MEng|MBA|PhD|MRes|MPhil)\\b')
              THEN regexp_extract(degree, '\\b(BSc|MSc|BA|BEng|MEng|MBA|PhD|MRes|MPhil)\\b', 1) END AS degree,
         department, CAST(duration_years AS DOUBLE) AS duration_years, start_month,
         fee_uk_yearly, fee_intl_yearly, ucas_code, CAST(ielts_score AS DOUBLE) AS ielts_score,
         CASE WHEN entry_requirements IS NOT NULL THEN
           rtrim(substr(entry_requirements || '. ' || description
             || '. Applicants are assessed on their full academic record.', 1, 1500)) END AS entry_requirements
  FROM rows
)"""


@register("markdown_fields", with_catalogue(
    "SELECT url, name, degree, department, duration_years, start_month, fee_uk_yearly, "
    "fee_intl_yearly, ucas_code, ielts_score, entry_requirements FROM md", extra=MD_EXPECTED))
def q_markdown_fields(spark, d):
    return markdown_fields(markdown_pages(spark, d), keep=["url"]).select(
        "url", "name", "degree", "department", "duration_years", "start_month", "fee_uk_yearly",
        "fee_intl_yearly", "ucas_code", "ielts_score", "entry_requirements")


# --- V1-V6: validation on the driver pages ---------------------------------------

_H1 = """trim(replace(replace(replace(replace(replace(
  regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1),
  '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&#39;', ''''), '&amp;', '&'))"""


def _sql_reason(name: str, url: str) -> str:
    n, u = f"coalesce({name}, '')", f"coalesce({url}, '')"
    toks = " OR ".join(f"strpos(lower({u}), '{t}') > 0" for t in rules.BLOCKED_URL_TOKENS)
    names = ", ".join(f"'{x}'" for x in rules.BLOCKED_NAMES)
    return (f"CASE WHEN {n} = '' THEN 'missing_name' "
            f"WHEN {u} = '' OR NOT starts_with({u}, 'http') THEN 'invalid_url' "
            f"WHEN length({n}) < {rules.MIN_NAME_LENGTH} THEN 'name_too_short' "
            f"WHEN lower({n}) IN ({names}) OR {toks} THEN 'non_course' END")


def _candidates(spark, d):
    """(page_id, name, url): each page by its heading, and each anchor of each listing page by its text."""
    p = X.stage_inputs(parsed_pages(scan_pages(spark, d)), keep=["page_id", "url"])
    pages = p.select(F.col("page_id").cast("string").alias("page_id"), F.col("_txt_name").alias("name"), "url")
    anchors = L.anchor_rows(parsed_pages(listing_pages(spark, d), fields=("tag", "attrs", "t0", "t1"), hits=False))
    return pages.unionByName(anchors.select(
        "page_id", F.nullif(F.col("text"), F.lit("")).alias("name"), L.url_join("url", "href").alias("url")))


_CANDIDATES = LISTED_SQL + f""",
candidates AS (
  SELECT CAST(page_id AS VARCHAR) AS page_id, nullif({_H1}, '') AS name, url FROM pages
  UNION ALL SELECT page_id, nullif(txt, ''), abs_url FROM resolved
)"""


@register("validate_items", _CANDIDATES + f"""
SELECT page_id, name, url, {_sql_reason('name', 'url')} AS drop_reason FROM candidates""")
def q_validate_items(spark, d):
    return Q.validate(_candidates(spark, d), name="name", url="url")


@register("validation_summary", _CANDIDATES + f"""
SELECT coalesce({_sql_reason('name', 'url')}, 'accepted') AS reason, count(*) AS n FROM candidates GROUP BY 1""")
def q_validation_summary(spark, d):
    return Q.validation_summary(Q.validate(_candidates(spark, d), name="name", url="url"))


# --- F1-F2: gap filling ------------------------------------------------------------

def _flagged_markdown(spark, d, rows, items):
    """The markdown views of flagged items alone: the narrow rows meet the gate, not the rendered documents."""
    return markdown_pages(spark, d, Q.flagged_only(rows.withColumn("url", F.col("source_url")), items))


@register("fill_gaps", with_catalogue("""
SELECT url, name,
       CASE WHEN needs_fallback THEN coalesce(degree, CASE WHEN true_level = 'research' THEN 'PhD' END)
            ELSE degree END AS degree,
       CASE WHEN needs_fallback THEN coalesce(fee_uk_yearly, true_fee_uk) ELSE fee_uk_yearly END AS fee_uk_yearly,
       CASE WHEN needs_fallback THEN coalesce(fee_intl_yearly, true_fee_intl) ELSE fee_intl_yearly END
         AS fee_intl_yearly,
       ucas_code, entry_requirements, ielts_score
FROM items""", extra=ITEMS_CTE))
def q_fill_gaps(spark, d):
    # items and fillers come from the same course rows: one catalogue computation
    unread = ("id", "university_id", "is_active", "created_at", "updated_at", "p_type", "p_size")
    rows = handed_over(course_rows(spark, d).drop(*unread), "rows")
    items = _items(spark, d, rows)
    fillers = markdown_fields(_flagged_markdown(spark, d, rows, items), keep=["url"])
    filled = Q.fill_gaps(items, fillers)
    return filled.select("url", F.col("course.name").alias("name"),
                         F.col("course.degree").alias("degree"),
                         F.col("fees.uk.yearly").alias("fee_uk_yearly"),
                         F.col("fees.international.yearly").alias("fee_intl_yearly"),
                         F.col("admission.ucas_code").alias("ucas_code"),
                         F.col("admission.entry_requirements").alias("entry_requirements"),
                         F.col("admission.english_requirement.ielts").alias("ielts_score"))


# --- D1-D2: first-wins dedup over page observations --------------------------------

_OBS_URL = ("'https://www.university-' || CAST(l_suppkey AS VARCHAR) || '.example.ac.uk/courses/' "
            "|| CAST(l_partkey AS VARCHAR)")


def _observations(spark, d):
    obs = cat.course_observations(spark, d)
    return obs.select(cat.course_url(F.col("l_partkey"), F.col("l_suppkey")).alias("url"),
                      "l_orderkey", "l_linenumber", "l_shipdate",
                      F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("seq"))


@register("dedup_first_by_url", f"""
SELECT url, l_orderkey, l_linenumber, l_shipdate FROM (
  SELECT {_OBS_URL} AS url, l_orderkey, l_linenumber, l_shipdate,
         row_number() OVER (PARTITION BY l_partkey, l_suppkey
                            ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_first(spark, d):
    return Q.dedup_first(_observations(spark, d), "url", "seq").drop("seq")


@register("dedup_summary", f"SELECT count(DISTINCT {_OBS_URL}) AS total_unique_urls FROM lineitem")
def q_dedup_summary(spark, d):
    return Q.dedup_summary(_observations(spark, d), "url")


# --- U1-U7: upserts of later observations into the earlier catalogue ----------------

def _later_items(spark, d):
    """Observations on/after the cutoff as items (fee = unit price after discount)."""
    obs = cat.course_observations(spark, d).filter(
        F.col("l_shipdate") >= F.lit(CUTOFF).cast("timestamp_ntz"))
    part = read_table(spark, d, "part").select("p_partkey", "p_name")
    unis = cat.universities(spark, d).select("supplier_key", F.col("name").alias("uni_name"),
                                             F.col("location").alias("uni_location"))
    j = (obs.join(part, obs.l_partkey == part.p_partkey, "inner")
         .join(unis, obs.l_suppkey == unis.supplier_key, "left"))
    raw = j.select(
        cat.course_url(F.col("l_partkey"), F.col("l_suppkey")).alias("url"),
        "uni_name", F.concat(F.col("uni_location"), F.lit(" ("),
                             F.year("l_shipdate").cast("string"), F.lit(")")).alias("uni_location"),
        F.col("p_name").alias("name"),
        F.lit(None).cast("string").alias("degree"), F.lit(None).cast("string").alias("level"),
        F.lit(None).cast("string").alias("department"), F.lit(None).cast("string").alias("ucas_code"),
        F.lit("full-time").alias("study_mode"), F.lit(None).cast("string").alias("duration_years"),
        F.lit(None).cast("string").alias("start_month"),
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity") * 10)
         .cast("bigint").alias("fee_uk_yearly"),
        F.lit(None).cast("bigint").alias("fee_uk_sandwich"),
        F.lit(None).cast("bigint").alias("fee_intl_yearly"),
        F.lit(None).cast("bigint").alias("fee_intl_sandwich"),
        F.lit(None).cast("string").alias("deadline_main"), F.lit(None).cast("string").alias("deadline_late"),
        F.lit(None).cast("string").alias("ielts_score"),
        F.concat(F.col("p_name"), F.lit(" (order "), F.col("l_orderkey").cast("string"), F.lit(")"))
         .alias("description"),
        F.lit(None).cast("string").alias("entry_requirements"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("seq"))
    return N.normalise(raw, university_name="uni_name", university_location="uni_location",
                       scraped_at=SCRAPED_AT, keep=["seq"])


_LATER_SQL = f"""
later AS (
  SELECT {_OBS_URL} AS url, s.s_name AS uni_name,
         n.n_name || ' (' || CAST(year(l_shipdate) AS VARCHAR) || ')' AS uni_location,
         p.p_name AS name,
         CAST(floor(l_extendedprice * (1 - l_discount) / l_quantity * 10) AS BIGINT) AS fee_uk_yearly,
         p.p_name || ' (order ' || CAST(l_orderkey AS VARCHAR) || ')' AS description,
         l_shipdate, l_orderkey, l_linenumber
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE l_shipdate >= TIMESTAMP '{CUTOFF}'
),
last_in AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY l_shipdate DESC,
                 l_orderkey DESC, l_linenumber DESC) AS rn FROM later) WHERE rn = 1
)"""


#: what a later observation lacks becomes null in the stored row
_LOST = ("degree", "level", "department", "ucas_code", "duration_years", "start_month", "fee_uk_sandwich",
         "fee_intl_yearly", "fee_intl_sandwich", "deadline_main", "deadline_late", "ielts_score")
_UPSERTED = [c for c in U.COURSE_COLUMNS if c != "raw_json"]


def upserted_columns(courses):
    """Every column of the courses; of the stored item its name and url."""
    stored = lambda path: F.get_json_object("raw_json", path)
    return courses.select(*_UPSERTED, stored("$.course.name").alias("raw_name"), stored("$.metadata.url").alias("raw_url"))


@register("upsert_courses", with_catalogue(f"""
SELECT coalesce(b.id, sha256(i.url)) AS id, coalesce(b.source_url, i.url) AS source_url,
       coalesce(b.university_id, sha256(i.uni_name)) AS university_id,
       CASE WHEN i.url IS NOT NULL THEN i.name ELSE b.name END AS name,
       CASE WHEN i.url IS NOT NULL THEN i.fee_uk_yearly ELSE b.fee_uk_yearly END AS fee_uk_yearly,
       CASE WHEN i.url IS NOT NULL THEN 'full-time' ELSE b.study_mode END AS study_mode,
       {', '.join(f'CASE WHEN i.url IS NULL THEN b.{c} END AS {c}' for c in _LOST)},
       coalesce(b.is_active, true) AS is_active,
       coalesce(b.created_at, TIMESTAMP '{RUN_TS}') AS created_at,
       CASE WHEN i.url IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE b.updated_at END AS updated_at,
       CASE WHEN i.url IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE b.scraped_at END AS scraped_at,
       i.name AS raw_name, i.url AS raw_url
FROM courses b FULL OUTER JOIN last_in i ON b.source_url = i.url""",
    extra=_LATER_SQL, before=CUTOFF))
def q_upsert_courses(spark, d):
    base = cat.courses(spark, d, before=CUTOFF)
    rows = U.course_rows_from_items(U.latest_items(_later_items(spark, d)), seq="seq", run_ts=RUN_TS)
    return upserted_columns(U.merge_courses(base, rows))


@register("upsert_universities", with_catalogue(f"""
SELECT coalesce(b.id, sha256(i.uni_name)) AS id, coalesce(b.name, i.uni_name) AS name,
       CASE WHEN i.uni_name IS NOT NULL THEN i.uni_location ELSE b.location END AS location
FROM unis b FULL OUTER JOIN (
  SELECT uni_name, uni_location FROM (
    SELECT coalesce(uni_name, 'Unknown') AS uni_name, uni_location,
           row_number() OVER (PARTITION BY coalesce(uni_name, 'Unknown')
                              ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
    FROM later) WHERE rn = 1) i ON b.name = i.uni_name""", extra=_LATER_SQL))
def q_upsert_universities(spark, d):
    base = cat.universities(spark, d).drop("supplier_key")
    out = U.upsert_universities(base, _later_items(spark, d), seq="seq", run_ts=RUN_TS)
    return out.select("id", "name", "location")


@register("upsert_details", with_catalogue(f"""
SELECT coalesce(b.course_id, sha256(i.url)) AS course_id,
       CASE WHEN i.url IS NOT NULL THEN i.description ELSE b.description END AS description,
       CASE WHEN i.url IS NOT NULL THEN NULL ELSE b.entry_requirements END AS entry_requirements
FROM details b FULL OUTER JOIN last_in i ON b.course_id = sha256(i.url)""",
    details=True, extra=_LATER_SQL, before=CUTOFF))
def q_upsert_details(spark, d):
    base_c = cat.courses(spark, d, before=CUTOFF)
    base = cat.course_details(spark, d, base_c)
    rows = U.detail_rows_from_items(_later_items(spark, d), seq="seq")
    return U.upsert_details(base, rows).select("course_id", "description", "entry_requirements")


# a course seen once has a page without a name; its row is an error, not a save
@register("run_counters", with_catalogue("""
SELECT count(*) FILTER (WHERE n_obs > 1) AS saved, count(*) FILTER (WHERE n_obs = 1) AS errors
FROM facts JOIN part ON l_partkey = p_partkey"""))
def q_run_counters(spark, d):
    part = read_table(spark, d, "part").select("p_partkey", "p_name")
    rows = (cat.course_facts(spark, d).join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.when(F.col("n_obs") > 1, F.col("p_name")).otherwise(F.lit("  ")).alias("name")))
    return U.run_counters(rows, F.coalesce(clean_str(F.col("name")) != "", F.lit(False)))


@register("evolve_schema", with_catalogue("""
SELECT id, source_url, updated_at, CAST(NULL AS VARCHAR) AS raw_json FROM courses"""))
def q_evolve_schema(spark, d):
    """A table without ``raw_json`` gains it as nulls; ``updated_at``, which it has, keeps its values."""
    old = cat.courses(spark, d).select("id", "source_url", "updated_at")
    return U.evolve_schema(old, {"raw_json": "string", "updated_at": "timestamp_ntz"})


# --- P1: pages -> catalogue ------------------------------------------------------

# Pages of the chain beside each course's own: before it, pages whose names are no course's (by
# p_size), and after it, pages of the SMALL courses under another department (duplicates).  Pages
# of research courses are without degree, fees and texts (flagged for filling).
NO_COURSE_NAMES = {49: "Events", 50: "Go"}
_BARE = ("degree", "fee_uk_yearly", "fee_intl_yearly", "fee_uk_sandwich", "fee_intl_sandwich")
GONE = "/retired"
_COURSE_VALUES = {"name": "string", "degree": "string", "level": "string", "department": "string", "ucas_code": "string",
                  "study_mode": "string", "duration_years": "decimal(4,1)", "start_month": "string",
                  "fee_uk_yearly": "bigint", "fee_uk_sandwich": "bigint", "fee_intl_yearly": "bigint",
                  "fee_intl_sandwich": "bigint", "deadline_main": "string", "deadline_late": "string",
                  "ielts_score": "decimal(3,1)"}


def _chain_pages(spark, d):
    from ..sources.rendered import page_columns
    rows = course_rows(spark, d)
    taught = F.col("level") != "research"
    shown = rows.withColumns({c: F.when(taught, F.col(c)) for c in _BARE})
    other = F.lit(None).cast("string")
    for size, name in NO_COURSE_NAMES.items():
        other = F.when(F.col("p_size") == size, F.lit(name)).otherwise(other)
    page = lambda seq, name, department: F.struct(
        F.lit(seq).alias("seq"), name.alias("name"), department.alias("department"))
    pages = F.array_compact(F.array(
        F.when(other.isNotNull(), page(0, other, F.col("department"))),
        page(1, F.col("name"), F.col("department")),
        F.when(F.col("p_type") == "SMALL", page(2, F.col("name"), F.lit("Moved")))))
    each = shown.withColumn("_page", F.explode(pages)).withColumns(
        {c: F.col("_page")[c] for c in ("seq", "name", "department")})
    return each.hint("rebalance").select(*page_columns(), "seq"), rows


def _stored(spark, d):
    """The three tables before the run: solvent universities and the courses seen before the
    cutoff, under ids that are not the keys' hashes, some also under a url that no page has any more."""
    old = lambda c: F.concat(F.lit("old-"), F.substring(c, 1, 16))
    unis = cat.universities(spark, d, solvent=True).drop("supplier_key").withColumn("id", old(F.col("id")))
    url = F.col("source_url")
    urls = F.when(F.col("p_size").isin(*NO_COURSE_NAMES), F.array(url, F.concat(url, F.lit(GONE)))).otherwise(F.array(url))
    courses = (cat.courses(spark, d, with_part=True, before=CUTOFF).withColumn("source_url", F.explode(urls))
               .drop("p_type", "p_size").withColumn("raw_json", F.lit(None).cast("string"))
               .withColumns({"id": old(F.sha2(F.col("source_url"), 256)), "university_id": old(F.col("university_id"))}))
    return unis, courses, cat.course_details(spark, d, courses)


def _chain_sql() -> str:
    from .extract_queries import EXPECTED_CTE
    sizes = ", ".join(str(s) for s in NO_COURSE_NAMES)
    old = "'old-' || substr({}, 1, 16)"
    values = ", ".join(_COURSE_VALUES)
    none = ", ".join(["NULL"] * len(_COURSE_VALUES))
    entry = "'IELTS ' || CAST(ielts_score AS VARCHAR) || ' overall; UCAS code ' || coalesce(ucas_code, 'n/a')"
    return with_catalogue(f"""
SELECT 'courses' AS tbl, cid AS id, url AS key, uid AS parent_id, {values}, coalesce(b_active, true) AS is_active,
       coalesce(b_created, TIMESTAMP '{RUN_TS}') AS created_at, CAST(NULL AS VARCHAR) AS txt,
       CAST(NULL AS VARCHAR) AS entry_requirements
FROM merged
UNION ALL
SELECT 'courses', cid, url, uid, {values}, b_active, b_created, NULL, NULL FROM gone
UNION ALL
SELECT 'items', sha256(url), url, university_id, {values}, NULL, NULL, e_description, e_entry FROM merged
UNION ALL
SELECT 'universities', coalesce(b_uid, sha256(u.name)), u.name, NULL, u.name, {none[6:]}, NULL,
       CASE WHEN b_uid IS NULL THEN TIMESTAMP '{RUN_TS}' ELSE u.created_at END, u.location, NULL
FROM unis u LEFT JOIN base_u ON base_u.uname = u.name
WHERE b_uid IS NOT NULL OR u.id IN (SELECT university_id FROM merged)
UNION ALL
SELECT 'details', sha256('details:' || cid), cid, NULL, {none}, NULL, NULL, e_entry, e_entry
FROM merged WHERE e_entry IS NOT NULL
UNION ALL
SELECT 'details', sha256('details:' || cid), cid, NULL, {none}, NULL, NULL,
       concat_ws(' ', name, 'is a', degree, 'course taught by', department), {entry}
FROM gone WHERE level <> 'research'""", extra=EXPECTED_CTE + f""",
base_u AS (SELECT u.name AS uname, {old.format('u.id')} AS b_uid
           FROM unis u JOIN supplier s ON s.s_suppkey = u.supplier_key WHERE s.s_acctbal >= 0),
base_f AS (SELECT l_partkey AS b_part, l_suppkey AS b_supp, min(l_shipdate) AS b_created, max(l_shipdate) AS b_last,
                  max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) = 1 AS b_active
           FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUTOFF}' GROUP BY 1, 2),
merged AS (
  SELECT e.url, c.university_id, {_clean('e.name')} AS name, {_norm_degree('e.degree')} AS degree,
         {_norm_level('e.level')} AS level, {_clean('e.department')} AS department, {_clean('e.ucas_code')} AS ucas_code,
         e.study_mode, CAST(e.duration_years AS DECIMAL(4,1)) AS duration_years, {_clean('e.start_month')} AS start_month,
         e.fee_uk_yearly, CASE WHEN c.level <> 'research' THEN e.fee_uk_sandwich END AS fee_uk_sandwich,
         e.fee_intl_yearly, CASE WHEN c.level <> 'research' THEN e.fee_intl_sandwich END AS fee_intl_sandwich,
         {_clean('e.deadline_main')} AS deadline_main, {_clean('e.deadline_late')} AS deadline_late,
         CAST(e.ielts_score AS DECIMAL(3,1)) AS ielts_score,
         e.description AS e_description, {_clean('e.entry_requirements')} AS e_entry, b_active, b_created,
         CASE WHEN b_part IS NOT NULL THEN {old.format('c.id')} ELSE sha256(e.url) END AS cid,
         CASE WHEN b_part IS NOT NULL THEN {old.format('c.university_id')}
              ELSE coalesce(b_uid, c.university_id) END AS uid
  FROM courses c JOIN expected e ON e.url = c.source_url
  JOIN unis u ON u.id = c.university_id LEFT JOIN base_u ON base_u.uname = u.name
  LEFT JOIN base_f ON b_part = c.l_partkey AND b_supp = c.l_suppkey
),
gone AS (
  SELECT c.* REPLACE (strftime(b_created, '%B') AS start_month,
                      '15 January ' || CAST(year(b_last) + 1 AS VARCHAR) AS deadline_main),
         b_active, b_created, c.source_url || '{GONE}' AS url, {old.format(f"sha256(c.source_url || '{GONE}')")} AS cid,
         {old.format('c.university_id')} AS uid
  FROM courses c JOIN base_f ON b_part = c.l_partkey AND b_supp = c.l_suppkey WHERE c.p_size IN ({sizes})
)""")


@register("pages_to_catalogue", _chain_sql())
def q_pages_to_catalogue(spark, d):
    """The pages of every course through the whole chain: the accepted items with the texts of
    their pages, and the three stored tables."""
    from .pipeline import accepted_items, pages_to_items, upsert_tables
    pages, rows = _chain_pages(spark, d)
    items, _bad = pages_to_items(pages, SCRAPED_AT)
    fillers = markdown_fields(_flagged_markdown(spark, d, rows, items), keep=["url"])
    accepted, _rejects = accepted_items(items, fillers, keep_temp=["raw_description"])
    accepted = handed_over(accepted, "items")
    unis, courses, details = upsert_tables(accepted.drop("raw_description"), *_stored(spark, d), RUN_TS)
    flat = N.flatten_item(accepted, keep=["raw_description"]).withColumns(
        {"id": F.sha2("source_url", 256), "university_id": F.sha2("university_name", 256)})
    null = lambda t: F.lit(None).cast(t)
    empty = {"parent_id": "string", **_COURSE_VALUES, "is_active": "boolean", "created_at": "timestamp_ntz",
             "txt": "string", "entry_requirements": "string"}

    def table(tbl, df, key, **cols):
        return df.select(F.lit(tbl).alias("tbl"), "id", F.col(key).alias("key"),
                         *[(F.col(cols[c]) if c in cols else null(t)).try_cast(t).alias(c) for c, t in empty.items()])

    values = {c: c for c in _COURSE_VALUES}
    return (table("courses", courses, "source_url", parent_id="university_id", is_active="is_active",
                  created_at="created_at", **values)
            .unionByName(table("items", flat, "source_url", parent_id="university_id", txt="raw_description",
                               entry_requirements="entry_requirements", **values))
            .unionByName(table("universities", unis, "name", name="name", created_at="created_at", txt="location"))
            .unionByName(table("details", details, "course_id", txt="description",
                               entry_requirements="entry_requirements")))
