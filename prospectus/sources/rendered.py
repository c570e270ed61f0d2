"""Course pages rendered from the catalogue, as a page source for extraction.

The input ``pages`` table has no course fields (no fees, UCAS codes, ...), so
the field extractors are exercised on pages rendered from catalogue columns:
the extracted values can then be checked against the columns they came from.
Page layout varies with ``p_type`` so that each selector / fallback path of
the extractors is used by some pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalogue as cat


def course_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses with the university and part attributes the renderer uses."""
    c = cat.courses(spark, sf_dir, with_part=True, with_university=True)
    university = ["university_name", "university_location"]
    return c.select(*[x for x in c.columns if x not in university], *cat.detail_text_columns(), *university)


def _p(cls: str | None, body) -> F.Column:
    open_tag = f'<p class="{cls}">' if cls else "<p>"
    return F.concat(F.lit(open_tag), body, F.lit("</p>"))


def render_html(r=F.col) -> F.Column:
    """HTML of one course page from the ``course_rows`` columns."""
    name, degree = r("name"), r("degree")
    ptype = r("p_type")
    # a course whose page lists no degree has a bare title
    title = F.concat_ws(" | ", F.when(degree.isNotNull(), name).otherwise(F.lit("Course")), degree)
    og = F.when(ptype.isin("STANDARD", "MEDIUM"), F.concat(
        F.lit('<meta property="og:title" content="'), name, F.lit(" | "),
        r("university_name"), F.lit('">')))
    # a key that stands twice (the later one counts), and pages with the other title key only
    old = F.when(ptype == "MEDIUM", F.lit('<meta property="og:title" content="Before | it moved">'))
    twitter = F.when(ptype == "SMALL", F.concat(F.lit('<meta name="twitter:title" content="'), name, F.lit(' | Share">')))
    ucas_meta = F.when((ptype == "ECONOMY") & r("ucas_code").isNotNull(), F.concat(
        F.lit('<meta name="programme:ucas_code" content="'), r("ucas_code"), F.lit('">')))
    course_type = F.when(ptype != "PROMO", F.concat(
        F.lit('<span class="course-type">'), degree, F.lit("</span>")))
    ucas_dl = F.when((ptype != "LARGE") & r("ucas_code").isNotNull(), F.concat(
        F.lit("<dt>UCAS code</dt><dd>"), r("ucas_code"), F.lit("</dd>")))
    ucas_para = F.when((ptype == "LARGE") & r("ucas_code").isNotNull(), F.concat(
        F.lit("<p>Apply through UCAS with code <b>"), r("ucas_code"), F.lit("</b></p>")))
    duration = F.when(r("p_size") % 3 == 0, F.concat(r("p_size").cast("string"), F.lit(" months")))\
        .otherwise(F.concat(r("duration_years").cast("string"), F.lit(" years")))
    fee = lambda c: F.format_number(c, 0)  # noqa: E731  9,001
    sandwich = F.when(r("fee_uk_sandwich").isNotNull(),
                      _p(None, F.concat(F.lit("Sandwich year: £"), fee(r("fee_uk_sandwich")))))
    late = F.when(ptype == "SMALL", _p(None, F.concat(
        F.lit("Late applications through clearing until 31 August "),
        F.year(r("scraped_at")).cast("string"))))
    descr = F.when(r("description").isNotNull(), F.concat(
        F.lit('<div class="course-description">'), r("description"), F.lit("</div>")))
    entry = F.when(r("entry_requirements").isNotNull(), F.concat(
        F.lit("<section><h2>Entry requirements</h2><p>"), r("entry_requirements"),
        F.lit("</p></section>")))
    pieces = [
        F.lit("<!DOCTYPE html><html><head><title>"), title, F.lit("</title>"), old, og, twitter, ucas_meta,
        F.lit('</head><body><div class="programme-header"><h1 class="course-title">'), name,
        F.lit("</h1></div>"), course_type,
        F.concat(F.lit('<div class="study-level">'), r("level"), F.lit("</div>")),
        F.concat(F.lit('<div class="department">'), r("department"), F.lit("</div>")),
        F.lit('<dl class="key-facts">'), ucas_dl,
        F.lit("<dt>Duration</dt><dd>"), duration, F.lit("</dd></dl>"), ucas_para,
        _p("study-mode", F.concat(F.lit("Study mode: "),
                                  F.regexp_replace(r("study_mode"), ",", ", "))),
        _p("start-date", F.concat(F.lit("Starts "), r("start_month"), F.lit(" "),
                                  F.year(r("created_at")).cast("string"))),
        _p(None, F.concat(F.lit("UK students: £"), fee(r("fee_uk_yearly")))),
        _p(None, F.concat(F.lit("International students: £"), fee(r("fee_intl_yearly")))),
        sandwich,
        _p("deadline", r("deadline_main")), late,
        _p(None, F.concat(F.lit("English: IELTS "), r("ielts_score").cast("string"),
                          F.lit(" overall"))),
        descr, entry, F.lit("</body></html>"),
    ]
    return F.concat_ws("", *pieces)


def rendered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, html, university_name, university_location)`` per course."""
    rows = course_rows(spark, sf_dir)
    # Parsing is CPU work per page: the narrow course rows are rebalanced before
    # the html is generated, into as many parts as AQE finds their size needs.
    return rows.hint("rebalance").select(*page_columns())


def page_columns() -> list:
    return [F.col("id").alias("page_id"), F.col("source_url").alias("url"), render_html().alias("html"),
            F.col("university_name"), F.col("university_location")]


def render_markdown(r=F.col) -> F.Column:
    """A markdown view of a course page (what a page-to-markdown fetch returns)."""
    entry = F.when(r("entry_requirements").isNotNull(), F.concat(
        F.lit("\n\nEntry Requirements\n"), r("entry_requirements"), F.lit(". "),
        r("description"), F.lit(". Applicants are assessed on their full academic record.")))
    ucas = F.when(r("ucas_code").isNotNull(), F.concat(F.lit("\nUCAS code: "), r("ucas_code")))
    return F.concat_ws("", F.lit("# "), r("name"), F.lit("\n\n"), r("degree"), F.lit(" programme\n"),
                       F.lit("School of "), r("department"), F.lit("\n"),
                       F.lit("Duration: "), r("duration_years").cast("string"), F.lit(" years\n"),
                       F.lit("Start date: "), r("start_month"), F.lit("\n"),
                       F.lit("UK: £"), F.format_number(r("fee_uk_yearly"), 0), F.lit(" per year\n"),
                       F.lit("International: £"), F.format_number(r("fee_intl_yearly"), 0),
                       F.lit(" per year"), ucas,
                       F.lit("\nEnglish: IELTS "), r("ielts_score").cast("string"), entry)


def markdown_pages(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """``(url, md)``: one markdown document per course."""
    rows = rows if rows is not None else course_rows(spark, sf_dir)
    return rows.select(F.col("source_url").alias("url"),
                                             render_markdown().alias("md"))


def raw_from_catalogue(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Raw records as a source would deliver them (text fees, padded names,
    abbreviated levels); research courses list no degree, fees or long texts."""
    rows = rows if rows is not None else course_rows(spark, sf_dir)
    taught = F.col("level") != "research"
    lvl = (F.when(F.col("level") == "undergraduate", F.lit("UG"))
           .when(F.col("level") == "postgraduate", F.lit("pg ")).otherwise(F.col("level")))
    return rows.select(
        F.col("source_url").alias("url"), "university_name", "university_location",
        F.concat(F.lit(" "), F.col("name"), F.lit("  ")).alias("name"),
        F.when(taught, F.col("degree")).alias("degree"),
        lvl.alias("level"),
        F.concat(F.col("department"), F.lit("\n")).alias("department"),
        "ucas_code", "study_mode",
        F.col("duration_years").cast("string").alias("duration_years"),
        "start_month",
        F.when(taught, F.format_number("fee_uk_yearly", 0)).alias("fee_uk_yearly"),
        F.col("fee_uk_sandwich").cast("string").alias("fee_uk_sandwich"),
        F.when(taught, F.format_number("fee_intl_yearly", 0)).alias("fee_intl_yearly"),
        F.col("fee_intl_sandwich").cast("string").alias("fee_intl_sandwich"),
        "deadline_main", "deadline_late",
        F.col("ielts_score").cast("string").alias("ielts_score"),
        "description", "entry_requirements",
        F.col("scraped_at").alias("seen_at"))
