"""Catalogue queries: search, detail, university lists, counts (Q1-Q17).

All functions are DataFrame in, DataFrame out.  Small dimension sides are
left to AQE's runtime size check (``autoBroadcastJoinThreshold``) instead of
a blind ``broadcast`` hint: the universities table grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.search import lexemes, query_terms


def search_base(courses: DataFrame, unis: DataFrame) -> DataFrame:
    """Q1+Q2: active courses with their university name and location."""
    u = unis.select(F.col("id").alias("_uid"), F.col("name").alias("uni_name"),
                    F.col("location").alias("uni_location"))
    return (courses.filter(F.col("is_active").eqNullSafe(True))
            .join(u, courses.university_id == u._uid, "inner").drop("_uid"))


def keyword_filter(df: DataFrame, q: str, literal: bool = False, matches: DataFrame | None = None) -> DataFrame:
    """Q3: full-text AND-match of the query terms OR name/department ILIKE.

    ``matches`` holds the ids that the stored postings find for ``q``; without it the rows'
    own texts are stemmed."""
    pat = _like_pattern(q, literal)
    like = (F.coalesce(F.col("name").ilike(pat), F.lit(False))
            | F.coalesce(F.col("department").ilike(pat), F.lit(False)))
    if matches is None:
        own = lexemes(F.concat_ws(" ", "name", "department", "degree"))
        found = F.forall(F.array(*[F.lit(t) for t in query_terms(q)]), lambda t: F.array_contains("_lexemes", t))
        found = found if query_terms(q) else F.lit(False)
        return df.withColumn("_lexemes", own).filter(like | found).drop("_lexemes")
    hit = matches.select(F.col("id").alias("_hit"))
    return df.join(hit, df.id == hit._hit, "left").filter(like | F.col("_hit").isNotNull()).drop("_hit")


def _like_pattern(v: str, literal: bool = False) -> str:
    if literal:
        v = v.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return f"%{v}%"


def search_filtered(courses: DataFrame, unis: DataFrame, q: str | None = None,
                    university: str | None = None, degree: str | None = None,
                    level: str | None = None, min_fee: int | None = None,
                    max_fee: int | None = None, literal: bool = False,
                    matches: DataFrame | None = None) -> DataFrame:
    """Q1-Q5: the filtered search relation (before ordering and paging).

    ``matches`` are the ids that a stored search vector finds for ``q``."""
    df = search_base(courses, unis)
    if q:
        df = keyword_filter(df, q, literal, matches)
    if university:
        df = df.filter(F.col("uni_name").ilike(_like_pattern(university, literal)))
    if degree:
        df = df.filter(F.col("degree").ilike(_like_pattern(degree, literal)))
    if level:
        df = df.filter(F.col("level").ilike(_like_pattern(level, literal)))
    if min_fee is not None:
        df = df.filter(F.col("fee_uk_yearly") >= F.lit(int(min_fee)))
    if max_fee is not None:
        df = df.filter(F.col("fee_uk_yearly") <= F.lit(int(max_fee)))
    return df


def list_projection(df: DataFrame) -> DataFrame:
    """Q8: the list row; a zero duration is shown as null."""
    dur = F.col("duration_years")
    return df.select(
        "id", "name", "degree", "level", "department",
        F.col("uni_name").alias("university_name"),
        F.col("uni_location").alias("university_location"),
        F.when(dur != 0, dur.cast("double")).alias("duration_years"),
        "fee_uk_yearly", "fee_intl_yearly", "source_url")


def check_page(page: int, page_size: int) -> None:
    if page < 1:
        raise ValueError(f"page must be >= 1, got {page}")
    if not 1 <= page_size <= rules.PAGE_SIZE_MAX:
        raise ValueError(f"page_size must be in 1..{rules.PAGE_SIZE_MAX}, got {page_size}")


def search_page(filtered: DataFrame, page: int = 1,
                page_size: int = rules.PAGE_SIZE_DEFAULT) -> DataFrame:
    """Q7: order by name (id breaks ties), offset, limit -> TakeOrderedAndProject; far down, ``deep_page``."""
    check_page(page, page_size)
    if (page - 1) * page_size > SHALLOW:
        return deep_page(filtered, page, page_size)
    ordered = list_projection(filtered).orderBy(F.col("name").asc_nulls_first(), F.col("id"))
    offset = (page - 1) * page_size
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(page_size)


#: rows that a page's range may hold before it is read, and skipped rows up to which a page is a plain top-k
PAGE_RANGE_ROWS, SHALLOW = 50_000, 10_000


def _page_order() -> list:
    return [F.col("name").asc_nulls_first(), F.col("id").asc_nulls_first()]


def deep_page(filtered: DataFrame, page: int, page_size: int = rules.PAGE_SIZE_DEFAULT,
              range_rows: int = PAGE_RANGE_ROWS) -> DataFrame:
    """Q7 far down: the same page as ``search_page`` by order statistics.

    The keys (name, id) are put in ranges, and the ranges' sizes tell which of them the page
    meets; these are divided again until they are small.  The driver sees a row for each range.
    Then only the rows of the page's ranges are sorted, less those that come before the page."""
    check_page(page, page_size)
    skip = (page - 1) * page_size
    keys, rows = filtered.select("name", "id"), list_projection(filtered)
    key = F.struct("name", "id")  # orders like the two columns, nulls first
    inside = F.lit(True)
    parts = max(int(filtered.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    while True:
        placed = keys.filter(inside).repartitionByRange(parts, *_page_order()).withColumn("_range", F.spark_partition_id())
        ranges = (placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
                  .orderBy("_range").collect())
        total, before, hit = sum(r.n for r in ranges), 0, []
        for r in ranges:
            if before + r.n > skip and before < skip + page_size:
                hit.append((before, r))
            before += r.n
        if not hit:
            return rows.limit(0)
        skip -= hit[0][0]
        inside = inside & _between(hit[0][1].lo, hit[-1][1].hi)
        held = sum(r.n for _, r in hit)
        if held <= max(range_rows, page_size) or held == total:
            break
    ordered = rows.filter(inside).orderBy(*_page_order())
    return (ordered.offset(skip) if skip else ordered).limit(page_size)


def _between(lo, hi) -> Column:
    """Whether (name, id) lies from ``lo`` to ``hi``; the bounds on the name alone can be pushed to the scan."""
    literal = lambda r: F.struct(*[F.lit(r[c]).cast("string").alias(c) for c in ("name", "id")])
    key = F.struct("name", "id")
    cond = (key >= literal(lo)) & (key <= literal(hi))
    if lo["name"] is not None:
        cond = cond & (F.col("name") >= lo["name"]) & (F.col("name") <= hi["name"])
    return cond


def search_total(filtered: DataFrame) -> DataFrame:
    """Q6: total over the filtered relation (pruned to a count)."""
    return filtered.agg(F.count(F.lit(1)).alias("total"))


def search(courses: DataFrame, unis: DataFrame, page: int = 1,
           page_size: int = rules.PAGE_SIZE_DEFAULT, **filters) -> tuple[DataFrame, DataFrame]:
    """The search endpoint: ``(page_df, total_df)``."""
    check_page(page, page_size)
    f = search_filtered(courses, unis, **filters)
    return search_page(f, page, page_size), search_total(f)


def course_counts(courses: DataFrame) -> DataFrame:
    """count(course.id) per university, aggregated before any join."""
    return courses.groupBy("university_id").agg(F.count("id").alias("course_count"))


def university_list(unis: DataFrame, courses: DataFrame) -> DataFrame:
    """Q10: every university with its course count (zero kept), by name."""
    counts = course_counts(courses)
    return (unis.join(counts, unis.id == counts.university_id, "left")
            .select(unis.id, unis.name, unis.location, unis.website,
                    F.coalesce(counts.course_count, F.lit(0)).alias("course_count"))
            .orderBy("name", "id"))


def university_detail(unis: DataFrame, courses: DataFrame, university_id: str) -> DataFrame:
    """Q11: one university and its count; empty when not found."""
    u = unis.filter(F.col("id") == university_id)
    c = courses.filter(F.col("university_id") == university_id)
    counts = course_counts(c)
    return (u.join(counts, u.id == counts.university_id, "left")
            .select(u.id, u.name, u.location, u.website,
                    F.coalesce(counts.course_count, F.lit(0)).alias("course_count")))


def totals(unis: DataFrame, courses: DataFrame) -> DataFrame:
    """Q12: the two independent count(*) totals, as one row."""
    nu = unis.agg(F.count(F.lit(1)).alias("total_universities"), F.lit(0).alias("_k"))
    nc = courses.agg(F.count(F.lit(1)).alias("total_courses"), F.lit(0).alias("_k"))
    # two global aggregates, one row each, joined on a constant key
    return nu.join(F.broadcast(nc), "_k").drop("_k")


def counts_desc(unis: DataFrame, courses: DataFrame) -> DataFrame:
    """Q13: (id, name, location, course_count) by count desc, name, id."""
    counts = course_counts(courses)
    return (unis.join(counts, unis.id == counts.university_id, "left")
            .select(unis.id, unis.name, unis.location,
                    F.coalesce(counts.course_count, F.lit(0)).alias("course_count"))
            .orderBy(F.col("course_count").desc(), "name", "id"))


def universities_without_courses(unis: DataFrame, courses: DataFrame) -> DataFrame:
    """Q16: universities no course points at (distinct keys first, then anti join)."""
    used = courses.select(F.col("university_id").alias("_uid")).distinct()
    return unis.join(used, unis.id == used._uid, "left_anti").select("id", "name", "location")


def orphan_courses(courses: DataFrame, unis: DataFrame) -> DataFrame:
    """Q17: courses whose university is missing (why TOTAL != sum of rows)."""
    u = unis.select(F.col("id").alias("_uid"))
    return courses.join(u, courses.university_id == u._uid, "left_anti")
