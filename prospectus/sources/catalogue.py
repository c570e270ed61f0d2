"""The catalogue tables (universities, courses, course_details) derived from the
input tables.

A university is a supplier (location = its nation); a course is a distinct
``(l_partkey, l_suppkey)`` pair of ``lineitem`` described by ``part``.  Every
``lineitem`` row is one observation of a course page, so the catalogue grows
with the data.  Keys are deterministic hashes of natural keys, so re-running
any job gives the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import few
from .tables import read_table

# Fixture labels used to give synthetic courses a degree (chosen by p_size).
FIXTURE_DEGREES = ["BSc (Hons)", "BA (Hons)", "MSc", "MA", "PhD", "BEng",
                   "MEng", "MBA", "LLB", "MRes"]
CATALOGUE_CREATED_AT = "2020-01-01 00:00:00"


def university_key(name) -> F.Column:
    return F.sha2(name, 256)


def course_url(partkey, suppkey) -> F.Column:
    return F.concat(F.lit("https://www.university-"), suppkey.cast("string"),
                    F.lit(".example.ac.uk/courses/"), partkey.cast("string"))


def universities(spark: SparkSession, sf_dir: str, solvent: bool = False) -> DataFrame:
    """supplier x nation -> universities(id, name, location, website, created_at, supplier_key).

    ``solvent`` leaves out suppliers whose balance is negative: universities that
    have gone while their courses are still in the catalogue.  Where they are few they are
    marked for broadcast, so that a join does not shuffle the courses."""
    sup = few(read_table(spark, sf_dir, "supplier"))
    if solvent:
        sup = sup.filter(F.col("s_acctbal") >= 0)
    sup = sup.select("s_suppkey", "s_name", "s_nationkey")
    # nation is a fixed 25-row dimension: a proven size bound, so broadcast it.
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey, "left")
            .select(university_key(F.col("s_name")).alias("id"),
                    F.col("s_name").alias("name"),
                    F.col("n_name").alias("location"),
                    F.lit(None).cast("string").alias("website"),
                    F.lit(CATALOGUE_CREATED_AT).cast("timestamp_ntz").alias("created_at"),
                    F.col("s_suppkey").alias("supplier_key")))


def course_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem: an observation of a course page at l_shipdate."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     "l_quantity", "l_extendedprice", "l_discount", "l_linestatus",
                     "l_shipdate")


def course_facts(spark: SparkSession, sf_dir: str, before: str | None = None) -> DataFrame:
    """Aggregate observations per course (hash aggregate, partial map-side).

    ``before`` (a date) keeps the observations earlier than it: the catalogue
    as it was at that time.  The predicate is pushed into the parquet scan.
    """
    obs = course_observations(spark, sf_dir)
    if before is not None:
        obs = obs.filter(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    return (obs.groupBy("l_partkey", "l_suppkey")
            .agg(F.min("l_shipdate").alias("first_seen"),
                 F.max("l_shipdate").alias("last_seen"),
                 F.count(F.lit(1)).alias("n_obs"),
                 F.max((F.col("l_linestatus") == "O").cast("int")).alias("any_open")))


def describe_course(part_cols: DataFrame) -> list:
    """Course attribute expressions from the ``part`` columns."""
    degree = F.element_at(F.array(*[F.lit(d) for d in FIXTURE_DEGREES]),
                          (F.col("p_size") % len(FIXTURE_DEGREES) + 1).cast("int"))
    level = (F.when(degree.startswith("B") | degree.startswith("LLB"), F.lit("undergraduate"))
             .when(degree == "PhD", F.lit("research"))
             .otherwise(F.lit("postgraduate")))
    ucas = F.when(level == "undergraduate",
                  F.concat(F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                                       (F.col("p_partkey") % 26 + 1).cast("int"), 1),
                           F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")))
    return [
        F.col("p_name").alias("name"),
        degree.alias("degree"),
        level.alias("level"),
        F.col("p_brand").alias("department"),
        ucas.alias("ucas_code"),
        F.when(F.col("p_size") > 25, F.lit("full-time,part-time"))
         .otherwise(F.lit("full-time")).alias("study_mode"),
        (F.col("p_size").cast("double") / 10).cast("decimal(4,1)").alias("duration_years"),
        F.floor(F.col("p_retailprice") * 10).cast("bigint").alias("fee_uk_yearly"),
        F.when(F.col("p_type") == "LARGE", F.floor(F.col("p_retailprice")).cast("bigint"))
         .alias("fee_uk_sandwich"),
        F.floor(F.col("p_retailprice") * 25).cast("bigint").alias("fee_intl_yearly"),
        F.when(F.col("p_type") == "LARGE", F.floor(F.col("p_retailprice")).cast("bigint"))
         .alias("fee_intl_sandwich"),
        (F.lit(5.5) + (F.col("p_size") % 4) * 0.5).cast("decimal(3,1)").alias("ielts_score"),
    ]


def courses(spark: SparkSession, sf_dir: str, with_part: bool = False,
            before: str | None = None, with_university: bool = False) -> DataFrame:
    """The courses table; ``with_part`` also keeps ``p_type``/``p_size``, ``with_university`` adds
    ``university_name``/``university_location``, which meet the suppliers before these meet the courses."""
    facts = course_facts(spark, sf_dir, before)
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    own = []
    if with_university:
        u = universities(spark, sf_dir).select(
            F.col("id").alias("_uid"), F.col("name").alias("university_name"),
            F.col("location").alias("university_location"))
        sup = few(sup.join(u, university_key(F.col("s_name")) == F.col("_uid"), "left").drop("_uid"))
        own = [F.col("university_name"), F.col("university_location")]
    url = course_url(F.col("l_partkey"), F.col("l_suppkey"))
    joined = (facts.join(part, facts.l_partkey == part.p_partkey, "inner")
              .join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left"))
    attrs = describe_course(joined)
    return joined.select(
        F.sha2(url, 256).alias("id"),
        university_key(F.col("s_name")).alias("university_id"),
        *attrs[:6],
        attrs[6],
        F.date_format("first_seen", "MMMM").alias("start_month"),
        *attrs[7:11],
        F.concat(F.lit("15 January "), (F.year("last_seen") + 1).cast("string")).alias("deadline_main"),
        F.lit(None).cast("string").alias("deadline_late"),
        attrs[11],
        url.alias("source_url"),
        (F.col("any_open") == 1).alias("is_active"),
        F.col("last_seen").alias("scraped_at"),
        F.col("first_seen").alias("created_at"),
        F.col("last_seen").alias("updated_at"),
        *([F.col("p_type"), F.col("p_size")] if with_part else []), *own,
    )


def detail_text_columns() -> list:
    """description / entry_requirements of a course row (null for research)."""
    has = F.col("level") != "research"
    return [
        F.when(has, F.concat_ws(" ", F.col("name"), F.lit("is a"), F.col("degree"),
                                F.lit("course taught by"), F.col("department"))).alias("description"),
        F.when(has, F.concat(F.lit("IELTS "), F.col("ielts_score").cast("string"),
                             F.lit(" overall; UCAS code "),
                             F.coalesce(F.col("ucas_code"), F.lit("n/a")))).alias("entry_requirements"),
    ]


def course_details(spark: SparkSession, sf_dir: str, courses_df: DataFrame | None = None) -> DataFrame:
    """1:1 long texts; research courses have none."""
    c = courses_df if courses_df is not None else courses(spark, sf_dir)
    return (c.filter(F.col("level") != "research")
            .select(F.sha2(F.concat(F.lit("details:"), F.col("id")), 256).alias("id"),
                    F.col("id").alias("course_id"),
                    *detail_text_columns(),
                    F.lit(None).cast("string").alias("modules"),
                    F.lit(None).cast("string").alias("career_prospects")))
