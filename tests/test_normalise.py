"""Raw record -> item (the reference's normaliser cases)."""

from pyspark.sql import functions as F

from prospectus.functions.fields import norm_degree, norm_level
from prospectus.operators import normalize as N

RAW_COLS = ("name string, degree string, level string, department string, ucas_code string, "
            "study_mode array<string>, duration_years double, start_month string, "
            "fee_uk_yearly bigint, fee_uk_sandwich bigint, fee_intl_yearly bigint, "
            "fee_intl_sandwich bigint, deadline_main string, deadline_late string, "
            "ielts_score double, description string, entry_requirements string")
FULL_RAW = ("BSc Computer Science", "BSc", "undergraduate", "Computer Science", "G400",
            ["full-time", "part-time"], 3.0, "September", 9250, None, 35000, None,
            "January 2025", None, 6.5, "A course.", "AAA")
SPARSE_RAW = ("Some Course",) + (None,) * 16


def items(spark, rows):
    df = spark.createDataFrame(rows, RAW_COLS).select(
        "*", F.lit("UCL").alias("university_name"), F.lit("London").alias("university_location"),
        F.lit("https://www.ucl.ac.uk/course").alias("url"))
    return N.normalise(df, scraped_at="2025-01-01T00:00:00+00:00")


def test_full_item(spark):
    it = items(spark, [FULL_RAW]).collect()[0]
    assert it.university.name == "UCL" and it.university.location == "London"
    assert it.course.degree == "BSc" and it.course.level == "undergraduate"
    assert it.fees.uk.yearly == 9250 and it.fees.international.yearly == 35000
    assert it.fees.uk.currency == "GBP" and it.fees.international.currency == "GBP"
    assert it.admission.english_requirement.ielts == 6.5
    assert it.admission.ucas_code == "G400"
    assert it.needs_fallback is False
    assert "T" in it.metadata.scraped_at


def test_sparse_item_flagged(spark):
    it = items(spark, [SPARSE_RAW]).collect()[0]
    assert it.course.name == "Some Course"
    assert list(it.course.study_mode) == ["full-time"]
    assert it.needs_fallback is True


def test_empty_name_dropped(spark):
    assert items(spark, [("",) + FULL_RAW[1:]]).count() == 0
    assert items(spark, [("  \t",) + FULL_RAW[1:]]).count() == 0


def _one(spark, col_fn, value):
    return spark.createDataFrame([(value,)], "x string").select(col_fn(F.col("x"))).first()[0]


def test_degree_rules(spark):
    cases = {"bsc (hons)": "BSc", "BSc (Hons)": "BSc", "B.Sc.": "BSc", "MBA": "MBA",
             "msc": "MSc", "PhD": "PhD", "LLB": "LLB", "Foundation Degree": "Foundation Degree"}
    for raw, want in cases.items():
        assert _one(spark, norm_degree, raw) == want, raw
    # the literal character-class rule, kept behind compat=True
    literal = lambda c: norm_degree(c, compat=True)
    assert _one(spark, literal, "bsc (hons)") == "bsc (hons)"
    assert _one(spark, literal, "MBA") == "BA"
    assert _one(spark, literal, "BSc (Hons)") == "BSc"
    assert _one(spark, norm_degree, None) is None


def test_level_rules(spark):
    assert _one(spark, norm_level, "ug") == "undergraduate"
    assert _one(spark, norm_level, " PG ") == "postgraduate"
    assert _one(spark, norm_level, "Doctoral") == "research"
    assert _one(spark, norm_level, "Foundation") == "foundation"


def test_fee_text_to_int(spark):
    from prospectus.functions.text import clean_str, to_float, to_int
    df = spark.createDataFrame([("9,250", "9,250.00", "  a   b ", "x")], "a string, b string, c string, d string")
    r = df.select(to_int("a"), to_int("b"), clean_str("c"), to_float("d")).first()
    assert tuple(r) == (9250, 925000, "a b", None)


def test_item_json_keeps_nulls(spark):
    df = items(spark, [FULL_RAW])
    js = df.select(N.item_to_json(df)).first()[0]
    assert '"sandwich_year":null' in js and '"currency":"GBP"' in js
