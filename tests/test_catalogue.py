"""Catalogue queries on a tiny fixture (the reference's API cases) and on sf0.001."""

import hashlib
import re
from decimal import Decimal as D

import duckdb
import pytest
from pyspark.sql import functions as F

from prospectus.functions import stem as S
from prospectus.functions.stem import stem
from prospectus.plans.stem_sql import stem_ctes

from prospectus.operators import catalogue as C
from prospectus.operators import report as R

UNI_COLS = "id string, name string, location string, website string"
COURSE_COLS = ("id string, university_id string, name string, degree string, level string, "
               "department string, ucas_code string, study_mode string, duration_years decimal(4,1), "
               "fee_uk_yearly bigint, fee_intl_yearly bigint, source_url string, is_active boolean")


@pytest.fixture(scope="module")
def cat(spark):
    unis = spark.createDataFrame([
        ("u1", "Test University", "London, England", None),
        ("u2", "Empty College", None, None)], UNI_COLS)
    courses = spark.createDataFrame([
        ("c1", "u1", "Computer Science", "BSc", "undergraduate", "Computing", "G400",
         "full-time", D("3.0"), 9250, 35000, "https://t.ac.uk/cs", True),
        ("c2", "u1", "Data Science", "MSc", "postgraduate", "Computing", None,
         "full-time", D("1.0"), 12000, 30000, "https://t.ac.uk/ds", True),
        ("c3", "u1", "Old Course", "BA", "undergraduate", "History", None,
         "full-time", D("0"), None, None, "https://t.ac.uk/old", False),
        ("c4", "u9", "Orphan Course", "BA", "undergraduate", "Art", None,
         "full-time", D("3.0"), 9000, 20000, "https://x.ac.uk/o", True)], COURSE_COLS)
    return unis, courses


def test_filter_by_university(cat):
    u, c = cat
    page, total = C.search(c, u, university="test university")
    assert total.first().total >= 1
    assert page.first().university_name == "Test University"


def test_filters_degree_level_fee(cat):
    u, c = cat
    assert C.search(c, u, degree="BSc")[1].first().total >= 1
    assert C.search(c, u, level="undergraduate")[1].first().total >= 1
    assert C.search(c, u, min_fee=5000, max_fee=15000)[1].first().total == 2
    assert C.search(c, u, min_fee=0)[1].first().total == 2  # null fees drop out; 0 is a bound


def test_inactive_and_orphan_excluded_from_search(cat):
    u, c = cat
    ids = {r.id for r in C.search_filtered(c, u).collect()}
    assert ids == {"c1", "c2"}


def test_keyword_fulltext_or_ilike(cat):
    u, c = cat
    assert {r.id for r in C.search_filtered(c, u, q="science").collect()} == {"c1", "c2"}
    assert {r.id for r in C.search_filtered(c, u, q="comput").collect()} == {"c1", "c2"}  # ILIKE
    assert {r.id for r in C.search_filtered(c, u, q="sciences of computers").collect()} == {"c1", "c2"}  # stems only
    assert C.search_filtered(c, u, q="the").count() == 0  # stop word only, no ILIKE hit


def test_stems():
    plain = {"consigned": "consign", "consistency": "consist", "consolatory": "consolatori", "conspirators": "conspir",
             "knackeries": "knackeri", "knavish": "knavish", "knightly": "knight", "knitting": "knit", "computing": "comput",
             "computers": "comput", "skies": "sky", "dying": "die", "news": "news", "generalization": "general",
             "communication": "communic", "agreed": "agre", "hopping": "hop", "hoping": "hope", "flies": "fli", "ties": "tie",
             "gas": "gas", "national": "nation", "proceed": "proceed", "by": "by", "sayyid": "sayyid", "bsc2s": "bsc2s",
             "écoles": "écoles", "universities": "univers", "adoption": "adopt", "rational": "ration", "roll": "roll"}
    assert {w: stem(w) for w in plain} == plain


def test_stems_match_the_sql_rules(sf_small):
    """The oracles' step-by-step SQL over every token of the documents and over made-up endings."""
    ends = [*S.STEP_2, *S.STEP_3, *S.STEP_4, "s", "es", "ed", "eed", "eedly", "ing", "ingly", "ied", "ies", "e", "ll", "y"]
    made = [a + b + e for a in ("gener", "b", "yt", "con", "tt", "oy") for b in ("", "al", "ess", "og", "iv") for e in ends]
    con = duckdb.connect()
    con.execute("CREATE TABLE made AS SELECT unnest(?) AS token", [made])
    got = con.execute(f"""WITH {stem_ctes(f"SELECT token FROM made UNION ALL SELECT unnest(string_split_regex(lower(text), "
                      f"'[^a-z0-9]+')) FROM '{sf_small}/documents.parquet'")} SELECT token, stem FROM stems""").fetchall()
    assert len(got) > 1500 and all(stem(t) == s for t, s in got if t)


def test_stems_of_arrays(spark):
    df = spark.createDataFrame([(["computing", "x"],), ([],), (["computers", "computing"],)], "t array<string>")
    assert [r[0] for r in df.select(S.stems("t")).collect()] == [["comput", "x"], [], ["comput", "comput"]]


def test_paging_and_bounds(cat):
    u, c = cat
    p1 = C.search(c, u, page=1, page_size=1)[0].collect()
    p2 = C.search(c, u, page=2, page_size=1)[0].collect()
    assert [r.name for r in p1 + p2] == ["Computer Science", "Data Science"]
    assert C.search(c, u, page=3, page_size=1)[0].count() == 0
    with pytest.raises(ValueError):
        C.search(c, u, page=0)
    with pytest.raises(ValueError):
        C.search(c, u, page_size=999)


def test_zero_duration_shown_as_null(cat):
    u, c = cat
    row = C.list_projection(C.search_base(c.withColumn("is_active", F.lit(True)), u)
                            .filter("id = 'c3'")).first()
    assert row.duration_years is None


def test_university_list_detail_and_counts(cat):
    u, c = cat
    rows = {r.name: r.course_count for r in C.university_list(u, c).collect()}
    assert rows == {"Test University": 3, "Empty College": 0}  # inactive counted
    assert C.university_detail(u, c, "u1").first().course_count == 3
    assert C.university_detail(u, c, "nope").count() == 0
    assert [r.name for r in C.universities_without_courses(u, c).collect()] == ["Empty College"]
    assert [r.id for r in C.orphan_courses(c, u).collect()] == ["c4"]


def test_total_line_is_independent_count(cat):
    u, c = cat
    lines = [r.line for r in R.summary_lines(u, c).orderBy("line_no").collect()]
    assert lines[0] == "🎓 Total Universities: 2" and lines[2] == "📚 Total Courses: 4"
    total = next(x for x in lines if x.startswith("TOTAL"))
    assert total.rstrip().endswith("4")  # 4 courses although the rows add to 3
    assert any(x.startswith("⚠️  Universities with no courses: 1") for x in lines)
    assert lines[-1] == "   - Empty College"
    assert any("N/A" in x for x in lines)


def test_numbers_over_many_ranges(spark):
    df = spark.range(5000).selectExpr("id % 7 as course_count", "cast(id % 1000 as string) name", "cast(id as string) id",
                                      "'x' location").repartition(9)
    order = [F.col("course_count").desc(), F.col("name"), F.col("id"), F.col("location")]
    got, _ = R.numbered(df, order)
    rows = sorted(got.collect(), key=lambda r: r.line_no)
    assert [r.line_no for r in rows] == list(range(1, 5001))
    assert [(-r.course_count, r.name, r.id) for r in rows] == sorted((-(i % 7), str(i % 1000), str(i)) for i in range(5000))


def test_summary_is_planned_without_jobs_and_counts_once(spark, cat):
    u, c = cat
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-summary", "")
    lines = R.summary_lines(u, c)
    assert not tracker.getJobIdsForGroup("plan-summary")
    spark.sparkContext.setJobGroup("", "")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "RDD" not in plan.replace("Scan ExistingRDD", "")
    empty = [r.line for r in R.summary_lines(u.limit(0), c.limit(0)).orderBy("line_no").collect()]
    assert len(empty) == 11 and empty[0] == "🎓 Total Universities: 0" and empty[9].endswith("0")


def test_detail_falls_back_to_raw_json(spark, cat):
    u, c = cat
    raw = ('{"course": {"name": "Computer Science", "start_month": "October", "study_mode": ["part-time", "distance"]},'
           ' "fees": {"uk": {"yearly": 1}}, "admission": {"english_requirement": {"ielts": 6.5}},'
           ' "metadata": {"scraped_at": "2024-01-01T00:00:00"}}')
    text_modes = '{"course": {"study_mode": "distance,part-time"}, "fees": null}'
    cc = (c.withColumn("raw_json", F.when(F.col("id") == "c3", F.lit(raw)).when(F.col("id") == "c2", F.lit(text_modes))
                       .when(F.col("id") == "c1", F.lit("[1]")).otherwise(F.lit("not json")))
          .withColumn("start_month", F.when(F.col("id") == "c3", F.lit("")))
          .withColumn("study_mode", F.when(F.col("id") == "c1", F.col("study_mode")).when(F.col("id") == "c2", F.lit("")))
          .withColumn("deadline_main", F.lit(None).cast("string"))
          .withColumn("deadline_late", F.lit(None).cast("string"))
          .withColumn("fee_uk_sandwich", F.lit(None).cast("bigint"))
          .withColumn("fee_intl_sandwich", F.lit(None).cast("bigint"))
          .withColumn("ielts_score", F.lit(0).cast("decimal(3,1)"))
          .withColumn("scraped_at", F.lit(None).cast("timestamp_ntz")))
    details = spark.createDataFrame([("d1", "c1", "desc", "AAA")],
                                    "id string, course_id string, description string, entry_requirements string")
    record = R.course_record(cc, u, details)
    assert record.columns == ["id", "university", "course", "fees", "admission", "metadata"]
    d = {r.id: r for r in record.collect()}
    assert d["c3"].course.start_month == "October"         # column '' -> raw
    assert d["c3"].course.study_mode == ["part-time", "distance"]
    assert d["c3"].fees.uk.yearly == 1 and d["c3"].fees.uk.currency == d["c3"].fees.international.currency == "GBP"
    assert d["c3"].course.duration_years is None           # 0 falls through; raw has none
    assert d["c3"].admission.english_requirement.ielts == 6.5
    assert d["c3"].metadata.scraped_at == "2024-01-01T00:00:00" and d["c1"].metadata.scraped_at == ""
    assert d["c2"].course.study_mode == ["distance", "part-time"]  # stored as text
    assert d["c1"].admission.entry_requirements == "AAA" and d["c1"].course.study_mode == ["full-time"]
    assert d["c4"].university == ("Unknown", None)          # missing university, stored text is no JSON
    assert d["c4"].course.study_mode == ["full-time"]
    one = R.course_record(cc, u, details, course_id="c2").collect()
    assert len(one) == 1 and R.course_record(cc, u, details, course_id="zz").count() == 0


def test_deep_pages_are_those_of_a_plain_sort(spark, cat):
    u, _ = cat
    rows = [(f"i{i:04d}", "u1", None if i % 50 == 0 else f"n{i % 90}", "BSc", "ug", "x", None, "full-time", D("1.0"), 1, 2, f"u{i}", True)
            for i in range(1500)]
    found = C.search_filtered(spark.createDataFrame(rows, COURSE_COLS).repartition(5), u)
    want = sorted(((r[2] is not None, r[2] or "", r[0]) for r in rows))
    for page in (1, 2, 5, 74, 75, 76, 90):
        got = [(r.name is not None, r.name or "", r.id) for r in C.deep_page(found, page, 20, range_rows=100).collect()]
        assert got == want[(page - 1) * 20:page * 20]
    assert C.deep_page(found.limit(0), 3).count() == 0
    plan = C.deep_page(found, 74, 20, range_rows=100)._jdf.queryExecution().executedPlan().toString()
    top = [int(x) for x in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan)]
    assert top and max(top) < 200  # nothing like the 1460 rows before the page


def test_export_file_names(spark):
    df = spark.createDataFrame([(' a/b:c? ',), ('..Royal Holloway ISC (Study Group)',)], "name string")
    got = [r[0] for r in df.select(R.file_stem(F.col("name"))).collect()]
    assert got == ["a_b_c_", "Royal Holloway ISC (Study Group)"]


def test_ids_are_hashes_of_natural_keys(spark, sf_small):
    from prospectus.sources import catalogue as src
    u = src.universities(spark, sf_small).filter("name = 'Supplier#000000001'").first()
    assert u.id == hashlib.sha256(b"Supplier#000000001").hexdigest()


def test_export_and_summary_writers(spark, cat):
    import os
    from prospectus.session import work_path
    u, c = cat
    c = c.withColumn("raw_json", F.concat(F.lit('{"id": "'), F.col("id"), F.lit('"}')))
    out = work_path(spark, "test-export")
    R.write_export(R.export_rows(u, c), out)
    folders = sorted(d for d in os.listdir(out) if d.startswith("file_stem="))
    assert folders == ["file_stem=Empty College", "file_stem=Test University"]
    back = R.read_export(spark, out)
    assert back.columns == ["file_stem", *R.EXPORT_FIELDS]
    assert back.filter("file_stem = 'Test University'").count() == 3
    assert R.read_export(spark, out, "Empty College").count() == 0
    assert {r.raw_json for r in R.read_export(spark, out, "Test University").collect()} == {f'{{"id": "c{i}"}}' for i in (1, 2, 3)}
    # a university's files follow its size
    many = R.export_rows(u, c.filter("id = 'c1'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(1000))))
                         .withColumn("source_url", F.concat("source_url", F.col("n").cast("string"))).repartition(11))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts are written by one task
    try:
        R.write_export(many, out + "-many", rows_per_file=250)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = lambda stem: len([f for f in os.listdir(f"{out}-many/file_stem={stem}") if f.endswith(".txt")])
    assert files("Empty College") == 1 and 2 <= files("Test University") <= 4
    assert R.read_export(spark, out + "-many").count() == 1000
    lines = R.export_lines(spark, out + "-many")  # one listing serves the records and the folders
    assert R.export_records(lines).count() == 1000 and lines.select("file_stem").distinct().count() == many.select("file_stem").distinct().count()
    path = work_path(spark, "test-summary")
    R.write_summary(R.summary_lines(u, c), path)
    text = [r.value for r in spark.read.text(path).collect()]
    assert len(text) == R.summary_lines(u, c).count()


def test_like_wildcards_and_literal_mode(cat):
    u, c = cat
    # user text goes into ILIKE as is: '%' and '_' act as wildcards ...
    assert C.search_filtered(c, u, degree="_Sc").count() == 2
    # ... unless literal mode escapes them
    assert C.search_filtered(c, u, degree="_Sc", literal=True).count() == 0


def test_universities_without_kept_courses_reads_all_observations(spark, sf_small, tmp_path):
    from prospectus.plans import catalogue_queries as CQ
    read = lambda t: spark.read.parquet(f"{sf_small}/{t}.parquet")
    k = sorted(r.s_suppkey for r in read("supplier").collect())
    gone, late, none = k[0], k[1], k[2]
    balance = F.when(F.col("s_suppkey") == gone, -5.0).otherwise(5.0).cast(read("supplier").schema["s_acctbal"].dataType)
    seen = ~F.col("l_suppkey").isin(none, late) | ((F.col("l_suppkey") == late) & (F.col("l_shipdate") >= F.lit("2000-01-01")))
    for t in ("nation", "part"):
        read(t).write.parquet(f"{tmp_path}/{t}.parquet")
    read("supplier").withColumn("s_acctbal", balance).write.parquet(f"{tmp_path}/supplier.parquet")
    read("lineitem").filter(seen).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = [r.name for r in CQ.q_universities_without_kept_courses(spark, str(tmp_path)).collect()]
    assert sorted(got) == [f"Supplier#{x:09d}" for x in (gone, none)]


def test_search_vector_cuts_each_text_once(spark):
    """Tokens are cut once for stems and weights; distinct, without stop words, in the order of their first place."""
    from prospectus.functions.search import tokens
    from prospectus.operators.fulltext import search_vector
    rows = [("a", "The art of The ART, and art 2", None, "BSc"), ("b", None, "", "the of"), ("c", "Rings ring", "ring", None)]
    df = spark.createDataFrame(rows, "id string, name string, department string, degree string")
    assert [r[0] for r in df.orderBy("id").select(tokens(F.col("name"))).collect()] == [["art", "2"], [], ["rings", "ring"]]
    vector = search_vector(df)
    assert sorted(vector.collect()) == [("a", "2", "A"), ("a", "art", "A"), ("a", "bsc", "C"), ("c", "ring", "A"), ("c", "ring", "B")]
    assert vector._jdf.queryExecution().optimizedPlan().toString().count("split(") == 3


def test_course_record_moves_no_university_ids(spark):
    """Q9: few universities are sent to the courses, and their ids stay out of the join with the details."""
    cols = ("id string, university_id string, name string, degree string, level string, department string, ucas_code string, "
            "study_mode string, duration_years double, start_month string, fee_uk_yearly long, fee_uk_sandwich long, fee_intl_yearly long, "
            "fee_intl_sandwich long, deadline_main string, deadline_late string, ielts_score double, source_url string, scraped_at timestamp_ntz")
    courses = spark.createDataFrame([(i, u, *[None] * 17) for i, u in [("a", "u1"), ("b", "gone"), ("c", None), ("d", "u1"), ("d", "u2")]], cols)
    unis = spark.createDataFrame([("u1", "One", "X"), ("u2", None, "Y"), (None, "none", "Z")], "id string, name string, location string")
    details = spark.createDataFrame([("a", "asked"), (None, "no")], "course_id string, entry_requirements string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        record = R.course_record(courses, unis, details)
        plan = record._jdf.queryExecution().sparkPlan().toString()
        got = record.select("id", "university.*", "admission.entry_requirements").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin [university_id" in plan
    assert sorted(map(tuple, got), key=str) == [("a", "One", "X", "asked"), ("b", "Unknown", None, None), ("c", "Unknown", None, None),
                                                ("d", "One", "X", None), ("d", None, "Y", None)]
