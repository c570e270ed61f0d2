"""Link discovery: urljoin parity (brute force against the standard library)
and per-source rules on hand-written listing pages."""

import itertools
from urllib.parse import urljoin

from pyspark.sql import functions as F

from prospectus import rules
from prospectus.operators import links as L
from prospectus.operators.html import parsed_pages
from prospectus.sources import listing

BASES = ["http://a.example/b/c/d;p?q", "https://h.example/x/y/", "http://h.example",
         "https://h.example/en/25#top", "http://h.example/fr/825?page=2&ref=x"]
REFS = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "", ".", "..", "../", "../g",
        "../..", "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "g/../h", "g/./h",
        "/a//b/", "a//b", "mailto:x@y", "http://other/x/../y", "HTTP://UP/x", " /sp ", "/x\ty"]


def test_urljoin_matches_stdlib(spark):
    rows = list(itertools.product(BASES, REFS))
    df = spark.createDataFrame(rows, "base string, ref string")
    got = df.select("base", "ref", F.expr(L.url_join_sql("base", "ref")).alias("j")).collect()
    bad = [(r.base, r.ref, r.j, urljoin(r.base, r.ref)) for r in got if r.j != urljoin(r.base, r.ref)]
    assert not bad, bad[:5]


LISTING = """<html><body><nav><a href="/about">About</a></nav><main>
<a href="/courses/undergraduate/computing">Computing</a>
<a href="/courses/undergraduate/computing/">Computing again</a>
<a href="/courses/postgraduate/law?x=1">Law with query</a>
<a href="mailto:x@y.z">mail</a><a href="">empty</a><a>no href</a>
<a href="https://www.mdx.example/courses/foundation/art">Art</a>
<div class="course-item"><a href="/study/thing">Item</a></div>
<a class="link" href="/study/courses/rgu-1">RGU</a><a class="aspect-ratio-card" href="/r1">R</a>
<a class="aspect-ratio-card" href="/r1">R again</a>
<a href="/programmes/foundation">P</a><a href="/programmes">all</a>
</main></body></html>"""


def discover(spark, source, page_url="https://www.mdx.example/courses"):
    df = spark.createDataFrame([(1, page_url, LISTING, source)],
                               "page_id long, url string, html string, source string")
    p = L.with_rules(parsed_pages(df), L.rules_frame(spark))
    starts = df.select("source", "url")
    return [r.url for r in L.discover_links(p, starts).orderBy("pos").collect()]


def test_middlesex_rules(spark):
    assert discover(spark, "middlesex") == [
        "https://www.mdx.example/courses/undergraduate/computing",
        "https://www.mdx.example/courses/undergraduate/computing/",
        "https://www.mdx.example/courses/foundation/art"]


def test_lsbu_include_exclude_and_dedup(spark):
    got = discover(spark, "lsbu")
    assert "https://www.mdx.example/courses/postgraduate/law?x=1" in got
    assert all(not u.startswith("mailto:") for u in got)
    assert len(got) == len(set(got))


def test_selector_sources_without_dedup(spark):
    assert discover(spark, "ravensbourne") == ["https://www.mdx.example/r1"] * 2
    assert discover(spark, "rgu") == ["https://www.mdx.example/study/courses/rgu-1"]
    assert discover(spark, "royal_holloway_isc") == ["https://www.mdx.example/programmes/foundation"]


def test_brookes_selector_union_then_filter(spark):
    got = discover(spark, "brookes")
    assert "https://www.mdx.example/study/thing" not in got  # selected but filtered out
    assert "https://www.mdx.example/courses/undergraduate/computing" in got


def test_regents_canonical_and_start_urls(spark):
    got = discover(spark, "regents_uni", page_url="https://www.mdx.example/courses/undergraduate/computing")
    # canonical form drops the trailing '/', the page's own URL is a start URL
    assert "https://www.mdx.example/courses/undergraduate/computing" not in got
    assert got == ["https://www.mdx.example/courses/postgraduate/law?x=1",
                   "https://www.mdx.example/courses/foundation/art"]


def test_rule_table_is_complete():
    assert len(rules.SOURCE_RULES) == 18
    st = next(r for r in rules.SOURCE_RULES if r["source"] == "st_georges")
    assert len(st["includes"]) == 76 and len(st["excludes"]) == 21


def _tables(spark, folder, keys):
    spark.createDataFrame(keys, "l_partkey long, l_suppkey long").write.parquet(f"{folder}/lineitem.parquet")
    parts = sorted({k for k, _ in keys})
    spark.createDataFrame([(k, f"course {k}", k % 50) for k in parts],
                          "p_partkey long, p_name string, p_size int").write.parquet(f"{folder}/part.parquet")


def test_listing_pages_of_a_very_large_university(spark, tmp_path):
    """More than a thousand pages of one university stay its own, each with its own url."""
    n = 1100 * listing.PAGE_LINKS
    _tables(spark, str(tmp_path), [(k, 1) for k in range(n)] + [(k, 2) for k in range(60)])
    pages = listing.listing_pages(spark, str(tmp_path))
    r = pages.agg(F.count("*"), F.countDistinct("page_id"), F.countDistinct("url")).first()
    assert list(r) == [1102, 1102, 1102]
    starts = listing.start_urls(spark, str(tmp_path))
    assert starts.count() == 1102 and starts.join(pages, "url", "left_anti").count() == 0
    anchors = L.links_all(parsed_pages(pages))
    assert anchors.count() == n + 60 + 1102 * (len(listing.NAV) + 4)


def test_every_source_yields_links_and_start_urls_go(spark, tmp_path):
    _tables(spark, str(tmp_path), [(k, s) for s in range(18) for k in range(120)])
    pages = listing.listing_pages(spark, str(tmp_path))
    with_r = L.with_rules(parsed_pages(pages), L.rules_frame(spark))
    assert L.discover_links(with_r).select("source").distinct().count() == 18
    kept = L.discover_links(with_r, listing.start_urls(spark, str(tmp_path)))
    gone = L.discover_links(with_r).join(kept, ["page_id", "pos"], "left_anti")
    assert {r.source for r in gone.select("source").distinct().collect()} == {"regents_uni"}
    assert gone.count() > 0


def test_one_rule_as_literals_equals_the_joined_rule(spark):
    df = spark.createDataFrame([(1, "https://h.example/courses", LISTING, "qub")],
                               "page_id long, url string, html string, source string")
    spec = next(r for r in rules.SOURCE_RULES if r["source"] == "qub")
    joined = L.discover_links(L.with_rules(parsed_pages(df), L.rules_frame(spark))).collect()
    literal = L.discover_links(L.with_one_rule(parsed_pages(df), spec)).collect()
    assert joined == literal and len(joined) > 0


def test_links_meet_start_urls_without_a_sort(spark, tmp_path):
    """A sort by a pattern's result would evaluate the pattern for each comparison."""
    from prospectus.plans import link_queries as Q
    folder = str(tmp_path)
    _tables(spark, folder, [(i, 1 + i % 3) for i in range(60)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query in (Q.q_links_exclude_start, Q.q_discover_course_links):
            plan = query(spark, folder)._jdf.queryExecution().sparkPlan().toString()
            join = [row for row in plan.split("\n") if "LeftAnti" in row]
            assert len(join) == 1 and "ShuffledHashJoin" in join[0] and "regexp_replace" not in join[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_discovery_holds_each_step_once():
    assert L.discover_sql().count("'scheme'") == 2  # the base's parts and the reference's


def test_rooted_references_match_stdlib(spark):
    refs = ["/", "/a/b/", "/a?x=/../y#/./z", "/.a/b", "/a/..b/../c", "/a/.", "/a/..", "/a//b", "/?q", "/#f", "/ä b", "\n /a\tb", "/a/.b"]
    df = spark.createDataFrame(list(itertools.product(BASES, refs)), "base string, ref string")
    got = df.select("base", "ref", F.expr(L.url_join_sql("base", "ref")).alias("j")).collect()
    assert not [r for r in got if r.j != urljoin(r.base, r.ref)]
