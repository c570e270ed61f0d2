"""Registered link-discovery queries.

Listing all links, resolving them, first-wins dedup, the status filter and the
next-page link run on the driver ``pages`` table; their oracle hrefs come from a
regular expression over the HTML (those anchors carry only an ``href``).  The
rules that need course links run on the listing pages rendered from the
catalogue (``sources.listing``), whose links take every form the 18 source
rules tell apart; their oracle restates the anchors in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..operators import links as L
from ..operators.html import parsed_pages
from ..sources.listing import LINK_FORMS, NAV, OPEN_DAY, PAGE_LINKS, SOURCES, listing_pages, start_urls
from ..sources.tables import scan_pages
from .oracle_base import with_catalogue
from .registry import register

MIDDLESEX = next(r for r in rules.SOURCE_RULES if r["source"] == "middlesex")


#: what link rules read of an element
LINK_FIELDS = ("tag", "classes", "attrs", "within")


def _parsed(spark, d):
    return parsed_pages(scan_pages(spark, d), fields=LINK_FIELDS, texts=False, hits=False)


def _listed(spark, d):
    return parsed_pages(listing_pages(spark, d), fields=LINK_FIELDS, texts=False, hits=False)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_HREFS = """
anchors AS (
  SELECT page_id, url, unnest(generate_series(1, len(hs))) AS pos, unnest(hs) AS href
  FROM (SELECT page_id, url,
               list_transform(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1),
                 lambda h: replace(replace(replace(replace(replace(h, '&quot;', '"'), '&copy;', '©'),
                   '&middot;', '·'), '&#39;', ''''), '&amp;', '&')) AS hs
        FROM pages)
),
resolved AS (
  SELECT *, CASE WHEN href = '' THEN url
                 WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
                 THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href END AS abs_url
  FROM anchors
)"""


def _scheme_ok(h: str) -> str:
    return (f"({h} <> '' AND NOT (" + " OR ".join(f"starts_with({h}, {_q(x)})"
                                                   for x in rules.UNSAFE_HREF_SCHEMES) + "))")


def _any(h: str, words) -> str:
    return "(" + " OR ".join(f"strpos({h}, {_q(w)}) > 0" for w in words) + ")" if words else "false"


def _listing_anchors_sql() -> str:
    """The anchors of the rendered listing pages, in document order, and what they resolve to."""
    srcs = "[" + ", ".join(_q(s) for s in SOURCES) + "]"
    host = "'https://www.university-' || CAST(suppkey AS VARCHAR) || '.example.ac.uk'"
    path = "'/courses/undergraduate/page-' || CAST({} AS VARCHAR)"
    none = "CAST(NULL AS VARCHAR)"
    fixed = [(_q(h), none, "false", t) for h, t in NAV] + [
        (path.format("(page_no + 1) % npages"), "'next'", "true", "Next"),
        (path.format("page_no") + " || '/'", none, "true", "This page"),
        *[(_q(OPEN_DAY), "'course-link'", "true", "Open day")] * 2]
    fixed_rows = "\n".join(
        f"  UNION ALL SELECT suppkey, page_no, {h}, {c}, {i + 1}, {m}, false, {_q(t)} FROM lpage"
        for i, (h, c, m, t) in enumerate(fixed))
    n = len(LINK_FORMS)
    sec = ("CASE WHEN lvl = 'undergraduate' THEN 'undergraduate' WHEN lvl = 'research' "
           "THEN 'research-degrees' ELSE 'postgraduate' END || '/' || ")
    hrefs = " ".join(f"WHEN {i} THEN {_q(p)} || {sec if s else ''}CAST(c.l_partkey AS VARCHAR) || {_q(x)}"
                     for i, (p, s, x, _c, _d) in enumerate(LINK_FORMS))
    classes = " ".join(f"WHEN {i} THEN {_q(c)}" for i, (_p, _s, _x, c, _d) in enumerate(LINK_FORMS) if c)
    cards = ", ".join(str(i) for i, f in enumerate(LINK_FORMS) if f[4])
    return f"""
lpages AS (SELECT l_suppkey, CAST(ceil(count(*) / {PAGE_LINKS}.0) AS BIGINT) AS npages
           FROM facts GROUP BY l_suppkey),
lcourse AS (
  SELECT c.l_suppkey AS suppkey, c.l_partkey % p.npages AS page_no, p.npages,
         CASE c.l_partkey % {n} {hrefs} END AS href, CASE c.l_partkey % {n} {classes} END AS cls,
         c.l_partkey % {n} IN ({cards}) AS in_card, c.l_partkey AS o,
         c.p_name AS txt
  FROM cbase2 c JOIN lpages p ON c.l_suppkey = p.l_suppkey
),
lpage AS (SELECT DISTINCT suppkey, page_no, npages FROM lcourse),
lall AS (
  SELECT suppkey, page_no, href, cls,
         {len(fixed)} + row_number() OVER (PARTITION BY suppkey, page_no ORDER BY o) AS pos,
         true AS in_main, in_card, txt
  FROM lcourse
{fixed_rows}
),
listed AS (
  SELECT suppkey || '-' || page_no AS page_id, {host} || {path.format("page_no")} AS url,
         {srcs}[suppkey % {len(SOURCES)} + 1] AS source, suppkey, pos, href, cls, in_main, in_card, txt
  FROM lall
),
resolved AS (
  SELECT *, CASE WHEN starts_with(href, '/') THEN {host} || href
                 WHEN href = '' OR starts_with(href, '#') THEN url || href
                 ELSE href END AS abs_url
  FROM listed
)"""


LISTED_SQL = with_catalogue("", extra=_listing_anchors_sql()).rstrip()


@register("links_all", "WITH " + _HREFS.strip() + " SELECT page_id, pos, href FROM anchors")
def q_links_all(spark, d):
    return L.links_all(_parsed(spark, d)).select("page_id", "pos", "href")


@register("links_scheme_filter", LISTED_SQL
          + f" SELECT page_id, pos, href FROM listed WHERE {_scheme_ok('href')}")
def q_links_scheme(spark, d):
    return L.scheme_filter(L.links_all(_listed(spark, d))).select("page_id", "pos", "href")


ST_GEORGES = next(r for r in rules.SOURCE_RULES if r["source"] == "st_georges")


@register("links_include_exclude", LISTED_SQL + f"""
SELECT page_id, pos, href FROM listed
WHERE {_scheme_ok('href')} AND {_any('href', ST_GEORGES['includes'])}
  AND NOT {_any('href', ST_GEORGES['excludes'])}""")
def q_links_include_exclude(spark, d):
    links = L.scheme_filter(L.links_all(_listed(spark, d)))
    return L.include_exclude(links, ST_GEORGES["includes"], ST_GEORGES["excludes"]).select(
        "page_id", "pos", "href")


def _resolved(parsed):
    links = L.links_all(parsed)
    return links.withColumn("abs_url", L.url_join("url", "href"))


@register("links_resolve", "WITH " + _HREFS.strip() + " SELECT page_id, pos, href, abs_url FROM resolved")
def q_links_resolve(spark, d):
    return _resolved(_parsed(spark, d)).select("page_id", "pos", "href", "abs_url")


@register("links_dedup", "WITH " + _HREFS.strip() + """
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY first_pos) AS pos, abs_url AS url
FROM (SELECT page_id, abs_url, min(pos) AS first_pos FROM resolved GROUP BY page_id, abs_url)""")
def q_links_dedup(spark, d):
    p = _parsed(spark, d)
    arr = F.expr(f"array_distinct(transform({L.hrefs_sql()}, h -> {L.url_join_sql('url', 'h')}))")
    return (p.select("page_id", F.posexplode(arr).alias("pos", "url"))
            .withColumn("pos", F.col("pos") + 1))


@register("links_canonical", LISTED_SQL + """
SELECT page_id, pos, regexp_replace(split_part(abs_url, '#', 1), '/+$', '') AS canonical_url
FROM resolved""")
def q_links_canonical(spark, d):
    return _resolved(_listed(spark, d)).select("page_id", "pos", L.canonical("abs_url").alias("canonical_url"))


@register("links_exclude_start", LISTED_SQL + """
SELECT r.page_id, r.pos, r.abs_url FROM resolved r
WHERE NOT EXISTS (SELECT 1 FROM listed p
                  WHERE regexp_replace(p.url, '/+$', '') = regexp_replace(r.abs_url, '/+$', ''))""")
def q_links_exclude_start(spark, d):
    """Links that point back at any listing page (start URL) are dropped."""
    # the key is a column, not an expression that a sort would evaluate for each comparison; the
    # links, many for each start URL, are not sorted at all
    links = _resolved(_listed(spark, d)).withColumn("_key", F.regexp_replace("abs_url", "/+$", ""))
    starts = start_urls(spark, d).select(F.regexp_replace("url", "/+$", "").alias("_start")).hint("shuffle_hash")
    return (links.join(starts, links._key == starts._start, "left_anti")
            .select("page_id", "pos", "abs_url"))


@register("links_detail_only", LISTED_SQL + f"""
SELECT page_id, pos, abs_url FROM resolved
WHERE strpos(abs_url, '/courses/') > 0 AND strpos(abs_url, '?') = 0 AND strpos(abs_url, '#') = 0
  AND {_any('abs_url', MIDDLESEX['abs_any'])}""")
def q_links_detail_only(spark, d):
    """Detail-page URL tests on resolved links."""
    r = _resolved(_listed(spark, d))
    a = F.col("abs_url")
    anyc = F.lit(False)
    for t in MIDDLESEX["abs_any"]:
        anyc = anyc | a.contains(t)
    return (r.filter(a.contains("/courses/") & ~a.contains("?") & ~a.contains("#") & anyc)
            .select("page_id", "pos", "abs_url"))


def _sel_cond(s: dict) -> str | None:
    """SQL for one selector over an anchors row; None where no listing page has such a container."""
    c = []
    if s.get("class_eq"):
        c.append(f"coalesce(cls = {_q(s['class_eq'])}, false)")
    if s.get("anc_tag"):
        if s["anc_tag"] == "main" and not s.get("anc_class"):
            c.append("in_main")
        elif s["anc_tag"] == "div" and s.get("anc_class") == "course-item":
            c.append("in_card")
        else:
            return None
    if s.get("href_contains"):
        c.append(f"strpos(href, {_q(s['href_contains'])}) > 0")
    if s.get("href_prefix"):
        c.append(f"starts_with(href, {_q(s['href_prefix'])})")
    return "(" + " AND ".join(c) + ")"


def _selected(selectors: list[dict]) -> str:
    alts = [c for c in (_sel_cond(s) for s in selectors) if c]
    return "(" + " OR ".join(alts) + ")" if alts else "false"


def _discover_sql(with_starts: bool) -> str:
    """Every source's link rule over the anchors of the listing pages."""
    parts = []
    for r in rules.SOURCE_RULES:
        keep = [_selected(r["selectors"]) if r.get("selectors") is not None else "true"]
        if r.get("href_any"):
            keep.append(_any("href", r["href_any"]))
        if r.get("drop_schemes"):
            keep.append(_scheme_ok("href"))
        if r.get("includes"):
            keep.append(_any("href", r["includes"]))
        if r.get("excludes"):
            keep.append("NOT " + _any("href", r["excludes"]))
        if r.get("href_not"):
            keep.append(f"href <> {_q(r['href_not'])}")
        chosen, late = "(" + " AND ".join(keep) + ")", "0"
        pat = r.get("url_patterns")
        if pat:  # links found only by the URL patterns follow those of the selectors
            late = f"CASE WHEN {chosen} THEN 0 ELSE 1 END"
            chosen = "(" + chosen + " OR (" + " AND ".join(
                [f"strpos(href, {_q(w)}) > 0" for w in pat["all"]] + [_any("href", pat["any"])]) + "))"
        u = "abs_url"
        if r.get("canonical"):
            u = "regexp_replace(split_part(abs_url, '#', 1), '/+$', '')"
        abs_conds = []
        if r.get("abs_contains"):
            abs_conds.append(f"strpos({u}, {_q(r['abs_contains'])}) > 0")
        if r.get("exclude_self"):
            abs_conds.append(f"regexp_replace({u}, '/+$', '') <> regexp_replace(url, '/+$', '')")
        if r.get("abs_plain"):
            abs_conds.append(f"strpos({u}, '?') = 0 AND strpos({u}, '#') = 0")
        if r.get("abs_any"):
            abs_conds.append(_any(u, r["abs_any"]))
        dropped = "false"
        if r.get("exclude_start") and with_starts:
            dropped = f"regexp_replace({u}, '/+$', '') IN (SELECT url FROM starts WHERE source = {_q(r['source'])})"
        where = " AND ".join([f"source = {_q(r['source'])}", chosen] + abs_conds)
        parts.append(f"SELECT page_id, source, {late} AS late, pos AS apos, {u} AS url, {dropped} AS dropped, "
                     f"{'true' if r.get('dedup') else 'false'} AS dd FROM resolved a WHERE {where}")
    union = "\nUNION ALL\n".join(parts)
    return LISTED_SQL + f""",
starts AS (SELECT DISTINCT url, source FROM listed),
cand AS ({union}),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY late, apos) AS k FROM cand)
  WHERE NOT dd OR k = 1
),
placed AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY late, apos) AS pos FROM firsts)
SELECT page_id, source, pos, url FROM placed WHERE NOT dropped"""


def _ruled(spark, d, only: list[dict] | None = None):
    return L.with_rules(_listed(spark, d), L.rules_frame(spark, only))


@register("discover_links", _discover_sql(with_starts=False))
def q_discover_links(spark, d):
    """L1-L8, L10, L11 with every source's rule: what each listing page yields by itself."""
    return L.discover_links(_ruled(spark, d)).select("page_id", "source", "pos", "url")


@register("discover_course_links", _discover_sql(with_starts=True))
def q_discover_course_links(spark, d):
    """L1-L11 with every source's rule: the course-link job of all listing pages."""
    return L.discover_links(_ruled(spark, d), start_urls(spark, d)).select("page_id", "source", "pos", "url")


BROOKES = next(r for r in rules.SOURCE_RULES if r["source"] == "brookes")
QUB = next(r for r in rules.SOURCE_RULES if r["source"] == "qub")


@register("links_by_selector", LISTED_SQL + f"""
SELECT page_id, pos, href FROM (
  SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS pos
  FROM listed WHERE {_selected(BROOKES['selectors'])})
WHERE {_any('href', BROOKES['href_any'])}""")
def q_links_by_selector(spark, d):
    """L2: a selector union (positions count its anchors), then the href post-filter."""
    names = ("href_contains", "href_prefix", "class_eq", "anc_tag", "anc_class")
    sels = F.array(*[F.struct(*[F.lit(v).cast("string").alias(k) for k, v in zip(names, s)])
                     for s in L.rule_rows([BROOKES])[0][3]])
    out = (_listed(spark, d).withColumn("r_sel", sels)
           .select("page_id", F.posexplode(F.expr(L.hrefs_sql("r_sel"))).alias("pos", "href"))
           .withColumn("pos", F.col("pos") + 1))
    return out.filter(F.col("href").contains("/course/") | F.col("href").contains("/courses/"))


@register("links_union_strategies", LISTED_SQL + f"""
SELECT DISTINCT page_id, abs_url FROM resolved
WHERE {_selected(QUB['selectors'])}
   OR (strpos(href, '/courses/') > 0 AND (strpos(href, '/undergraduate/') > 0
       OR strpos(href, '/postgraduate-') > 0))""")
def q_links_union(spark, d):
    """Selector strategy union URL-pattern strategy, as a set (its dedup is per page)."""
    links = L.discover_links(L.with_one_rule(_listed(spark, d), QUB))
    return links.select("page_id", F.col("url").alias("abs_url"))


_STATUS = "CASE WHEN strpos(html, '</html>') > 0 THEN 200 ELSE 403 END"


@register("pages_status_filter", f"SELECT page_id, url FROM pages WHERE {_STATUS} <> 403")
def q_pages_status(spark, d):
    """Pages fetched as 403 are skipped; a page whose HTML was cut off before
    </html> stands for a blocked fetch here (the input has no status column)."""
    p = scan_pages(spark, d).withColumn(
        "status", F.when(F.col("html").contains("</html>"), F.lit(200)).otherwise(F.lit(403)))
    return L.pages_status_filter(p).select("page_id", "url")


@register("links_next_page", "WITH " + _HREFS.strip() + """
SELECT page_id, abs_url AS next_url FROM resolved WHERE pos = 1 AND abs_url IS NOT NULL""")
def q_links_next_page(spark, d):
    """L13 with a next-page selector of 'first a[href]'."""
    return L.next_page_link(_parsed(spark, d), {"tag": "a", "attr": "href"})


@register("partner_override", LISTED_SQL + " SELECT DISTINCT page_id, CASE WHEN suppkey % 3 = 0 "
          + "THEN 'OIEG - Partner ' || suppkey ELSE [" + ", ".join(
    _q(r["university_name"]) for r in rules.SOURCE_RULES) + f"][suppkey % {len(SOURCES)} + 1] END "
    "AS university_name FROM listed")
def q_partner_override(spark, d):
    """Partner logo alt text renames the university."""
    return L.partner_override(_ruled(spark, d)).select("page_id", "university_name")
