"""Link discovery (L1-L14): listing pages -> course URLs.

Per page, the anchors are filtered and resolved with array expressions over
the page's own ``elems`` (narrow: no shuffle); per-source behaviour comes from
a rule table of 18 rows (``rules.SOURCE_RULES``), broadcast to the page rows.
Only "drop every start URL" (L9) needs a join, against the set of listing
page URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules
from ..functions.selectors import elem_at_sql, elem_text_sql, let_sql as let, lit, var

SELECTOR_TYPE = T.ArrayType(T.StructType([
    T.StructField(k, T.StringType()) for k in ("href_contains", "href_prefix", "class_eq",
                                               "anc_tag", "anc_class")]))
RULE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("university_name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("r_selectors", SELECTOR_TYPE),
    T.StructField("r_href_any", T.ArrayType(T.StringType())),
    T.StructField("r_drop_schemes", T.BooleanType()),
    T.StructField("r_includes", T.ArrayType(T.StringType())),
    T.StructField("r_excludes", T.ArrayType(T.StringType())),
    T.StructField("r_abs_contains", T.StringType()),
    T.StructField("r_abs_plain", T.BooleanType()),
    T.StructField("r_abs_any", T.ArrayType(T.StringType())),
    T.StructField("r_canonical", T.BooleanType()),
    T.StructField("r_exclude_self", T.BooleanType()),
    T.StructField("r_exclude_start", T.BooleanType()),
    T.StructField("r_href_not", T.StringType()),
    T.StructField("r_pat_all", T.ArrayType(T.StringType())),
    T.StructField("r_pat_any", T.ArrayType(T.StringType())),
    T.StructField("r_dedup", T.BooleanType()),
])


def rule_rows(spec: list[dict] | None = None) -> list[tuple]:
    rows = []
    for r in (spec or rules.SOURCE_RULES):
        sels = r.get("selectors")
        pat = r.get("url_patterns") or {}
        rows.append((
            r["source"], r["university_name"], r["location"],
            [tuple(s.get(k) for k in ("href_contains", "href_prefix", "class_eq", "anc_tag",
                                      "anc_class")) for s in sels] if sels is not None else None,
            r.get("href_any"), bool(r.get("drop_schemes")), r.get("includes"), r.get("excludes"),
            r.get("abs_contains"), bool(r.get("abs_plain")), r.get("abs_any"),
            bool(r.get("canonical")), bool(r.get("exclude_self")), bool(r.get("exclude_start")),
            r.get("href_not"), pat.get("all"), pat.get("any"), bool(r.get("dedup")),
        ))
    return rows


def rules_frame(spark: SparkSession, spec: list[dict] | None = None) -> DataFrame:
    """The per-source rule table (fixed size: one row per source)."""
    return spark.createDataFrame(rule_rows(spec), RULE_SCHEMA)


# --- URL resolution (L6) -------------------------------------------------------

_URL_RE = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"


def _group_sql(u: str, n: int) -> str:
    return f"regexp_extract({u}, {lit(_URL_RE)}, {n})"


def _parts_sql(u: str) -> str:
    """RFC 3986 split of URL expression ``u`` into a struct (regex run once per part)."""
    return (f"named_struct('scheme', {_group_sql(u, 2)}, 'netloc', {_group_sql(u, 4)}, 'path', {_group_sql(u, 5)}, "
            f"'qpart', {_group_sql(u, 6)}, 'fpart', {_group_sql(u, 8)})")


def _rooted_sql(r: str) -> str:
    """Whether ``r`` is a path from the root without segments that begin with a dot (and no line breaks):
    it is put behind the host as it stands."""
    return (f"startswith({r}, '/') AND NOT startswith({r}, '//') AND NOT contains({r}, '/.') "
            f"AND NOT {r} RLIKE {lit(r'[\x{85}\x{2028}\x{2029}]')}")


def remove_dots_sql(segs: str, squeeze: bool) -> str:
    """Resolve '.' and '..' in a segment array the way ``urljoin`` does.

    ``squeeze`` drops empty inner segments (done for relative references only).
    The result always starts with '/', as the URL is re-assembled with a host.
    """
    def body(sg):
        acc, s_, mid = var("acc"), var("s"), var("m")
        cleaned = (f"CASE WHEN size({sg}) > 2 THEN concat(slice({sg}, 1, 1), "
                   f"filter(slice({sg}, 2, size({sg}) - 2), {mid} -> {mid} != ''), "
                   f"slice({sg}, -1, 1)) ELSE {sg} END") if squeeze else sg
        resolved = (f"aggregate({cleaned}, CAST(array() AS array<string>), ({acc}, {s_}) -> "
                    f"CASE WHEN {s_} = '..' THEN slice({acc}, 1, greatest(size({acc}) - 1, 0)) "
                    f"WHEN {s_} = '.' THEN {acc} ELSE concat({acc}, array({s_})) END)")
        tail = lambda res: (f"CASE WHEN element_at({sg}, -1) IN ('.', '..') "  # noqa: E731
                            f"THEN concat({res}, array('')) ELSE {res} END")
        joined = lambda t: f"coalesce(nullif(array_join({t}, '/'), ''), '/')"
        return let(resolved, lambda res: let(joined(tail(res)), lambda j:
                   f"CASE WHEN startswith({j}, '/') THEN {j} ELSE concat('/', {j}) END"))
    return let(segs, body)


def url_join_sql(base: str, ref: str) -> str:
    """``urllib.parse.urljoin(base, ref)`` for http(s) bases, as a SQL expression."""
    # leading C0 controls and blanks are stripped, tabs and line breaks removed
    def clean(x):
        return (f"CASE WHEN {x} RLIKE '^[\\\\x00-\\\\x20]|[\\\\t\\\\r\\\\n]' THEN regexp_replace(regexp_replace({x}, "
                f"'^[\\\\x00-\\\\x20]+', ''), '[\\\\t\\\\r\\\\n]', '') ELSE {x} END")

    def with_parts(b, r, p):
        auth = f"concat({b}.scheme, '://', {b}.netloc)"
        base_dir = f"split({b}.path, '/')"
        base_parts = (f"CASE WHEN element_at({base_dir}, -1) != '' "
                      f"THEN slice({base_dir}, 1, size({base_dir}) - 1) ELSE {base_dir} END")
        abs_path = remove_dots_sql(f"split({p}.path, '/')", squeeze=False)
        rel_path = remove_dots_sql(f"concat({base_parts}, split({p}.path, '/'))", squeeze=True)
        return (
            f"CASE WHEN {r} = '' THEN {base} "
            f"WHEN {r} RLIKE '^[a-zA-Z][a-zA-Z0-9+.-]*:' AND "
            f"lower({p}.scheme) != lower({b}.scheme) THEN {r} "
            f"WHEN {r} RLIKE '^[a-zA-Z][a-zA-Z0-9+.-]*://' THEN "
            f"concat(lower({p}.scheme), substring({r}, length({p}.scheme) + 1)) "
            f"WHEN {r} RLIKE '^//' THEN concat({b}.scheme, ':', {r}) "
            f"WHEN {p}.path = '' THEN concat({auth}, {b}.path, "
            f"CASE WHEN {p}.qpart != '' THEN {p}.qpart "
            f"WHEN {b}.qpart != '' THEN {b}.qpart ELSE '' END, {p}.fpart) "
            f"WHEN {p}.path RLIKE '^/' THEN concat({auth}, {abs_path}, {p}.qpart, {p}.fpart) "
            f"ELSE concat({auth}, {rel_path}, {p}.qpart, {p}.fpart) END")

    # most references are plain rooted paths, for which neither URL is taken apart
    return let(clean(ref), lambda r: (
        f"CASE WHEN {_rooted_sql(r)} THEN concat({_group_sql(base, 2)}, '://', {_group_sql(base, 4)}, {r}) ELSE "
        + let(_parts_sql(base), lambda b: let(_parts_sql(r), lambda p: with_parts(b, r, p))) + " END"))


def url_join(base: Column | str, ref: Column | str) -> Column:
    """L6 as a Column: resolve ``ref`` against ``base`` (both column names)."""
    return F.expr(url_join_sql(base if isinstance(base, str) else base._jc.toString(),
                               ref if isinstance(ref, str) else ref._jc.toString()))


def canonical_sql(u: str) -> str:
    """Cut at '#', strip trailing '/'."""
    return f"regexp_replace(substring_index({u}, '#', 1), '/+$', '')"


def canonical(u: Column | str) -> Column:
    return F.expr(canonical_sql(u if isinstance(u, str) else u._jc.toString()))


# --- per-page anchor arrays ---------------------------------------------------------

def _selector_match_sql(e: str, sels: str) -> str:
    s = var("s")
    one = (f"(({s}.href_contains IS NULL OR contains({e}.attrs['href'], {s}.href_contains)) AND "
           f"({s}.href_prefix IS NULL OR startswith({e}.attrs['href'], {s}.href_prefix)) AND "
           f"({s}.class_eq IS NULL OR array_contains({e}.classes, {s}.class_eq)) AND "
           f"({s}.anc_tag IS NULL OR array_contains({e}.within, "
           f"concat({s}.anc_tag, '.', coalesce({s}.anc_class, '')))))")
    return f"({sels} IS NULL OR exists({sels}, {s} -> {one}))"


def hrefs_sql(sels: str | None = None) -> str:
    """href of every <a href> (matching the selector array column ``sels``), in order."""
    e, e2 = var("e"), var("e")
    cond = f"{e}.tag = 'a' AND map_contains_key({e}.attrs, 'href')"
    if sels:
        cond += f" AND {_selector_match_sql(e, sels)}"
    return f"transform(filter(elems, {e} -> {cond}), {e2} -> {e2}.attrs['href'])"


def _any_sql(x: str, arr: str) -> str:
    p = var("p")
    return f"exists({arr}, {p} -> contains({x}, {p}))"


def scheme_ok_sql(h: str) -> str:
    """L3: not empty and not tel:/mailto:/javascript:/# (case-sensitive prefixes)."""
    prefixes = " OR ".join(f"startswith({h}, {lit(x)})" for x in rules.UNSAFE_HREF_SCHEMES)
    return f"({h} != '' AND NOT ({prefixes}))"


def discover_sql(page_url: str = "url") -> str:
    """The per-page resolved link array under the row's rule columns (r_*)."""
    h = var("h")
    hrefs = hrefs_sql("r_selectors")
    keep = (f"((r_href_any IS NULL OR {_any_sql(h, 'r_href_any')}) "
            f"AND (NOT r_drop_schemes OR {scheme_ok_sql(h)}) "
            f"AND (r_includes IS NULL OR {_any_sql(h, 'r_includes')}) "
            f"AND (r_excludes IS NULL OR NOT {_any_sql(h, 'r_excludes')}) "
            f"AND (r_href_not IS NULL OR {h} != r_href_not))")
    chosen = f"filter({hrefs}, {h} -> {keep})"
    g = var("h")
    pattern_hrefs = (f"CASE WHEN r_pat_all IS NULL THEN CAST(array() AS array<string>) ELSE "
                     f"filter({hrefs_sql()}, {g} -> forall(r_pat_all, q -> contains({g}, q)) "
                     f"AND {_any_sql(g, 'r_pat_any')}) END")
    # each step stands in the expression once: a copy in every branch would be planned for each of them
    both = let(chosen, lambda c: f"CASE WHEN r_pat_all IS NULL THEN {c} ELSE array_distinct(concat({c}, {pattern_hrefs})) END")
    x, a = var("x"), var("u")
    target = let(url_join_sql(page_url, x), lambda u: f"CASE WHEN r_canonical THEN {canonical_sql(u)} ELSE {u} END")
    resolved = f"transform({both}, {x} -> {target})"
    page_canon = f"regexp_replace({page_url}, '/+$', '')"
    abs_keep = (f"((r_abs_contains IS NULL OR contains({a}, r_abs_contains)) "
                f"AND (NOT r_exclude_self OR regexp_replace({a}, '/+$', '') != {page_canon}) "
                f"AND (NOT r_abs_plain OR NOT ({a} LIKE '%?%' OR {a} LIKE '%#%')) "
                f"AND (r_abs_any IS NULL OR {_any_sql(a, 'r_abs_any')}))")
    kept = f"filter({resolved}, {a} -> {abs_keep})"
    return let(kept, lambda k: f"CASE WHEN r_dedup THEN array_distinct({k}) ELSE {k} END")


def with_rules(parsed: DataFrame, rule_table: DataFrame, source_col: str = "source") -> DataFrame:
    """Attach each page's source rule (broadcast: the rule table has one row per source)."""
    r = rule_table.withColumnRenamed("source", "_rule_source")
    return (parsed.join(F.broadcast(r), parsed[source_col] == r["_rule_source"], "inner")
            .drop("_rule_source"))


def with_one_rule(parsed: DataFrame, spec: dict) -> DataFrame:
    """One source's rule on every page, as literals (no join)."""
    values = dict(zip(RULE_SCHEMA.names, rule_rows([spec])[0]))
    cols = {"source": F.lit(values["source"])}
    for f in RULE_SCHEMA.fields[1:]:
        v = values[f.name]
        if isinstance(v, list):
            v = F.array(*[F.struct(*[F.lit(x).cast("string") for x in e]) if isinstance(e, tuple) else F.lit(e)
                          for e in v])
        cols[f.name] = (v if isinstance(v, Column) else F.lit(v)).cast(f.dataType)
    return parsed.withColumns(cols)


def discover_links(parsed_with_rules: DataFrame, start_urls: DataFrame | None = None) -> DataFrame:
    """(page_id, source, pos, url) for every course link of every listing page.

    ``start_urls`` (source, url): listing pages whose URL must not come back as a
    course link for sources with ``exclude_start`` (L9, trailing '/' ignored).
    """
    links = (parsed_with_rules
             .select("page_id", "source", "r_exclude_start",
                     F.posexplode(F.expr(discover_sql("url"))).alias("pos", "url"))
             .withColumn("pos", F.col("pos") + 1))
    if start_urls is not None:
        starts = start_urls.select(F.col("source").alias("_s_source"),
                                   F.regexp_replace("url", "/+$", "").alias("_s_url"),
                                   F.lit(0).cast("long").alias("_s_part")).hint("shuffle_hash")
        # a null key meets nothing: links of other sources pass by without being compared
        key = F.when(links.r_exclude_start, F.regexp_replace(links.url, "/+$", ""))
        # and they are dealt by their page, so that they do not gather where the null key goes; links
        # are many for each start URL and are not sorted
        links = links.withColumns({"_key": key, "_part": F.when(key.isNotNull(), F.lit(0).cast("long"))
                                   .otherwise(F.xxhash64("page_id"))})
        links = links.join(starts, (links._key == starts._s_url) & (links.source == starts._s_source)
                           & (links._part == starts._s_part), "left_anti").drop("_key", "_part")
    return links.drop("r_exclude_start")


# --- single-operator forms over the exploded link table ---------------------------

def anchor_rows(parsed: DataFrame) -> DataFrame:
    """(page_id, url, href, text) of every <a href>: candidate items of a listing page."""
    e, e2 = var("e"), var("e")
    arr = (f"transform(filter(elems, {e} -> {e}.tag = 'a' AND map_contains_key({e}.attrs, 'href')), {e2} -> "
           f"named_struct('href', {e2}.attrs['href'], 'text', {elem_text_sql(e2, '', False)}))")
    return parsed.select("page_id", "url", F.explode(F.expr(arr)).alias("a")).select("page_id", "url", "a.*")


def links_all(parsed: DataFrame) -> DataFrame:
    """L1: (page_id, pos, href) of every <a href> in document order (pos from 1)."""
    return (parsed.select("page_id", "url", F.posexplode(F.expr(hrefs_sql())).alias("pos", "href"))
            .withColumn("pos", F.col("pos") + 1))


def scheme_filter(links: DataFrame, href: str = "href") -> DataFrame:
    """L3."""
    return links.filter(F.expr(scheme_ok_sql(href)))


def include_exclude(links: DataFrame, includes: list[str], excludes: list[str],
                    href: str = "href") -> DataFrame:
    """L4+L5: keep if any include occurs, then drop if any exclude occurs (plain substrings)."""
    h = F.col(href)
    inc = F.lit(False)
    for p in includes:
        inc = inc | h.contains(p)
    exc = F.lit(False)
    for p in excludes:
        exc = exc | h.contains(p)
    return links.filter(inc & ~exc)


def pages_status_filter(pages: DataFrame, status: str = "status") -> DataFrame:
    """Drop pages fetched with the blocked status (403)."""
    return pages.filter(F.col(status).isNull() | (F.col(status) != rules.BLOCKED_STATUS))


def next_page_link(parsed: DataFrame, selector: dict | None) -> DataFrame:
    """First element matching the next-page selector, resolved; none if unset."""
    if not selector:
        return parsed.select("page_id").filter(F.lit(False)).withColumn("next_url", F.lit(None).cast("string"))
    from ..functions.selectors import first_index_sql
    ix = first_index_sql(selector)
    href = f"{elem_at_sql(ix)}.attrs['href']"
    return (parsed.select("page_id", F.expr(f"CASE WHEN {href} IS NOT NULL THEN "
                                            f"{url_join_sql('url', href)} END").alias("next_url"))
            .filter(F.col("next_url").isNotNull()))


def partner_override(parsed: DataFrame, university_col: str = "university_name") -> DataFrame:
    """L14: '.course-partner-logo img' alt text -> 'OIEG - <alt>' as university name."""
    from ..functions.selectors import first_index_sql
    ix = first_index_sql({"tag": "img", "ancestor_class": rules.PARTNER_LOGO_CLASS})
    alt = f"nullif({elem_at_sql(ix)}.attrs['alt'], '')"
    return parsed.withColumn(university_col, F.expr(
        f"coalesce(concat({lit(rules.PARTNER_PREFIX)}, {alt}), {university_col})"))
