"""Page -> raw fields (the reference's extractor cases, with our own HTML)."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prospectus.operators import extract as X
from prospectus.operators import html as H
from prospectus.operators.html import parse_html, parsed_pages

PHYSICS_PAGE = """<html><head><title>Marine Physics, MEng with a year at sea</title>
<meta name="description" content="unused here"></head><body><main>
<section class="facts"><p>Home fee: £11,340 a year. UK applicants only.</p>
<p>Overseas and international fee: £27,950 a year</p>
<p class="start-date">Teaching begins in January 2027</p>
<p class="duration">Length: 4 years</p><p class="study-mode">Part-time or full-time</p></section>
<h1 class="course-title"> MEng Marine Physics </h1>
<article class="course-description">Waves, tides and the instruments that measure them.</article>
<aside><span class="ucas-code">F731</span><span class="department">Ocean Sciences</span>
<em>An IELTS score of 7.0 is asked for</em></aside>
<div id="entry-requirements">BBB with Physics at grade B</div></main></body></html>"""

BARE_PAGE = "<main><h1>Glass Making</h1></main>"

PRICES_PAGE = """<title>What it costs</title><h1>MA Ceramics</h1><table>
<tr><td>UK and home</td><td>UK students pay £12,075</td></tr>
<tr><td>Elsewhere</td><td>International students pay £21,460</td></tr></table>"""


def extract(spark, pages):
    rows = [(i, f"https://example.ac.uk/c/{i}", h) for i, h in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = X.extract_fields(parsed_pages(df), keep=["page_id"]).orderBy("page_id").collect()
    return [r.asDict() for r in out]


def test_every_field_of_a_page(spark):
    r = extract(spark, [PHYSICS_PAGE])[0]
    want = {"name": "MEng Marine Physics", "degree": "MEng", "department": "Ocean Sciences",
            "duration_years": 4.0, "ucas_code": "F731", "ielts_score": 7.0, "start_month": "January",
            "fee_uk_yearly": 11340, "fee_intl_yearly": 27950,
            "description": "Waves, tides and the instruments that measure them.",
            "entry_requirements": "BBB with Physics at grade B"}
    assert {k: r[k] for k in want} == want
    assert sorted(r["study_mode"]) == ["full-time", "part-time"]
    assert len(X.RAW_FIELDS) == 17 and set(X.RAW_FIELDS) <= set(r)


def test_page_with_a_heading_only(spark):
    r = extract(spark, [BARE_PAGE])[0]
    assert r["name"] == "Glass Making"
    assert r["ucas_code"] is None and r["duration_years"] is None
    assert r["level"] is None  # no title: counted as empty text
    assert r["study_mode"] == ["full-time"]


def test_prices_by_keyword(spark):
    r = extract(spark, [PRICES_PAGE])[0]
    assert (r["fee_uk_yearly"], r["fee_intl_yearly"]) == (12075, 21460)
    # sandwich keywords absent: the generic first-pound amount is used
    assert r["fee_uk_sandwich"] == r["fee_intl_sandwich"] == 12075


@pytest.mark.parametrize("text,expected", [
    ("18 months", 1.5), ("3 months", 0.2), ("9 months", 0.8), ("4 years", 4.0),
    ("1.5 years", 1.5), ("flexible", None),
    ("4-year programme", None)])  # the year pattern needs digits then blanks
def test_duration(spark, text, expected):
    r = extract(spark, [f'<html><body><h1>X course</h1><div class="duration">{text}</div></body></html>'])[0]
    assert r["duration_years"] == expected


def test_single_pound_amount_fills_all_fees(spark):
    r = extract(spark, ["<html><body><h1>Course A</h1><p>Fee: £1,000</p></body></html>"])[0]
    assert (r["fee_uk_yearly"], r["fee_intl_yearly"], r["fee_uk_sandwich"]) == (1000, 1000, 1000)


def test_pound_with_commas_only_is_null(spark):
    r = extract(spark, ["<html><body><h1>Course B</h1><p>UK fee £, to be confirmed</p></body></html>"])[0]
    assert r["fee_uk_yearly"] is None


def test_meta_name_and_programme_meta(spark):
    html = """<html><head><meta property="og:title" content=" Nursing BSc | Uni ">
    <meta name="programme:ucas_code" content="B740"><meta name="programme:duration" content="3 academic years">
    </head><body><h1>Other</h1></body></html>"""
    r = extract(spark, [html])[0]
    assert r["name"] == "Nursing BSc"
    assert r["ucas_code"] == "B740"
    assert r["duration_years"] == 3.0


def test_definition_list_and_node_scan(spark):
    html = """<html><body><h1>Law LLB</h1><dl><dt>UCAS code</dt><dd>M100</dd>
    <dt>Duration</dt><dd>2 years</dd><dt>Start</dt><dd>january</dd>
    <dt>Application deadline</dt><dd> 15 Jan </dd></dl></body></html>"""
    r = extract(spark, [html])[0]
    assert r["ucas_code"] == "M100"
    assert r["duration_years"] == 2.0
    assert r["start_month"] == "January"
    assert r["deadline_main"] == "15 Jan"


def test_ucas_text_node_scan(spark):
    html = "<html><body><h1>Maths</h1><p>Apply via UCAS using <b>G100</b></p></body></html>"
    assert extract(spark, [html])[0]["ucas_code"] == "G100"


def test_script_text_seen_by_late_deadline(spark):
    html = """<html><head><script>var late = "clearing closes 2026";</script></head>
    <body><h1>Course C</h1></body></html>"""
    r = extract(spark, [html])[0]
    assert r["deadline_late"] == 'var late = "clearing closes 2026";'


def test_nbsp_and_unclosed_tags(spark):
    html = "<html><body><h1>Art\xa0and  Design</h1><p>unclosed <b>bold<p>next</body>"
    r = extract(spark, [html])[0]
    assert r["name"] == "Art\xa0and  Design"  # raw text; normalisation collapses it
    from prospectus.functions.text import clean_str
    df = spark.createDataFrame([(r["name"],)], "x string")
    assert df.select(clean_str("x")).first()[0] == "Art and Design"


def test_entry_section_with_h2(spark):
    html = """<html><body><h1>Course D</h1><section><h2>Entry requirements</h2>
    <p>BBB</p></section></body></html>"""
    assert extract(spark, [html])[0]["entry_requirements"] == "Entry requirements BBB"


def test_tokenizer_structure():
    e, t = parse_html('<div class="a b"><p>x<p>y</div><script>var s="</p>";</script>')
    tags = [x["tag"] for x in e]
    assert tags == ["div", "p", "p", "script"]
    assert e[0]["classes"] == ["a", "b"]
    assert e[2]["parent"] == 0  # the second <p> closes the first
    assert t[-1]["kind"] == "raw" and t[-1]["text"] == 'var s="</p>";'


def test_quarantine_reports_whole_pages_too(spark, tmp_path):
    from prospectus.plans import extract_queries as EQ
    html = "cast(concat(cast(repeat('<p>a</p>', 20) as binary), unhex('{}'), cast('<p>b</p>' as binary)) as string)"
    rows = [(1, html.format("FF")), (2, html.format("C3A9")), (3, "repeat('é', 3)")]
    pages = " union all ".join(f"select {i}L page_id, 'u{i}' url, {h} html" for i, h in rows)
    spark.sql(pages).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in EQ.q_extract_quarantine(spark, str(tmp_path)).collect())
    assert got == [(1, "UnicodeDecodeError"), (3, "UnicodeDecodeError")]


ODD_PAGES = ["<title>t</title><h1 class='a course-title'>n</h1><dl><dt>UCAS code</dt><dd>A100</dd><dt>Length</dt><dd>3</dd></dl>",
             "<div class='programme-header'><p><h1>x</h1></div><h1 class='coursework'>y</h1><section><p>no</p></section>"
             "<section><h2>Entry</h2>z</section>", "<dd>lone</dd><b data-ucas=''>q</b><i id=overview class='my-length start'>r", None,
             "<meta name=a content=1><div id=entry-requirements class='faculty faculty'></div><dt>Start</dt><p>-</p><dd>w</dd>"]


def test_noted_elements_are_those_of_the_selectors(spark):
    """The first element that the tokenizer notes for a selector is the first of all that match it."""
    from prospectus import rules
    from prospectus.functions import selectors as S
    specs = [spec for rs in rules.SELECTOR_RULES.values() for _css, spec in rs] + [{"tag": "meta"}, {"tag": "title"}]
    df = spark.createDataFrame(list(enumerate(ODD_PAGES)), "page_id long, html string")
    p = parsed_pages(df)
    noted = p.select(*[F.expr(S.first_hit_sql(k, spec)).alias(f"k{k}") for k, spec in enumerate(specs)]).collect()
    plain = p.select(*[F.expr(S.first_index_sql(spec)).alias(f"k{k}") for k, spec in enumerate(specs)]).collect()
    assert noted == plain and sum(v is not None for r in noted for v in r) > 15


def test_only_the_fields_asked_for_leave_the_tokenizer(spark):
    df = spark.createDataFrame(list(enumerate(ODD_PAGES)), "page_id long, html string")
    few = parsed_pages(df, fields=("tag", "end", "t0", "t1", "prev"))
    assert few.schema["elems"].dataType.elementType.names == ["tag", "end", "t0", "t1", "prev"]
    cols = [X.extract_department(), X.extract_entry_requirements()]
    assert X.stage_inputs(few, ["page_id"]).select(*cols).collect() == X.stage_inputs(parsed_pages(df), ["page_id"]).select(*cols).collect()


def test_pages_without_elements_give_the_same_texts(spark):
    """Fields whose selectors look at an element alone need its text range only."""
    df = spark.createDataFrame(list(enumerate([*ODD_PAGES, PHYSICS_PAGE, PRICES_PAGE, "<script class='level'>s</script><div class=department>"
                                               "a<script>b</script> <!--c--> d</div>"])), "page_id long, html string")
    bare = parsed_pages(df, fields=())
    assert "elems" not in bare.columns
    cols = [X.extract_degree(), X.extract_level(), X.extract_department(), X.title_text(), *X.extract_fees().values()]
    got = X.stage_inputs(bare, ["page_id"]).select("page_id", "_txt_level", *cols).collect()
    assert got == X.stage_inputs(parsed_pages(df), ["page_id"]).select("page_id", "_txt_level", *cols).collect()
    assert [r._txt_department for r in X.stage_inputs(bare, ["page_id"]).collect()][-1] == "a d"
    assert got[-1]._txt_level == "s"


PRICED = ["UK £1,200\nhome £5", "home 12 £,\nuk £ 7", "UK\n£3", "£4 uk £", "uk £ 9 Home £8", "no price", "£££6 home/EU £1", None, "",
          "domestic £\n\n2,5 x", "K uk£,,"]


def test_fees_by_stretches_match_the_patterns(spark):
    """One cut at the pound signs gives what a pattern for each keyword finds."""
    import re

    from prospectus import rules
    from prospectus.functions.fields import fee_from_parts, priced_parts

    def plain(text):
        for p in [*[re.escape(k) + r"[^\n£]*£\s*([\d,]+)" for k in rules.FEE_UK_KEYWORDS], r"£\s*([\d,]+)"]:
            m = re.search(p, text or "", re.I)
            if m:
                return int(m.group(1).replace(",", "")) if m.group(1).strip(",") else None

    df = spark.createDataFrame(list(enumerate(PRICED)), "i int, t string").withColumn("p", priced_parts("t"))
    got = df.orderBy("i").select(fee_from_parts("p", rules.FEE_UK_KEYWORDS)).collect()
    assert [r[0] for r in got] == [plain(t) for t in PRICED]


def test_pages_parsed_for_named_selectors_give_the_same_fields(spark):
    """Only a job's own selectors are noted and only their texts handed on; its fields are those of the whole parse."""
    from prospectus.operators import html as H
    odd = [*ODD_PAGES, PHYSICS_PAGE, BARE_PAGE, PRICES_PAGE, "<script class='level'>s</script><div class=department>a<script>b</script> <!--c--> d</div>",
           "<h2>Entry<section>in</section></h2><section>a<h2>x</h2></section><section><div><h2>E<b>ntry</b></h2>y</div></section>",
           "<dl><dt>Duration<script>9</script></dt><!-- - --><dd>2 years<dt>Dur<b>ation</b><dd>7 years</dl><meta name='programme:duration' content='6 academic years'>",
           "<dt>Length</dt><p class='my-length'></p><dd>no</dd><dt>Start</dt><dd>June</dd> < 5 <title>BSc &amp; more", "£ 5 <b>UK £7</b><textarea>home £8</textarea>"]
    df = spark.createDataFrame(list(enumerate(odd)), "page_id long, html string")
    whole = X.stage_inputs(parsed_pages(df), ["page_id"])
    fields = {"name": X.extract_name, "degree": X.extract_degree, "level": X.extract_level, "department": X.extract_department,
              "study_mode": X.extract_study_mode, "duration": X.extract_duration, "start_month": X.extract_start_month,
              "description": X.extract_description, "entry_requirements": X.extract_entry_requirements}
    for field, value in fields.items():
        parsed = parsed_pages(df, texts=False, select=X.selected((field,), title=True, meta=True))
        assert not {"elems", "texts"} & set(parsed.columns)
        got = X.stage_selected(parsed, ["page_id"], (field,)).select("page_id", value()).collect()
        assert got == whole.select("page_id", value()).collect(), field
    fees = [c.alias(k) for k, c in X.extract_fees().items()]
    bare = X.stage_selected(parsed_pages(df, select=()), ["page_id"], ())
    assert bare.select("page_id", *fees).collect() == whole.select("page_id", *fees).collect()
    # the nodes of other elements are not handed on
    out = H._Columns(False, X.selected(("department",)), False)
    H.parse_into(out, "a<p>b<p class=department>c<b>d</b></p>e")
    assert out.t_text == ["c", "d"] and not out.e_n


def test_pages_that_nest_plainly_are_read_like_one_by_one():
    """Many at a time or alone, a page gives the same columns; those that do not nest plainly go through the loop."""
    plain = ["<!DOCTYPE html><title>T &amp; u</title><meta name=a content=b><dl><dt>Duration</dt><dd>2 years</dd></dl>t > 1",
             "x<div class='programme-header'><h1 class='q course-title'>n<b>&lt;m</b></h1></div><section><h2>Entry</h2><p>e</p></section>",
             "<ul><li>a</li><li>b<br>c</li></ul><p class=department>d</p><p>£5</p>", "<script>a &amp; b</script>£7", "", None]
    odd = ["<p>a<p class=department>b", "<!-- <p> -->x", "<div><b></div></b>y", "<a t='>'>z</a>", "</p>q", "<title>a<b></title>c",
           "<li>a<ul><li class=department>b</li></ul></li>", "a < b", "<script>'<p>'</script><h1>n</h1>", "<div class=department>open"]
    docs = [d for pair in zip(plain * 2, odd + plain) for d in pair]
    every = X.selected(tuple(X.R), title=True, meta=True)
    for select, texts, lines in ((every, False, False), (every, True, False), (X.selected(("department",)), False, False),
                                 ((), True, False), ((), True, True)):
        alone = H._Columns(False, select, texts)
        for d in docs:
            H.parse_into(alone, d)
            alone.end_page()
        got, errors = H._selected_pages(pa.array(docs, pa.string()), select, texts, lines)
        want = [alone.lines() if lines else alone.arrays(())[1], *alone.hits(True)]
        assert [c.to_pylist() for c in got] == [c.to_pylist() for c in want] and errors == [None] * len(docs)
    nests = H._PlainPages(H._Columns(False, every, False), pa.array([*plain, *odd], pa.string())).plain.tolist()
    assert nests == [True] * len(plain) + [False] * len(odd)


def test_bytes_of_a_page_parsed_for_selectors_are_decoded_or_quarantined():
    cols, errors = H._selected_pages(pa.array(["<p class=department>é</p>".encode(), b"\xff", None]), X.selected(("department",)), False, False)
    assert [[t["text"] for t in n] for n in cols[0].to_pylist()] == [["é"], [], []]
    assert [e and e.split(":")[0] for e in errors] == [None, "UnicodeDecodeError", None]


def test_fees_from_lines(spark):
    """Keywords in any case, also beside letters outside of ASCII and in those that fold to ASCII."""
    rows = [(1, "<p>UK: £1,000</p><p>Overſeas Größe: £2,000</p><p>Sandwich £30</p>"), (2, "<p>Für HOME: £5</p><p>£,</p>"), (3, None),
            (4, "<p>Ho<b>me</b> £7</p><p>INTERNATIONAL £8<!-- uk £9 --></p><script>uk £10</script>"), (5, "<p>K uK £١٢</p>")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    want = X.stage_selected(parsed_pages(df, select=()), ["page_id"], ()).select("page_id", "_priced")
    got = X.stage_selected(parsed_pages(df, select=(), lines=True), ["page_id"], ())
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    fees = {r[0]: tuple(r[1:]) for r in got.select("page_id", *[c.alias(k) for k, c in X.extract_fees().items()]).collect()}
    assert fees[1] == (1000, 30, 2000, 30) and fees[2] == (5, 5, 5, 5) and fees[3] == (None,) * 4 and fees[4] == (7, 7, 8, 7)


WORDY = ["<p>UCAS <b>A100</b></p><p>Ucas: B200</p>", "<!-- IELTS 5 --><div>x<!-- ielts --> 6.5 IELTS<b> 7</b></div>", "late 2026<p>Late entry <i>until</i> 2027 </p>",
         "<script>clearing 2031</script><p>IELT&#83; 6</p>", "<div>IELTS<p>IELTS: none<p>ucaſ C300 \u0130elts 4.5</div>", "IELTS 8", None, "",
         "<style>late 1999</style><title>UCAS D400</title>", "<p>L\u00e1te</p><ul><li>IELTS<li>6.0</ul> < IELTS 3"]


def test_nodes_with_words_are_noted_like_those_of_the_whole_page(spark):
    """fields that read the parents of nodes with a word, of pages parsed at once and one by one."""
    docs = [*WORDY, *ODD_PAGES, PHYSICS_PAGE, BARE_PAGE, PRICES_PAGE]
    df = spark.createDataFrame(list(enumerate(docs)), "page_id long, html string")
    whole = X.stage_inputs(parsed_pages(df), ["page_id"])
    for field, value in {"ucas_code": X.extract_ucas, "deadline_late": X.extract_deadline_late, "ielts_score": X.extract_ielts}.items():
        parsed = parsed_pages(df, texts=False, select=X.selected((field,), meta=True), words=X.WORDS[field])
        assert not {"elems", "texts", "lines"} & set(parsed.columns)
        got = X.stage_selected(parsed, ["page_id"], tuple({field} & set(X.R))).select("page_id", value()).collect()
        want = whole.select("page_id", value()).collect()
        assert got == want and sum(r[1] is not None for r in want) > 2, field
    assert X.extract_fields(X.parsed_for_fields(df)).collect() == X.extract_fields(parsed_pages(df)).collect()


def test_words_patterns_hold_what_spark_matches(spark):
    """Every character that a pattern without regard to case takes for a letter of a word is in the tokenizer's pattern."""
    import re
    letters = sorted(set("".join(X.ALL_WORDS).lower()))
    chars = spark.createDataFrame([(chr(c),) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000], "char string")
    for flags in ("(?iU)", "(?i)"):
        got = chars.select("char", *[F.col("char").rlike(flags + x).alias(x) for x in letters]).filter(" or ".join(letters)).collect()
        assert all(re.fullmatch(H.words_pattern([x]), r.char) for r in got for x in letters if r[x])


def test_definition_and_meta_entries_without_elements(spark):
    """The lists and meta entries of pages that are parsed for them only."""
    from prospectus.functions import selectors as S
    docs = ["<dl><dt>Duration</dt><dd>2 years</dd></dl>", "<dt>Dur<b>ation<dd>3<dd>4", "<dd>0</dd><dt>Length</dt><dd>x</dd><dt>Duration</dt><p></p><dd>5</dd>",
            "<dl><dt>Duration</dt><dd> </dd><dt>Duration</dt><dd>6</dd></dl>", None, *ODD_PAGES, PHYSICS_PAGE]
    df = spark.createDataFrame(list(enumerate(docs)), "page_id long, html string")
    want = parsed_pages(df).select("page_id", X.dl_lookup("Duration")).collect()
    assert X.dl_selected(parsed_pages(df, texts=False, select=(H.DD,)), "Duration", "d").select("page_id", "d").collect() == want
    assert sum(r[1] is not None for r in want) == 2
    metas = lambda staged: staged.select("page_id", S.meta_map("_meta")).collect()
    alone = parsed_pages(df, texts=False, select=X.selected((), meta=True))
    assert metas(X.stage_selected(alone, ["page_id"], ())) == metas(X.stage_inputs(parsed_pages(df), ["page_id"]))
