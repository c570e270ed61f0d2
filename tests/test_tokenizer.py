"""The page tokenizer: linear in the page, containers, subtree ends, quarantine, batches."""

import time

import pyarrow as pa
import pytest

from prospectus.operators import extract as X
from prospectus.operators import html as H


def seconds(doc):
    t = time.process_time()
    out = H._Columns()
    H.parse_into(out, doc)
    out.end_page()
    out.arrays()
    return time.process_time() - t


@pytest.mark.parametrize("piece,tail", [
    ("<div>", ""), ("<div class='course-item'>", ""), ('<a href="x', ""), ("<a b='c ", '">'),
    ('<a b="c ', "'> x"), ("<a <a ", '"'), ("<a", ' ">'), ("<", ">"), ("<!", ""), ('<p title="a>b">', ""),
    ('<p t="<i>\'', ">"),
])
def test_time_is_about_linear(piece, tail):
    small, large = piece * 25_000 + tail, piece * 100_000 + tail
    seconds(small)
    # four times the page: a quadratic tokenizer takes sixteen times as long
    assert seconds(large) < 9 * seconds(small) + 0.5


def test_deep_nesting_keeps_containers_short():
    elems, _ = H.parse_html("<main><div class='course-item x'>" * 3000 + "<a href='/c'>c</a>")
    assert elems[-1]["tag"] == "a" and set(elems[-1]["within"]) == {"main.", "div.course-item"}
    assert max(len(e["within"]) for e in elems) <= len(H.CONTAINERS)


def test_subtree_ends_and_containers():
    elems, texts = H.parse_html("<main><ul><li class='course'>a<b>c</b></li><li>d</li></ul></main><p>e")
    tags = [e["tag"] for e in elems]
    assert tags == ["main", "ul", "li", "b", "li", "p"]
    assert [e["end"] for e in elems] == [5, 5, 4, 4, 5, 6]
    assert [e["within"] for e in elems] == [[], ["main."], ["main."], ["main.", "li.course"], ["main."], []]
    # an element's descendants are those whose parent chain reaches it
    for i, e in enumerate(elems):
        below = set()
        for j, f in enumerate(elems):
            k = f["parent"]
            while k >= 0 and k != i:
                k = elems[k]["parent"]
            if k == i:
                below.add(j)
        assert below == set(range(i + 1, e["end"]))


@pytest.mark.parametrize("doc,tags", [
    ('<p title="a>b">x</p>', ["p"]), ("<p title='<i>'>x<b>y", ["p", "b"]),
    ('<p title="never closed>x<b>y</b>', ["b"]), ('<a b="c<a b="d">e</a>', ["a"]),
    ("a < b <i>c</i>", ["i"]), ("<br/><img src=x/>", ["br", "img"]), ("", []), (None, []),
])
def test_odd_tags(doc, tags):
    elems, _ = H.parse_html(doc)
    assert [e["tag"] for e in elems] == tags


def test_unreadable_bytes_go_to_quarantine(spark):
    rows = [(1, "<h1>fine é</h1>".encode()), (2, "<h1>café".encode()[:-1]), (3, None), (4, b"")]
    raw = X.extract_fields(H.parsed_pages(spark.createDataFrame(rows, "page_id long, html binary")
                                          .selectExpr("page_id", "'u' AS url", "html")), keep=["page_id"])
    ok, bad = X.split_quarantine(raw)
    assert [(r.page_id, r.parse_error.split(":")[0]) for r in bad.collect()] == [(2, "UnicodeDecodeError")]
    assert sorted((r.page_id, r.name) for r in ok.collect()) == [(1, "fine é"), (3, None), (4, None)]


def test_large_pages_are_handed_on_in_parts(monkeypatch):
    monkeypatch.setattr(H, "FLUSH_CHARS", 30)
    docs = ["<p>" + "x" * k for k in range(40)] + [None]
    rb = pa.RecordBatch.from_pydict({"page_id": list(range(41)), "html": docs})
    parts = list(H._parse_batches([rb], keep_html=False))
    assert len(parts) > 10
    got = [r for b in parts for r in b.to_pylist()]
    assert [r["page_id"] for r in got] == list(range(41))
    for r, doc in zip(got, docs):
        assert (r["elems"], r["texts"]) == H.parse_html(doc)


def test_tags_known_by_their_text_read_like_new_ones(monkeypatch):
    bits = ["<p>", "</P >", "<a title='x>y'>", "<a title='", "'>", "<b", "<", "</", "<!-- > -->", "<br/>", "<li>", "</li>", "t>", "<i \"<q>\">"]
    doc = "".join(bits[(i * i + i // 5) % len(bits)] for i in range(400))
    known = H.parse_html(doc)
    monkeypatch.setattr(H, "KNOWN_TAG_CHARS", 0)
    assert H.parse_html(doc) == known
    out = H._Columns()
    H.parse_into(out, "<p>a</p><p>b</p>")
    assert out.tags["</p>"][:2] == (-1, "p")
