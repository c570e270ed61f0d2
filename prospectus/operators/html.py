"""Pages -> per-page element and text-node arrays (the elements job).

The only Python in the extraction path is a small tolerant tokenizer run by
``mapInArrow`` over Arrow batches of pages; it records structure only
(tag, attributes, parent, subtree and text ranges, enclosing containers).  Selector matching and all
field logic are Spark column expressions over these arrays (see
``functions.selectors`` and ``operators.extract``), so a page is processed
inside the task that reads it: no shuffle.

Output columns added to the page row::

  elems: array<struct<tag, id, cls, classes: array<string>,
                      attrs: map<string,string>, parent: int, end: int,
                      within: array<string>, t0: int, t1: int,
                      prev_tag: string, prev: int>>
  texts: array<struct<text: string, parent: int, kind: string>>
  hit_i, hit_k, hit_t0, hit_t1: array<int>
  parse_error: string

Element ``i`` is ``elems[i]`` (0-based; ``element_at`` is 1-based).  Its
descendants are ``elems[i + 1 .. end)`` and its descendant text nodes
``texts[t0 .. t1)``.  ``within`` names the enclosing elements that a selector
asks for (``CONTAINERS``, a short fixed list), so it stays short however deep a
page nests.  ``kind`` is ``text``, ``raw`` (inside script/style) or ``comment``.
``hit_i`` and ``hit_k`` list, in document order, the elements whose tag and containers allow a
selector of ``SELECTORS`` and the selector's number, ``hit_t0`` and ``hit_t1`` those elements' text ranges; what a selector asks of neighbours and
texts is tested by Spark.

A job that reads a few selectors only names them (``select``).  Its pages have no ``elems``; ``hit_prev`` is
the noted element's previous sibling, ``metas`` the attributes of the noted meta elements, and with ``texts=False``
``noted`` holds, in place of ``texts``, the text nodes inside noted elements, which the ranges then count.  One that
reads no selector at all gets the nodes without their parents (-1), or with ``lines`` their texts as one string.
One that names ``words`` has in the array ``words`` the nodes that may hold one, each with the range of its parent's texts;
these stand among the nodes, and ``lines`` comes beside them.
Pages whose tags nest plainly are parsed many at a time for such a job (``_PlainPages``), the others one by one.

Time and output are linear in the page: a tag whose quotes or ``>`` never close
is text, found without scanning the rest of the page again for each such tag.
"""

from __future__ import annotations

import html as _html
import re
import sys
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .. import rules

# Ship this module's code with the task closure, so executors need no
# installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ELEM_TYPE = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("cls", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("parent", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("within", T.ArrayType(T.StringType())),
    T.StructField("t0", T.IntegerType()),
    T.StructField("t1", T.IntegerType()),
    T.StructField("prev_tag", T.StringType()),
    T.StructField("prev", T.IntegerType()),
])
TEXT_TYPE = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("kind", T.StringType()),
])

_A_ELEM = pa.struct([
    ("tag", pa.string()), ("id", pa.string()), ("cls", pa.string()),
    ("classes", pa.list_(pa.string())),
    ("attrs", pa.map_(pa.string(), pa.string())), ("parent", pa.int32()),
    ("end", pa.int32()), ("within", pa.list_(pa.string())), ("t0", pa.int32()), ("t1", pa.int32()),
    ("prev_tag", pa.string()), ("prev", pa.int32()),
])
_A_TEXT = pa.struct([("text", pa.string()), ("parent", pa.int32()), ("kind", pa.string())])

_TOKEN = re.compile(
    r"<!--(.*?)(?:-->|\Z)"                       # 1 comment
    r"|<!\[CDATA\[(.*?)(?:\]\]>|\Z)"             # 2 cdata
    r"|<[!?][^>]*>?"                             # doctype / processing instruction
    # 3 slash 4 name 5 attrs; this form never looks beyond the next angle bracket
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>"
    r"|([^<]+|<)", re.S)                         # 6 text
_TAG_START = re.compile(r"<(/?)(?=[a-zA-Z])")
_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile(r"[>\"']")
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr "
                 "basefont bgsound frame keygen".split())
RAW_TEXT = frozenset(("script", "style"))
RCDATA = frozenset(("title", "textarea"))
# start tags that implicitly close an open <p>
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl "
                     "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
                     "hr main menu nav ol p pre section summary table ul li dd dt".split())
# start tag -> open tags it closes when it is the nearest such open element
SELF_CLOSING_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
                         "option": ("option",), "tr": ("tr", "td", "th"),
                         "td": ("td", "th"), "th": ("td", "th")}
LIST_SCOPE = frozenset(("ul", "ol", "dl", "table", "select", "body", "html"))
_END_TAG = {t: re.compile(r"</" + t + r"\s*>", re.I) for t in RAW_TEXT | RCDATA}


#: bytes of page text after which a batch of parsed pages is handed on (int32 offsets, task memory)
FLUSH_CHARS = 16 << 20


#: the longest tag that is looked up by its text (so that a far '>' is not copied for each '<')
KNOWN_TAG_CHARS = 400


def container_name(tag: str | None, cls: str | None) -> str:
    return f"{tag or ''}.{cls or ''}"


def _containers() -> dict[tuple[str | None, str | None], str]:
    """The (tag, class) pairs that selectors ask for among an element's ancestors."""
    pairs = {(None, rules.PARTNER_LOGO_CLASS)}
    for specs in rules.SELECTOR_RULES.values():
        pairs |= {(None, x["ancestor_class"]) for _css, x in specs if "ancestor_class" in x}
    for r in rules.SOURCE_RULES:
        pairs |= {(x["anc_tag"], x.get("anc_class")) for x in r.get("selectors") or () if x.get("anc_tag")}
    return {k: container_name(*k) for k in sorted(pairs, key=str)}


CONTAINERS = _containers()
_CONTAINER_TAGS = frozenset(t for t, c in CONTAINERS if c is None)


class _LongTags:
    """Ends of tags whose quoted values hold angle brackets.

    A scan that finds no end marks the quotes it opened; a later scan that opens
    one of them fails at once, so each quote of a page is followed only once.
    """

    def __init__(self, doc: str):
        self.doc, self.last = doc, doc.rfind(">")
        self.name_end, self.near, self.doomed = -1, (0, -1), set()

    def find(self, start: int) -> tuple[int, int] | None:
        """(end of the name, position of '>') of the tag whose name starts at ``start``."""
        doc, n = self.doc, len(self.doc)
        if start > self.last:
            return None
        if self.name_end < start:
            m = _NAME_END.search(doc, start)
            self.name_end = m.start() if m else n
        i = name_end = self.name_end
        x, at = self.near
        if not x <= i <= at:
            m = _SPECIAL.search(doc, i)
            at = m.start() if m else n
            self.near = (i, at)
        opened = []
        while at < n and at not in self.doomed:
            if doc[at] == ">":
                return name_end, at
            opened.append(at)
            close = doc.find(doc[at], at + 1)
            if close < 0:
                break
            m = _SPECIAL.search(doc, close + 1)
            at = m.start() if m else n
        self.doomed.update(opened)
        return None


#: selectors of all extracted fields in the order of ``rules.SELECTOR_RULES``, which numbers them; then E1's and the title's elements,
#: then those whose texts a selector asks for beside or below its element (noted where such a selector is named), E19's and L1's
SELECTORS = ([spec for specs in rules.SELECTOR_RULES.values() for _css, spec in specs]
             + [{"tag": "meta"}, {"tag": "title"}, {"tag": "dt"}, {"tag": "h2"}, {"dt": ""}, {"tag": "a", "attr": "href"}])
META, TITLE, DT, H2, DD, LINK = range(len(SELECTORS) - 6, len(SELECTORS))
ELEM_FIELDS = tuple(f.name for f in ELEM_TYPE.fields)
HITS = ["hit_i", "hit_k", "hit_t0", "hit_t1"]
#: columns of a job that names its selectors, beside ``texts`` or ``noted``
SELECTED = [*HITS, "hit_prev", "metas"]
#: a node that holds a word, and the range of its parent's texts (numbers of nodes)
_A_WORD = pa.struct([("at", pa.int32()), ("t0", pa.int32()), ("t1", pa.int32())])
WORD_TYPE = T.StructType([T.StructField(f.name, T.IntegerType()) for f in _A_WORD])
#: letters outside of ASCII that some pattern without regard to case takes for an ASCII one
_FOLDED = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}
_KINDS = ("text", "raw", "comment")
_TEXT, _RAW, _COMMENT = range(3)


def words_pattern(words: Iterable[str]) -> str:
    """A pattern (of ``re`` and RE2) for any of some words of letters, in any case."""
    return "|".join("".join(f"[{c}{c.upper()}{_FOLDED.get(c, '')}]" for c in w.lower()) for w in words)


def _fits(spec: dict, name: str, id_: str | None, cls: str | None, classes: list[str], keys: list[str]) -> bool:
    """Whether a tag allows the selector; what stands around and below the element is not looked at."""
    return (name == spec.get("tag", "dd" if "dt" in spec else name)
            and ("id" not in spec or spec["id"] == id_)
            and ("class_eq" not in spec or spec["class_eq"] in classes)
            and ("class_like" not in spec or (cls is not None and spec["class_like"] in cls))
            and ("attr" not in spec or spec["attr"] in keys))


class _Columns:
    """Column-wise buffers for one Arrow batch of parsed pages.

    What a tag says by itself (name, attributes, the selectors it fits) is kept once for each
    distinct tag of the batch; its elements hold the tag's number."""

    def __init__(self, elems: bool = True, select: Iterable[int] | None = None, all_texts: bool = True):
        self.elems, self.all_texts = elems, all_texts
        self.select = range(TITLE + 1) if select is None else sorted(
            {*select, *(DT for k in select if "dt" in SELECTORS[k]), *(H2 for k in select if "has_h2" in SELECTORS[k])})
        self.around = elems or any("ancestor_class" in SELECTORS[k] for k in self.select)
        self.asked: dict[tuple, list] = {}     # selectors that a tag of a name may fit, with an id, a class, attributes or without
        self.tags: dict[str, tuple] = {}       # text of a tag -> number, name and how it nests
        self.open_at: dict[str, list[int]] = {}  # stack positions of the page's open elements of each tag
        self.n_tag, self.n_id, self.n_cls = [], [], []
        self.c_flat, self.c_off = [], [0]
        self.a_keys, self.a_vals, self.a_off = [], [], [0]
        self.arounds: list[tuple] = [()]       # distinct lists of containers, and what an element adds to one
        self.grown: dict[tuple, int] = {}
        self.e_n, self.e_parent, self.e_around, self.e_end = [], [], [], []
        self.e_t0, self.e_t1, self.e_prev = [], [], []
        self.t_text, self.t_parent, self.t_kind = [], [], []
        self.n_noted, self.n_i, self.n_t0, self.n_t1, self.n_prev = [], [], [], [], []  # noted elements: tag's number, ...
        self.hit_n, self.hit_k = [], []        # ... and for each selector that one fits its place among them
        self.page_e_off, self.page_t_off, self.page_n_off, self.page_h_off = [0], [0], [0], [0]

    def open_of(self, name: str) -> list[int]:
        return self.open_at.setdefault(name, [])

    def _asked(self, name: str, *has: bool) -> list[tuple[int, str | None]]:
        """The selectors, each with its container, that a tag of the name may fit which ``has`` an id, a class, attributes."""
        got = self.asked.get((name, has))
        if got is None:
            lacks = {x for x, there in zip(("id", "class_eq", "class_like", "attr"), (has[0], has[1], has[1], has[2])) if not there}
            got = self.asked[name, has] = [
                (k, CONTAINERS.get((None, SELECTORS[k].get("ancestor_class")))) for k in self.select
                if name == SELECTORS[k].get("tag", "dd" if "dt" in SELECTORS[k] else name) and not SELECTORS[k].keys() & lacks]
        return got

    def tag(self, text: str, closing: bool, name: str, raw_attrs: str) -> tuple:
        """The tag ``text``, read once a batch; an end tag has the number -1."""
        if text in self.tags:
            return self.tags[text]
        name = name.lower()
        if closing:
            out = self.tags[text] = (-1, name, self.open_of(name), False, False, (), False, (), (), False, False)
            return out
        id_ = cls = None
        keys, vals = [], []
        if raw_attrs and not raw_attrs.isspace():
            seen = set()
            for a in _ATTR.finditer(raw_attrs):
                key = a.group(1).lower()
                if key in seen:
                    continue  # first duplicate attribute wins
                seen.add(key)
                val = a.group(2)
                if val is None:
                    val = a.group(3)
                if val is None:
                    val = a.group(4)
                val = "" if val is None else (_html.unescape(val) if "&" in val else val)
                keys.append(key)
                vals.append(val)
                if key == "id":
                    id_ = val
                elif key == "class":
                    cls = val
        classes = cls.split() if cls else []  # class tokens (whitespace-separated)
        n = len(self.n_tag)
        self.n_tag.append(name)
        self.n_id.append(id_)
        self.n_cls.append(cls)
        self.c_flat.extend(classes)
        self.c_off.append(len(self.c_flat))
        self.a_keys.extend(keys)
        self.a_vals.extend(vals)
        self.a_off.append(len(self.a_keys))
        own = tuple(w for (t, c), w in CONTAINERS.items() if (t is None or t == name) and (c is None or c in classes)
                    ) if self.around else ()
        hits = [x for x in self._asked(name, bool(id_), bool(cls), bool(keys)) if _fits(SELECTORS[x[0]], name, id_, cls, classes, keys)]
        closes = tuple(self.open_of(t) for t in SELF_CLOSING_SIBLINGS.get(name, ()))
        raw_body = name in RAW_TEXT or name in RCDATA
        plain = not (closes or name in LIST_SCOPE or own or hits or name in VOID or raw_body)  # nests and nothing else
        out = (n, name, self.open_of(name), plain, name in CLOSES_P, closes, name in LIST_SCOPE, own, hits,
               name in VOID, raw_body)
        self.tags[text] = out
        return out

    def grow(self, around: int, own: tuple) -> int:
        """The list of containers ``around`` with an element's own ones."""
        key = (around, own)
        at = self.grown.get(key)
        if at is None:
            old = self.arounds[around]
            new = old + tuple(w for w in own if w not in old)
            at = around
            if new != old:
                at = len(self.arounds)
                self.arounds.append(new)
            self.grown[key] = at
        return at

    def end_page(self):
        self.page_e_off.append(len(self.e_n))
        self.page_t_off.append(len(self.t_text))
        self.page_n_off.append(len(self.n_i))
        self.page_h_off.append(len(self.hit_k))

    def rollback(self):
        """Drop a half-parsed page (parse error): the page gets empty arrays."""
        for at, lists in ((self.page_e_off[-1], (self.e_n, self.e_parent, self.e_around, self.e_end, self.e_t0, self.e_t1, self.e_prev)),
                          (self.page_t_off[-1], (self.t_text, self.t_parent, self.t_kind)),
                          (self.page_n_off[-1], (self.n_noted, self.n_i, self.n_t0, self.n_t1, self.n_prev)),
                          (self.page_h_off[-1], (self.hit_n, self.hit_k))):
            for lst in lists:
                del lst[at:]
        for lst in self.open_at.values():
            lst.clear()

    def _elem_field(self, name: str, n: pa.Array) -> pa.Array:
        i32, text = pa.int32(), pa.string()
        if name == "tag":
            return pa.array(self.n_tag, text).take(n)
        if name == "id":
            return pa.array(self.n_id, text).take(n)
        if name == "cls":
            return pa.array(self.n_cls, text).take(n)
        if name == "classes":
            return pa.ListArray.from_arrays(pa.array(self.c_off, i32), pa.array(self.c_flat, text)).take(n)
        if name == "attrs":
            return pa.MapArray.from_arrays(pa.array(self.a_off, i32), pa.array(self.a_keys, text),
                                           pa.array(self.a_vals, text)).take(n)
        if name == "within":
            off, flat = [0], []
            for around in self.arounds:
                flat.extend(around)
                off.append(len(flat))
            return pa.ListArray.from_arrays(pa.array(off, i32), pa.array(flat, text)).take(pa.array(self.e_around, i32))
        if name == "prev_tag":
            at = []
            for lo, hi in zip(self.page_e_off, self.page_e_off[1:]):
                at.extend(self.e_n[lo + p] if p >= 0 else None for p in self.e_prev[lo:hi])
            return pa.array(self.n_tag, text).take(pa.array(at, i32))
        return pa.array(getattr(self, "e_" + name), i32)

    def arrays(self, fields: tuple[str, ...] = ELEM_FIELDS, texts: bool = True):
        """The lists of elements (without ``fields``: None) and of text nodes."""
        i32 = pa.int32()
        elems = nodes = None
        if fields:
            n = pa.array(self.e_n, i32)
            elem = pa.StructArray.from_arrays([self._elem_field(f, n) for f in fields],
                                              fields=[_A_ELEM.field(f) for f in fields])
            elems = pa.ListArray.from_arrays(pa.array(self.page_e_off, i32), elem)
        if texts:
            text = pa.StructArray.from_arrays(
                [pa.array(self.t_text, pa.string()), pa.array(self.t_parent, i32),
                 pa.array(_KINDS, pa.string()).take(pa.array(self.t_kind, i32))], fields=list(_A_TEXT))
            nodes = pa.ListArray.from_arrays(pa.array(self.page_t_off, i32), text)
        return elems, nodes

    def lines(self) -> pa.Array:
        """Each page's texts outside of scripts, styles and comments, one node a line."""
        at = zip(self.page_t_off, self.page_t_off[1:])
        return pa.array(["\n".join(t for t, k in zip(self.t_text[lo:hi], self.t_kind[lo:hi]) if k == _TEXT) for lo, hi in at], pa.string())

    def words(self, pattern: str) -> pa.Array:
        """The nodes that hold the pattern, with the ranges of their parents' texts (of pages parsed with elements)."""
        search, i32 = re.compile(pattern).search, pa.int32()
        off, at, t0, t1 = [0], [], [], []
        for first, lo, hi in zip(self.page_e_off, self.page_t_off, self.page_t_off[1:]):
            for j in range(lo, hi):
                if search(self.t_text[j]):
                    up = self.t_parent[j]
                    at.append(j - lo)
                    t0.append(self.e_t0[first + up] if up >= 0 else 0)
                    t1.append(self.e_t1[first + up] if up >= 0 else hi - lo)
            off.append(len(at))
        return pa.ListArray.from_arrays(pa.array(off, i32), pa.StructArray.from_arrays([pa.array(x, i32) for x in (at, t0, t1)], fields=list(_A_WORD)))

    def hits(self, selected: bool = False):
        """The columns ``HITS``, or ``SELECTED``."""
        i32 = pa.int32()
        off, at, hit_k = pa.array(self.page_h_off, i32), pa.array(self.hit_n, i32), pa.array(self.hit_k, i32)
        of = lambda x: pa.array(x, i32).take(at)
        cols = [of(self.n_i), hit_k, of(self.n_t0), of(self.n_t1)] + [of(self.n_prev)] * selected
        cols = [pa.ListArray.from_arrays(off, x) for x in cols]
        if selected:
            meta = np.isin(hit_k.to_numpy(), (META, LINK))
            before = np.concatenate(([0], np.cumsum(meta)))[self.page_h_off]
            cols.append(pa.ListArray.from_arrays(pa.array(before, i32), self._elem_field("attrs", of(self.n_noted).filter(pa.array(meta)))))
        return cols


def parse_into(out: _Columns, doc: str | bytes | None) -> None:
    """Tokenize one page into ``out``.  Tolerant of unclosed/misnested tags.

    A page given as bytes must be UTF-8; one that is not is an error."""
    if isinstance(doc, bytes):
        doc = doc.decode("utf-8")
    if not doc:
        return
    elems, all_texts = out.elems, out.all_texts
    e_n, e_parent, e_around, e_end = out.e_n, out.e_parent, out.e_around, out.e_end
    e_t0, e_t1, e_prev = out.e_t0, out.e_t1, out.e_prev
    t_text, t_parent, t_kind = out.t_text, out.t_parent, out.t_kind
    n_t1, hit_n, hit_k, tags, arounds = out.n_t1, out.hit_n, out.hit_k, out.tags, out.arounds
    base, tbase = len(e_n), len(t_text)  # numbers are page-local
    # open elements: number, stack positions of its tag, containers around its children, place among the noted
    # elements (or -1), whether it ends an implied close; the document itself is the first
    stack: list[tuple] = [(-1, None, 0, -1, False)]
    push, pop = stack.append, stack.pop
    last_child: list[int] = [-1]   # ... and, where it is asked for, the latest child of each
    prevs = elems or DT in out.select
    flat = not elems and not out.select  # nothing is noted: tags only cut the text, whose nodes then have no parents
    lean = not prevs
    parent, around = -1, 0         # of the innermost one: number, containers
    n_open = 0                     # noted elements that are open
    idx = -1
    unescape, find, known = _html.unescape, doc.find, tags.get
    long_tags = None
    open_p, open_button, open_div = out.open_of("p"), out.open_of("button"), out.open_of("div")
    scopes: list[int] = []         # stack positions of the elements that end an implied close

    def close_until(k):
        nonlocal n_open, parent, around
        t1 = len(t_text) - tbase
        while len(stack) > k:
            i, at, _, noted, scope = pop()
            at.pop()
            if prevs:
                last_child.pop()
            if scope:
                scopes.pop()
            if noted >= 0:
                n_t1[noted] = t1
                n_open -= 1
            if elems:
                e_t1[base + i] = t1
                e_end[base + i] = idx + 1
        parent, _, around, _, _ = stack[-1]

    pos, n_doc, gt = 0, len(doc), -1  # gt: the first '>' from pos on
    while pos < n_doc:
        lt = find("<", pos)
        if lt != pos:
            if all_texts or n_open:
                text = doc[pos:lt] if lt >= 0 else doc[pos:]
                t_text.append(unescape(text) if "&" in text else text)
                t_parent.append(parent)
                t_kind.append(_TEXT)
            if lt < 0:
                break
            pos = lt
        if gt < pos:
            gt = find(">", pos)
            if gt < 0:
                gt = n_doc
        # a tag that was met before ends at the next '>'; others are read by the pattern
        own_tag = known(doc[pos:gt + 1]) if gt - pos < KNOWN_TAG_CHARS else None
        if own_tag is not None:
            pos = gt + 1
        else:
            m = _TOKEN.match(doc, pos)
            what = m.lastindex
            if what == 6:  # '<' that begins no tag, or one that reaches over the next angle bracket
                t = _TAG_START.match(doc, pos)
                ends = None
                if t:
                    long_tags = long_tags or _LongTags(doc)
                    ends = long_tags.find(t.end())
                if ends is None:
                    if all_texts or n_open:
                        t_text.append("<")
                        t_parent.append(parent)
                        t_kind.append(_TEXT)
                    pos += 1
                    continue
                raw, name, attrs = doc[pos:ends[1] + 1], doc[t.end():ends[0]], doc[ends[0]:ends[1]]
                pos = ends[1] + 1
                # such a tag is not known by its text up to the next '>'
                own_tag = out.tag("\0" + raw, raw[1] == "/", name, attrs)
            elif what == 5:
                pos = m.end()
                own_tag = out.tag(m.group(), m.group(3) == "/", m.group(4), m.group(5))
            else:
                if what and (all_texts or n_open):
                    t_text.append(m.group(what))
                    t_parent.append(parent)
                    t_kind.append(_COMMENT if what == 1 else _TEXT)
                pos = m.end()
                continue  # doctype / PI
        n, name, at, plain, closes_p, closes, scope, own, hits, void, raw_body = own_tag
        if flat and not raw_body:
            continue
        if n < 0:  # end tag: close up to the nearest open element of that name
            if not at:
                continue
            if at[-1] + 1 < len(stack):
                close_until(at[-1])
                continue
            i, _, _, noted, scope = pop()  # most often it is the innermost one
            at.pop()
            if prevs:
                last_child.pop()
            if scope:
                scopes.pop()
            if noted >= 0:
                n_t1[noted] = len(t_text) - tbase
                n_open -= 1
            if elems:
                e_t1[base + i] = len(t_text) - tbase
                e_end[base + i] = idx + 1
            parent, _, around, _, _ = stack[-1]
            continue
        if lean and plain and not (closes_p and open_p):
            parent = idx = idx + 1
            at.append(len(stack))
            push((idx, at, around, -1, False))
            continue
        if closes_p and open_p:  # implied </p>
            if open_p[-1] > max(scopes[-1] if scopes else -1, open_button[-1] if open_button else -1):
                close_until(open_p[-1])
        if closes:  # implied </li>, </dd>, ...
            k = max(a[-1] if a else -1 for a in closes)
            if k > max(scopes[-1] if scopes else -1, open_div[-1] if open_div else -1):
                close_until(k)
        idx += 1
        if elems:
            here = len(t_text) - tbase
            e_n.append(n)
            e_parent.append(parent)
            e_around.append(around)
            e_end.append(idx + 1)
            e_t0.append(here)
            e_t1.append(here)
            e_prev.append(last_child[-1])
        noted = -1
        for k, container in hits:
            if container is None or container in arounds[around]:
                if noted < 0:
                    noted, here = len(n_t1), len(t_text) - tbase
                    out.n_noted.append(n)
                    out.n_i.append(idx)
                    out.n_t0.append(here)
                    n_t1.append(here)
                    out.n_prev.append(last_child[-1])
                hit_n.append(noted)
                hit_k.append(k)
        if prevs:
            last_child[-1] = idx
        if void:
            continue
        if raw_body:
            end = _END_TAG[name].search(doc, pos)
            body = doc[pos:end.start()] if end else doc[pos:]
            pos = end.end() if end else n_doc
            if body and (all_texts or n_open or noted >= 0):
                t_text.append(body if name in RAW_TEXT else unescape(body))
                t_parent.append(-1 if flat else idx)
                t_kind.append(_RAW if name in RAW_TEXT else _TEXT)
                if elems:
                    e_t1[-1] += 1
                if noted >= 0:
                    n_t1[noted] += 1
            continue
        at.append(len(stack))
        if scope:
            scopes.append(len(stack))
        if noted >= 0:
            n_open += 1
        parent = idx
        if own:
            around = out.grow(around, own)
        push((idx, at, around, noted, scope))
        if prevs:
            last_child.append(-1)
    close_until(1)


def parse_html(doc: str | None):
    """One page -> (elems, texts) as Python lists of dicts (tests, debugging)."""
    out = _Columns()
    parse_into(out, doc)
    out.end_page()
    e_arr, t_arr = out.arrays()
    return e_arr[0].as_py(), t_arr[0].as_py()


#: groups of tags of which one open element may be closed by a start tag, beside <p>
_IMPLIED = sorted(set(SELF_CLOSING_SIBLINGS.values()))
_NO_TAG = (-1, "", None, False, False, (), False, (), (), False, False)


class _PlainPages:
    """The pages of a batch that nest plainly, parsed all at once for a job that names its selectors.

    Such a page has no comment, no angle bracket outside of a tag or in a quoted value, every element that is not void has its
    end tag in place, no start tag closes an element, and what a <title> or a script holds ends at the next tag.  There every
    tag ends at the first '>' and the tree follows from counting; ``plain`` tells these pages, others are left to ``parse_into``
    and are empty here.  Without selectors (``flat``) tags only cut the text and need not nest, unless ``words`` (a pattern)
    are looked for."""

    def __init__(self, out: _Columns, html: pa.Array, words: str = ""):
        self.out, self.n_pages, self.words = out, len(html), words
        self.flat = not out.select and not words
        cut = pc.split_pattern(html.fill_null(""), "<")
        off = cut.offsets.to_numpy().astype(np.int64)
        pieces, size = cut.values, np.diff(off)  # of a page: what comes before its first tag, then a tag and its text each
        lead = np.zeros(len(pieces), dtype=bool)
        lead[off[:-1]] = True
        self.plain = np.ones(self.n_pages, dtype=bool)
        self.page = np.repeat(np.arange(self.n_pages), size - 1)
        self.n = len(self.page)
        halves = pc.split_pattern(pieces.filter(pa.array(~lead)), ">", max_splits=1)
        at = halves.offsets.to_numpy()
        self.plain[self.page[np.diff(at) != 2]] = False
        tags = halves.values.take(pa.array(at[:-1])).dictionary_encode()
        self.code = tags.indices.to_numpy()
        self._read_tags(tags.dictionary.to_pylist())
        self._nest()
        # the text nodes: of each page the leading one, then those after its tags
        self.texts = pa.concat_arrays([pieces.filter(pa.array(lead)), halves.values.take(pa.array(at[1:] - 1))])
        self.of_piece = np.empty(len(pieces), dtype=np.int64)
        self.of_piece[lead] = np.arange(self.n_pages)
        self.of_piece[~lead] = self.n_pages + np.arange(self.n)
        self.piece_of, self.first = np.flatnonzero(~lead), off[:-1]
        self.piece_page = np.repeat(np.arange(self.n_pages), size)
        self._note()

    def _read_tags(self, texts: list[str]):
        """What the batch's distinct tags say, and which pages hold something that is no plain tag."""
        infos, odd, bare = [], [], []
        for text in texts:
            m = _TOKEN.fullmatch(f"<{text}>")
            is_tag = m is not None and m.lastindex == 5
            infos.append(self.out.tag(m.group(), m.group(3) == "/", m.group(4), m.group(5)) if is_tag else _NO_TAG)
            odd.append(not is_tag and not (text[:1] in ("!", "?") and not text.startswith(("!--", "![CDATA["))))
            bare.append(is_tag and m.group(3) == "/" and not m.group(5).strip())
        self.infos, code = infos, self.code
        of = lambda values, dtype: np.array(list(values), dtype=dtype)[code] if infos else np.zeros(0, dtype)
        names = {x[1]: i for i, x in enumerate({x[1]: x for x in infos}.values())}
        self.start = of((x[0] >= 0 for x in infos), bool)
        self.number = of((x[0] for x in infos), np.int64)
        self.name = of((names[x[1]] for x in infos), np.int64)
        self.delta = of((0 if not x[1] or x[9] and x[0] >= 0 else 1 if x[0] >= 0 else -1 for x in infos), np.int64)
        self.raw = of((x[0] >= 0 and x[1] in RAW_TEXT for x in infos), bool)
        self._bad(of(odd, bool))
        # the content of a title or script: up to the next tag, which ends it
        body = of((x[0] >= 0 and x[10] for x in infos), bool)
        bare, here = of(bare, bool), np.arange(self.n)
        after = np.minimum(here + 1, self.n - 1)
        self._bad(body & ~((after > here) & (self.page[after] == self.page) & bare[after] & (self.name[after] == self.name)))
        if self.flat:
            return
        # a start tag closes nothing where no element that it may close is open
        for group in ("p",), *_IMPLIED:
            closing = [x[0] >= 0 and (x[4] if group == ("p",) else SELF_CLOSING_SIBLINGS.get(x[1]) == group) for x in infos]
            member = [x[1] in group for x in infos]
            if any(closing) and any(member):
                step = self.delta * of(member, bool)
                self._bad(of(closing, bool) & (self._within_page(np.cumsum(step) - step) > 0))

    def _bad(self, tokens: np.ndarray):
        self.plain[self.page[tokens]] = False

    def _within_page(self, before: np.ndarray) -> np.ndarray:
        """Running totals without what earlier pages added."""
        if not self.n:
            return before
        first = np.flatnonzero(np.concatenate(([True], self.page[1:] != self.page[:-1])))
        return before - np.repeat(before[first], np.diff(np.append(first, self.n)))

    def _nest(self):
        """Depths, elements' numbers and the end tag of each element; pages with others than plain nesting are left out."""
        if self.flat:
            return
        depth = self._within_page(np.cumsum(self.delta) - self.delta) + self.delta  # after the tag
        self._bad(depth < 0)
        total = np.bincount(self.page, weights=self.delta, minlength=self.n_pages)
        self.plain &= total == 0
        # tags of other pages count for nothing, so that the rest can be paired: of one level, in turn open and close
        ok = self.plain[self.page]
        self.delta, self.start = np.where(ok, self.delta, 0), self.start & ok
        self.depth = np.where(ok, depth, 0)
        ends = np.flatnonzero(self.delta)
        level = np.maximum(self.depth, self.depth - self.delta)[ends]
        ends = ends[np.argsort(level, kind="stable")]
        self.opens, closes = ends[0::2], ends[1::2]
        self._bad(self.opens[self.name[self.opens] != self.name[closes]])
        self.close = np.arange(self.n)
        self.close[self.opens] = closes
        self.key = self.depth[self.opens] * self.n + self.opens  # ascending
        self.element = self._within_page(np.cumsum(self.start) - self.start)

    def _innermost(self, depth: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The tag of the element of that depth that is open at a place; -1 for the document."""
        got = np.searchsorted(self.key, depth * self.n + at, side="right") - 1
        out = np.full(len(at), -1, dtype=np.int64)
        inside = depth > 0
        out[inside] = self.opens[got[inside]]
        return out

    def _note(self):
        """The noted elements and the selectors they fit, in document order."""
        self.noted = self.hit_at = self.hit_k = np.zeros(0, dtype=np.int64)
        if self.flat or not self.n:
            return
        n_hits = np.array([len(x[8]) if x[0] >= 0 else 0 for x in self.infos])
        first = np.cumsum(n_hits) - n_hits
        names = [None, *CONTAINERS.values()]
        ks = np.array([k for x in self.infos if x[0] >= 0 for k, _ in x[8]], dtype=np.int64)
        cs = np.array([names.index(c) for x in self.infos if x[0] >= 0 for _, c in x[8]], dtype=np.int64)
        tok = np.flatnonzero(self.start & self.plain[self.page] & (n_hits[self.code] > 0))
        n = n_hits[self.code[tok]]
        where = np.repeat(first[self.code[tok]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        tok, k, c = np.repeat(tok, n), ks[where], cs[where]
        keep = c == 0
        for i in np.unique(c[~keep]).tolist():
            own = np.array([names[i] in x[7] for x in self.infos])[self.code]
            step = self.delta * own
            # a close tag leaves the containers that its element entered
            step[self.close[self.opens]] = -step[self.opens]
            keep |= (c == i) & ((np.cumsum(step) - step)[tok] > 0)
        tok, self.hit_k = tok[keep], k[keep]
        self.noted, self.hit_at = np.unique(tok, return_inverse=True)

    def _lists(self, page: np.ndarray, values: pa.Array) -> pa.ListArray:
        off = np.concatenate(([0], np.cumsum(np.bincount(page, minlength=self.n_pages))))
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), values)

    def _near(self, full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces whose texts hold one of the words, and the tags of their parents (-1: the document)."""
        holds = pc.match_substring_regex(self.texts, self.words).to_numpy(zero_copy_only=False)
        piece = np.flatnonzero(holds[self.of_piece] & full)
        return piece, self._parents(self.of_piece[piece] - self.n_pages)

    def _parents(self, at: np.ndarray) -> np.ndarray:
        """The tags of the elements around the texts after some tags (negative: before a page's first tag), or -1."""
        parent = np.full(len(at), -1, dtype=np.int64)
        after = at >= 0
        if after.any():
            parent[after] = self._innermost(self.depth[at[after]], at[after])
        return parent

    def columns(self, lines: bool) -> list[pa.Array]:
        """The text nodes (or with ``lines`` the page's text), the columns ``SELECTED`` and, where words are looked for, these
        and the page's text beside the nodes."""
        i32, out, noted = pa.int32(), self.out, self.noted
        raw = np.concatenate((np.zeros(self.n_pages, dtype=bool), self.raw))
        entity = pc.match_substring(self.texts, "&").to_numpy(zero_copy_only=False) & ~raw
        if entity.any():
            mask = pa.array(entity)
            self.texts = pc.replace_with_mask(self.texts, mask, pa.array([_html.unescape(t) for t in self.texts.filter(mask).to_pylist()], pa.string()))
        full = (pc.binary_length(self.texts).to_numpy(zero_copy_only=False) > 0)[self.of_piece] & self.plain[self.piece_page]
        near, above = self._near(full) if self.words else (None, noted[:0])
        if out.all_texts:
            kept = full
        else:
            step = np.zeros(self.n, dtype=np.int64)
            inner = np.unique(np.concatenate((noted[self.delta[noted] > 0], above[above >= 0])))
            step[inner] = 1
            step[self.close[inner]] -= 1
            inside = np.zeros(len(full), dtype=bool)
            inside[self.piece_of] = np.cumsum(step) > 0
            if self.words:  # the whole document is the parent
                inside |= np.isin(self.piece_page, self.piece_page[near[above < 0]])
            kept = full & inside
        piece = np.flatnonzero(kept)
        page, at = self.piece_page[piece], self.of_piece[piece] - self.n_pages  # at: the tag before the text, if not negative
        text, own_raw = self.texts.take(pa.array(self.of_piece[piece])), raw[self.of_piece[piece]]
        if lines:
            if self.words:
                whole = np.flatnonzero(full & ~raw[self.of_piece])
                as_lines = pc.binary_join(self._lists(self.piece_page[whole], self.texts.take(pa.array(self.of_piece[whole]))), "\n")
            else:
                nodes = pc.binary_join(self._lists(page[~own_raw], text.filter(pa.array(~own_raw))), "\n")
        if self.words or not lines:
            parent = np.full(len(piece), -1, dtype=np.int64)
            if not self.flat and self.n:
                tag = self._parents(at)
                parent = np.where(tag >= 0, self.element[tag], -1)
            nodes = self._lists(page, pa.StructArray.from_arrays(
                [text, pa.array(parent, i32), pa.array(_KINDS, pa.string()).take(pa.array(np.where(own_raw, _RAW, _TEXT)))], fields=list(_A_TEXT)))
        before = np.concatenate(([0], np.cumsum(kept)))
        cols = [nodes, *self._noted(before)]
        if self.words:
            page = self.piece_page[near]
            here, all_kept = before[self.first[page]], np.bincount(self.piece_page[piece], minlength=self.n_pages)
            inner, t0, t1 = above >= 0, np.zeros(len(near), dtype=np.int64), all_kept[page]
            t0[inner], t1[inner] = (before[self.piece_of[x[inner]]] - here[inner] for x in (above, self.close[above] if self.n else above))
            cols.append(self._lists(page, pa.StructArray.from_arrays(
                [pa.array(x, i32) for x in (before[near] - here, t0, t1)], fields=list(_A_WORD))))
            cols += [as_lines] if lines else []
        return cols

    def _noted(self, before: np.ndarray) -> list[pa.Array]:
        """The columns ``SELECTED``: of the noted elements number, range of texts, previous sibling."""
        i32, out, noted = pa.int32(), self.out, self.noted
        if not len(noted):
            empty = self._lists(noted, pa.array([], i32))
            return [*[empty] * 5, self._lists(noted, out._elem_field("attrs", pa.array([], i32)))]
        texts_at = lambda tok: before[self.piece_of[tok]] - before[self.first[self.page[tok]]]
        prev = np.full(len(noted), -1, dtype=np.int64)
        if DT in out.select:
            prev = self._previous()[noted]
        page, at = self.page[noted[self.hit_at]], self.hit_at
        cols = [self.element[noted], self.hit_k, texts_at(noted), texts_at(self.close[noted]), prev]
        cols = [self._lists(page, pa.array(x if x is self.hit_k else x[at], i32)) for x in cols]
        meta = np.isin(self.hit_k, (META, LINK))
        return [*cols, self._lists(page[meta], out._elem_field("attrs", pa.array(self.number[noted[at[meta]]], i32)))]

    def _previous(self) -> np.ndarray:
        """For each start tag the number of the element before it under the same parent, or -1."""
        tok = np.flatnonzero(self.start)
        above = self.depth[tok] - self.delta[tok]
        parent = self._innermost(above, tok)
        parent = np.where(parent < 0, -1 - self.page[tok], parent)
        order = np.lexsort((tok, above))
        a, b = order[:-1], order[1:]
        out = np.full(self.n, -1, dtype=np.int64)
        same = (above[a] == above[b]) & (parent[a] == parent[b])
        out[tok[b[same]]] = self.element[tok[a[same]]]
        return out


def _selected_pages(html: pa.Array, select: tuple[int, ...], texts: bool, lines: bool, words: str = "") -> tuple[list[pa.Array], list]:
    """The columns that a job reads which names its selectors, and each page's error."""
    as_text = not (pa.types.is_binary(html.type) or pa.types.is_large_binary(html.type))  # bytes are read one by one
    plain = _PlainPages(_Columns(False, select, texts), html.cast(pa.string()) if as_text else pa.nulls(len(html), pa.string()), words)
    plain.plain &= as_text
    cols, errs = plain.columns(lines), [None] * len(html)
    rest = np.flatnonzero(~plain.plain)
    if len(rest):
        other = _Columns(bool(words), select, texts or bool(words))  # words' parents are any elements
        for i, doc in zip(rest.tolist(), html.take(pa.array(rest)).to_pylist()):
            try:
                parse_into(other, doc)
            except Exception as exc:  # noqa: BLE001 - a bad page goes to quarantine
                other.rollback()
                errs[i] = f"{type(exc).__name__}: {exc}"
            other.end_page()
        nodes = other.lines() if lines and not words else other.arrays(())[1]
        more = [other.words(words), *([other.lines()] if lines else [])] if words else []
        at = np.arange(len(html))
        at[rest] = len(html) + np.arange(len(rest))
        cols = [pa.concat_arrays([a, b]).take(pa.array(at)) for a, b in zip(cols, [nodes, *other.hits(True), *more])]
    return cols, errs


def _selected_names(texts: bool, lines: bool, words: bool) -> list[str]:
    nodes = "texts" if texts else "noted"
    return [nodes, *SELECTED, "words"] + ["lines"] * lines if words else ["lines" if lines else nodes, *SELECTED]


def _parse_selected(batches, keep_html: bool, texts: bool, select: tuple[int, ...], lines: bool, words: str = ""):
    names_added = [*_selected_names(texts, lines, bool(words)), "parse_error"]
    for rb in batches:
        names = [f for f in rb.schema.names if keep_html or f != "html"]
        html = rb.column("html")
        size, lo = pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False).astype(np.int64), 0
        ends = np.cumsum(size)
        while lo < len(html):
            done = int(ends[lo - 1]) if lo else 0
            hi = min(int(np.searchsorted(ends, done + FLUSH_CHARS)) + 1, len(html))
            cols, errs = _selected_pages(html.slice(lo, hi - lo), select, texts, lines, words)
            yield pa.RecordBatch.from_arrays([rb.column(f).slice(lo, hi - lo) for f in names] + cols + [pa.array(errs, pa.string())],
                                             names=names + names_added)
            lo = hi


def _parse_batches(batches, keep_html: bool, fields: tuple[str, ...] = ELEM_FIELDS, texts: bool = True, hits: bool = True):
    added = ["elems"] * bool(fields) + ["texts"] * texts + HITS * hits + ["parse_error"]
    for rb in batches:
        names = [f for f in rb.schema.names if keep_html or f != "html"]
        docs = rb.column("html").to_pylist()
        out, errs, done, chars = _Columns(), [], 0, 0
        for k, doc in enumerate(docs):
            try:
                parse_into(out, doc)
                errs.append(None)
            except Exception as exc:  # noqa: BLE001 - a bad page goes to quarantine
                out.rollback()
                errs.append(f"{type(exc).__name__}: {exc}")
            out.end_page()
            chars += len(doc or "")
            if chars >= FLUSH_CHARS or k + 1 == len(docs):
                elems, nodes = out.arrays(fields, texts)
                cols = [rb.column(f).slice(done, k + 1 - done) for f in names]
                yield pa.RecordBatch.from_arrays(
                    cols + [elems] * bool(fields) + [nodes] * texts + (out.hits() if hits else [])
                    + [pa.array(errs, type=pa.string())], names=names + added)
                out, errs, done, chars = _Columns(), [], k + 1, 0


def parsed_pages(pages: DataFrame, keep_html: bool = False, fields: tuple[str, ...] = ELEM_FIELDS,
                 texts: bool = True, hits: bool = True, select: tuple[int, ...] | None = None, lines: bool = False,
                 words: tuple[str, ...] = ()) -> DataFrame:
    """Add ``elems``, ``texts``, ``hit_i`` .. ``hit_t1`` and ``parse_error`` to each page row (narrow).

    The other page columns pass through the Arrow batch untouched, so no join
    back is needed and the page partitioning is kept.  A page the tokenizer
    cannot handle gets empty arrays and a ``parse_error`` (quarantine, E18).
    A job that needs only some element ``fields`` (or no elements), no ``texts`` or no ``hits`` says so: what
    is left out is neither sent to the JVM nor copied there.  One that reads certain selectors only names their
    numbers in ``select`` and gets no elements but the columns ``SELECTED``, with ``noted`` for ``texts`` unless it asks for all; with ``lines`` the page's text
    stands there as one string, a line for each text node outside of scripts, styles and comments.  ``words`` (of ASCII
    letters) add the nodes that may hold one in any case, ``words``; ``lines`` then stands beside the nodes.
    """
    own = [f for f in pages.schema.fields if keep_html or f.name != "html"]
    numbers, nodes = T.ArrayType(T.IntegerType()), T.ArrayType(TEXT_TYPE)
    if select is None:
        added = ([T.StructField("elems", T.ArrayType(T.StructType([ELEM_TYPE[f] for f in fields])))] * bool(fields)
                 + [T.StructField("texts", nodes)] * texts + [T.StructField(c, numbers) for c in HITS] * hits)
    else:
        types = {"lines": T.StringType(), "texts": nodes, "noted": nodes, "words": T.ArrayType(WORD_TYPE),
                 "metas": T.ArrayType(ELEM_TYPE["attrs"].dataType)}
        added = [T.StructField(c, types.get(c, numbers)) for c in _selected_names(texts, lines, bool(words))]
    schema = T.StructType(own + added + [T.StructField("parse_error", T.StringType())])
    if select is not None:
        pattern, texts = words_pattern(words), texts or (lines and not words)
        return pages.mapInArrow(lambda it: _parse_selected(it, keep_html, texts, select, lines, pattern), schema)
    return pages.mapInArrow(lambda it: _parse_batches(it, keep_html, fields, texts, hits), schema)
