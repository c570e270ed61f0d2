"""Selector matching over the per-page ``elems``/``texts`` arrays.

Every helper builds a Spark SQL expression (higher-order functions
``filter``, ``exists``, ``transform``, ``slice``) that runs inside the task
holding the page: no Python, no shuffle.  Expressions are composed as SQL
text and turned into a Column with one ``F.expr`` call, which keeps the
driver-side cost of building a plan small.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.html import CONTAINERS, DT, H2, META
from .text import WS_LITERAL

_ids = itertools.count()


def lit(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def var(prefix: str = "v") -> str:
    """A fresh lambda variable name (nested lambdas must not shadow)."""
    return f"{prefix}{next(_ids)}"


def strip_sql(x: str) -> str:
    """``str.strip()`` of SQL expression ``x`` (a character-set trim, no regex)."""
    return f"btrim({x}, {WS_LITERAL})"


def nullif_empty_sql(x: str) -> str:
    return f"nullif({x}, '')"


def elem_at_sql(ix: str) -> str:
    """Element by 0-based index (null for -1 / null)."""
    return f"(CASE WHEN {ix} >= 0 THEN try_element_at(elems, {ix} + 1) END)"


def let_sql(expr: str, body) -> str:
    """Bind ``expr`` once and use it in ``body(v)`` (a one-element lambda)."""
    v = var("let")
    return f"element_at(transform(array({expr}), {v} -> {body(v)}), 1)"


def _joined_sql(nodes: str, kind: str, sep: str, strip: bool) -> str:
    """The texts of the nodes of a kind, joined; nulls (other kinds, with ``strip`` also blank texts) are passed over."""
    t = var("t")
    return _join_sql(nodes, t, f"{t}.kind = {kind}", sep, strip)


def _join_sql(nodes: str, t: str, fits: str, sep: str, strip: bool) -> str:
    """The texts of the nodes that fit (a condition on ``t``), joined; each is stripped once."""
    if not strip:
        return f"array_join(transform({nodes}, {t} -> CASE WHEN {fits} THEN {t}.text END), {lit(sep)})"
    x = var("x")
    texts = f"transform({nodes}, {t} -> CASE WHEN {fits} THEN {strip_sql(t + '.text')} END)"
    return f"array_join(filter({texts}, {x} -> {x} != ''), {lit(sep)})"


def elem_text_sql(e: str, sep: str = " ", strip: bool = True) -> str:
    """``get_text(separator=sep, strip=strip)`` of element struct expression ``e``."""
    return let_sql(e, lambda v: _joined_sql(f"slice(texts, {v}.t0 + 1, {v}.t1 - {v}.t0)",
                                            f"IF({v}.tag IN ('script', 'style'), 'raw', 'text')", sep, strip))


def doc_text_sql(sep: str = "", strip: bool = False) -> str:
    """``get_text`` of the whole document (script, style and comments excluded)."""
    return _joined_sql("texts", "'text'", sep, strip)


def _class_tokens(e: str) -> str:
    return f"{e}.classes"


def within(tag: str | None, cls: str | None) -> str:
    """Name of an enclosing element as the tokenizer records it; a pair it does not record is an error."""
    return CONTAINERS[(tag, cls)]


def predicate_sql(spec: dict, e: str, i: str) -> str:
    """Structured selector (see ``rules.SELECTOR_RULES``) as a condition on ``e``/``i``."""
    conds = []
    if "tag" in spec:
        conds.append(f"{e}.tag = {lit(spec['tag'])}")
    if "id" in spec:
        conds.append(f"coalesce({e}.id = {lit(spec['id'])}, false)")
    if "class_eq" in spec:
        conds.append(f"array_contains({_class_tokens(e)}, {lit(spec['class_eq'])})")
    if "class_like" in spec:
        conds.append(f"coalesce(contains({e}.cls, {lit(spec['class_like'])}), false)")
    if "attr" in spec:
        conds.append(f"map_contains_key({e}.attrs, {lit(spec['attr'])})")
    if "ancestor_class" in spec:
        conds.append(f"array_contains({e}.within, {lit(within(None, spec['ancestor_class']))})")
    if "dt" in spec:
        prev = elem_at_sql(f"{e}.prev")
        conds.append(f"{e}.tag = 'dd' AND {e}.prev >= 0 AND coalesce({prev}.tag = 'dt', false) "
                     f"AND contains({elem_text_sql(prev, '', False)}, {lit(spec['dt'])})")
    if "has_h2" in spec:
        d = var("d")
        conds.append(f"exists(slice(elems, {i} + 2, {e}.end - {i} - 1), {d} -> {d}.tag = 'h2' "
                     f"AND contains({elem_text_sql(d, '', False)}, {lit(spec['has_h2'])}))")
    return "(" + " AND ".join(conds) + ")"


def _cheap_guard(spec: dict, e: str) -> str:
    """A cheap necessary condition checked before the full predicate."""
    if "tag" in spec:
        return f"{e}.tag = {lit(spec['tag'])}"
    if "dt" in spec:
        return f"{e}.tag = 'dd'"
    if "id" in spec:
        return f"{e}.id IS NOT NULL"
    if "class_eq" in spec or "class_like" in spec:
        return f"{e}.cls IS NOT NULL"
    return "true"


def first_index_sql(spec: dict) -> str:
    """``select_one``: index of the first element (document order) matching ``spec``."""
    e, i, x = var("e"), var("i"), var("x")
    return (f"try_element_at(filter(transform(elems, ({e}, {i}) -> "
            f"CASE WHEN {_cheap_guard(spec, e)} AND {predicate_sql(spec, e, i)} THEN {i} END), "
            f"{x} -> {x} IS NOT NULL), 1)")


def hits_sql(k: int) -> str:
    """The elements that the tokenizer has noted for selector ``k``, in document order."""
    n, j, x = var("n"), var("j"), var("x")
    return (f"filter(transform(hit_k, ({n}, {j}) -> CASE WHEN {n} = {k} THEN hit_i[{j}] END), "
            f"{x} -> {x} IS NOT NULL)")


def first_hit_sql(k: int, spec: dict) -> str:
    """``select_one`` over the noted elements: a search of a short array of numbers, and only for a
    selector that asks for a neighbour's or a descendant's text a test of those noted for it."""
    if "dt" in spec or "has_h2" in spec:
        i = var("i")
        fits = let_sql(elem_at_sql(i), lambda e: predicate_sql(spec, e, i))
        return f"try_element_at(filter({hits_sql(k)}, {i} -> {fits}), 1)"
    return f"try_element_at(hit_i, cast(nullif(array_position(hit_k, {k}), 0) AS int))"


def _noted_at_sql(k: int) -> str:
    """The positions (from 1) of selector ``k`` among the noted elements."""
    n, j, x = var("n"), var("j"), var("x")
    return f"filter(transform(hit_k, ({n}, {j}) -> CASE WHEN {n} = {k} THEN {j} + 1 END), {x} -> {x} IS NOT NULL)"


def _near_sql(spec: dict, at: str, nodes: str) -> str:
    """Whether the noted element at ``at`` has the neighbour or descendant that a selector asks for, which is noted too.

    A heading that holds a text stands below an element where it begins later and its texts are among the element's."""
    q = var("q")
    if "dt" in spec:
        k, word, near = DT, spec["dt"], f"hit_i[{q} - 1] = hit_prev[{at} - 1]"
    else:
        k, word = H2, spec["has_h2"]
        near = (f"hit_i[{q} - 1] > hit_i[{at} - 1] AND hit_t0[{q} - 1] >= hit_t0[{at} - 1] AND hit_t1[{q} - 1] <= hit_t1[{at} - 1]")
    return f"exists({_noted_at_sql(k)}, {q} -> {near} AND contains({hit_text_sql(q, '', False, nodes)}, {lit(word)}))"


def first_hit_at_sql(k: int, spec: dict, nodes: str | None = None) -> str:
    """``select_one`` as a position (from 1) among the noted elements, which is enough for the element's text.

    ``nodes``: the text nodes of pages parsed without elements, where the tokenizer notes what such a selector asks for."""
    if "dt" in spec or "has_h2" in spec:
        at = var("p")
        fits = _near_sql(spec, at, nodes) if nodes else let_sql(
            f"hit_i[{at} - 1]", lambda i: let_sql(elem_at_sql(i), lambda e: predicate_sql(spec, e, i)))
        return f"try_element_at(filter({_noted_at_sql(k)}, {at} -> {fits}), 1)"
    return f"cast(nullif(array_position(hit_k, {k}), 0) AS int)"


def hit_text_sql(at: str, sep: str = " ", strip: bool = True, texts: str = "texts") -> str:
    """``get_text`` of the noted element at position ``at`` (a column); null without one.

    The content of a script or style is text of that element only, which is the node's parent."""
    t = var("t")
    nodes = f"slice({texts}, hit_t0[{at} - 1] + 1, hit_t1[{at} - 1] - hit_t0[{at} - 1])"
    fits = f"({t}.kind = 'text' OR ({t}.kind = 'raw' AND {t}.parent = hit_i[{at} - 1]))"
    return f"CASE WHEN {at} IS NOT NULL THEN {_join_sql(nodes, t, fits, sep, strip)} END"


def text_of_index_sql(ix: str) -> str:
    """Non-empty ``get_text(' ', strip=True)`` of element ``ix`` or null."""
    return let_sql(elem_text_sql(elem_at_sql(ix), " ", True), nullif_empty_sql)


def first_text_of(hit_cols: list[str], max_chars: int = 500, nodes: str = "texts") -> Column:
    """E0 over precomputed first-match columns (positions among the noted elements, priority order)."""
    texts = ", ".join(let_sql(hit_text_sql(c, texts=nodes), nullif_empty_sql) for c in hit_cols)
    return F.expr(f"substring(coalesce({texts}), 1, {max_chars})")


def first_text_sql(rules: list, max_chars: int = 500) -> str:
    texts = ", ".join(text_of_index_sql(first_index_sql(spec)) for _css, spec in rules)
    return f"substring(coalesce({texts}), 1, {max_chars})"


def first_text(rules: list, max_chars: int = 500) -> Column:
    """First selector whose first element has non-empty text; its text[:n]."""
    return F.expr(first_text_sql(rules, max_chars))


def hit_text(hit_col: str, sep: str = "", strip: bool = False, nodes: str = "texts") -> Column:
    """get_text of the noted element at position column ``hit_col`` (null when absent)."""
    return F.expr(hit_text_sql(hit_col, sep, strip, nodes))


def doc_text(sep: str = "", strip: bool = False) -> Column:
    return F.expr(doc_text_sql(sep, strip))


def meta_entries(attrs: str | None = None) -> Column:
    """E1 entries in document order: (key = name or property, value = stripped content), from the
    meta elements' attributes (a column) or the noted elements."""
    i, a1, a2 = var("i"), var("a"), var("a")
    attrs = attrs or f"transform({hits_sql(META)}, {i} -> elems[{i}].attrs)"
    key = lambda a: f"coalesce(nullif({a}['name'], ''), {a}['property'])"
    return F.expr(
        f"transform(filter({attrs}, {a1} -> {key(a1)} IS NOT NULL "
        f"AND nullif({a1}['content'], '') IS NOT NULL), "
        f"{a2} -> named_struct('key', {key(a2)}, 'value', {strip_sql(a2 + '[' + lit('content') + ']')}))")


def meta_get(key: str, entries_col: str = "_meta") -> Column:
    """Value of the last meta entry with ``key`` (later duplicates win)."""
    m = var("m")
    return F.expr(f"try_element_at(filter({entries_col}, {m} -> {m}.key = {lit(key)}), -1).value")


def meta_map(entries_col: str = "_meta") -> Column:
    """E1 as ``map<string,string>``, keeping the last value per key."""
    m, i, later = var("m"), var("i"), var("l")
    return F.expr(
        f"map_from_entries(filter({entries_col}, ({m}, {i}) -> NOT exists("
        f"slice({entries_col}, {i} + 2, greatest(size({entries_col}) - {i} - 1, 0)), "
        f"{later} -> {later}.key = {m}.key)))")


def nodes_like_sql(pattern: str) -> str:
    """The text nodes (any kind) that hold ``pattern``, each with the range of its parent's texts."""
    t, u = var("t"), var("t")
    at = lambda field, whole: f"IF({u}.parent < 0, {whole}, elems[{u}.parent].{field})"
    return (f"transform(filter(texts, {t} -> {t}.text RLIKE {lit(pattern)}), {u} -> named_struct("
            f"'text', {u}.text, 'kind', {u}.kind, 't0', {at('t0', '0')}, 't1', {at('t1', 'size(texts)')}))")


def word_nodes_sql(nodes: str) -> str:
    """The same of pages parsed for selectors, as the tokenizer has noted them (``words``) among ``nodes``."""
    w = var("w")
    return (f"transform(words, {w} -> named_struct('text', {nodes}[{w}.at].text, 'kind', {nodes}[{w}.at].kind, "
            f"'t0', {w}.t0, 't1', {w}.t1))")


def _above_sql(node: str, sep: str, strip: bool) -> str:
    """get_text of a noted node's parent, which may be the document; only a script's or style's node is a raw one."""
    return _joined_sql(f"slice(texts, {node}.t0 + 1, {node}.t1 - {node}.t0)", f"IF({node}.kind = 'raw', 'raw', 'text')", sep, strip)


def node_scan(node_pattern: str, parent_sep: str, parent_strip: bool, value_sql, nodes: str) -> str:
    """Nodes of ``nodes`` (as of ``nodes_like_sql``) matching ``node_pattern`` -> ``value_sql(parent_text)``,
    in document order, as an array expression."""
    t = var("t")
    u = var("t")
    return (f"transform(filter({nodes}, {t} -> {t}.text RLIKE {lit(node_pattern)}), "
            f"{u} -> {value_sql(_above_sql(u, parent_sep, parent_strip))})")


def first_node_value(node_pattern: str, parent_sep: str, parent_strip: bool, value_sql, nodes: str) -> str:
    """The first non-null ``value_sql(parent_text)`` over the nodes matching ``node_pattern``; parents after it are not read."""
    t, acc, u = var("t"), var("a"), var("t")
    value = value_sql(_above_sql(u, parent_sep, parent_strip))
    return (f"aggregate(filter({nodes}, {t} -> {t}.text RLIKE {lit(node_pattern)}), cast(NULL AS string), "
            f"({acc}, {u}) -> coalesce({acc}, {value}))")
