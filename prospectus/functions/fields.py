"""Per-value field rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .text import PY_WS, col_, nullif_empty, py_strip


def pattern_group(c, pattern: str, group: int = 1) -> Column:
    """``re.search(pattern, c).group(n)`` or null; a group that may match nothing is null then too."""
    return F.nullif(F.regexp_extract(col_(c), pattern, group), F.lit(""))


def capitalize(c) -> Column:
    """``str.capitalize``: first character upper, the rest lower."""
    c = col_(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def parse_degree(text) -> Column:
    """First marker (in list order) contained case-insensitively."""
    t = F.lower(col_(text))
    out = None
    for d in rules.DEGREE_MARKERS:
        cond = t.contains(d.lower())
        out = F.when(cond, F.lit(d.strip())) if out is None else out.when(cond, F.lit(d.strip()))
    return out


def _quote(s: str) -> str:
    return r"\Q" + s + r"\E"


def priced_parts(text) -> Column:
    """The '£ amount's of a text in order, each with what stands before it on its line, from the last pound sign on.

    A keyword (without line break or pound sign) that has the amount later on its line stands there, so
    the text is cut once for all keywords and no pattern scans it."""
    pieces = F.split(col_(text), "£")
    n = F.size(pieces) - 1
    both = F.zip_with(F.slice(pieces, 1, n), F.slice(pieces, 2, n), lambda before, after: F.struct(
        F.substring_index(before, "\n", -1).alias("before"),
        F.regexp_extract(after, f"(?U)^{PY_WS}*([\\d,]+)", 1).alias("amount")))
    # a text of ASCII characters has its lower-case form beside it, where a keyword is found without a pattern
    return F.transform(F.filter(both, lambda p: p["amount"] != ""), lambda p: F.struct(
        p["before"], p["amount"],
        F.when(F.octet_length(p["before"]) == F.length(p["before"]), F.lower(p["before"])).alias("plain")))


def _names(part: Column, keyword: str) -> Column:
    """Whether a priced part's text holds the keyword (lower-case ASCII) in any case."""
    return F.coalesce(part["plain"].contains(keyword), part["before"].rlike(f"(?iU){_quote(keyword)}"))


def fee_from_parts(parts, keywords: list[str]) -> Column:
    """E11 over a text's ``priced_parts``: the first keyword with an amount; else the first amount."""
    parts = col_(parts)
    first = lambda kw: F.try_element_at(F.filter(parts, lambda p: _names(p, kw)), F.lit(1))
    part = F.coalesce(*[first(kw) for kw in keywords], F.try_element_at(parts, F.lit(1)))
    digits = F.translate(part["amount"], ",", "")
    # a pound sign followed by commas only has no amount: null (no exception)
    return F.when(digits != "", digits.try_cast("bigint"))


def fee_from_text(text, keywords: list[str]) -> Column:
    """First keyword with '£ amount' later on its line; else the first £ amount."""
    return fee_from_parts(priced_parts(text), keywords)


def study_modes_from_text(text, strict: bool) -> Column:
    """E8 (strict regex) / N6 (substring) study modes; default [full-time]."""
    t = col_(text)
    if strict:
        full = t.rlike(f"(?iU)full[{PY_WS[1:-1]}-]time")
        part = t.rlike(f"(?iU)part[{PY_WS[1:-1]}-]time")
        dist = t.rlike("(?i)distance")
    else:
        low = F.lower(t)
        full, part, dist = low.contains("full"), low.contains("part"), low.contains("distance")
    modes = F.array_compact(F.array(F.when(full, F.lit("full-time")),
                                    F.when(part, F.lit("part-time")),
                                    F.when(dist, F.lit("distance-learning"))))
    return F.when(F.size(modes) > 0, modes).otherwise(F.array(F.lit(rules.DEFAULT_STUDY_MODE)))


def norm_study_modes(raw) -> Column:
    """A list passes as is (empty -> default); text -> substring rule."""
    raw = col_(raw)
    return study_modes_from_text(raw, strict=False)


def norm_study_modes_array(raw) -> Column:
    raw = col_(raw)
    return F.when(F.coalesce(F.size(raw), F.lit(0)) > 0, raw).otherwise(
        F.array(F.lit(rules.DEFAULT_STUDY_MODE)))


def _raw_fallback(raw: Column) -> Column:
    return F.substring(py_strip(raw), 1, rules.DEGREE_RAW_MAX_CHARS)


def norm_degree(raw, compat: bool = False) -> Column:
    """Degree text -> canonical label.

    ``compat=True`` is the literal rule: strip every character of the class
    ``[\\s.()Hons]``, lower-case, first dictionary key (in order) contained.
    The default is the intended rule: drop the word "hons" and ``[\\s.()]``,
    exact key first, then the longest contained key.
    Both fall back to the stripped raw text (20 characters).
    """
    raw = col_(raw)
    if compat:
        key = F.lower(F.regexp_replace(raw, f"[{PY_WS[1:-1]}.()Hons]+", ""))
        out = None
        for k, v in rules.DEGREE_NORMALISATION:
            c = key.contains(k)
            out = F.when(c, F.lit(v)) if out is None else out.when(c, F.lit(v))
    else:
        key = F.regexp_replace(F.regexp_replace(F.lower(raw), r"(?U)\bhons\b", ""),
                               f"[{PY_WS[1:-1]}.()]+", "")
        keys = [(k, v) for k, v in rules.DEGREE_NORMALISATION if "." not in k]
        out = None
        for k, v in keys:  # exact match
            c = key == k
            out = F.when(c, F.lit(v)) if out is None else out.when(c, F.lit(v))
        for k, v in sorted(keys, key=lambda kv: -len(kv[0])):  # longest contained key
            out = out.when(key.contains(k), F.lit(v))
    return F.when(nullif_empty(raw).isNotNull(), out.otherwise(_raw_fallback(raw)))


def norm_level(raw) -> Column:
    """lower/strip, mapped through the level table; unknown passes through."""
    raw = col_(raw)
    key = py_strip(F.lower(raw))
    m = F.create_map(*[x for kv in rules.LEVEL_NORMALISATION for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.when(nullif_empty(raw).isNotNull(), F.coalesce(F.element_at(m, key), key))


def falsy(c: Column, dtype: str) -> Column:
    """Python truthiness of a value: null, '' and 0 are false."""
    if dtype == "string":
        return c.isNull() | (c == "")
    if dtype == "array":
        return c.isNull() | (F.size(c) == 0)
    return c.isNull() | (c == 0)


def needs_fallback(types: dict[str, str]) -> Column:
    """At least ``FALLBACK_THRESHOLD`` core fields are falsy."""
    n = None
    for f in rules.FALLBACK_CORE_FIELDS:
        x = falsy(F.col(f), types[f]).cast("int")
        n = x if n is None else n + x
    return n >= rules.FALLBACK_THRESHOLD
