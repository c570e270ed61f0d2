"""Field extraction (E0-E19): parsed page -> the 17-field raw record.

Input: a page DataFrame that went through ``html.parsed_pages`` (has ``elems``
and ``texts``).  Every field is a column expression over the page's own
arrays, so extraction is a narrow projection with no shuffle.

The work is staged in three projections so that each expensive piece is
computed once per page and then referenced by name:

1. ``stage_inputs``: each selector rule's first element among those that the tokenizer
   noted for it (``hit_k``), the meta entries, the title index;
2. the texts of the selected elements per field (``_txt_<field>``), the title
   text and the whole page's amounts;
3. the field rules themselves (the functions below), over those columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import selectors as S
from ..functions.fields import (capitalize, fee_from_parts, parse_degree, pattern_group,
                                priced_parts, study_modes_from_text)
from ..functions.text import PY_WS, nullif_empty, py_strip
from .html import DD, META, SELECTED, TITLE, parsed_pages

R = rules.SELECTOR_RULES
MAX_CHARS = {"description": rules.DESCRIPTION_MAX_CHARS,
             "entry_requirements": rules.ENTRY_REQUIREMENTS_MAX_CHARS}
ARRAYS = ["elems", "texts"]
HITS = ["hit_i", "hit_t0", "hit_t1"]
PARSED = [*ARRAYS, *HITS, "hit_k"]
#: what extraction reads of an element (attributes for the meta entries)
ELEM_FIELDS = ("tag", "attrs", "end", "t0", "t1", "prev")
#: the words whose text nodes E7, E14 and E15 look for; one pass finds the few nodes of all three
WORDS = {"ucas_code": ("UCAS",), "deadline_late": ("late", "clearing"), "ielts_score": ("IELTS",)}
ALL_WORDS = tuple(w for words in WORDS.values() for w in words)
NODE_WORDS = "(?iU)" + "|".join(ALL_WORDS)


def selected(fields: tuple[str, ...], title: bool = False, meta: bool = False) -> tuple[int, ...]:
    """The numbers of the selectors of ``fields``, for pages that are parsed for them only."""
    out, offset = [TITLE] * title + [META] * meta, 0
    for field, rs in R.items():
        out += range(offset, offset + len(rs)) if field in fields else ()
        offset += len(rs)
    return tuple(out)


def stage_selected(parsed: DataFrame, keep: list[str], fields: tuple[str, ...]) -> DataFrame:
    """Stages 1-2 for pages parsed for the selectors of ``fields`` only (``html.parsed_pages`` with ``select``);
    the whole page's amounts are there where all texts or its ``lines`` were asked for, and the nodes that hold a word
    where ``words`` were."""
    nodes = _nodes_of(parsed)
    s1, matches = _matched(parsed, keep, fields)
    if nodes == "lines":  # the whole page's amounts and nothing else
        return s1.select(*keep, priced_parts("lines").alias("_priced"))
    return s1.select(*keep, *_page_columns(s1, nodes), *_text_columns(matches, nodes))


def _nodes_of(parsed: DataFrame) -> str:
    return next(c for c in ("noted", "texts", "lines") if c in parsed.columns)


def _matched(parsed: DataFrame, keep: list[str], fields: tuple[str, ...]) -> tuple[DataFrame, dict[str, list[str]]]:
    """Stage 1 for such pages, and the columns of each field's matches."""
    nodes = _nodes_of(parsed)
    more = [c for c in ("words", "lines") if c in parsed.columns and c != nodes]
    ix_cols, matches, offset = [], {}, 0
    for field, rs in R.items():
        if field in fields:
            matches[field] = [f"_ix_{field}_{k}" for k in range(len(rs))]
            ix_cols += [F.expr(S.first_hit_at_sql(offset + k, spec, nodes)).alias(at) for k, ((_css, spec), at) in enumerate(zip(rs, matches[field]))]
        offset += len(rs)
    return parsed.select(*keep, nodes, *more, *SELECTED, F.expr(S.first_hit_at_sql(TITLE, {"tag": "title"})).alias("_ix_title"), *ix_cols), matches


def _text_columns(matches: dict[str, list[str]], nodes: str) -> list[Column]:
    return [S.first_text_of(at, MAX_CHARS.get(field, rules.DEFAULT_MAX_CHARS), nodes).alias(f"_txt_{field}") for field, at in matches.items()]


def _page_columns(s1: DataFrame, nodes: str) -> list[Column]:
    """What fields read beside the texts of their selectors."""
    priced = ([priced_parts("lines").alias("_priced")] if "lines" in s1.columns
              else [priced_parts(S.doc_text("\n", False)).alias("_priced")] if nodes == "texts" else [])
    near = [F.col(nodes).alias("texts"), F.expr(S.word_nodes_sql(nodes)).alias("_nodes")] if "words" in s1.columns else []
    return [*near, S.hit_text("_ix_title", "", False, nodes).alias("_title"), S.meta_entries("metas").alias("_meta"), *priced]


def stage_inputs(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Stages 1-2: per-rule first matches, then per-field texts; fields that a job does not
    read are pruned, each has columns of its own.

    Pages parsed without elements have no meta entries, no text nodes' parents and no field with a
    selector that looks at a neighbour or a descendant."""
    read = set(parsed.schema["elems"].dataType.elementType.names) if "elems" in parsed.columns else set()
    arrays = [c for c in ARRAYS if c in parsed.columns]
    near = read >= {"tag", "end", "t0", "t1", "prev"}
    keep = keep if keep is not None else [c for c in parsed.columns if c not in (*PARSED, "parse_error")]
    # rule k's first element
    ix_cols, offset, fields = [], 0, []
    for field, rs in R.items():
        if near or not any("dt" in spec or "has_h2" in spec for _css, spec in rs):
            fields.append(field)
            for k, (_css, spec) in enumerate(rs):
                ix_cols.append(F.expr(S.first_hit_at_sql(offset + k, spec)).alias(f"_ix_{field}_{k}"))
        offset += len(rs)
    # a job that has not asked for attributes has no meta entries
    more = [S.meta_entries().alias("_meta")] if "attrs" in read else []
    # without text ranges there are no texts of nodes' parents
    more += [F.expr(S.nodes_like_sql(NODE_WORDS)).alias("_nodes")] if read >= {"t0", "t1"} else []
    s1 = parsed.select(*keep, *arrays, *HITS, "parse_error", F.expr(S.first_hit_at_sql(TITLE, {"tag": "title"})).alias("_ix_title"),
                       *more, *ix_cols)
    txt_cols = [S.first_text_of([f"_ix_{field}_{k}" for k in range(len(R[field]))],
                                MAX_CHARS.get(field, rules.DEFAULT_MAX_CHARS)).alias(f"_txt_{field}")
                for field in fields]
    return s1.select(*keep, *arrays, "parse_error", *[c for c in ("_meta", "_nodes") if c in s1.columns], *txt_cols,
                     S.hit_text("_ix_title", "", False).alias("_title"),
                     priced_parts(S.doc_text("\n", False)).alias("_priced"))


def _txt(field: str) -> Column:
    return F.col(f"_txt_{field}")


def _meta(key: str) -> Column:
    return S.meta_get(key, "_meta")


def title_text() -> Column:
    """``soup.find('title').get_text()``; a page without <title> gives null."""
    return F.col("_title")


def extract_name() -> Column:
    """Og:title / twitter:title before '|', else the name selectors."""
    meta = F.coalesce(*[nullif_empty(_meta(k)) for k in rules.META_NAME_KEYS])
    return F.when(meta.isNotNull(), py_strip(F.substring_index(meta, "|", 1))).otherwise(
        _txt("name"))


def extract_degree() -> Column:
    """Degree selector text decides when present; else the page title."""
    text = _txt("degree")
    return F.when(text.isNotNull(), parse_degree(text)).otherwise(parse_degree(title_text()))


def extract_level() -> Column:
    """E5: keywords over level selector text + title (a missing title counts as '')."""
    pool = F.lower(F.concat_ws(" ", F.coalesce(_txt("level"), F.lit("")),
                               F.coalesce(title_text(), F.lit(""))))

    def any_of(words):
        out = None
        for w in words:
            c = pool.contains(w)
            out = c if out is None else (out | c)
        return out
    return (F.when(any_of(rules.LEVEL_POSTGRADUATE_WORDS), F.lit("postgraduate"))
            .when(any_of(rules.LEVEL_UNDERGRADUATE_WORDS), F.lit("undergraduate"))
            .when(any_of(rules.LEVEL_RESEARCH_WORDS), F.lit("research")))


def extract_department() -> Column:
    return _txt("department")


UCAS_RE = r"(?U)\b([A-Z]\d{3})\b"


def extract_ucas() -> Column:
    """Meta code; else code in selector text; else the first text node that
    mentions UCAS whose parent text holds a code."""
    meta = nullif_empty(_meta(rules.META_UCAS_KEY))
    text = _txt("ucas_code")
    # the group is never empty, so '' means no match
    code = S.first_node_value(r"(?iU)\bUCAS\b", "", False,
                              lambda p: f"nullif(regexp_extract({p}, {S.lit(UCAS_RE)}, 1), '')", "_nodes")
    return F.coalesce(meta, F.when(text.isNotNull(), pattern_group(text, UCAS_RE)), F.expr(code))


def extract_study_mode() -> Column:
    """Modes named in the study-mode text, default [full-time]."""
    return study_modes_from_text(F.coalesce(_txt("study_mode"), F.lit("")), strict=True)


def extract_duration() -> Column:
    """Meta 'N academic years'; else 'N year'; else months/12 (half-even)."""
    meta_years = pattern_group(_meta(rules.META_DURATION_KEY),
                               f"(?iU)(\\d+){PY_WS}*academic{PY_WS}*years").try_cast("double")
    text = F.coalesce(_txt("duration"), F.lit(""))
    years = pattern_group(text, f"(?iU)(\\d+\\.?\\d*){PY_WS}*year").try_cast("double")
    months = pattern_group(text, f"(?iU)(\\d+){PY_WS}*month").try_cast("double")
    return F.coalesce(meta_years, years, F.bround(months / 12, 1))


def extract_start_month() -> Column:
    """First month name in the start/intake text, capitalised."""
    text = F.coalesce(_txt("start_month"), F.lit(""))
    return capitalize(pattern_group(text, "(?i)(" + "|".join(rules.MONTHS) + ")"))


def extract_fees() -> dict[str, Column]:
    """The four fee fields from the whole-page text (one node per line)."""
    parts = F.col("_priced")
    sandwich = fee_from_parts(parts, rules.FEE_SANDWICH_KEYWORDS)  # one expression, so it is evaluated once
    return {
        "fee_uk_yearly": fee_from_parts(parts, rules.FEE_UK_KEYWORDS),
        "fee_uk_sandwich": sandwich,
        "fee_intl_yearly": fee_from_parts(parts, rules.FEE_INTL_KEYWORDS),
        "fee_intl_sandwich": sandwich,
    }


def extract_deadline_main() -> Column:
    """E13."""
    t = _txt("deadline_main")
    return F.when(t.isNotNull(), py_strip(t))


def extract_deadline_late() -> Column:
    """First node mentioning late/clearing whose parent text has 4 digits."""
    year = S.lit(r"(?U)\d{4}")
    s = S.var("s")
    text = S.first_node_value("(?i)late|clearing", "", True,
                              lambda p: f"try_element_at(filter(array({p}), {s} -> {s} RLIKE {year}), 1)", "_nodes")
    return F.expr(f"substring({text}, 1, {rules.DEADLINE_LATE_MAX_CHARS})")


def extract_ielts() -> Column:
    """The parent texts of all IELTS nodes, then the first score.

    A score in the first text is the first of all; only without one the others are read."""
    first = F.expr(S.first_node_value("(?i)IELTS", "", False, lambda p: f"concat(' ', {p})", "_nodes"))
    parts = S.node_scan("(?i)IELTS", "", False, lambda p: f"concat(' ', {p})", "_nodes")
    score = lambda text: pattern_group(text, r"(?iU)IELTS[^\d]*(\d+\.?\d*)")
    return F.coalesce(score(first), score(F.expr(f"array_join({parts}, '')"))).try_cast("double")


def extract_description() -> Column:
    return _txt("description")


def extract_entry_requirements() -> Column:
    return _txt("entry_requirements")


def dl_lookup(word: str) -> Column:
    """Text of the dd that follows a dt containing ``word`` (on parsed pages)."""
    return S.first_text([(f"dt:contains('{word}') + dd", {"dt": word})])


def dl_selected(parsed: DataFrame, word: str, name: str) -> DataFrame:
    """E19 as column ``name`` on pages that are parsed for ``DD`` only."""
    at = parsed.withColumn("_ix", F.expr(S.first_hit_at_sql(DD, {"dt": word}, "noted")))
    return at.withColumn(name, S.first_text_of(["_ix"], nodes="noted")).drop("_ix")


RAW_FIELDS = ["name", "degree", "level", "department", "ucas_code", "study_mode",
              "duration_years", "start_month", "fee_uk_yearly", "fee_uk_sandwich",
              "fee_intl_yearly", "fee_intl_sandwich", "deadline_main", "deadline_late",
              "ielts_score", "description", "entry_requirements"]


def raw_record_columns() -> list[Column]:
    fees = extract_fees()
    cols = {
        "name": extract_name(),
        "degree": extract_degree(),
        "level": extract_level(),
        "department": extract_department(),
        "ucas_code": extract_ucas(),
        "study_mode": extract_study_mode(),
        "duration_years": extract_duration(),
        "start_month": extract_start_month(),
        **fees,
        "deadline_main": extract_deadline_main(),
        "deadline_late": extract_deadline_late(),
        "ielts_score": extract_ielts(),
        "description": extract_description(),
        "entry_requirements": extract_entry_requirements(),
    }
    return [cols[f].alias(f) for f in RAW_FIELDS]


def parsed_for_fields(pages: DataFrame) -> DataFrame:
    """Pages parsed for what the 17 raw fields read, and nothing else."""
    return parsed_pages(pages, texts=False, select=selected(tuple(R), title=True, meta=True), words=ALL_WORDS, lines=True)


def extract_fields(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Parsed pages (whole or ``parsed_for_fields``) -> ``keep`` columns + the 17 raw fields (+ parse_error)."""
    if "words" in parsed.columns:
        keep = keep if keep is not None else [c for c in parsed.columns if c not in (*SELECTED, "noted", "words", "lines", "parse_error")]
        return stage_selected(parsed, [*keep, "parse_error"], tuple(R)).select(*keep, *raw_record_columns(), "parse_error")
    keep = keep if keep is not None else [c for c in parsed.columns
                                          if c not in (*PARSED, "parse_error")]
    return stage_inputs(parsed, keep).select(*keep, *raw_record_columns(), "parse_error")


def split_quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages that failed to parse go to a quarantine frame with the error."""
    bad = F.col("parse_error").isNotNull()
    return raw.filter(~bad).drop("parse_error"), raw.filter(bad)
