"""Operator 3: chat formatting by schema fingerprints.

Data sets keep conversations in many layouts: one row per turn, a list of
messages, prompt and response columns, instruction records.  A layout is known
by the field paths it uses; the hash of those paths (the fingerprint) selects a
declarative mapping, a SQL expression that yields the canonical turns
``array<struct<role, text>>``.  The fingerprint of a table is taken from its
schema; that of a JSON column is computed for each row, so one column may mix
layouts.  Only DataFrame and SQL functions are used.

The template writes ``<turn>role\\ntext</turn>\\n`` for each turn.  Inside roles
and texts a backslash is doubled and a backslash is put after the ``<`` of
``<turn`` and ``</turn``; a line break in a role becomes ``<\\nl>``.  As all other
backslashes are doubled, a single one after ``<`` marks an escape, so reading
back gives the very texts.  The loss mask lists the code point spans of the
assistants' texts in the formatted string.

Defined cases: null role and text count as empty; rows of a conversation are
ordered by turn (null first), then role and text; repeated rows are turns of
their own; rows with a null conv_id form one conversation; columns beyond a
layout's own are ignored; an empty table gives an empty table; a JSON record of
unknown layout has null turns, is not formatted, and is returned by ``rejected_json``; a
record's layout is told by all elements of its list, and an empty list has no turns.  Texts
are taken whole, however long.  A conversation is one string, so its turns meet in one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, written

TURNS = "array<struct<role:string,text:string>>"
OPEN, CLOSE = "<turn>", "</turn>\n"


@dataclass(frozen=True)
class Layout:
    """Paths that make up a layout and the SQL that turns them into turns."""

    name: str
    paths: tuple[str, ...]
    table_sql: str | None
    json_schema: str | None = None

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _pair(role: str, text: str) -> str:
    return f"named_struct('role', cast({role} as string), 'text', cast({text} as string))"


def _listed(col: str, role: str, text: str) -> str:
    return f"transform({col}, m -> {_pair(f'm.{role}', f'm.{text}')})"


#: declarative mappings; {0} stands for the record
LAYOUTS = (
    Layout("turn_rows", ("conv_id", "turn", "role", "text"), None),
    Layout("messages", ("messages[].role", "messages[].content"), _listed("{0}messages", "role", "content"),
           "messages array<struct<role:string,content:string>>"),
    Layout("from_value", ("conversations[].from", "conversations[].value"),
           "transform({0}conversations, m -> " + _pair("case m.`from` when 'human' then 'user' when 'gpt' then "
                                                       "'assistant' else m.`from` end", "m.value") + ")",
           "conversations array<struct<`from`:string,value:string>>"),
    Layout("prompt_response", ("prompt", "response"),
           f"array({_pair(chr(39) + 'user' + chr(39), '{0}prompt')}, {_pair(chr(39) + 'assistant' + chr(39), '{0}response')})",
           "prompt string, response string"),
    Layout("instruction", ("instruction", "output"),
           f"array({_pair(chr(39) + 'user' + chr(39), '{0}instruction')}, {_pair(chr(39) + 'assistant' + chr(39), '{0}output')})",
           "instruction string, output string"),
    Layout("instruction_input", ("instruction", "input", "output"),
           "array(" + _pair("'user'", "concat_ws('\\n\\n', {0}instruction, nullif({0}input, ''))") + ", "
           + _pair("'assistant'", "{0}output") + ")",
           "instruction string, input string, output string"),
)
_KNOWN = {p for lay in LAYOUTS for p in lay.paths}
BY_FINGERPRINT = {lay.fingerprint: lay for lay in LAYOUTS}


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Nested field paths; ``[]`` steps into an array."""
    out: list[str] = []
    for f in schema.fields:
        kind, at = f.dataType, prefix + f.name
        while isinstance(kind, T.ArrayType):
            kind, at = kind.elementType, at + "[]"
        out += schema_paths(kind, at + ".") if isinstance(kind, T.StructType) else [at]
    return out


def layout_of(df: DataFrame) -> Layout:
    """The mapping selected by the fingerprint of the table's known field paths."""
    fp = fingerprint(p for p in schema_paths(df.schema) if p in _KNOWN - {"conv_id"} or p == "conv_id" and "turn" in df.columns)
    if fp not in BY_FINGERPRINT:
        raise ValueError(f"no layout has the field paths {schema_paths(df.schema)}")
    return BY_FINGERPRINT[fp]


def canonical_turns(df: DataFrame) -> DataFrame:
    """Any known table layout -> (conv_id, turns)."""
    lay = layout_of(df)
    if lay.name == "turn_rows":
        t = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        return (df.groupBy("conv_id").agg(F.array_sort(F.collect_list(t)).alias("rows"))
                .select("conv_id", F.expr(_listed("rows", "role", "text")).alias("turns")))
    conv = F.col("conv_id") if "conv_id" in df.columns else F.lit(None).cast("long")
    return df.select(conv.alias("conv_id"), F.expr(lay.table_sql.format("")).alias("turns"))


def _under(keys: Column, parent: str) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(parent + "[]."), k))


def json_paths(record: Column) -> Column:
    """Sorted field paths of a JSON record that layouts know, two levels deep, over all elements of its lists.

    An empty list counts as one of a layout's elements: a conversation without turns."""
    none = F.array().cast("array<string>")
    top = F.coalesce(F.json_object_keys(record), none)
    flat = F.filter(top, lambda k: k.isin(sorted(p for p in _KNOWN if "[" not in p)))
    nested = []
    for p in sorted({p.split("[")[0] for p in _KNOWN if "[" in p}):
        elements = F.from_json(F.get_json_object(record, f"$.{p}"), "array<string>")
        keys = F.flatten(F.transform(elements, lambda e: F.coalesce(F.json_object_keys(e), none)))
        known = F.array(*[F.lit(k) for k in sorted(_KNOWN) if k.startswith(p + "[]")])
        under = F.filter(_under(keys, p), lambda k: k.isin(sorted(_KNOWN)))
        nested.append(F.when(F.size(elements) == 0, known).otherwise(F.coalesce(under, none)))
    return F.array_sort(F.array_distinct(F.concat(flat, *nested)))


def canonical_turns_json(df: DataFrame, record: str, conv_id: str = "conv_id") -> DataFrame:
    """JSON records, each of its own layout -> (conv_id, fingerprint, turns)."""
    fp = F.substring(F.sha2(F.array_join(json_paths(F.col(record)), "\n"), 256), 1, 16)
    turns = F.lit(None).cast(TURNS)
    for lay in LAYOUTS:
        if lay.json_schema:
            parsed = f"from_json(`{record}`, '{lay.json_schema}')."
            turns = F.when(F.col("fingerprint") == lay.fingerprint, F.expr(lay.table_sql.format(parsed))).otherwise(turns)
    return (df.withColumn("fingerprint", fp)
            .select(F.col(conv_id).alias("conv_id"), "fingerprint", turns.alias("turns")))


def rejected_json(df: DataFrame, record: str, conv_id: str = "conv_id") -> DataFrame:
    """Records of no known layout, which ``format_turns`` leaves out: (conv_id, fingerprint, record)."""
    turns = canonical_turns_json(df.withColumn("_id", F.struct(F.col(conv_id), F.col(record))), record, "_id")
    return turns.filter("turns is null").select(F.col(f"conv_id.{conv_id}").alias("conv_id"), "fingerprint",
                                                F.col(f"conv_id.{record}").alias("record"))


def _replace(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def escape(col: Column) -> Column:
    c = _replace(F.coalesce(col, F.lit("")), "\\", "\\\\")
    return _replace(_replace(c, "</turn", "<\\/turn"), "<turn", "<\\turn")


def unescape(col: Column) -> Column:
    c = _replace(_replace(col, "<\\turn", "<turn"), "<\\/turn", "</turn")
    return _replace(c, "\\\\", "\\")


def format_turns(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, turns) -> (conv_id, formatted, loss_mask array<struct<from, upto>>)."""
    head = lambda t: F.concat(F.lit(OPEN), _replace(escape(t["role"]), "\n", "<\\nl>"), F.lit("\n"))
    parts = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"),
                                                    t["role"].isin(*loss_roles).alias("loss")))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<from:bigint,upto:bigint>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        frm = acc["at"] + F.length(p["head"])
        upto = frm + F.length(p["body"])
        span = F.array(F.struct(frm.cast("long").alias("from"), upto.cast("long").alias("upto")))
        return F.struct((upto + len(CLOSE)).cast("long").alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return (turns.filter("turns is not null").select("conv_id", parts.alias("parts"))
            .select("conv_id", text.alias("formatted"), F.aggregate("parts", start, step)["spans"].alias("loss_mask")))


def read_formatted(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask) -> with turns and loss_text read from the string."""
    pieces = F.filter(F.split("formatted", CLOSE, -1), lambda p: p != "")
    body = F.transform(pieces, lambda p: F.substr(p, F.lit(len(OPEN) + 1)))
    turns = F.transform(body, lambda p: F.struct(
        unescape(_replace(F.substring_index(p, "\n", 1), "<\\nl>", "\n")).alias("role"),
        unescape(F.substr(p, F.length(F.substring_index(p, "\n", 1)) + 2)).alias("text")))
    loss = F.array_join(F.transform("loss_mask", lambda s: unescape(F.substr(
        F.col("formatted"), (s["from"] + 1).cast("int"), (s["upto"] - s["from"]).cast("int")))), "")
    return formatted.withColumns({"turns": turns, "loss_text": loss})


def op3_chat(spark, sf_dir) -> DataFrame:
    said = "'\\\\### Assistant: </turn> ok'"
    extra = spark.range(2).selectExpr("cast(-7 as bigint) conv_id", "id turn",
                                      "if(id = 0, 'user', 'assistant') role", f"{said} text")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_formatted(written(format_turns(canonical_turns(rows)), "chat"))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(digest, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '</turn', '<\/turn'), '<turn', '<\turn') AS esc,
    replace(replace(replace(replace(role, '\', '\\'), '</turn', '<\/turn'), '<turn', '<\turn'), chr(10), '<\nl>') AS esc_role
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn>') + length(esc_role) + 1 + length(esc) + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
