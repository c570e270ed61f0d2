"""Operator 8: personal data, by fixed patterns and bootstrapped contextual extraction.

The base kinds (email, ip, card, phone) are found by fixed patterns and checks.
They seed the extraction of identifiers of unknown form:

1. An instance is a white-space delimited token with a digit or ``@``; its pattern
   is the pair of words before it.  Tokens that begin a base span are seeds.
2. Patterns and instances form a graph.  In each of ``ROUNDS`` rounds a pattern's
   confidence is the share of its occurrences in the whole corpus - followed by an
   identifier or not - whose instance is believed, and an instance is believed by
   the noisy-or of its patterns' confidences (seeds fully).
3. Instances after a pattern with at least ``MIN_CONFIDENCE`` and ``MIN_SEEDS``
   distinct believed instances become spans of the pattern's commonest kind,
   without surrounding punctuation, where they touch no base span.

Occurrences of patterns are counted over all texts, but only for patterns with
``MIN_SEEDS`` distinct instances that could still reach ``MIN_CONFIDENCE`` after a
count over the texts that have identifiers.  All steps are DataFrame functions: the patterns
run on the JVM (possessive, so that they are linear and need no stack), the
graph is joins and partial aggregates, and a hot passage adds to its pattern
before the shuffle.

Defined cases: null and empty texts have no spans; rows that repeat an id are
treated by their own texts, repeated rows each get their spans; null ids are kept;
very long texts are searched whole; a pattern met with several kinds equally often takes the
first by name, a token in which several kinds begin the first in ``KINDS``; columns beyond
doc_id and text are ignored; an empty table gives an empty table.  Positions are code
points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_CONFIDENCE = 0.6
MIN_SEEDS = 3
#: patterns up to which the set to be counted is broadcast; a shuffle join beyond
BROADCAST_PATTERNS = 200_000

#: the contract's patterns, with possessive repeats; a match starts at the start of
#: a run or where the last match ended, since no other start in the run can match
_RUN = "[A-Za-z0-9._%+-]"
REGEX = {
    "email": rf"(?:\G|(?<!{_RUN})){_RUN}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WORD = r"[^\x20\x09-\x0D]++"
_SPACES = r"[\x20\x09-\x0D]+"
SPAN = "struct<from:bigint,upto:bigint,text:string>"


#: matches whose positions are summed in one array, so that n matches cost n steps of bounded size
_CHUNK = 64


def matches(text: Column, regex: str) -> Column:
    """array<struct<from, upto, text>> of the leftmost non-overlapping matches.

    Positions are the running sum of the lengths of what lies between matches and
    of the matches, first inside chunks, then over chunks.
    """
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    between = F.split(text, regex, -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    empty = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        frm = acc["at"] + F.length(x["gap"])
        upto = frm + F.length(x["hit"])
        return F.struct(upto.cast("long").alias("at"), F.concat(acc["out"], F.array(F.struct(
            frm.cast("long").alias("from"), upto.cast("long").alias("upto"), x["hit"].alias("text")))).alias("out"))

    def chunks(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / _CHUNK).cast("int")),
                           lambda c: F.slice(p, c * _CHUNK + 1, F.lit(_CHUNK)))

    zero = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))
    # bound once by transform over a one-element array, so that inner steps don't evaluate it again
    local = F.transform(F.array(pairs), lambda p: F.transform(chunks(p), lambda c: F.aggregate(c, zero, step)))

    def shift(all_chunks: Column) -> Column:
        starts = F.aggregate(all_chunks, F.array(F.lit(0).cast("long")),
                             lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c["at"])))
        moved = F.zip_with(all_chunks, F.slice(starts, 1, F.size(all_chunks)), lambda c, at: F.transform(
            c["out"], lambda m: F.struct((m["from"] + at).alias("from"), (m["upto"] + at).alias("upto"), m["text"].alias("text"))))
        return F.flatten(moved)

    placed = F.element_at(F.transform(local, shift), 1)
    return F.when(F.rlike(text, F.lit(regex)), placed).otherwise(empty)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _valid(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(s, r"\."), lambda p: (F.length(part(p)) <= 3)
                        & (F.coalesce(F.when(F.length(part(p)) <= 3, part(p)).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return (n >= 13) & (n <= 19) & F.call_function("luhn_check", F.when(n <= 19, _digits(s)).otherwise(F.lit("1")))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    sign = {"email": "@", "ip": ".", "phone": "+"}.get(kind)
    hits = F.filter(matches(text, REGEX[kind]), lambda m: _valid(kind, m["text"]))
    return F.when(F.contains(text, F.lit(sign)), hits).otherwise(F.array().cast(f"array<{SPAN}>")) if sign else hits


def _tokens(words: Column) -> Column:
    """Words with a digit or ``@``, each with the hash of the two words before it."""
    low = F.transform(words, lambda w: F.lower(w["text"]))
    gone = F.array(F.lit(None).cast("string"))
    one = F.concat(gone, F.slice(low, 1, F.greatest(F.size(low) - 1, F.lit(0))))
    two = F.concat(gone, gone, F.slice(low, 1, F.greatest(F.size(low) - 2, F.lit(0))))
    pair = F.zip_with(two, one, lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.xxhash64(a, b)))
    rows = F.zip_with(words, F.slice(pair, 1, F.size(words)), lambda w, p: F.struct(
        p.alias("pattern"), w["from"].alias("from"), w["upto"].alias("upto"), w["text"].alias("text")))
    return F.transform(F.filter(rows, lambda t: F.rlike(t["text"], F.lit("[0-9@]"))), lambda t: F.struct(
        t["pattern"].alias("pattern"), t["from"].alias("from"), t["upto"].alias("upto"), _trim(t).alias("core")))


def _trim(token: Column) -> Column:
    """The token's span without surrounding punctuation."""
    lead = F.length(token["text"]) - F.length(F.regexp_replace(token["text"], r"^[^\p{L}0-9+]+", ""))
    core = F.regexp_replace(F.regexp_replace(token["text"], r"^[^\p{L}0-9+]+", ""), r"[^\p{L}0-9]+$", "")
    frm = token["from"] + lead
    return F.struct(frm.alias("from"), (frm + F.length(core)).alias("upto"), core.alias("text"))


def find_base(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, _text (hash), one array of spans per kind, tokens with their patterns.

    Texts without a digit or ``@`` have empty arrays and cost one look.
    """
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    t = t.select("doc_id", F.when(F.rlike("text", F.lit("[0-9@]")), F.col("text")).alias("text"),
                 F.xxhash64("text").alias("_text"))
    none = F.array().cast(f"array<{SPAN}>")
    some = lambda c: F.when(F.col("text").isNotNull(), c).otherwise(none)
    t = t.withColumns({k: some(base_spans(F.col("text"), k)) for k in KINDS} | {"words": some(matches(F.col("text"), WORD))})
    return t.withColumn("tokens", _tokens(F.col("words"))).drop("text", "words")


def pattern_totals(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """How often each wanted pair of words occurs in the corpus, followed by another word."""
    words = F.filter(F.split(F.lower("text"), _SPACES), lambda w: w != "")
    t = docs.select(words.alias("w")).filter("size(w) > 2")
    pair = F.explode(F.expr("transform(sequence(1, size(w) - 2), i -> xxhash64(element_at(w, i), element_at(w, i + 1)))"))
    small = wanted.count() <= BROADCAST_PATTERNS
    pairs = t.select(pair.alias("pattern"))
    if small:
        return pairs.join(F.broadcast(wanted), "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("total"))
    # each task adds up its pairs before they are shuffled, and one row a pair meets the wanted ones
    return pairs.groupBy("pattern").agg(F.count("*").alias("total")).join(wanted, "pattern", "left_semi")


def discover(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Spans that believed patterns add: doc_id, _text, kind, from, upto."""
    kind = F.lit(None).cast("string")
    starts = lambda c: (c["from"] >= F.col("t.from")) & (c["from"] < F.col("t.upto"))
    for k in reversed(KINDS):
        kind = F.when(F.exists(k, starts), F.lit(k)).otherwise(kind)
    meets = F.lit(False)
    for k in KINDS:
        meets = meets | F.exists(k, lambda c: (c["from"] < F.col("t.upto")) & (c["upto"] > F.col("t.from")))
    edges = (found.filter("size(tokens) > 0").select("doc_id", "_text", *KINDS, F.explode("tokens").alias("t"))
             .filter("t.pattern is not null and length(t.core.text) > 0")
             .select("doc_id", "_text", F.col("t.pattern").alias("pattern"), F.xxhash64("t.core.text").alias("instance"),
                     kind.alias("kind"), meets.alias("meets"), F.col("t.core.from").alias("from"),
                     F.col("t.core.upto").alias("upto")))
    edges = written(edges, "pii-edges")
    links = written(edges.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("kind").alias("kind")), "pii-links")
    wanted = written(links.groupBy("pattern").agg(F.count("*").alias("c"), F.sum("n").alias("followed"))
                     .filter(F.col("c") >= MIN_SEEDS).select("pattern", "followed"), "pii-wanted")
    # occurrences in texts with identifiers bound the confidence from above: most common word pairs end here
    near = pattern_totals(docs.filter(F.rlike("text", F.lit("[0-9@]"))), wanted.select("pattern"))
    wanted = written(wanted.join(near, "pattern").filter(F.col("followed") >= MIN_CONFIDENCE * F.col("total"))
                     .select("pattern"), "pii-wanted")
    links = written(links.join(wanted, "pattern", "left_semi"), "pii-links")
    totals = written(pattern_totals(docs, wanted), "pii-totals")
    graph = written(links.join(totals, "pattern"), "pii-graph")
    seeds = graph.groupBy("instance").agg(F.max("kind").alias("seed"))
    belief = seeds.select("instance", F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0).alias("belief"))
    patterns = None
    for _ in range(ROUNDS):
        known = graph.join(belief, "instance")
        patterns = written(known.groupBy("pattern").agg(
            # rounded, as sums of doubles depend on their order
            F.round(F.sum(F.col("n") * F.col("belief")) / F.max("total"), 9).alias("confidence"),
            F.count(F.when(F.col("belief") >= 0.5, 1)).alias("instances"), F.mode("kind", True).alias("kind")), "pii-patterns")
        usable = patterns.withColumn("confidence", F.when(F.col("instances") >= MIN_SEEDS, F.least("confidence", F.lit(0.999)))
                                     .otherwise(0.0))
        by = graph.select("pattern", "instance").join(usable.select("pattern", "confidence"), "pattern")
        doubt = by.groupBy("instance").agg(F.exp(F.sum(F.log(1 - F.col("confidence")))).alias("doubt"))
        belief = written(seeds.join(doubt, "instance").select("instance", F.when(F.col("seed").isNotNull(), 1.0)
                                                              .otherwise(1 - F.col("doubt")).alias("belief")), "pii-belief")
    good = patterns.filter((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("instances") >= MIN_SEEDS) & F.col("kind").isNotNull())
    return (edges.filter("not meets").drop("kind").join(good.select("pattern", "kind"), "pattern")
            .select("doc_id", "_text", "kind", "from", "upto").distinct())


def _joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["k"] + 1), s["from"], s["upto"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans; one row per row of docs."""
    docs = docs.select("doc_id", "text")
    found = written(find_base(docs), "pii-base")
    added = discover(docs, found)
    number = F.expr("array_position(array(%s), kind)" % ",".join(f"'{k}'" for k in KINDS)) - 1
    added = (added.withColumn("k", number.cast("int")).groupBy("doc_id", "_text")
             .agg(F.collect_set(F.struct("k", "from", "upto")).alias("added")).withColumnRenamed("doc_id", "_id"))
    numbered = lambda i: lambda m: F.struct(F.lit(i).alias("k"), m["from"].alias("from"), m["upto"].alias("upto"))
    base = F.concat(*[F.transform(k, numbered(i)) for i, k in enumerate(KINDS)])
    out = found.drop("tokens").withColumnRenamed("_text", "_hash")
    out = out.join(added, out["doc_id"].eqNullSafe(added["_id"]) & (out["_hash"] == added["_text"]), "left")
    none = F.array().cast("array<struct<k:int,from:bigint,upto:bigint>>")
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], _joined(base).alias("base_spans"),
                      _joined(F.concat(base, F.coalesce("added", none))).alias("spans"))


def op8_pii(spark, sf_dir) -> DataFrame:
    out = personal_data(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")
