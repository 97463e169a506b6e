"""Personal data, and the terms that give it away.

Personal data of four kinds is found by patterns and checks. What else reveals it is a
question of information: a term t tells PMI(t; e) = log p(e|t) / p(e) about a value e, and
e itself holds IC(e) = -log p(e). Both are counted over the corpus, by lines: p(e) is the
share of lines with e, and p(e|t) that of a term's different contexts (the words before and
after it in its line) which stand in a line with e, smoothed towards p(e) as if half a
context more had been seen. Values of any number of lines take part. A term that tells
nearly all of IC(e) is removed, one that tells all but a bit is generalised, wherever it
stands. Copies of a line have the same contexts and count once; as each rare word of a single
line would be a term, a term needs two contexts beside e.

A generalised term is replaced by a broader one: the word that stands in the most of its
contexts, in two at least, and is no term itself. Where there is none, a label stands for it.

Inputs: null text counts as empty and has no spans; equal texts get equal spans; texts of any
length are looked at whole; rows may repeat and ids be null; an empty table has no terms;
other columns pass through unchanged, but ``personal_spans`` is replaced. All of it is column
expressions and joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfold.llm.shared import let, materialise, whole_text
from landfold.llm.spans import SPAN, find, replaced

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "removed", "generalised"]
# Where a match starts within a run of its first characters, one that starts with the run
# would have been found before: the lookbehinds spare the search, \G keeps what follows a match.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Bits of IC(e) that a term may leave open and still be removed, or generalised.
REMOVED_WITHIN = math.log2(1 / 0.9)
GENERALISED_WITHIN = 1.0
#: Different contexts in which a term must stand beside a value, and a broader one in a term's place.
SUPPORT = 2
#: Contexts that p(e) counts for in p(e|t).
PRIOR = 0.5
#: Terms or contexts that are sent to all tasks, at most; more are joined by shuffling words.
SENT = 200_000
#: No value is without one of these.
HINT = r"@|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|\+[0-9]|(?:[0-9][\x20-]?){15}[0-9]"
#: Parts that texts of one content are dealt into where their terms are joined to them.
SALTS = 16
WORD = r"[\p{L}]+"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """Spans of the four kinds as listed in BASE, each by start."""
    return F.concat(
        find(text, EMAIL, "email"),
        find(text, IP, "ip", lambda m: F.regexp_like(m, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))),
        find(
            text,
            CARD,
            "card",
            lambda m: let(
                _digits(m), lambda d: F.length(d).between(16, 19) & F.call_function("luhn_check", d)
            ),
        ),
        find(text, PHONE, "phone", lambda m: F.length(_digits(m)).between(8, 15)),
    )


def _values(line: Column) -> Column:
    """Distinct values of a line as kind:text, in small letters."""
    return F.array_distinct(
        F.transform(
            base_spans(line),
            lambda s: F.concat_ws(":", s["kind"], F.lower(F.substring(line, s["start"] + 1, s["end"] - s["start"]))),
        )
    )


def _few(rows: DataFrame) -> DataFrame:
    """Stored rows, sent to all tasks if their number, which is looked at, allows it."""
    return F.broadcast(rows) if rows.count() <= SENT else rows


def disclosure(docs: DataFrame) -> DataFrame:
    """(e, term, c_te, c_t, pmi, open): what terms tell of values, in bits, and what of IC(e) stays open.

    Pairs of fewer than SUPPORT contexts are left out.
    """
    lines = docs.select(F.explode(F.split(whole_text(), "\n")).alias("line"))
    some = F.regexp_like("line", F.lit(HINT))
    valued = (
        lines.where(some)
        .groupBy("line")
        .agg(F.count("*").alias("n"))
        .withColumn("values", _values(F.col("line")))
        .where(F.size("values") > 0)
    )
    valued = materialise(valued, "valued-lines")
    beside = valued.select("line", "n", F.explode("values").alias("e"), "values")
    counted = beside.groupBy("e").agg(F.sum("n").alias("c_e"))
    # The letters of the line's own values are no terms.
    own = F.regexp_extract_all(F.lower(F.array_join("values", " ")), F.lit(WORD), 0)
    pairs = (
        beside.select("e", own.alias("own"), F.explode(_in_context(F.col("line"))).alias("w"))
        .where(~F.array_contains("own", F.col("w.word")))
        .groupBy("e", F.col("w.word").alias("term"))
        .agg(F.count_distinct("w.context").alias("c_te"))
        .where(F.col("c_te") >= SUPPORT)
    )
    pairs = materialise(pairs, "pairs")
    # All contexts of those terms, whatever stands beside them.
    wanted = materialise(pairs.select(F.col("term").alias("word")).distinct(), "wanted")
    words = _contexts(lines).join(_few(wanted), "word", "left_semi")
    words = words.distinct().groupBy(F.col("word").alias("term")).agg(F.count("*").alias("c_t"))
    total = lines.agg(F.count("*").alias("total"))
    p_e = F.col("c_e") / F.lit(total.first()["total"] or 1)
    p = (F.col("c_te") + PRIOR * p_e) / (F.col("c_t") + PRIOR)
    pmi = F.log2(p / p_e)
    return (
        pairs.join(counted, "e")
        .join(words, "term")
        .select("e", "term", "c_te", "c_t", pmi.alias("pmi"), (-F.log2(p_e) - pmi).alias("open"))
    )


def _contexts(lines: DataFrame) -> DataFrame:
    return lines.select(F.explode(_in_context(F.col("line"))).alias("w")).select("w.word", "w.context")


def revealing_terms(docs: DataFrame) -> DataFrame:
    """(term, kind, broader): terms of the corpus that reveal personal data, and what is done with them."""
    terms = (
        disclosure(docs)
        .groupBy("term")
        .agg(F.min("open").alias("open"))
        .where(F.col("open") <= GENERALISED_WITHIN)
        .select(
            "term",
            F.when(F.col("open") <= REMOVED_WITHIN, F.lit("removed")).otherwise(F.lit("generalised")).alias("kind"),
        )
    )
    terms = materialise(terms, "terms")
    general = terms.where(F.col("kind") == "generalised").select("term")
    if general.isEmpty():
        return terms.withColumn("broader", F.lit(None).cast("string"))
    all_contexts = _contexts(docs.select(F.explode(F.split(whole_text(), "\n")).alias("line")))
    places = all_contexts.join(_few(general.withColumnRenamed("term", "word")), "word", "left_semi").distinct()
    places = materialise(places.select(F.col("word").alias("term"), "context"), "places")
    # A context is one of few words; where it is common, pairs are made distinct before they meet.
    known = materialise(places.select("context").distinct(), "contexts")
    others = all_contexts.join(_few(known), "context", "left_semi").distinct()
    others = others.join(terms.select(F.col("term").alias("word")), "word", "left_anti")
    broader = (
        places.join(others, "context")
        .groupBy("term", "word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= SUPPORT)
        .groupBy("term")
        .agg(F.min_by("word", F.struct(-F.col("n"), "word")).alias("broader"))
    )
    return terms.join(broader, "term", "left")


def _in_context(line: Column) -> Column:
    """Array of struct(word, context); the context is a hash of the words before and after."""
    return let(
        F.regexp_extract_all(F.lower(line), F.lit(WORD), 0),
        lambda ws: F.transform(
            ws,
            lambda w, i: F.struct(
                w.alias("word"),
                F.xxhash64(
                    F.coalesce(F.get(ws, i - 1), F.lit("")), F.coalesce(F.get(ws, i + 1), F.lit(""))
                ).alias("context"),
            ),
        ),
    )


_TERMS = "_landfold_terms"


def _with_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``docs`` with an array of the terms that their texts hold; null where there are none."""
    if terms.isEmpty():
        kept = "array<struct<term:string,kind:string,broader:string>>"
        return docs.withColumn(_TERMS, F.lit(None).cast(kept))
    key, salt = F.md5(whole_text()), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0))
    own = (
        docs.select(key.alias("_landfold_key"), whole_text().alias("text"))
        .select("_landfold_key", F.explode(words).alias("term"))
        .join(_few(terms), "term")
        .distinct()
        .groupBy("_landfold_key")
        .agg(F.sort_array(F.collect_list(F.struct("term", "kind", "broader"))).alias(_TERMS))
        # Copies of a text are many rows of one key: each salt has a row for them to meet.
        .withColumn("_landfold_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    keyed = docs.withColumn("_landfold_key", key).withColumn("_landfold_salt", salt)
    return keyed.join(own, ["_landfold_key", "_landfold_salt"], "left").select(*docs.columns, _TERMS)


def _spans_with_terms(docs: DataFrame, terms: DataFrame | None) -> DataFrame:
    terms = revealing_terms(docs) if terms is None else terms
    if "broader" not in terms.columns:
        terms = terms.withColumn("broader", F.lit(None).cast("string"))
    found = _with_terms(docs, materialise(terms.select("term", "kind", "broader"), "terms"))
    of = lambda kind: F.transform(F.filter(_TERMS, lambda t: t["kind"] == kind), lambda t: t["term"])
    added = [_term_spans(whole_text(), of(k), k) for k in KINDS[4:]]
    return found.withColumn("personal_spans", F.concat(base_spans(whole_text()), *added))


def find_personal(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``personal_spans``: base kinds as listed, each by start, then revealing terms.

    ``terms`` (term, kind, and perhaps broader) are those of this corpus if none are given.
    """
    found = _spans_with_terms(docs, terms)
    return found.select(*[c for c in docs.columns if c != "personal_spans"], "personal_spans")


def _term_spans(text: Column, words: Column, kind: str) -> Column:
    none = F.array().cast(f"array<{SPAN}>")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(words, "|"), F.lit(r")(?!\p{L})"))
    return F.when(F.coalesce(F.size(words), F.lit(0)) <= 0, none).otherwise(find(text, pattern, kind))


def sanitise(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind, and revealing terms removed or generalised."""
    found = _spans_with_terms(docs, terms)

    def named(s: Column) -> Column:
        """A span whose kind is followed by what is broader, if there is such a term."""
        word = F.lower(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))
        own = F.get(F.filter(_TERMS, lambda t: t["term"] == word), F.lit(0))["broader"]
        kind = F.when(s["kind"] == "generalised", F.concat_ws(":", s["kind"], own)).otherwise(s["kind"])
        return F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    def label(kind: Column) -> Column:
        return (
            F.when(kind == "removed", F.lit(""))
            .when(F.startswith(kind, F.lit("generalised:")), F.substring(kind, 13, F.length(kind)))
            .otherwise(F.concat(F.lit("["), F.upper(kind), F.lit("]")))
        )

    clean = replaced(F.col("text"), F.transform("personal_spans", named), label)
    text = F.when(F.col("text").isNotNull(), clean)
    return found.withColumn("text", text).select(*[c for c in docs.columns if c != "personal_spans"])
