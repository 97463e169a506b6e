"""Document fingerprints: Merkle trees over phrases, paragraphs and sections.

A paragraph is a line. Its leaves are its phrases: runs of up to eight words that end
early where a sentence does, so that an edit upsets no phrase beyond its sentence. A
section ends with a blank paragraph or with one whose hash starts with 0 or 1, so that
sections too fall into step again behind an edit. A node's hash is that of what is below
it, and the root's is equal for equal texts only.

A fingerprint is the root's hash and then, section by section, hashes cut to eight digits::

    root/section:paragraph.phrase.phrase,paragraph.phrase,/section:...

Inputs: null text counts as empty; rows equal in id and text are one document in the
order of ``next_documents``; rows with a null id come last there; among equal ids the
digest of the text decides; other columns are ignored. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfold.llm.shared import let, materialise, whole_text

PHRASE = (
    r"[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?][\x20\x09-\x0D]+){0,7}"
    r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"
)
#: Rows of ids alone that one task puts in order.
ORDERED = 200_000


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text that is not null."""
    paragraphs = F.transform(
        F.split(text, "\n", -1),
        lambda p: let(
            F.transform(F.regexp_extract_all(p, F.lit(PHRASE), 0), lambda x: F.md5(x)),
            lambda h: F.struct(
                F.sha2(F.array_join(h, ""), 256).alias("hash"),
                F.array_join(F.transform(h, lambda x: F.concat(F.lit("."), F.substring(x, 1, 8))), "").alias(
                    "phrases"
                ),
            ),
        ),
    )
    lines = F.transform(
        paragraphs,
        lambda p: F.concat(
            p["hash"],
            p["phrases"],
            F.when((p["phrases"] == "") | F.substring(p["hash"], 1, 1).isin("0", "1"), F.lit("/")).otherwise(
                F.lit(",")
            ),
        ),
    )
    sections = F.transform(
        F.filter(F.split(F.array_join(lines, ""), "/", -1), lambda s: s != ""),
        lambda s: F.struct(F.sha2(s, 256).alias("hash"), s.alias("below")),
    )
    return let(
        sections,
        lambda all_: F.concat_ws(
            "/",
            F.sha2(F.array_join(F.transform(all_, lambda s: s["hash"]), ""), 256),
            F.transform(
                all_,
                lambda s: F.concat_ws(
                    ":",
                    F.substring(s["hash"], 1, 8),
                    F.regexp_replace(s["below"], r"([0-9a-f]{8})[0-9a-f]{56}", "$1"),
                ),
            ),
        ),
    )


def root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, "/", 1)


def likeness(one: Column, other: Column) -> Column:
    """Share of the phrases of two fingerprints that both have; 1 for equal ones."""
    phrases = lambda f: F.regexp_extract_all(f, F.lit(r"\.([0-9a-f]{8})"), 1)
    return F.when(one == other, F.lit(1.0)).otherwise(
        let(
            F.struct(phrases(one).alias("a"), phrases(other).alias("b")),
            lambda p: F.coalesce(
                F.size(F.array_intersect(p["a"], p["b"])) / F.nullif(F.size(F.array_union(p["a"], p["b"])), F.lit(0)),
                F.lit(0.0),
            ),
        )
    )


def sections(fingerprint: Column) -> Column:
    """Array of struct(hash, paragraphs); paragraphs are arrays of their hashes."""
    parts = F.split(fingerprint, "/")
    return F.transform(
        F.slice(parts, F.lit(2), F.size(parts)),
        lambda s: F.struct(
            F.substring_index(s, ":", 1).alias("hash"),
            F.regexp_extract_all(s, F.lit(r"[:,]([0-9a-f]{8})"), 1).alias("paragraphs"),
        ),
    )


def edited_paragraphs(before: Column, after: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``after`` that ``before`` has nowhere.

    Sections that both have are passed over without a look at their paragraphs.
    """
    flat = lambda f: F.flatten(
        F.transform(
            sections(f),
            lambda s: F.transform(
                s["paragraphs"], lambda p: F.struct(s["hash"].alias("section"), p.alias("paragraph"))
            ),
        )
    )
    return let(
        F.struct(
            F.transform(sections(before), lambda s: s["hash"]).alias("sections"),
            F.flatten(F.transform(sections(before), lambda s: s["paragraphs"])).alias("paragraphs"),
            flat(after).alias("new"),
        ),
        lambda b: F.filter(
            F.transform(
                b["new"],
                lambda p, i: F.when(
                    ~F.array_contains(b["sections"], p["section"])
                    & ~F.array_contains(b["paragraphs"], p["paragraph"]),
                    i,
                ),
            ),
            lambda i: i.isNotNull(),
        ),
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that rows equal in both share."""
    return docs.select("doc_id", whole_text().alias("text")).withColumn(
        "key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5("text"))
    )


def next_documents(docs: DataFrame) -> DataFrame:
    """key, next_key and n_chars of each document; next is by falling id, and the first after the last.

    Only ids and digests are ordered: by range, then within ranges, and the first of
    each range follows on the last of the one before.
    """
    rows = materialise(
        _keyed(docs).select("key", "doc_id", F.length("text").cast("bigint").alias("n_chars")).distinct(), "keys"
    )
    ranges = max(1, -(-rows.count() // ORDERED))
    order = [F.col("doc_id").desc_nulls_last(), F.col("key").desc()]
    placed = materialise(
        rows.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("range", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id()),
        "order",
    )
    # One row a range: so few that one task orders them.
    heads = placed.groupBy("range").agg(F.min_by("key", "place").alias("head"))
    following = heads.select(
        "range",
        F.coalesce(
            F.lead("head").over(Window.orderBy("range")),
            F.first("head").over(Window.orderBy("range")),
        ).alias("following"),
    )
    within = F.lead("key").over(Window.partitionBy("range").orderBy("place"))
    return (
        placed.withColumn("within", within)
        .join(following, "range")
        .select("key", F.coalesce("within", "following").alias("next_key"), "n_chars")
    )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its text with the end replaced, and how alike they are.

    The last third of the text (floor of the code points by three) is replaced by as many
    of the next document's first, or by all it has.
    """
    # Both joins below need the same columns of the same rows, so texts are shuffled once;
    # fingerprints come after, as plans with lambda functions are never taken for the same.
    rows = _keyed(docs)
    asked = next_documents(docs).select(
        F.col("next_key").alias("key"),
        F.col("key").alias("asker"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("third"),
    )
    heads = (
        rows.join(asked, "key")
        .select(
            F.col("asker").alias("key"),
            F.col("doc_id").alias("next_id"),
            F.expr("left(text, third)").alias("head"),
            fingerprint(F.col("text")).alias("next_fingerprint"),
        )
        .dropDuplicates(["key"])
    )
    n = F.length("text")
    edited = rows.join(heads, "key").select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.concat(F.expr("left(text, length(text) - int(floor(length(text) / 3)))"), F.col("head")).alias("edited"),
        fingerprint(F.col("text")).alias("fingerprint"),
        "next_fingerprint",
        "next_id",
    )
    return edited.withColumn("edited_fingerprint", fingerprint(F.col("edited"))).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "next_id",
    )
