"""One query for each operator, over its whole table, and the SQL that some must equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfold.llm import near_duplicates as near
from landfold.llm import byte_bpe, fingerprints, hard_negatives, neighbours, packing, quality, sanitise
from landfold.llm import secret_scan, tiled_similarity, token_counts, turn_repair, warc
from landfold.llm.shared import materialise, table, work_folder
from landfold.llm.spans import joined

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


_OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1),
         lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles FROM w
), x AS (SELECT doc_id, unnest(shingles) AS shingle, len(shingles) AS n FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS c FROM s UNION SELECT p.b, r.c FROM reached r JOIN pairs p ON p.a = r.doc_id
)
SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, min(c) AS component_id, s.doc_id = min(c) AS kept
FROM s JOIN reached USING (doc_id) GROUP BY s.doc_id, shingles
"""


@query("op8_near_duplicates", _OP8)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    found = near.near_duplicates(table(spark, sf, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.classify(docs, table(spark, sf, "labels")).select(
        "doc_id", "held_out", "score", "predicted"
    )


@query("op7_secret_scan")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    of = lambda kind: F.filter("secret_spans", lambda s: s["kind"] == kind)
    base = F.filter("secret_spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secret_spans")).alias("spans"),
    )


@query("op4_packing")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_FINGERPRINT = """
    (SELECT sha256(array_to_string(list_transform(sections, lambda s: sha256(s)), '')) || '/' ||
        array_to_string(list_transform(sections, lambda s: substr(sha256(s), 1, 8) || ':' ||
            regexp_replace(s, '([0-9a-f]{8})[0-9a-f]{56}', '\\1', 'g')), '/')
     FROM (SELECT list_filter(string_split(array_to_string(list_transform(list_transform(
        string_split(%s, chr(10)),
        lambda p: list_transform(regexp_extract_all(p, '{phrase}'), lambda x: md5(x))),
        lambda h: sha256(array_to_string(h, '')) ||
            array_to_string(list_transform(h, lambda x: '.' || substr(x, 1, 8)), '') ||
            CASE WHEN len(h) = 0 OR substr(sha256(array_to_string(h, '')), 1, 1) IN ('0', '1')
                 THEN '/' ELSE ',' END), ''), '/'), lambda s: s <> '') AS sections))
""".replace("{phrase}", fingerprints.PHRASE)
_LIKENESS = """
    CASE WHEN {a} = {b} THEN 1.0 ELSE coalesce(
        len(list_intersect(list_distinct(regexp_extract_all({a}, '\\.([0-9a-f]{8})', 1)),
                           list_distinct(regexp_extract_all({b}, '\\.([0-9a-f]{8})', 1))))::DOUBLE /
        nullif(len(list_distinct(list_concat(regexp_extract_all({a}, '\\.([0-9a-f]{8})', 1),
                                             regexp_extract_all({b}, '\\.([0-9a-f]{8})', 1)))), 0), 0.0) END
"""


def _likeness_sql(a: str, b: str) -> str:
    return _LIKENESS.replace("{a}", a).replace("{b}", b)


_OP1 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS after,
             coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
      FROM d WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, left(text, (length(text) - length(text) // 3)::INT) || left(after, (length(text) // 3)::INT) AS edited
      FROM n),
f AS (SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
             {_FINGERPRINT % 'text'} AS fingerprint, {_FINGERPRINT % 'edited'} AS edited_fingerprint,
             {_FINGERPRINT % 'after'} AS after_fingerprint, next_id FROM e)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       {_likeness_sql('fingerprint', 'edited_fingerprint')} AS near_edited,
       {_likeness_sql('fingerprint', 'after_fingerprint')} AS near_next, next_id
FROM f
"""


@query("op1_fingerprints", _OP1)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf, "documents"))


_OP3 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""


@query("op3_warc", _OP3)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "warc")
    warc.write(table(spark, sf, "pages"), folder)
    return warc.read_records(spark, folder).select(
        warc.page_of(F.col("record_id")).cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).cast("bigint").alias("refers_to"),
    )


@query("op5_nearest_neighbours")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.search(table(spark, sf, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@query("op6_personal_data")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    found = sanitise.find_personal(table(spark, sf, "documents").select("doc_id", "text"))
    of = lambda kind: F.filter("personal_spans", lambda s: s["kind"] == kind)
    base = F.filter("personal_spans", lambda s: s["kind"].isin(sanitise.BASE))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in sanitise.BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("personal_spans")).alias("spans"),
    )


@query("op2_token_counts")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocabulary = token_counts.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts.count_tokens(spark, docs, vocabulary, public_tokenizers.PATTERN).drop("text")


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(spark, docs, path, public_tokenizers.PATTERN, ["doc_id"])
    ids = F.col("ids")
    return coded.select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(ids, byte_bpe.Ranks(path)), 256).alias("decoded_sha256"),
    )


# The DP of op11 backwards over the rows, as a list of {cost, audit, lines} for the states.
_STATES = range(1, 5)
_DUE = {1: (3, "user"), 2: (3, "user"), 3: (4, "assistant"), 4: (3, "user")}
_KEPT = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}


def _best(options: list[str]) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))[1]"


def _edited_sql(q: int) -> str:
    to, due = _DUE[q]
    then = "{{'c': v[{to}].c + {cost}, 'a': '{letter}' || v[{to}].a, 't': list_concat([{role} || ':' || text], v[{to}].t)}}"
    options = [f"{{'c': v[{q}].c + 4, 'a': 'D' || v[{q}].a, 't': v[{q}].t}}"]
    cost = "CASE fault WHEN 't' THEN 3 ELSE 0 END"
    options += [
        f"CASE WHEN fault IN ('c', 't') AND initial = '{k}' THEN {then.format(to=n, cost=cost, letter='K', role='role')} END"
        for k, n in _KEPT[q].items()
    ]
    changed = then.format(to=to, cost="3 + " + cost, letter="R", role=f"'{due}'")
    return _best([*options, f"CASE WHEN fault IN ('c', 't') THEN {changed} END"])


def _inserted_sql(q: int, of: str) -> str:
    to, due = _DUE[q]
    new = f"{{'c': {of}[{to}].c + 3, 'a': 'I' || {of}[{to}].a, 't': list_concat(['{due}:'], {of}[{to}].t)}}"
    return _best([f"{of}[{q}]", new])


_OP11 = rf"""
WITH RECURSIVE k AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS m
  FROM conversations, k
), e AS (
  SELECT conv_id, turn, CASE m WHEN 4 THEN 'user' ELSE role END AS role,
    CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE m WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM d WHERE m <> 0
), o AS (
  SELECT *, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n FROM e
), f AS MATERIALIZED (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE 'c' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair FROM o
), walk AS (
  SELECT conv_id, max(n) + 1 AS n, [{{'c': 0, 'a': '', 't': []::VARCHAR[]}},
    {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}}, {{'c': 3, 'a': 'I', 't': ['assistant:']}},
    {{'c': 0, 'a': '', 't': []::VARCHAR[]}}] AS v FROM f GROUP BY conv_id
  UNION ALL
  SELECT conv_id, n, [{', '.join(_inserted_sql(q, 'i') for q in _STATES)}] FROM (
    SELECT conv_id, n, [{', '.join(_inserted_sql(q, 'b') for q in _STATES)}] AS i FROM (
      SELECT f.conv_id, f.n, [{', '.join(_edited_sql(q) for q in _STATES)}] AS b
      FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n - 1))
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v[1].c, 0)::BIGINT AS cost, coalesce(v[1].a, '') AS audit,
  sha256(coalesce(array_to_string(v[1].t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM a.conv_id AND w.n = 1
"""


@query("op11_turn_repair", _OP11)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    conversations = table(spark, sf, "conversations")
    turns = turn_repair.damage(conversations)
    plans = turn_repair.plan_repairs(turns)
    plans = materialise(plans, "plans")
    digests = turn_repair.repaired_digests(turns, plans).withColumnRenamed("conv_id", "_d")
    known = plans.withColumnRenamed("conv_id", "_p")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        conversations.select("conv_id")
        .distinct()
        .join(known, F.col("conv_id").eqNullSafe(F.col("_p")), "left")
        .join(digests, F.col("conv_id").eqNullSafe(F.col("_d")), "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


_USABLE = """
  SELECT *, list_transform({e}, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE {e} IS NOT NULL AND len({e}) > 0
    AND len(list_filter({e}, lambda x: x IS NULL OR NOT isfinite(x))) = 0
""".replace("{e}", "embedding")

_OP12 = f"""
WITH RECURSIVE e AS ({_USABLE}),
n AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS length FROM e WHERE list_inner_product(v, v) > 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (a.length * b.length) >= 0.9
), reached AS (
  SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT p.b, r.c FROM reached r JOIN pairs p ON p.a = r.vec_id
)
SELECT e.vec_id, coalesce(k, 0) AS n_links, component_id, e.vec_id = component_id AS kept FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS k FROM pairs GROUP BY a) ON a = e.vec_id
JOIN (SELECT vec_id, min(c) AS component_id FROM reached GROUP BY vec_id) r ON r.vec_id = e.vec_id
"""


@query("op12_near_embeddings", _OP12)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return tiled_similarity.near_vectors(table(spark, sf, "embeddings"), 0.9)


_OP13 = f"""
WITH e AS ({_USABLE} AND label IS NOT NULL),
x AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(v, lambda c: floor(256 * c)::DOUBLE) AS v FROM e
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM x a JOIN x b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank, n.id AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n USING (anchor_id)
WHERE NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


@query("op13_hard_negatives", _OP13)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, lambda vec_id: vec_id % 100 == 0)
