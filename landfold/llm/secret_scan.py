"""Secret scan: rules of known shape, and two character Markov models.

The rules are patterns. The models are first-order Markov chains over characters: one of
random strings, trained on the values that the rules find and on digests, one of ordinary identifiers,
trained on the short words of other text and on identifiers made of them, as programmers
do: several words joined by ``_``, ``-`` or ``/`` or in camel case, some with a number. A long
run of identifier characters that no rule has found is a secret if its log-likelihood
ratio, a character, is over a threshold. The threshold is as high as still finds nearly all
random strings, whichever alphabet they are drawn from, and no lower than what nearly all
identifiers stay below, as measured on labelled strings that trained neither model. Runs found in texts train nothing, so that no unknown
secret can pass for an ordinary identifier or raise the bar for others. UUIDs are names, not
secrets, and are left out of what is judged. All of it is column expressions.

Inputs: null text counts as empty and has no spans; equal texts get equal spans; texts of
any length are looked at whole; an empty table trains models that know nothing, which
find nothing; other columns pass through unchanged, but ``secret_spans`` is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfold.llm.shared import let, whole_text
from landfold.llm.spans import SPAN, find, in_order, matches, replaced

KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
#: A run of fewer characters would be dropped, and a run has no other match in it.
HEX = r"[0-9a-f]{24,}"
#: What the models judge, if it is not one character repeated.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: What ordinary identifiers are learned from, if it is shorter than a candidate.
WORD = r"[A-Za-z0-9+/_=-]{2,}"
#: Words that may be keys: long ones of both letters and digits. Nothing is learned from them.
KEYLIKE = r"^(?=.*[0-9])(?=.*[A-Za-z]).{12,}$"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Texts that the models learn from: so many with secrets, so many without.
SAMPLE = 4000
#: Share of identifiers that stay below the threshold, and of random strings that may.
ORDINARY, RANDOM = 0.999, 0.04
#: Words of an identifier that is made up.
JOINED = 4
UUID = r"(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})"
#: Share of the flat model in that of ordinary identifiers, so that a few pairs never seen decide nothing.
UNSEEN = 0.02
_N = len(ALPHABET) + 1


@dataclass(frozen=True)
class MarkovModels:
    """Log-likelihood ratios of character pairs, row by row, and the threshold of their mean."""

    ratios: tuple[float, ...]
    threshold: float


def base_spans(text: Column) -> Column:
    """Spans of the three rules, by start and then as KINDS lists them."""
    return in_order(
        F.concat(
            find(text, ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 6),
            find(text, ACCESS, "access", lambda m: F.length(m) >= 20),
            find(text, HEX, "hex"),
        ),
        KINDS,
    )


def _pairs(string: Column) -> Column:
    """Numbers of a string's pairs of neighbouring characters."""
    return let(
        F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c)),
        lambda c: F.zip_with(
            F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))),
            F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))),
            lambda x, y: x * _N + y,
        ),
    )


def _counted(strings: DataFrame) -> dict[int, int]:
    """How often each pair occurs in distinct strings; at most one row a pair comes back."""
    pairs = strings.select("string").distinct().select(F.explode(_pairs(F.col("string"))).alias("pair"))
    return {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect()}


def train(docs: DataFrame) -> MarkovModels:
    """Models from labelled samples of ``docs``.

    Random strings are what the rules find in at most SAMPLE texts; ordinary identifiers
    are the words, too short for a candidate and not like keys, of at most SAMPLE texts
    without a hint of a rule, and what is made of them. Half of the strings, by their hash,
    train the models and the long ones of the other half set the threshold. Random strings are
    joined by some of three further alphabets, cut from digests of the same texts. Which texts are taken depends on a hash of the text alone;
    repeated strings count once.
    """
    texts = docs.select(whole_text().alias("text"))
    hint = F.lit(r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}")

    def sample(which: Column) -> DataFrame:
        keys = (
            texts.where(which)
            .select(F.xxhash64("text").alias("h"))
            .distinct()
            .orderBy("h")
            .limit(SAMPLE)
        )
        return texts.join(F.broadcast(keys), F.xxhash64("text") == F.col("h"), "left_semi")

    with_some = sample(F.regexp_like("text", hint))
    random = with_some.select(
        F.explode(
            F.concat(
                F.filter(
                    F.transform(matches(F.col("text"), ASSIGN), lambda m: F.regexp_extract(m["text"], ASSIGN, 1)),
                    lambda v: F.length(v) >= 6,
                ),
                F.filter(
                    F.transform(matches(F.col("text"), ACCESS), lambda m: m["text"]),
                    lambda v: F.length(v) >= 20,
                ),
                F.transform(matches(F.col("text"), HEX), lambda m: m["text"]),
            )
        ).alias("string")
    )
    short = lambda w: ~F.regexp_like(w, F.lit(CANDIDATE)) & ~F.regexp_like(w, F.lit(KEYLIKE))
    without = sample(~F.regexp_like("text", hint))
    words = without.select(
        F.filter(F.regexp_extract_all("text", F.lit(WORD), 0), short).alias("words")
    )
    usual = words.select(F.explode(F.concat("words", _made_up(F.col("words")))).alias("string"))
    digest = without.select(F.sha2("text", 256).alias("d")).distinct()
    alphabets = {
        "base64": F.base64(F.unhex(F.substring("d", 1, 48))),
        "upper hex": F.upper(F.substring("d", 1, 32)),
        "base36": F.lower(F.concat(F.conv(F.substring("d", 1, 15), 16, 36), F.conv(F.substring("d", 16, 15), 16, 36))),
    }
    drawn = [digest.select(F.lit(k).alias("kind"), s.alias("string")) for k, s in alphabets.items()]
    random = reduce(DataFrame.unionByName, [random.select(F.lit("rules").alias("kind"), "string"), *drawn])
    usual = usual.select(F.lit("").alias("kind"), "string")
    half = F.pmod(F.xxhash64("string", F.lit("half")), F.lit(2))
    chance_n, usual_n = _counted(random.where(half == 0)), _counted(usual.where(half == 0))
    ratios = _ratios(chance_n, usual_n)
    if not usual_n:
        return MarkovModels(ratios, math.inf)
    # What the hex rule finds anyway is never judged.
    unknown = random.where(~F.regexp_like("string", F.lit(HEX)))
    judged = usual.unionByName(unknown).where((half == 1) & (F.length("string") >= 20))
    # By kind, the ratio that so many of its strings stay below.
    ordered = judged.distinct().withColumn("ratio", _mean(ratios, F.col("string"))).groupBy("kind").agg(
        F.percentile_approx("ratio", [ORDINARY, RANDOM], 10_000).alias("at")
    )
    at = {r["kind"]: r["at"] for r in ordered.collect()}
    if "" not in at:
        return MarkovModels(ratios, math.inf)
    return MarkovModels(ratios, max(at[""][0], min(r[1] for k, r in at.items() if k)))


def _made_up(words: Column) -> Column:
    """Identifiers of JOINED neighbouring words each, in four manners of writing and some with a number."""
    plain = F.filter(words, lambda w: F.regexp_like(w, F.lit("^[A-Za-z]{2,}$")))
    return let(
        plain,
        lambda p: F.when(F.size(p) < JOINED, F.array().cast("array<string>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.size(p) - JOINED + 1, F.lit(JOINED)),
                lambda i: let(F.slice(p, i, F.lit(JOINED)), lambda ws: let(F.xxhash64(ws), lambda h: _written(ws, h))),
            )
        ),
    )


def _written(words: Column, draw: Column) -> Column:
    lower = F.transform(words, lambda w: F.lower(w))
    camel = F.array_join(F.transform(lower, lambda w: F.initcap(w)), "")
    number = F.when(F.pmod(draw, F.lit(5)) == 0, F.pmod(draw, F.lit(97)).cast("string")).otherwise("")
    manner = F.pmod(F.shiftright(draw, 8), F.lit(4))
    return F.concat(
        F.when(manner == 0, F.array_join(lower, "_"))
        .when(manner == 1, F.array_join(lower, "-"))
        .when(manner == 2, F.concat(F.lit("/"), F.array_join(lower, "/")))
        .otherwise(camel),
        number,
    )


def _ratios(chance: dict[int, int], usual: dict[int, int]) -> tuple[float, ...]:
    """log p(next | this, random) - log p(next | this, ordinary).

    Random strings may be drawn from any characters, so half of their model is the flat one.
    """
    out = []
    for x in range(_N):
        row = range(x * _N, (x + 1) * _N)
        c = sum(chance.get(k, 0) for k in row)
        u = sum(usual.get(k, 0) for k in row)
        for k in row:
            p = 0.5 / _N + 0.5 * (chance.get(k, 0) + 1.0) / (c + _N)
            q = UNSEEN / _N + (1 - UNSEEN) * (usual.get(k, 0) + 0.05) / (u + 0.05 * _N)
            out.append(round(math.log(p / q), 4))
    return tuple(out)


def _mean(ratios: tuple[float, ...], string: Column) -> Column:
    """Mean log-likelihood ratio of a string's pairs."""
    flat = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    return let(
        F.struct(_pairs(string).alias("p"), flat.alias("r")),
        lambda s: F.aggregate(s["p"], F.lit(0.0), lambda n, k: n + F.get(s["r"], k))
        / F.greatest(F.size(s["p"]), F.lit(1)),
    )


def all_spans(text: Column, models: MarkovModels) -> Column:
    """Spans of the rules and, where they leave a string alone, of the models."""
    if math.isinf(models.threshold):
        return base_spans(text)
    return let(
        F.struct(text.alias("whole"), base_spans(text).alias("base")),
        lambda s: in_order(
            F.concat(
                s["base"],
                F.transform(
                    F.filter(
                        matches(s["whole"], CANDIDATE),
                        lambda m: ~F.exists(
                            s["base"], lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])
                        )
                        & ~F.regexp_like(m["text"], F.lit(r"^(.)\1*$"))
                        & let(
                            F.regexp_replace(m["text"], UUID, ""),
                            lambda t: (F.length(t) >= 20) & (_mean(models.ratios, t) > models.threshold),
                        ),
                    ),
                    lambda m: F.struct(F.lit("markov").alias("kind"), m["start"], m["end"]).cast(SPAN),
                ),
            ),
            KINDS,
        ),
    )


def scan(docs: DataFrame, models: MarkovModels | None = None) -> DataFrame:
    """``docs`` with ``secret_spans``, of rules and models; models are trained if none are given."""
    models = models or train(docs)
    return docs.withColumn("secret_spans", all_spans(whole_text(), models))


def redact(docs: DataFrame, models: MarkovModels | None = None) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by its kind; texts without secrets stay as they are."""
    found = scan(docs, models)
    label = lambda kind: F.concat(F.lit("[SECRET:"), kind, F.lit("]"))
    return found.withColumn(
        "text", F.when(F.col("text").isNotNull(), replaced(F.col("text"), F.col("secret_spans"), label))
    ).drop("secret_spans")
