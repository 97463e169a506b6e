"""Compression classifier: which of two dictionaries makes a text smaller.

Two zstandard dictionaries are trained, on text labelled good and on text labelled bad.
A text is compressed in blocks with each of them, so that the dictionaries count over
its whole length. The difference of the sizes, divided by the larger, and the smaller
size a byte (text that repeats itself shrinks under any dictionary) go through a
logistic curve fitted on labelled texts that the dictionaries have not seen.

Inputs: null text counts as empty; an empty text has no difference and gets the score of
the curve at zero; equal texts get equal scores; other columns pass through unchanged. Labels that are null,
contradict each other or belong to no document are left out. With labels of one kind
only, every text scores the share of good labels with one added to each kind; without
labels 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfold.llm.shared import whole_text

#: Labelled texts of each kind: so many for a dictionary, so many for the curve.
SAMPLE = 1500
#: Labelled texts of more characters than this are passed over in training.
MOST_CHARS = 16_384
BLOCK = 512
DICTIONARY_BYTES = 112_640
LEVEL = 1


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the curve; a few hundred kilobytes, whatever the input."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def scorer(self) -> Callable[[str], float]:
        measure = _measure(self.good, self.bad) if self.good and self.bad else None

        def score(text: str) -> float:
            x = measure(text) if measure else (0.0,) * (len(self.weights) - 1)
            z = self.weights[0] + sum(w * v for w, v in zip(self.weights[1:], x, strict=True))
            return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

        return score


def _measure(good: bytes, bad: bytes) -> Callable[[str], tuple[float, ...]]:
    def compressor(d: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(d)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    by_good, by_bad = compressor(good), compressor(bad)

    def measure(text: str) -> tuple[float, ...]:
        raw = text.encode("utf-8", "surrogatepass")
        if not raw:
            return (0.0, 0.0, 0.0)
        g = b = 0
        for i in range(0, len(raw), BLOCK):
            block = raw[i : i + BLOCK]
            g += len(by_good.compress(block))
            b += len(by_bad.compress(block))
        blocks = -(-len(raw) // BLOCK)
        net = max(0.0, min(g, b) - 8.0 * blocks) / len(raw)  # without the frames' headers
        return ((b - g) / max(b, g), (b - g) / len(raw), max(0.0, 0.25 - net))

    return measure


def train(labelled: DataFrame) -> QualityModel:
    """A model from (doc_id, text, quality), from a sample of bounded size.

    The sample is the SAMPLE * 2 texts of each kind whose ids hash lowest, among texts of
    at most MOST_CHARS characters; half train the dictionaries, half the curve.
    """
    fit = (
        labelled.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(
            F.min("quality").alias("low"),
            F.max("quality").alias("quality"),
            F.min(whole_text()).alias("text"),
        )
        .where("low = quality")
    )
    return _fit(fit)


def train_on(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """As ``train``, with the sample drawn before any text is moved."""
    # crc32 is for the split; the order of the sample comes from another hash.
    kinds = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("quality"))
        .where("low = quality")
        .select("doc_id", "quality")
    )
    short = docs.where(F.length(whole_text()) <= MOST_CHARS).select("doc_id").distinct()
    known = kinds.join(short, "doc_id")
    counts = {int(r["quality"]): r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    drawn = None
    for kind in (0, 1):
        ids = (
            known.where(F.col("quality") == kind)
            .orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id")
            .limit(2 * SAMPLE)
        )
        drawn = ids if drawn is None else drawn.unionByName(ids)
    # At most 4 * SAMPLE ids: small enough for every executor, by its bound.
    rows = (
        docs.where(F.length(whole_text()) <= MOST_CHARS)
        .select("doc_id", whole_text().alias("text"))
        .join(F.broadcast(drawn), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id")
        .collect()
    )
    return _from_rows([(r["text"], int(r["quality"])) for r in rows], counts)


def _fit(fit: DataFrame) -> QualityModel:
    docs = fit.select("doc_id", "text")
    return train_on(docs, fit.select("doc_id", "quality"))


def _from_rows(rows: list[tuple[str, int]], counts: dict[int, int]) -> QualityModel:
    kinds = {k: [t for t, q in rows if q == k] for k in (0, 1)}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    flat = math.log((n1 + 1) / (n0 + 1)) if n0 + n1 else 0.0
    trained = {k: _dictionary(t[0::2]) for k, t in kinds.items()}
    if not (trained[0] and trained[1]):
        return QualityModel(b"", b"", (flat,))
    measure = _measure(trained[1], trained[0])
    x, y, w = [], [], []
    for k, total in ((0, n0), (1, n1)):
        own = kinds[k][1::2] or kinds[k]
        for t in own:
            x.append((1.0, *measure(t)))
            y.append(float(k))
            w.append(total / len(own))
    return QualityModel(trained[1], trained[0], _logistic(np.array(x), np.array(y), np.array(w)))


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; with too little text for training, the text itself."""
    blocks = []
    for t in texts:
        raw = t.encode("utf-8", "surrogatepass")
        blocks += [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's method, with a slight ridge."""
    w = w / w.sum() * len(y)
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-4] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (w * (y - p)) - ridge @ beta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def score(model: QualityModel, text: Column) -> Column:
    """The score of a text column, 0 to 1."""

    def of(texts: pd.Series) -> pd.Series:
        f = model.scorer()
        return pd.Series([f(t) for t in texts], dtype="float64")

    return F.pandas_udf(of, "double")(F.coalesce(text, F.lit("")))


def held_out() -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    model = train_on(docs.where(~held_out()), labels.select("doc_id", "quality"))
    extra = {"held_out", "score", "predicted"}
    kept = docs.drop(*[c for c in docs.columns if c.lower() in extra])
    return kept.withColumns({"held_out": held_out(), "score": score(model, F.col("text"))}).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
