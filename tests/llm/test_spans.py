from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfold.llm import sanitise, secret_scan
from landfold.llm.spans import find, in_order, joined, matches, replaced

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    spans = [("email", m) for m in EMAIL.finditer(text)]
    spans += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", m) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [("phone", m) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in spans)


def secrets(text):
    kinds = ["assign", "access", "hex"]
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


PIECES = st.sampled_from(
    [
        *"aZ09 .+-@_%'\":=()é𝒳\n",
        "a@b.c",
        "x.y@d-e.f.g",
        "1.2.3.4",
        "256.1.1.1",
        "0255.001.1.1",
        "4111 1111 1111 1111",
        "4111111111111112",
        "+1 (555) 010-9999",
        "token",
        "Secret =",
        "api_key: ",
        "PASSWD='",
        "abcdef",
        "AKIA",
        "ABCDEFGH12345678",
        "0123456789abcdef0123456789",
    ]
)
TEXTS = st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=40, max_size=60)


@settings(max_examples=4, deadline=None)
@given(TEXTS)
def test_base_spans_are_those_of_the_plain_patterns(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(
        "text",
        joined(sanitise.base_spans(F.col("text"))).alias("p"),
        joined(secret_scan.base_spans(F.col("text"))).alias("s"),
    ).collect()
    for row in got:
        assert row["p"] == personal(row["text"])
        assert row["s"] == secrets(row["text"])


def test_many_matches_of_a_long_text(spark):
    """More matches than a slice holds, and characters of several bytes between them."""
    text = "".join(f"é{'x' * (i % 7)}{i:07d}" for i in range(1000))
    want = [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)]
    row = spark.createDataFrame([(text,)], "text string").select(matches(F.col("text"), "[0-9]+").alias("m"))
    assert [tuple(m) for m in row.first()["m"]] == want


@pytest.mark.parametrize("text", ["", "none here", "a" * 200_000, "1" * 100_000])
def test_texts_without_matches_and_long_runs(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(joined(sanitise.base_spans(F.col("text"))).alias("s")).first()["s"] == ""


def test_replaced(spark):
    text = "aa-é11é-bb-22-cc"
    spans = F.concat(
        find(F.col("text"), "[0-9]+", "n"), find(F.col("text"), "é[0-9]+é", "wide"), find(F.col("text"), "cc", "end")
    )
    label = lambda kind: F.concat(F.lit("<"), kind, F.lit(">"))
    df = spark.createDataFrame([(text,), ("",), ("plain",)], "text string")
    out = [r[0] for r in df.select(replaced(F.col("text"), spans, label)).collect()]
    assert out == ["aa-<wide>-bb-<n>-<end>", "", "plain"]
    many = "".join(f"{i}," for i in range(700))
    df = spark.createDataFrame([(many,)], "text string")
    assert df.select(replaced(F.col("text"), spans, label)).first()[0] == "<n>," * 700
    assert df.select(joined(in_order(find(F.col("text"), "x", "n"), ["n"]))).first()[0] == ""
