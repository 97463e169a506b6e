from __future__ import annotations

import base64
import hashlib
import random

from landfold.llm import secret_scan

WORDS = "connection manager default handler response counter utility iteration provider network setting".split()


def corpus():
    r = random.Random(1)
    plain = [" ".join(r.choice(WORDS) + r.choice(["", "_", "-"]) + r.choice(WORDS) for _ in range(60)) for _ in range(60)]
    keys = [f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}"' for i in range(40)]
    return plain, keys


def test_models_find_what_no_rule_knows(documents):
    plain, keys = corpus()
    unknown = [base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode().rstrip("=") for i in range(20)]
    texts = plain + keys + [f"use {u} here" for u in unknown] + ["default_connection_manager_provider is plain"]
    found = secret_scan.scan(documents(texts)).orderBy("doc_id").collect()
    spans = [[(s["kind"], t[s["start"] : s["end"]]) for s in r["secret_spans"]] for r, t in zip(found, texts, strict=True)]
    assert all(not s for s in spans[:60])
    assert all(s == [("assign", k.rstrip('"')), ("hex", k.split('"')[1])] for s, k in zip(spans[60:100], keys, strict=True))
    hit = sum(any(k == "markov" for k, _ in s) for s in spans[100:120])
    assert hit >= 19
    assert spans[120] == []


def test_redaction_keeps_the_rest(documents):
    plain, keys = corpus()
    docs = documents([*plain, keys[0], None, ""])
    out = [r["text"] for r in secret_scan.redact(docs).orderBy("doc_id").collect()]
    assert out[:60] == plain
    assert out[60:] == ['[SECRET:assign]"', None, ""]


def test_empty_tables_and_clashing_names(documents):
    empty = documents([])
    assert secret_scan.scan(empty).collect() == []
    odd = documents(["token=abcdef123456"] * 3, [1, 1, None]).selectExpr("*", "1 AS secret_spans", "2 AS string")
    rows = secret_scan.scan(odd).collect()
    assert [[s["kind"] for s in r["secret_spans"]] for r in rows] == [["assign"]] * 3
    assert [r["string"] for r in rows] == [2] * 3


def test_unlabelled_random_strings_neither_hide_nor_hide_others(documents, monkeypatch):
    """Keys in the texts that models learn from, and more of them in texts that they do not."""
    monkeypatch.setattr(secret_scan, "SAMPLE", 80)
    plain, keys = corpus()
    unknown = [base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode().rstrip("=") for i in range(200)]
    short = [hashlib.md5(str(i).encode()).hexdigest()[:16] for i in range(60)]
    ruled = ["-" * 40, "connection_manager_default_handler"]
    texts = plain + keys + [f"use {u} and {s} here" for u, s in zip(unknown, short * 4, strict=False)] + ruled
    found = secret_scan.scan(documents(texts)).orderBy("doc_id").collect()
    kinds = [[s["kind"] for s in r["secret_spans"]] for r in found]
    assert not any(kinds[:60]) and not any(kinds[-2:])
    # At most 80 of the 262 texts without a hint are in the sample.
    assert sum(k == ["markov"] for k in kinds[100:300]) >= 190


def test_ratio_of_a_pair_never_seen_is_bounded():
    usual = {secret_scan._N + 2: 1_000_000}
    assert max(secret_scan._ratios({}, usual)) < 5


def test_identifiers_paths_and_uuids_are_not_secrets(spark):
    """Measured on labelled strings of words that the corpus does not have."""
    import uuid
    from pathlib import Path

    import pytest

    data = "/root/testdata/sf0.01/documents.parquet"
    if not Path(data).exists():
        pytest.skip("no test tables here")
    models = secret_scan.train(spark.read.parquet(data))
    r = random.Random(4)
    words = (
        "user profile service abstract singleton proxy factory bean response database transaction customer address"
        " validator configuration controller repository python packages numpy share local window buffer stream parser"
    ).split()
    write = ["_".join, "-".join, lambda ws: "/" + "/".join(ws), lambda ws: "".join(w.title() for w in ws), lambda ws: "_".join(ws) + "_v2"]
    plain = [write[i % 5]([r.choice(words) for _ in range(r.randint(3, 6))]) for i in range(500)]
    plain += ["AbstractSingletonProxyFactoryBeanImpl", "/usr/lib/python3/dist-packages/numpy/core", "//example-org/wiki/Main_Page"]
    plain += [str(uuid.UUID(int=r.getrandbits(128))) for _ in range(200)]
    letters = secret_scan.ALPHABET[:62]
    random_ = ["".join(r.choice(letters) for _ in range(24)) for _ in range(200)]
    random_ += [base64.b64encode(r.randbytes(24)).decode() for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(plain + random_)]
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), models).collect()
    hit = {x["doc_id"] for x in found if any(s["kind"] == "markov" for s in x["secret_spans"])}
    wrong = sum(i < len(plain) for i in hit)
    assert wrong < 0.01 * len(plain) + 1
    assert len(hit) - wrong >= 0.95 * len(random_)


def test_ratio_against_brute_force(spark):
    """The mean log-likelihood ratio, and the ratios from pair counts, in plain Python."""
    import math

    chance, usual = {65 * 2: 3, 67: 5}, {67: 9, 68: 1}
    ratios = secret_scan._ratios(chance, usual)
    n = secret_scan._N
    for k in (67, 68, 130, 4000):
        row = range(k // n * n, k // n * n + n)
        c, u = sum(chance.get(j, 0) for j in row), sum(usual.get(j, 0) for j in row)
        p = 0.5 / n + 0.5 * (chance.get(k, 0) + 1) / (c + n)
        q = secret_scan.UNSEEN / n + (1 - secret_scan.UNSEEN) * (usual.get(k, 0) + 0.05) / (u + 0.05 * n)
        assert abs(ratios[k] - math.log(p / q)) < 1e-4
    text = "abZ9/+_x="
    at = [secret_scan.ALPHABET.index(ch) + 1 for ch in text]
    want = sum(ratios[a * n + b] for a, b in zip(at, at[1:])) / (len(text) - 1)
    df = spark.createDataFrame([(text,)], "t string")
    assert abs(df.select(secret_scan._mean(ratios, secret_scan.F.col("t"))).first()[0] - want) < 1e-9
