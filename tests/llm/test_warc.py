from __future__ import annotations

import gzip
import hashlib
import random
from pathlib import Path

import pytest

from landfold.llm import warc

PAGES = "page_id bigint, url string, html string"


def corpus():
    r = random.Random(8)
    page = lambda n: "".join(r.choice(["é", "ab", "\r\n", "\r\n\r\n", "WARC/1.0", "\n", "𝒳", "\r", " "]) for _ in range(n))
    html = [page(r.choice([0, 1, 5, 60, 3000])) for _ in range(60)] + [None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100]
    html += [html[0], html[3]] * 3 + ["long " * 200_000, "long " * 200_000, "\r\n\r\n" * 50, "z" * 200 + "\r\n"]
    rows = [(i, f"http://h{i}.example.com/\r\n\x00 p", h) for i, h in enumerate(html)]
    r.shuffle(rows)
    return [*rows, (500, None, "no url")]


def want(rows):
    payloads = {i: (h or "").encode() for i, _, h in rows}
    out = []
    for i, p in payloads.items():
        first = min(j for j, q in payloads.items() if q == p)
        again = len(p) >= 100 and first != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out)


@pytest.mark.parametrize(("segment", "chunk"), [(warc.SEGMENT, warc.CHUNK), (1000, 777)])
def test_round_trip(spark, tmp_path, segment, chunk):
    rows = corpus()
    folder = str(tmp_path / "archives")
    warc.write(spark.createDataFrame(rows, PAGES).repartition(3), folder, segment)
    got = warc.read_records(spark, folder).collect()
    page = lambda x: None if x is None else int(x.removeprefix("<urn:page:").rstrip(">"))
    assert sorted(
        (page(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], page(r["refers_to"])) for r in got
    ) == want(rows)
    chunks = {}
    for r in warc.read_chunks(spark, folder, chunk).where("record_type = 'response'").collect():
        chunks.setdefault(page(r["record_id"]), []).append(r)
    for i, _, h in rows:
        if i not in chunks:
            continue
        own = sorted(chunks[i], key=lambda r: r["chunk_no"])
        payload = (h or "").encode()
        assert b"".join(r["chunk"] for r in own) == payload
        assert [r["chunk_no"] for r in own] == list(range(len(own)))
        assert all(len(r["chunk"]) <= chunk for r in own)
        seen = 0
        for r in own:
            seen += len(r["chunk"])
            assert (r["payload_bytes"], r["digest"]) == (seen, hashlib.sha256(payload[:seen]).hexdigest())
        assert [r["last"] for r in own] == [False] * (len(own) - 1) + [True]


def test_records_are_well_formed(spark, tmp_path):
    folder = tmp_path / "archives"
    warc.write(spark.createDataFrame([(1, "http://a b", "x" * 2500), (2, "u", "x" * 2500)], PAGES).coalesce(1), str(folder), 1000)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(folder).glob("part-*")))
    kinds = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        data = rest[n + 4 :]
        kinds.append((fields["WARC-Type"], fields.get("WARC-Segment-Number"), "WARC-Segment-Total-Length" in fields))
    assert sorted(kinds, key=str) == [("continuation", "2", False), ("continuation", "3", True), ("response", "1", False), ("revisit", None, False)]


def test_repeated_rows_missing_ids_and_empty_table(spark, tmp_path):
    long = "z" * 150
    rows = [(1, "u", long), (1, "u", long), (2, "u", long), (None, "u", long), (None, None, None)]
    odd = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS digest", "2 AS first", "3 AS n")
    warc.write(odd, str(tmp_path / "a"))
    got = sorted((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_records(spark, str(tmp_path / "a")).na.fill("").collect())
    one = "<urn:page:1>"
    assert got == [(one, "response", "", 150), (one, "response", "", 150), ("<urn:page:2>", "revisit", one, 150), ("<urn:page:null>", "response", "", 0), ("<urn:page:null>", "revisit", one, 150)]
    warc.write(spark.createDataFrame([], PAGES), str(tmp_path / "b"))
    assert warc.read_records(spark, str(tmp_path / "b")).collect() == []


def test_damaged_archives_are_refused():
    parser = warc._Parser(10, True)
    with pytest.raises(ValueError, match="version"):
        parser.feed(b"HTTP/1.1 200 OK\r\n\r\n")
    parser = warc._Parser(10, True)
    parser.feed(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 9\r\n\r\nabc")
    with pytest.raises(ValueError, match="within"):
        parser.close()
