from __future__ import annotations

import gzip

import pytest

from landfold import append, list_files, parse_size, read_csv, read_lines, read_table, read_text, to_bronze
from landfold.functions.sizes import rate_options

ODD_LINES = [
    'a,"b, c"', "x\x01y", "tilde~cut", "\x00nul,1", "in\x00side", '"unbalanced', "back\\slash",
    "  lead", "#c", 'z"q"\x01￿"', "p￿q￿r", '"x,y"', "quote￾d", "tab\tend ",
]


def values(df):
    return sorted(r.value for r in df.select("value").collect())


@pytest.mark.parametrize("skip", [0, 2])
def test_lines_come_through_whole(spark, drop, skip):
    head = ["# made by", ""][:skip]
    drop("d1/f.csv", [*head, "h1,h2", *ODD_LINES[:7], "", "   "])
    drop("d2/k=1/f.csv", [*head, "h1,h2", *ODD_LINES[7:], ""])
    df = read_lines(spark, drop.landing, streaming=False, skip_rows=skip)
    assert df.columns == ["value", "fileMetadata"]
    assert values(df) == sorted(ODD_LINES)


def test_lines_without_header(spark, drop):
    drop("f.csv", ["1,2", "3,4"])
    assert values(read_lines(spark, drop.landing, header=False, streaming=False)) == ["1,2", "3,4"]


def test_header_is_dropped_once_in_a_file_of_many_splits(spark, drop):
    lines = [f"{i},{'x' * 50}" for i in range(2000)]
    drop("f.csv", ["skip me", "id,text", *lines])
    drop("g.csv", ["skip me", "id,text", "last,1"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = read_lines(spark, drop.landing, streaming=False, skip_rows=1)
        assert df.rdd.getNumPartitions() > 3
        assert values(df) == sorted([*lines, "last,1"])
        got = values(read_lines(spark, drop.landing, streaming=False))
        assert got == sorted([*lines, "last,1", "id,text", "id,text"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_head_longer_than_its_split_is_refused(spark, drop):
    drop("f.csv", [f"line {i:05d}" for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        with pytest.raises(Exception, match="longer than its first split"):
            read_lines(spark, drop.landing, streaming=False, skip_rows=2500).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_heads_that_are_not_valid_text(spark, drop, tmp_path):
    (tmp_path / "landing" / "f.csv").write_bytes(b"\xff\xfe made by\n\t\nna\xefve,caf\xe9\n1,a\n\t \n2,b\n")
    assert values(read_lines(spark, drop.landing, streaming=False, skip_rows=1)) == ["1,a", "2,b"]
    assert values(read_lines(spark, drop.landing, streaming=False, header=False, skip_rows=3)) == ["1,a", "2,b"]


def test_compressed_lines(spark, drop, tmp_path):
    with gzip.open(tmp_path / "landing" / "f.csv.gz", "wt") as out:
        out.write("h\n1\n2\n")
    assert values(read_lines(spark, drop.landing, streaming=False)) == ["1", "2"]


def test_text_by_line_and_by_file(spark, drop):
    drop("a/f.txt", ["one", "", "two"])
    drop("b/f.txt", ["three"])
    assert values(read_text(spark, drop.landing, streaming=False)) == ["", "one", "three", "two"]
    assert values(read_text(spark, drop.landing, streaming=False, skip_rows=2)) == ["two"]
    whole = read_text(spark, drop.landing, streaming=False, whole_text=True)
    assert values(whole) == ["one\n\ntwo\n", "three\n"]
    with pytest.raises(ValueError):
        read_text(spark, drop.landing, whole_text=True, skip_rows=1)


def test_typed_csv(spark, drop):
    drop("f.csv", ["id;name", '1;"a;b"', "2;c"])
    df = read_csv(spark, drop.landing, "id INT, name STRING", delimiter=";", streaming=False)
    assert sorted((r.id, r.name) for r in df.collect()) == [(1, "a;b"), (2, "c")]
    # Columns bind by position, whatever the header says, and the caller's options win.
    df = read_csv(
        spark, drop.landing, "a INT, b STRING", options={"sep": ";"}, streaming=False
    )
    assert sorted((r.a, r.b) for r in df.collect()) == [(1, "a;b"), (2, "c")]


def test_typed_csv_after_skipped_rows(spark, drop):
    drop("f.csv", ["exported today", "id;name", '1;"a;b"', "2;c"])
    df = read_csv(
        spark, drop.landing, "id INT, name STRING", delimiter=";", skip_rows=1, streaming=False
    )
    assert sorted((r.id, r.name) for r in df.collect()) == [(1, "a;b"), (2, "c")]


def test_typed_rows_keep_a_line_in_bronze(spark, drop):
    drop("f.csv", ["id,name", "1,a", "2,"])
    rows = to_bronze(read_csv(spark, drop.landing, "id INT, name STRING", streaming=False), "landing/")
    assert rows.columns == [
        "fullFilePath", "datasource", "inputFileName", "ingestTime", "ingestDate", "value",
        "fileMetadata", "data",
    ]
    assert sorted((r.value, r.data.id, r.data.name) for r in rows.collect()) == [
        ("1,a", 1, "a"), ("2,", 2, None),
    ]


def test_bronze_envelope(spark, drop):
    path = drop("x/patients.csv", ["h", "1"], at=1_600_000_000)
    row = to_bronze(read_lines(spark, drop.landing, streaming=False), "the/landing/").first()
    assert row.fullFilePath.endswith(path)
    assert (row.datasource, row.inputFileName, row.value) == ("the/landing/", "patients.csv", "1")
    assert row.ingestTime.date() == row.ingestDate
    assert row.fileMetadata.file_name == "patients.csv"
    assert row.fileMetadata.file_modification_time.timestamp() == 1_600_000_000


def test_listing(spark, drop):
    drop("a/f.csv", ["1"])
    drop("b/c/f.csv", ["1"])
    drop("b/g.txt", ["1"])
    names = sorted(r.inputFileName for r in list_files(spark, drop.landing).collect())
    assert names == ["f.csv", "f.csv", "g.txt"]


@pytest.mark.parametrize(
    "size,expected",
    [(5, 5), ("5", 5), ("10g", 10 << 30), ("2KB", 2048), (" 3 m ", 3 << 20), ("1t", 1 << 40)],
)
def test_sizes(size, expected):
    assert parse_size(size) == expected


@pytest.mark.parametrize("size", ["", "ten", "-1", "0", 0, "1.5g"])
def test_bad_sizes(size):
    with pytest.raises(ValueError):
        parse_size(size)


def test_one_rate_limit_only():
    with pytest.raises(ValueError, match="not both"):
        rate_options(1000, "10g")
    assert rate_options(1000, None) == {"maxFilesPerTrigger": "1000"}
    assert rate_options(None, "1k") == {"maxBytesPerTrigger": "1024"}
    assert rate_options(None, None) == {}
    with pytest.raises(ValueError):
        rate_options(0, None)


def ingest(spark, drop, **limits):
    rows = to_bronze(read_lines(spark, drop.landing, **limits), drop.landing)
    query = append(rows, f"{drop.root}/bronze", f"{drop.root}/checkpoint")
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_each_file_is_read_once(spark, drop):
    for i in range(5):
        drop(f"d{i}/f.csv", ["h", str(i)])
    assert len(ingest(spark, drop, max_files=2)) == 3
    assert ingest(spark, drop, max_files=2) == []
    drop("late/f.csv", ["h", "9"])
    drop("d0/f.csv", ["h", "changed"])  # a path once seen is not read again
    assert ingest(spark, drop, max_files=2) == [1]
    assert values(read_table(spark, f"{drop.root}/bronze")) == ["0", "1", "2", "3", "4", "9"]


def test_a_file_far_older_than_the_others_is_read(spark, drop):
    drop("new/f.csv", ["h", "new"], at=1_700_000_000)
    ingest(spark, drop)
    drop("old/f.csv", ["h", "old"], at=1_000_000_000)
    assert ingest(spark, drop) == [1]


def test_byte_limit_paces_batches(spark, drop):
    for i in range(4):
        drop(f"d{i}/f.csv", ["h", str(i) * 100])
    assert len(ingest(spark, drop, max_files=None, max_bytes="150b")) == 4


def test_a_limit_among_the_options_replaces_ours(spark, drop):
    for i in range(4):
        drop(f"d{i}/f.csv", ["h", str(i)])
    assert len(ingest(spark, drop, options={"maxBytesPerTrigger": "1"})) == 4


def test_several_flows_feed_one_table(spark, drop):
    table = f"{drop.root}/bronze"
    for flow in ("a", "b"):
        drop(f"{flow}/f.csv", ["h", flow])
        rows = to_bronze(read_lines(spark, f"{drop.landing}/{flow}"), flow)
        append(rows, table, f"{drop.root}/checkpoint/{flow}", flow=flow).awaitTermination()
    assert values(read_table(spark, table)) == ["a", "b"]
    with pytest.raises(ValueError, match="another checkpoint"):
        append(rows, table, f"{drop.root}/checkpoint/c", flow="a")
    seen = read_table(spark, table, streaming=True).writeStream.format("memory").queryName("both")
    seen.trigger(availableNow=True).start().awaitTermination()
    assert values(spark.table("both")) == ["a", "b"]
