from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import types as T

from landfold import ChangeTable, DropZone, Feed
from landfold.operators.bronze import ENVELOPE

#: Tables with columns of every kind, and keys of one and of several columns.
TABLES = {
    "customers": ("c_id bigint, name string, nation int, balance double, since date", ["c_id"]),
    "orders": ("o_id bigint, c_id bigint, status string, total double, placed timestamp", ["o_id"]),
    "lines": ("o_id bigint, line int, part string, price double, shipped date", ["o_id", "line"]),
    "stock": ("part string, supplier string, bin string, amount int, cost double", ["part", "supplier", "bin"]),
    "visits": ("at timestamp, user_id bigint, page string, referrer string", ["user_id", "at", "page", "referrer"]),
}


def write_ddl(tmp_path, ddl):
    folder = tmp_path / "ddl"
    folder.mkdir(exist_ok=True)
    for name, text in ddl.items():
        (folder / f"{name}.ddl").write_text(text)
    return str(folder)


def sample(field, i):
    kind = field.dataType
    if isinstance(kind, T.DateType):
        return f"2020-01-{i:02d}", dt.date(2020, 1, i)
    if isinstance(kind, T.TimestampType):
        return f"2020-01-{i:02d}T03:04:05Z", dt.datetime(2020, 1, i, 3, 4, 5)
    if isinstance(kind, T.DoubleType):
        return f"{i}.25", i + 0.25
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return str(i), i
    return f'"{field.name}, {i}"', f"{field.name}, {i}"


def test_many_sources_from_files_to_keyed_tables(spark, drop, tmp_path):
    tables = TABLES
    want = {}
    for name, (columns, keys) in tables.items():
        schema = T.StructType.fromDDL(columns)
        rows = {i: [sample(f, i) for f in schema.fields] for i in (1, 2, 3)}
        head = ",".join(schema.fieldNames()).upper()
        lines = {i: ",".join(text for text, _ in row) for i, row in rows.items()}
        # The second file brings row 2 again, with a null where no key is.
        changed = next((j for j, f in enumerate(schema.fields) if f.name not in keys), None)
        again = ",".join("" if j == changed else text for j, (text, _) in enumerate(rows[2]))
        drop(f"2020/01/{name}.csv", [head, lines[1], lines[2]], at=1_600_000_000)
        drop(f"2020/02/{name}.csv", [head, again, lines[3]], at=1_600_000_100)
        want[name] = {tuple(v for _, v in row) for row in rows.values()}

    zone = DropZone(spark, drop.landing, drop.root, [Feed("landed", max_files=30)])
    ddl = write_ddl(
        tmp_path,
        {n: f"struct<{', '.join(c.replace(' ', ':', 1) for c in cols.split(', '))}>" for n, (cols, _) in tables.items()},
    )
    done = zone.run(ddl, {n: k for n, (_, k) in tables.items()})
    assert done == sorted(tables)
    for name in tables:
        got = zone.silver(name)
        assert set(got.columns) == set(T.StructType.fromDDL(tables[name][0]).fieldNames())
        ordered = got.select(T.StructType.fromDDL(tables[name][0]).fieldNames())
        assert {tuple(r) for r in ordered.collect()} == want[name], name
    assert zone.refresh_alerts()[0].count() == 0
    assert zone.quarantine("customers") is None


def small_zone(spark, drop, **feed):
    return DropZone(spark, drop.landing, drop.root, [Feed("landed", **feed)])


ITEMS = "struct<id:string,n:int,value:string,op:string>"


def test_arrivals_over_several_runs(spark, drop, tmp_path):
    zone = small_zone(spark, drop, max_files=1)
    ddl = write_ddl(tmp_path, {"items": ITEMS})
    keys = {"items": ["id"]}
    head = "id,n,value,op"

    drop("d2/items.csv", [head, "a,2,new,", "b,1,x,"], at=2000)
    drop("d1/items.csv", [head, "a,1,old,", "c,3,only here,"], at=1000)
    drop("d1/other.csv", ["h", "1"])
    assert zone.run(ddl, keys) == ["items"]
    got = {r.id: (r.n, r.value) for r in zone.silver("items").collect()}
    assert got == {"a": (2, "new"), "b": (1, "x"), "c": (3, "only here")}
    assert [r.source for r in zone.refresh_alerts()[0].collect()] == ["other_csv"]

    # A late file, a null update, a malformed line and a source nobody described.
    drop("d3/items.csv", [head, "a,,newest,", "broken line"], at=3000)
    drop("d0/items.csv", [head, "b,7,too old,", "d,4,late,"], at=500)
    drop("d3/orders.csv", ["id,total", "o1,5"])
    assert zone.run(ddl, keys) == ["items"]
    got = {r.id: (r.n, r.value) for r in zone.silver("items").collect()}
    assert got == {
        "a": (2, "newest"), "b": (1, "x"), "c": (3, "only here"), "d": (4, "late"),
        "broken line": (None, None),
    }
    held = [(r.fullFilePath.split("/")[-2], r.value) for r in zone.quarantine("items").collect()]
    assert held == [("d3", "broken line")]
    assert sorted(r.source for r in zone.refresh_alerts()[0].collect()) == ["orders_csv", "other_csv"]

    assert zone.declare_silver() == ["items"]
    assert spark.sql("SELECT n FROM items WHERE id = 'd'").first().n == 4

    # Describing the source is all it takes; nothing is read again for the others.
    before = ChangeTable.open(spark, f"{drop.root}/silver/items").applied()
    ddl = write_ddl(tmp_path, {"items": ITEMS, "orders": "struct<id:string,total:int>"})
    assert zone.run(ddl, {**keys, "orders": ["id"]}) == ["items", "orders"]
    assert [tuple(r) for r in zone.silver("orders").collect()] == [("o1", 5)]
    assert ChangeTable.open(spark, f"{drop.root}/silver/items").applied() == before
    assert zone.bronze().count() == 10


def test_deletes_and_dropped_lines(spark, drop, tmp_path):
    zone = small_zone(spark, drop)
    ddl = write_ddl(tmp_path, {"items": ITEMS})
    drop("d1/items.csv", ["h", "a,1,x,", "b,1,x,"], at=1000)
    drop("d2/items.csv", ["h", "a,,,D", "bad"], at=2000)
    options = {
        "delete_when": "op = 'D'", "ignore_null_updates": False, "mode": "drop",
        "except_columns": ["op"],
    }
    zone.run(ddl, {"items": ["id"]}, **options)
    got = zone.silver("items")
    assert got.columns == ["id", "n", "value"]
    assert [tuple(r) for r in got.collect()] == [("b", 1, "x")]
    assert [r.value for r in zone.quarantine("items").collect()] == ["bad"]
    with pytest.raises(ValueError, match="mode"):
        zone.run(ddl, {"items": ["id"]}, mode="shrug")


def test_files_of_several_splits_are_a_batch_together(spark, drop, tmp_path):
    """Bronze has several files of each, and a keyed table takes no smaller batches for that."""
    zone = small_zone(spark, drop, max_files=2)
    for day in range(4):
        drop(f"d{day}/items.csv", ["id,n,value,op", *[f"k{i},{day},v{day},x" for i in range(60)]], at=1000 + day)
    split = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in split}
    for name, value in split.items():
        spark.conf.set(name, value)
    try:
        zone.ingest()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(list((tmp_path / "tables/bronze/landed").rglob("*.parquet"))) > 8
    zone.load_registry(write_ddl(tmp_path, {"items": ITEMS}), {"items": ["id"]})
    zone.refresh_silver()
    batches = [p for p in (tmp_path / "tables/checkpoints/all_silver/landed/commits").iterdir() if p.name.isdigit()]
    assert len(batches) == 2
    got = {(r.id, r.n, r.value) for r in zone.silver("items").collect()}
    assert got == {(f"k{i}", 3, "v3") for i in range(60)}


def test_failfast(spark, drop, tmp_path):
    zone = small_zone(spark, drop)
    drop("d1/items.csv", ["h", "a,1,x,", "bad"])
    with pytest.raises(Exception, match="does not fit its schema"):
        zone.run(write_ddl(tmp_path, {"items": ITEMS}), {"items": ["id"]}, mode="failfast")


@pytest.mark.parametrize("mode", ["permissive", "drop"])
def test_batches_of_which_nothing_is_left(spark, drop, tmp_path, mode):
    zone = small_zone(spark, drop, max_files=1)
    ddl = write_ddl(tmp_path, {"items": "struct<id:string,n:int,at:timestamp>"})
    drop("d1/items.csv", ["h", "short", "shorter"])
    drop("d2/items.csv", ["h", "b,1,", "c,2,"])
    drop("d3/items.csv", ["h", "d,2,2020-01-01T00:00:00Z"])
    zone.run(ddl, {"items": ["id"]}, mode=mode, sequence_by="at")
    assert [r.id for r in zone.silver("items").collect()] == ["d"]
    assert sorted((r.value, r.reason) for r in zone.quarantine("items").collect()) == [
        ("b,1,", "has no sequence"), ("c,2,", "has no sequence"),
        ("short", "does not fit the schema"), ("shorter", "does not fit the schema"),
    ]


def test_a_column_added_to_the_schema(spark, drop, tmp_path):
    zone = small_zone(spark, drop)
    drop("d1/items.csv", ["h", "a,1,x,", "b,2,y,"], at=1000)
    zone.run(write_ddl(tmp_path, {"items": ITEMS}), {"items": ["id"]})
    drop("d2/items.csv", ["h", "a,3,z,,extra"], at=2000)
    zone.run(write_ddl(tmp_path, {"items": ITEMS[:-1] + ",more:string>"}), {"items": ["id"]})
    got = {r.id: (r.n, r.value, r.more) for r in zone.silver("items").collect()}
    assert got == {"a": (3, "z", "extra"), "b": (2, "y", None)}
    assert zone.quarantine("items") is None


def test_lines_with_another_separator(spark, drop, tmp_path):
    zone = small_zone(spark, drop)
    ddl = write_ddl(tmp_path, {"items": ITEMS})
    drop("d1/items.csv", ["h", "a;1;x,y;", "b;2;z;"])
    zone.run(ddl, {"items": ["ID"]}, parse_options={"sep": ";"})
    assert sorted((r.id, r.n, r.value) for r in zone.silver("items").collect()) == [
        ("a", 1, "x,y"), ("b", 2, "z"),
    ]
    assert zone.stage("items", parse_options={"sep": ";"}).count() == 2


def test_history_target(spark, drop, tmp_path):
    zone = small_zone(spark, drop, max_files=1)
    ddl = write_ddl(tmp_path, {"items": ITEMS})
    for i, n in enumerate([1, 1, 2]):
        drop(f"d{i}/items.csv", ["h", f"a,{n},x,"], at=1000 * (i + 1))
    zone.run(ddl, {"items": ["id"]}, scd_type=2)
    at = [dt.datetime.fromtimestamp(s, dt.UTC).replace(tzinfo=None) for s in (1000, 3000)]
    rows = {(r.n, r["__START_AT"], r["__END_AT"]) for r in zone.silver("items").collect()}
    assert rows == {(1, at[0], at[1]), (2, at[1], None)}


def test_a_stream_that_cannot_start_stops_the_others(spark, drop, tmp_path):
    zone = small_zone(spark, drop)
    drop("d1/items.csv", ["h", "a,1,x,"])
    drop("d1/others.csv", ["h", "a,1,x,"])
    ddl = write_ddl(tmp_path, {"items": ITEMS, "others": ITEMS})
    keys = {"items": ["id"], "others": ["id"]}
    zone.run(ddl, keys, only=["others"])
    with pytest.raises(ValueError, match="other rules"):
        zone.run(ddl, keys, ignore_null_updates=False)
    assert spark.streams.active == []


def test_a_crash_between_state_and_checkpoint(spark, drop, tmp_path, monkeypatch):
    zone = small_zone(spark, drop, max_files=1)
    ddl = write_ddl(tmp_path, {"items": ITEMS})
    for i in range(4):
        drop(f"d{i}/items.csv", ["h", f"a,{i},x,", f"b{i},1,y,", "short"], at=1000 + i)
    applied = ChangeTable.apply
    calls = []

    def crash_once(self, *args, **kwargs):
        done = applied(self, *args, **kwargs)
        calls.append(kwargs["batch_id"])
        if calls == [0, 1]:
            raise RuntimeError("driver lost")
        return done

    monkeypatch.setattr(ChangeTable, "apply", crash_once)
    with pytest.raises(Exception, match="driver lost"):
        zone.run(ddl, {"items": ["id"]})
    zone.run(ddl, {"items": ["id"]})
    assert calls == [0, 1, 1, 2, 3]
    got = {r.id: r.n for r in zone.silver("items").collect()}
    assert got == {"a": 3, "b0": 1, "b1": 1, "b2": 1, "b3": 1, "short": None}
    assert zone.quarantine("items").count() == 4


def test_a_lost_checkpoint_applies_everything_again(spark, drop, tmp_path):
    zone = small_zone(spark, drop, max_files=1)
    ddl = write_ddl(tmp_path, {"items": ITEMS})
    for i in range(3):
        drop(f"d{i}/items.csv", ["h", f"a,{i},x,", f"b{i},1,y,"], at=1000 + i)
    zone.run(ddl, {"items": ["id"]})
    drop("d3/items.csv", ["h", "a,9,z,"], at=2000)
    (Path(drop.root) / "checkpoints/all_silver").rename(tmp_path / "lost")
    zone.run(ddl, {"items": ["id"]})
    got = {r.id: r.n for r in zone.silver("items").collect()}
    assert got == {"a": 9, "b0": 1, "b1": 1, "b2": 1}


def test_feeds_side_by_side(spark, drop):
    feeds = [
        Feed("left", folder="l"),
        Feed("right", folder="r", file_type="text", whole_text=True),
        Feed("typed", folder="t", csv_schema="a INT, b STRING", rules=(("/t/(\\w+)/", "t_$1"),)),
    ]
    drop("l/a.csv", ["h", "1", "2"])
    drop("r/a.txt", ["1", "2"])
    drop("t/007/a.csv", ["a,b", "1,x"])
    zone = DropZone(spark, drop.landing, drop.root, feeds)
    zone.ingest()
    assert sorted(r.value for r in zone.bronze("left").collect()) == ["1", "2"]
    assert [r.value for r in zone.bronze("right").collect()] == ["1\n2\n"]
    typed = zone.bronze("typed").first()
    assert (typed.value, typed.data.a, typed.data.b) == ("1,x", 1, "x")
    assert [r.source for r in zone.sources("typed").collect()] == ["t_007"]
    assert {r.datasource for r in zone.bronze("left").collect()} == {f"{drop.landing}/l/"}
    with pytest.raises(ValueError):
        DropZone(spark, drop.landing, drop.root, [Feed("x"), Feed("x")])


def test_small_files_are_merged_on_request(spark, drop):
    for i in range(40):
        drop(f"d{i}/claims.csv", ["h", f"{i}"])
        drop(f"d{i}/payers.csv", ["h", f"{i}"])
    files = {}
    for merge in (False, True):
        root = f"{drop.root}/{merge}"
        zone = DropZone(spark, drop.landing, root, [Feed("landed", merge_small_files=merge)])
        zone.ingest()
        assert zone.bronze().count() == 80
        files[merge] = len(zone.bronze().inputFiles())
    assert files[True] == 2 < files[False]


def test_files_of_many_names_without_a_split(spark, drop):
    for i in range(500):
        drop(f"export-{i}.csv", ["h", f"{i},x"])
    zone = small_zone(spark, drop, split=False)
    zone.ingest()
    bronze = Path(drop.root) / "bronze/landed"
    assert [p.name for p in bronze.iterdir() if p.is_dir()] == ["_spark_metadata"]
    assert zone.bronze().count() == 500
    assert [r.value for r in zone.split("export-7_csv").collect()] == ["7,x"]
    assert zone.sources().count() == 500


def test_a_second_refresh_reads_no_bronze(spark, drop, tmp_path, monkeypatch):
    zone = small_zone(spark, drop)
    ddl, keys = write_ddl(tmp_path, {"items": ITEMS}), {"items": ["id"]}
    drop("d1/items.csv", ["h", "a,1,x,"])
    zone.run(ddl, keys)
    for part in (Path(drop.root) / "bronze/landed").rglob("*.parquet"):
        part.unlink()  # a read of any of them would fail
    assert zone.refresh_silver() == ["items"]
    assert [r.source for r in zone.sources().collect()] == ["items_csv"]
    drop("d2/items.csv", ["h", "b,1,y,"])
    zone.run(ddl, keys)
    assert sorted(r.id for r in zone.silver("items").collect()) == ["a", "b"]


def test_a_table_registered_while_the_stream_runs(spark, drop, tmp_path):
    zone = small_zone(spark, drop)
    drop("d1/items.csv", ["h", "a,1,x,"])
    drop("d1/others.csv", ["h", "o,1,x,"])
    zone.ingest()
    zone.load_registry(write_ddl(tmp_path, {"items": ITEMS}), {"items": ["id"]})
    stream = zone.start_all_silver(every="1 second")
    try:
        stream.processAllAvailable()
        assert [r.id for r in zone.silver("items").collect()] == ["a"]
        zone.load_registry(write_ddl(tmp_path, {"items": ITEMS, "others": ITEMS}), {"items": ["id"], "others": ["id"]})
        drop("d2/items.csv", ["h", "b,2,x,"])
        zone.ingest()
        stream.processAllAvailable()
    finally:
        stream.stop()
    assert sorted(r.id for r in zone.silver("items").collect()) == ["a", "b"]
    assert [r.id for r in zone.silver("others").collect()] == ["o"]


def test_findings_keep_a_table_out(spark, drop, tmp_path):
    """Two entries of one table, and two file names that give one source."""
    zone = small_zone(spark, drop)
    drop("d/a.b.csv", ["h", "a,1,x,"])
    drop("d/a_b.csv", ["h", "b,1,x,"])
    drop("d/twice.csv", ["h", "c,1,x,"])
    drop("d/items.csv", ["h", "d,1,x,"])
    keys = tmp_path / "keys.py"
    keys.write_text('items = ["id"]\na_b = [\n  "id",  # "n"\n]\ntwice = ["id"]\ntwice = ["id"]\n')
    ddl = write_ddl(tmp_path, {"items": ITEMS, "a_b": ITEMS, "twice": ITEMS})
    assert zone.run(ddl, str(keys)) == ["items"]
    _, problems = zone.refresh_alerts()
    assert sorted((r.table_name, r.problem, r.detail) for r in problems.collect()) == [
        ("a_b", "several file names give one source", "a.b.csv, a_b.csv"),
        ("twice", "registered more than once", "2"),
    ]
    assert sorted(p.name for p in (Path(drop.root) / "silver").iterdir()) == ["items"]


@pytest.mark.parametrize("action", ["warn", "drop", "fail"])
def test_expectations_of_a_table(spark, drop, tmp_path, action):
    zone = small_zone(spark, drop)
    ddl, keys = write_ddl(tmp_path, {"items": ITEMS}), {"items": ["id"]}
    drop("d/items.csv", ["h", "a,1,x,", "b,-1,y,", "short"])
    options = {"expectations": {"not negative": "n >= 0", "known": "id <> 'z'"}, "on_violation": action, "mode": "drop"}
    if action == "fail":
        with pytest.raises(Exception, match="'not negative' is broken"):
            zone.run(ddl, keys, **options)
        return
    zone.run(ddl, keys, **options)
    assert sorted(r.id for r in zone.silver("items").collect()) == (["a", "b"] if action == "warn" else ["a"])
    assert sorted((r.value, r.reason) for r in zone.quarantine("items").collect()) == [
        ("b,-1,y,", "breaks: not negative"), ("short", "does not fit the schema"),
    ]
    with pytest.raises(ValueError, match="on_violation"):
        zone.run(ddl, keys, on_violation="shrug")


def test_published_tables(spark, drop, tmp_path):
    zone = small_zone(spark, drop)
    drop("d/my-items.csv", ["h", "a,1,x,"])
    ddl, keys = write_ddl(tmp_path, {"my-items": ITEMS}), {"my-items": ["id"]}
    zone.run(ddl, keys)
    names = ["my_items", "my_items_stage"]
    try:
        assert zone.publish("my-items", comment="first", properties={"quality": "silver", "pii": "no"}) == names[0]
        assert zone.publish("my-items", staged=True, comment="typed") == names[1]
        drop("d/2/my-items.csv", ["h", "b,2,y,"])
        zone.run(ddl, keys)
        zone.publish("my-items", comment="it's the second", properties={"quality": "gold"})
        assert spark.table("my_items").count() == 2
        assert spark.table("my_items_stage").select("id", "n").first() == ("a", 1)
        assert spark.catalog.getTable("my_items").description == "it's the second"
        properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES my_items").collect()}
        assert (properties["quality"], properties["pii"]) == ("gold", "no")
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_feed_named_with_a_dash(spark, drop):
    zone = DropZone(spark, drop.landing, drop.root, [Feed("all-files")])
    drop("d/claims.csv", ["h", "1"])
    zone.ingest()
    assert zone.declare_bronze() == ["claims_csv_bronze"]
    assert spark.table("all_files").count() == 1
    spark.sql("DROP TABLE all_files")


def test_catalog_names(spark, drop):
    zone = DropZone(
        spark, drop.landing, drop.root,
        [Feed("all_landed", comment="every line's home", properties={"quality": "bronze", "pii": True})],
    )
    drop("d/claims.csv", ["h", "1"])
    drop("d/payers.csv", ["h", "2", "3"])
    zone.ingest()
    assert zone.declare_bronze() == ["claims_csv_bronze", "payers_csv_bronze"]
    try:
        assert spark.table("all_landed").count() == 3
        assert spark.table("payers_csv_bronze").count() == 2
        assert spark.catalog.getTable("all_landed").description == "every line's home"
        properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES all_landed").collect()}
        assert properties["quality"] == "bronze" and properties["pii"] == "True"
    finally:
        spark.sql("DROP TABLE IF EXISTS all_landed")


def test_reading_one_source_reads_its_folder_only(spark, drop):
    drop("d/claims.csv", ["h", "1"])
    drop("d/payers.csv", ["h", "2"])
    zone = small_zone(spark, drop)
    zone.ingest()
    split = zone.split("claims_csv")
    assert [r.value for r in split.collect()] == ["1"]
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*source.*claims_csv", plan)
    assert all("source=claims_csv" in r[0] for r in split.selectExpr("_metadata.file_path").collect())


@pytest.mark.parametrize("merge", [False, True])
def test_of_lines_of_one_time_the_last_counts(spark, drop, tmp_path, merge):
    """Several lines a key in a file, over many splits; files of one time go by their path."""
    import random

    rng = random.Random(3)
    keys = [rng.randrange(40) for _ in range(3000)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        for name, at in [("b/items.csv", 1000), ("a/items.csv", 1000), ("old/items.csv", 500)]:
            lines = ["k,n", *(f"{k},{name[0]}{i}" for i, k in enumerate(keys))]
            drop(name, lines, at)
        # A key that stands in the older file and in the lesser path only.
        drop("old/z/items.csv", ["k,n", "77,first", "77,last"], 500)
        drop("a/z/items.csv", ["k,n", "78,2", "78,10", "78,1"], 1000)
        feed = Feed("all", merge_small_files=merge)
        zone = DropZone(spark, drop.landing, drop.root, [feed])
        ddl = tmp_path / "ddl"
        ddl.mkdir()
        (ddl / "items.ddl").write_text("struct<k:int,n:string>")
        zone.run(str(ddl), {"items": ["k"]})
        splits = {r.fileMetadata.file_block_start for r in zone.bronze().select("fileMetadata").collect()}
        assert len(splits) > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {k: f"b{i}" for i, k in enumerate(keys)} | {77: "last", 78: "1"}
    assert {r.k: r.n for r in zone.silver("items").collect()} == want
    assert zone.bronze().columns == list(ENVELOPE)
    assert zone.split("items_csv").columns == list(ENVELOPE)


@pytest.mark.parametrize("splits", ["256", "1m"])
def test_line_breaks_between_quotes(spark, drop, tmp_path, splits):
    """Records over many lines and many splits, blank lines in them, and a file with an odd quote."""
    import csv
    import io
    import random

    rng = random.Random(8)

    def text(rows):
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(rows)
        return out.getvalue()

    words = ["a", 'say "no"', "x,y", "\n", "\n\n", "line\nbreak", "", "z" * 100, '""', "end\n"]
    rows = [(i, "".join(rng.choice(words) for _ in range(rng.randrange(6))), i % 7) for i in range(200)]
    drop("one/notes.csv", [text([("k", "note\nhead", "n"), *rows[:120]]).rstrip("\n")])
    drop("two/notes.csv", ["", text([("k", "note", "n"), *rows[120:]]).rstrip("\n"), ""])
    drop("odd/notes.csv", ["k,note,n", '900,5" pipe,1', "901,whole,2"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", splits)
    try:
        zone = DropZone(spark, drop.landing, drop.root, [Feed("all", quoted_lines=True, max_files=1)])
        zone.run(write_ddl(tmp_path, {"notes": "struct<k:int,note:string,n:int>"}), {"notes": ["k"]}, parse_options={"escape": '"'})
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {r.k: (r.note or "", r.n) for r in zone.silver("notes").collect() if r.k is not None}
    assert got.pop(900)[0].startswith("5") and got.pop(901) == ("whole", 2)
    assert got == {k: (note, n) for k, note, n in rows}
    with pytest.raises(ValueError, match="quoted_lines"):
        Feed("x", quoted_lines=True, skip_rows=1).read(spark, drop.landing)
