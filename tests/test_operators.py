from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from landfold import (
    build_registry,
    expect,
    explode_arrays,
    flatten,
    flatten_and_explode,
    landed_sources,
    load_ddl,
    load_keys,
    match_source,
    parse_lines,
    quarantined,
    read_lines,
    registry_problems,
    source_name,
    split_source,
    stage,
    to_bronze,
    unknown_sources,
    violations,
    with_source,
)
from landfold.functions.names import table_of_source
from landfold.operators.stage import CORRUPT, LINE_ID, SEQUENCE

#: With a column named as bronze's own line is.
READINGS = "struct<taken:timestamp,device:string,room:string,note:string,value:string,unit:string>"


def test_source_names(spark):
    df = spark.createDataFrame(
        [("/in/a/claims.csv", "claims.csv"), ("/in/click/part-0.csv", "part-0.csv"), ("/in/v2/x", "x")],
        "path STRING, name STRING",
    )
    rules = [("/click/", "clicks"), (r"/v(\d+)/", "version_$1"), ("/in/", "other")]
    got = df.select(
        source_name(F.col("name")).alias("plain"),
        match_source(F.col("path"), F.col("name"), rules[:2]).alias("ruled"),
        match_source(F.col("path"), F.col("name"), rules).alias("first_wins"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("claims_csv", "claims_csv", "other"), ("part-0_csv", "clicks", "clicks"),
        ("x", "version_2", "version_2"),
    ]
    tables = spark.createDataFrame([("claims_csv",), ("claims",)], "s STRING")
    assert [r[0] for r in tables.select(table_of_source(F.col("s"))).collect()] == ["claims", "claims"]


def test_split_by_source(spark, drop):
    drop("d1/claims.csv", ["h", "1", "2"])
    drop("d2/claims.csv", ["h", "3"])
    drop("d2/payers.csv", ["h", "4"])
    bronze = to_bronze(read_lines(spark, drop.landing, streaming=False), drop.landing)
    routed = with_source(bronze)
    assert sorted(tuple(r) for r in landed_sources(bronze).collect()) == [
        ("claims.csv", "claims_csv"), ("payers.csv", "payers_csv"),
    ]
    claims = split_source(routed, "claims_csv")
    assert claims.columns == bronze.columns
    assert sorted(r.value for r in claims.collect()) == ["1", "2", "3"]


# Lines that tempt a parser, and whether they fit the schema.
LINES = [
    ('2020-01-02T03:04:05Z,t1,hall,"warm, dry",21.5,C', True),
    ('"2020-01-02T03:04:05Z",t2,hall,a~b,21.0,C', True),
    ('"x,y"', False),
    ("  lead space,1", False),
    ("bad,t4", False),
    ("2020-01-02T03:04:05Z,t5,,,,", True),
    ("not a time,t6,hall,n,1,C", False),
    ("2020-01-02T03:04:05Z,t7,hall,n,1,C,too,many", False),
]


def readings_bronze(spark, drop):
    drop("a/readings.csv", ["a,header", *[line for line, _ in LINES], ""], at=1_600_000_000)
    return to_bronze(read_lines(spark, drop.landing, streaming=False), drop.landing)


def test_stage_keeps_declared_columns_apart_from_the_envelope(spark, drop):
    rows = stage(readings_bronze(spark, drop), READINGS)
    assert rows.columns[:6] == ["taken", "device", "room", "note", "value", "unit"]
    by_device = {r.device: r for r in rows.collect()}
    assert by_device["t1"].value == "21.5"
    assert by_device["t1"].note == "warm, dry"
    assert by_device["t2"].note == "a~b"
    assert by_device["t5"].room is None
    assert by_device["t5"][CORRUPT] is None
    assert by_device["t4"].taken is None
    assert by_device["t4"][CORRUPT] == "bad,t4"
    assert by_device["t1"][SEQUENCE].timestamp() == 1_600_000_000
    assert len({r[LINE_ID] for r in rows.collect()}) == len(LINES)
    assert by_device["t1"]["_bronze"].inputFileName == "readings.csv"


def test_lines_that_do_not_fit(spark, drop):
    bronze = readings_bronze(spark, drop)
    bad = sorted(line for line, fits in LINES if not fits)
    assert sorted(r.value for r in quarantined(bronze, READINGS).collect()) == bad
    assert stage(bronze, READINGS).count() == len(LINES)
    assert stage(bronze, READINGS, mode="drop").count() == len(LINES) - len(bad)
    with pytest.raises(Exception, match="does not fit its schema"):
        stage(bronze, READINGS, mode="failfast").select("device").collect()
    with pytest.raises(ValueError):
        stage(bronze, READINGS, mode="shrug")
    with pytest.raises(ValueError, match="reserved"):
        stage(bronze, "a INT, Sequence_By STRING")


def test_parse_lines_options_and_nulls(spark):
    df = spark.createDataFrame([("1|a",), (None,), ("",)], "value STRING")
    got = [r.data for r in parse_lines(df, "a INT, b STRING", options={"sep": "|"}).collect()]
    assert (got[0].a, got[0].b) == (1, "a")
    assert got[1] is None
    assert (got[2].a, got[2].b) == (None, None)


def test_flatten_one_level(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 2, 'in', named_struct('y', 3)) AS s, named_struct('ID', 9) AS t")
    flat = flatten(df, columns=["s"])
    assert flat.columns == ["id", "t", "x", "in"]
    assert flat.select("x", "in.y").first() == (2, 3)
    replaced = flatten(df).first().asDict()
    assert replaced["ID"] == 9 and "id" not in replaced
    assert flatten(df, columns=["t"], on_collision="prefix").columns == ["id", "s", "t_ID"]
    for wrong in ({"on_collision": "error"}, {"columns": ["id"]}, {"on_collision": "x"}):
        with pytest.raises(ValueError):
            flatten(df, **wrong)


def test_explode(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, array(1, 2), array('a', 'b', 'c')), (2, array(), null) AS t(id, n, s)"
    )
    rows = [tuple(r) for r in explode_arrays(df).collect()]
    assert len(rows) == 7 and (2, None, None) in rows and (1, 2, "c") in rows
    assert explode_arrays(df, columns=["n"]).count() == 3
    both = spark.sql("SELECT named_struct('x', 1) AS s, array(named_struct('y', 2)) AS a")
    assert flatten_and_explode(both).columns == ["a", "x"]


def write_registry(tmp_path, ddl, keys):
    folder = tmp_path / "ddl"
    folder.mkdir()
    for name, text in ddl.items():
        (folder / f"{name}.ddl").write_text(text)
    (folder / "README.txt").write_text("not a schema")
    (tmp_path / "keys.txt").write_text(
        "# natural keys\n" + "".join(f"{t} = {str(k).replace(chr(39), chr(34))}\n" for t, k in keys.items())
    )
    return str(folder), str(tmp_path / "keys.txt")


def test_registry(spark, tmp_path):
    ddl, keys = write_registry(
        tmp_path,
        {
            "good": "struct<a:int,B:string>\n", "listed": "a int, b string", "unkeyed": "struct<a:int>",
            "odd_key": "struct<a:int>", "broken": "struct<a:nonsense", "absent": "struct<a:int>",
        },
        {
            "good": ["a", "b"], "listed": ["a"], "odd_key": ["a", "zz"], "broken": ["a"],
            "absent": ["a"], "only_key": ["x"],
        },
    )
    registry = build_registry(load_ddl(spark, ddl), load_keys(spark, keys))
    rows = {r.table_name: r for r in registry.collect()}
    assert set(rows) == {"good", "listed", "unkeyed", "odd_key", "broken", "absent", "only_key"}
    assert rows["good"].ddl == "struct<a:int,B:string>\n" and rows["good"]["keys"] == ["a", "b"]
    assert rows["good"].size == 23 and rows["good"].path.endswith("good.ddl")
    landed = spark.createDataFrame(
        [(f"{t}_csv",) for t in ("good", "listed", "unkeyed", "odd_key", "broken", "new")], "source STRING"
    )
    found = {(r.table_name, r.problem) for r in registry_problems(registry, landed).collect()}
    assert found == {
        ("unkeyed", "no keys"), ("odd_key", "keys are not columns"), ("broken", "schema cannot be parsed"),
        ("only_key", "no schema"), ("absent", "no file has landed"),
    }
    assert [tuple(r) for r in unknown_sources(landed, registry).collect()] == [("new_csv", "new")]
    same = load_keys(spark, {"good": ["a", "b"]}).first()
    assert same["keys"] == ["a", "b"]


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (-1, "b"), (None, None)], "n INT, s STRING")
    rules = {"positive": "n > 0", "named": F.col("s").isNotNull()}
    seen = Observation()
    assert expect(df, rules, observe=seen).count() == 3
    assert seen.get == {"rows": 3, "positive": 2, "named": 1}
    assert [r.n for r in expect(df, rules, action="drop").collect()] == [1]
    assert expect(df, {}, action="drop").count() == 3
    assert {r.n: r.broken for r in violations(df, rules).collect()} == {
        -1: ["positive"], None: ["positive", "named"],
    }
    with pytest.raises(Exception, match="'positive' is broken"):
        expect(df, rules, action="fail").collect()
    assert expect(df.limit(1), rules, action="fail").count() == 1
    with pytest.raises(ValueError):
        expect(df, rules, action="ignore")


def test_transforms_work_on_streams(spark, drop):
    drop("d/items.csv", ["h", "1,a", "2,b", "bad"])
    rows = stage(to_bronze(read_lines(spark, drop.landing), "x"), "n INT, s STRING", mode="drop")
    rows = rows.select(F.struct("n", "s").alias("r"), F.array(F.lit(1), F.lit(2)).alias("a"))
    rows = expect(flatten_and_explode(rows), {"n over one": "n > 1"}, action="drop", observe="rules")
    query = rows.writeStream.format("memory").queryName("transformed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("transformed").select("n", "s", "a").collect()) == [
        (2, "b", 1), (2, "b", 2),
    ]
    counted = [p["observedMetrics"]["rules"] for p in query.recentProgress if "rules" in p["observedMetrics"]]
    assert [(m["rows"], m["n over one"]) for m in counted] == [(4, 2)]
