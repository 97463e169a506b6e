"""Queries that show each operator on whole tables, with the SQL each must equal.

Where an operator reads files, the table is first written as files to the shared
folder, the way a sender would drop it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landfold.functions.structs import explode_arrays, flatten
from landfold.operators.bronze import landed_sources, split_source, to_bronze, with_source
from landfold.operators.changes import ChangeRules, apply_changes
from landfold.operators.expectations import expect, violations
from landfold.operators.history import apply_changes_history
from landfold.operators.registry import build_registry, load_keys, unknown_sources
from landfold.operators.stage import parse_lines, stage
from landfold.plans.dropzone import DropZone, Feed
from landfold.sources.files import list_files, read_lines
from landfold.sources.tables import read_table
from landfold.streaming.change_table import ChangeTable
from landfold.streaming.flows import append, apply_stream, await_all
from landfold.streaming.folder import Folder
from landfold.workspace import materialise, work_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

EVENTS_DDL = (
    "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>"
)
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
ORDERS_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
#: Events land in one folder per type; the folder names the source.
BY_TYPE = ((r"/kind=([^/]+)/", "$1_csv"),)
#: The same files taken as one source, whatever their folder.
AS_EVENTS = ((r"/", "events_csv"),)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- what a sender does --------------------------------------------------------

_LANDED: dict[tuple[str, str, str], str] = {}


def _landed(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    """Folder with the files of a table; written once per session, as it is only input."""
    key = (spark.sparkContext.applicationId, sf, name)
    path = _LANDED.get(key)
    if path is None or not Folder(spark, path).exists():
        path = work_folder(spark, f"landing-{name}")
        write(path)
        _LANDED[key] = path
    return path


def _event_lines(spark: SparkSession, sf: str) -> DataFrame:
    # The CSV writer would cut timestamps to milliseconds, their text is exact.
    return _as_text(table(spark, sf, "events").select(*EVENT_COLUMNS))


def land_events(spark: SparkSession, sf: str) -> str:
    """Events as CSV files with headers, in one folder per event type."""

    def write(path: str) -> None:
        lines = _event_lines(spark, sf).withColumn("kind", F.col("event_type"))
        lines.write.partitionBy("kind").option("header", True).csv(path)

    return _landed(spark, sf, "events", write)


_ORDER_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
)


def _as_text(rows: DataFrame) -> DataFrame:
    """Timestamps as the text that SQL has for them, not as the CSV writer's."""
    stamps = {f.name for f in rows.schema.fields if f.dataType.typeName().startswith("timestamp")}
    return rows.select(*[F.col(c).cast("string").alias(c) if c in stamps else c for c in rows.columns])


def land_orders(spark: SparkSession, sf: str) -> str:
    """Orders, all columns of them, as eight CSV files without quotes."""

    def write(path: str) -> None:
        orders = _as_text(table(spark, sf, "orders").select(*_ORDER_COLUMNS))
        orders.repartition(8, "o_orderkey").write.option("header", True).csv(path)

    return _landed(spark, sf, "orders", write)


def _quarter_of_files(spark: SparkSession, landing: str) -> int:
    """A file limit that makes about four batches, however many files there are."""
    files = list_files(spark, landing).where(F.endswith("inputFileName", F.lit(".csv"))).count()
    return max(1, math.ceil(files / 4))


def _zone(spark: SparkSession, name: str, landing: str, *feeds: Feed) -> DropZone:
    return DropZone(spark, landing, work_folder(spark, name), feeds)


# --- sources -------------------------------------------------------------------

_ORDER_LINES = (
    "SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)"
    " AS value FROM orders"
)


@query("ingest_lines", _ORDER_LINES)
def ingest_lines(spark: SparkSession, sf: str) -> DataFrame:
    zone = _zone(spark, "ingest-lines", land_orders(spark, sf), Feed("orders"))
    zone.ingest()
    return zone.bronze().select("value")


@query(
    "ingest_rate_limited",
    f"SELECT value, limited_by, batches FROM ({_ORDER_LINES}),"
    " (VALUES ('files', 4), ('bytes', 8)) AS limits(limited_by, batches)",
)
def ingest_rate_limited(spark: SparkSession, sf: str) -> DataFrame:
    """Eight files, two at a time or a byte at a time; how many batches that makes."""
    landing = land_orders(spark, sf)
    limits = {"files": {"max_files": 2}, "bytes": {"max_files": None, "max_bytes": 1}}
    zone = _zone(spark, "ingest-rate-limited", landing, *[Feed(t, **limit) for t, limit in limits.items()])
    zone.ingest()
    parts = []
    for t in limits:
        batches = zone.bronze(t).agg(F.count_distinct("ingestTime").cast("int")).first()[0]
        parts.append(
            zone.bronze(t).select("value", F.lit(t).alias("limited_by"), F.lit(batches).alias("batches"))
        )
    return reduce(DataFrame.unionByName, parts)


@query(
    "ingest_unsplit",
    "SELECT event_type || '_csv' AS source, event_id, ts, user_id, event_type, value, props FROM events",
)
def ingest_unsplit(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze in one folder, whatever its sources; a source is still told from the others."""
    zone = _zone(spark, "ingest-unsplit", land_events(spark, sf), Feed("events", rules=BY_TYPE, split=False))
    zone.ingest()
    kinds = [r.source for r in zone.sources().select("source").distinct().collect()]
    parts = [
        stage(zone.split(kind), EVENTS_DDL).select(F.lit(kind).alias("source"), *EVENT_COLUMNS) for kind in kinds
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "ingest_skip_rows",
    "SELECT concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) AS value FROM customer",
)
def ingest_skip_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Files with two lines of preamble, a blank line and a header."""

    def write(path: str) -> None:
        customer = table(spark, sf, "customer")
        line = F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        head = "exported by billing\nconfidential\n\nkey,name,nation,balance,segment\n"
        # A text writer puts the head before the first line of each of its tasks.
        first = F.monotonically_increasing_id() % F.lit(1 << 33) == 0
        customer.select(
            F.concat(F.when(first, F.lit(head)).otherwise(F.lit("")), line).alias("value")
        ).write.text(path)

    landing = _landed(spark, sf, "customer-preamble", write)
    zone = _zone(spark, "ingest-skip-rows", landing, Feed("customer", skip_rows=2))
    zone.ingest()
    return zone.bronze().select("value")


@query("ingest_quoted_lines", "SELECT doc_id, coalesce(text, '') AS text, lang, source, n_chars FROM documents")
def ingest_quoted_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in CSV files, their line breaks between quotes, landed line by line."""

    def write(path: str) -> None:
        documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
        kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        documents.write.options(header=True, quoteAll=True, escape='"', **kept).csv(path)

    landing = _landed(spark, sf, "documents-quoted", write)
    zone = _zone(
        spark, "quoted-lines", landing, Feed("texts", quoted_lines=True, rules=((r"/[^/]+$", "documents_csv"),))
    )
    zone.ingest()
    ddl = "struct<doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint>"
    Folder(spark, f"{zone.root}/ddl").publish("documents.ddl", ddl)
    zone.load_registry(f"{zone.root}/ddl", {"documents": ["doc_id"]})
    staged = zone.stage("documents", parse_options={"escape": '"'})
    return staged.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source", "n_chars")


@query(
    "ingest_whole_text",
    "SELECT bucket, length(v) AS n, md5(v) AS digest FROM (SELECT page_id // 100 AS bucket,"
    " string_agg(html || chr(10), '' ORDER BY page_id) AS v FROM pages GROUP BY 1)",
)
def ingest_whole_text(spark: SparkSession, sf: str) -> DataFrame:
    """One row per file; each file holds a hundred pages, newlines and all."""

    def write(path: str) -> None:
        pages = table(spark, sf, "pages").select(
            F.expr("page_id div 100").alias("bucket"), "page_id", "html"
        )
        pages.repartition("bucket").sortWithinPartitions("bucket", "page_id").select(
            "bucket", F.col("html").alias("value")
        ).write.partitionBy("bucket").text(path)

    landing = _landed(spark, sf, "pages", write)
    feed = Feed("pages", file_type="text", whole_text=True, rules=((r"/bucket=(\d+)/", "$1"),))
    zone = _zone(spark, "ingest-whole-text", landing, feed)
    zone.ingest()
    return zone._routed(feed).select(
        F.col("source").cast("bigint").alias("bucket"),
        F.length("value").cast("bigint").alias("n"),
        F.md5(F.encode("value", "utf-8")).alias("digest"),
    )


@query("ingest_text_lines", "SELECT doc_id, text FROM documents")
def ingest_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as one JSON text per line, with no header."""

    def write(path: str) -> None:
        documents = table(spark, sf, "documents")
        documents.select(F.to_json(F.struct("doc_id", "text")).alias("value")).write.text(path)

    landing = _landed(spark, sf, "documents", write)
    zone = _zone(spark, "ingest-text-lines", landing, Feed("documents", file_type="text"))
    zone.ingest()
    parsed = F.from_json("value", "doc_id BIGINT, text STRING")
    return zone.bronze().select(parsed.alias("d")).select("d.*")


@query(
    "ingest_typed_csv",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def ingest_typed_csv(spark: SparkSession, sf: str) -> DataFrame:
    def write(path: str) -> None:
        table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string")).write.option(
            "header", True
        ).option("sep", ";").csv(path)

    landing = _landed(spark, sf, "orders-typed", write)
    zone = _zone(spark, "ingest-typed", landing, Feed("orders", csv_schema=ORDERS_DDL, delimiter=";"))
    zone.ingest()
    return zone.bronze().select("data.*")


@query("ingest_folders", "SELECT event_type AS folder, count(*) AS n FROM events GROUP BY 1")
def ingest_folders(spark: SparkSession, sf: str) -> DataFrame:
    """One bronze table per folder, all ingested side by side."""
    landing = land_events(spark, sf)
    kinds = [n for n in Folder(spark, landing).names() if n.startswith("kind=")]
    zone = _zone(spark, "ingest-folders", landing, *[Feed(k.split("=")[1], folder=k) for k in kinds])
    zone.ingest()
    counts = [
        zone.bronze(t).groupBy(F.lit(t).alias("folder")).agg(F.count(F.lit(1)).alias("n")) for t in zone.feeds
    ]
    return reduce(DataFrame.unionByName, counts)


@query("append_flows", "SELECT event_id, event_type FROM events")
def append_flows(spark: SparkSession, sf: str) -> DataFrame:
    """Two flows feed one table: one for errors, one for everything else."""
    landing = land_events(spark, sf)
    root = work_folder(spark, "append-flows")
    lines = stage(to_bronze(read_lines(spark, landing), landing), EVENTS_DDL).select("event_id", "event_type")
    flows = {"errors": F.col("event_type") == "error", "others": F.col("event_type") != "error"}
    await_all(
        [
            append(lines.where(cond), f"{root}/events", f"{root}/checkpoints/{flow}", flow=flow)
            for flow, cond in flows.items()
        ]
    )
    return read_table(spark, f"{root}/events")


# --- bronze --------------------------------------------------------------------


def _bronze_by_type(spark: SparkSession, sf: str, name: str) -> DropZone:
    zone = _zone(spark, name, land_events(spark, sf), Feed("events", rules=BY_TYPE))
    zone.ingest()
    return zone


@query("landed_sources", "SELECT DISTINCT event_type || '_csv' AS source FROM events")
def landed(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_by_type(spark, sf, "landed-sources").sources().select("source").distinct()


@query("landed_files", "SELECT DISTINCT event_type AS folder FROM events")
def landed_files(spark: SparkSession, sf: str) -> DataFrame:
    """From a listing of the folder alone, without reading a line."""
    files = list_files(spark, land_events(spark, sf))
    return (
        files.where(F.endswith("inputFileName", F.lit(".csv")))
        .select(F.regexp_extract("path", r"/kind=([^/]+)/", 1).alias("folder"))
        .distinct()
    )


@query(
    "route_sources",
    "SELECT event_type || '_csv' AS source, count(*) AS n,"
    " CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1",
)
def route_sources(spark: SparkSession, sf: str) -> DataFrame:
    zone = _bronze_by_type(spark, sf, "route-sources")
    rows = parse_lines(zone._routed(zone.feeds["events"]), EVENTS_DDL)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("data.value") * 100).cast("bigint")).alias("cents"),
    )


@query(
    "declared_table",
    "SELECT event_type || '_csv' AS source, 'purchase events' AS comment, 'bronze' AS quality, count(*) AS n"
    " FROM events GROUP BY 1",
)
def declared_table(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze by its name in the catalog, with its comment and properties."""
    name = f"events_{uuid.uuid4().hex[:12]}"
    feed = Feed(name, rules=BY_TYPE, comment="purchase events", properties={"quality": "bronze"})
    zone = _zone(spark, "declared-table", land_events(spark, sf), feed)
    zone.ingest()
    zone.declare_bronze()
    comment, quality, rows = _catalogued(spark, name)
    return rows.groupBy("source", F.lit(comment).alias("comment"), F.lit(quality).alias("quality")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _catalogued(spark: SparkSession, name: str) -> tuple[str, str, DataFrame]:
    """Comment, quality and rows of a table; its name is dropped again, not its files."""
    comment = spark.catalog.getTable(name).description
    quality = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES `{name}`").collect()}["quality"]
    rows = spark.table(name)
    spark.sql(f"DROP TABLE `{name}`")
    return comment, quality, rows


_BY_NAME = ("events", "orders")


def _land_by_name(spark: SparkSession, sf: str) -> str:
    """Files that all have their table's name, each in a folder of its own."""

    def write(path: str) -> None:
        for name in _BY_NAME:
            rows = _as_text(table(spark, sf, name))
            rows.repartition(3, rows.columns[0]).write.option("header", True).csv(f"{path}/_{name}")
            files = Folder(spark, path)
            parts = [n for n in files.names(f"_{name}") if n.startswith("part-")]
            for i, part in enumerate(parts):
                files.move(f"_{name}/{part}", f"day{i}/{name}.csv", at=1_700_000_000 + 86_400 * i)
            files.delete(f"_{name}")

    return _landed(spark, sf, "by-name", write)


@query(
    "route_by_file_name",
    "SELECT 'events.csv' AS file, 'events_csv' AS source, 3 AS files, count(*) AS n, sum(event_id)::BIGINT AS keys"
    " FROM events UNION ALL SELECT 'orders.csv', 'orders_csv', 3, count(*), sum(o_orderkey)::BIGINT FROM orders",
)
def route_by_file_name(spark: SparkSession, sf: str) -> DataFrame:
    """No rules: files of one name, in whatever folder, are one source."""
    zone = _zone(spark, "route-by-name", _land_by_name(spark, sf), Feed("landed"))
    zone.ingest()
    named = zone.sources().select(F.col("inputFileName").alias("file"), "source")
    lines = zone._routed(zone.feeds["landed"]).groupBy("source").agg(
        F.count_distinct("fullFilePath").cast("int").alias("files"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.split_part("value", F.lit(","), F.lit(1)).cast("bigint")).alias("keys"),
    )
    return named.join(lines, "source")


@query("split_source", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def split(spark: SparkSession, sf: str) -> DataFrame:
    """One source out of bronze, streamed on to a table of its own."""
    zone = _bronze_by_type(spark, sf, "split-source")
    routed = zone._routed(zone.feeds["events"], streaming=True)
    own = f"{zone.root}/purchase_csv_bronze"
    append(
        split_source(routed, "purchase_csv"), own, f"{zone.root}/checkpoints/purchase_flow"
    ).awaitTermination()
    return stage(read_table(spark, own), EVENTS_DDL).select("event_id", "user_id", "value")


# --- registry ------------------------------------------------------------------


@query(
    "unknown_sources",
    "SELECT DISTINCT event_type || '_csv' AS source, event_type AS table_name FROM events"
    " WHERE event_type NOT IN ('click', 'view')",
)
def unknown(spark: SparkSession, sf: str) -> DataFrame:
    bronze = _bronze_by_type(spark, sf, "unknown-sources").bronze()
    known = spark.createDataFrame([(t, EVENTS_DDL) for t in ("click", "view")], "table_name STRING, ddl STRING")
    registry = build_registry(known, load_keys(spark, {t: ["user_id"] for t in ("click", "view")}))
    return unknown_sources(landed_sources(with_source(bronze, BY_TYPE)), registry)


def _land_star(spark: SparkSession, sf: str) -> str:
    """Small tables as CSV files, in one folder per table."""

    def write(path: str) -> None:
        for name in ("region", "nation", "customer", "part", "supplier"):
            table(spark, sf, name).write.option("header", True).csv(f"{path}/{name}")

    return _landed(spark, sf, "star", write)


@query(
    "registry_coverage",
    """
    SELECT 'region' AS table_name, 'ok' AS status, 2 AS n_columns, count(*) AS n_lines FROM region
    UNION ALL SELECT 'nation', 'keys are not columns', 3, count(*) FROM nation
    UNION ALL SELECT 'customer', 'ok', 5, count(*) FROM customer
    UNION ALL SELECT 'part', 'no keys', 6, count(*) FROM part
    UNION ALL SELECT 'supplier', 'unknown', NULL, count(*) FROM supplier
    UNION ALL SELECT 'orders', 'no file has landed', 6, NULL
    UNION ALL SELECT 'lineitem', 'schema cannot be parsed', NULL, NULL
    UNION ALL SELECT 'events', 'no schema', NULL, NULL
    """,
)
def registry_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Registry files made from the tables' schemas, held against what has landed."""
    zone = _zone(spark, "registry-coverage", _land_star(spark, sf), Feed("star", rules=((r"/(\w+)/[^/]+\.csv$", "$1_csv"),)))
    zone.ingest()

    ddl_folder = f"{zone.root}/ddl"
    for name in ("region", "nation", "customer", "part", "orders"):
        Folder(spark, ddl_folder).publish(f"{name}.ddl", table(spark, sf, name).schema.simpleString())
    Folder(spark, ddl_folder).publish("lineitem.ddl", "struct<l_orderkey:>")
    Folder(spark, zone.root).publish(
        "keys.py",
        """# natural keys, by table
region = ["r_regionkey"]
nation = [
    "n_nation",  # not one of its columns
]
customer = ['c_custkey']
orders = ["o_orderkey"]
lineitem = ["l_orderkey",
            "l_linenumber"]
events = ["event_id"]
""",
    )
    zone.load_registry(ddl_folder, f"{zone.root}/keys.py")
    unknown_rows, problems = zone.refresh_alerts()
    lines = (
        zone._routed(zone.feeds["star"])
        .groupBy(F.regexp_replace("source", "_csv$", "").alias("table_name"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    known = zone.registry().select(
        "table_name",
        F.when(~F.contains("ddl", F.lit(":>")), F.size(F.split("ddl", ":"))).cast("int").alias("columns_and_one"),
    )
    # A table that has never landed may have other findings as well; one of them tells.
    first = problems.groupBy("table_name").agg(
        F.max_by("problem", F.col("problem") != "no file has landed").alias("status")
    )
    found = unknown_rows.select("table_name", F.lit("unknown").alias("status")).unionByName(first)
    return (
        known.join(lines, "table_name", "full_outer")
        .join(found, "table_name", "left")
        .select(
            "table_name",
            F.coalesce("status", F.lit("ok")).alias("status"),
            (F.col("columns_and_one") - 1).alias("n_columns"),
            "n_lines",
        )
    )


# --- stage ---------------------------------------------------------------------


@query("parse_lines", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = _event_lines(spark, sf).select(F.to_csv(F.struct(*EVENT_COLUMNS)).alias("value"))
    return parse_lines(lines, EVENTS_DDL).select(*[f"data.{c}" for c in EVENT_COLUMNS])


@query("stage_rows", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stage_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A declared column named ``value`` next to bronze's own, through files."""
    zone = _bronze_by_type(spark, sf, "stage-rows")
    return stage(zone.bronze(), EVENTS_DDL).select(*EVENT_COLUMNS)


@query(
    "quarantine",
    "SELECT event_id, CASE WHEN props LIKE '%7}' THEN event_id || ',' || user_id || ',' || event_type END AS line,"
    " CASE WHEN props LIKE '%7}' THEN 'does not fit the schema' ELSE 'kept' END AS reason FROM events",
)
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that lost some of their fields, told from those that are whole."""

    def write(path: str) -> None:
        line = F.to_csv(F.struct(*EVENT_COLUMNS))
        cut = F.concat_ws(",", "event_id", "user_id", "event_type")
        _event_lines(spark, sf).select(
            F.when(F.col("props").like("%7}"), cut).otherwise(line).alias("value")
        ).write.text(path)

    landing = _landed(spark, sf, "events-cut", write)
    zone = _zone(spark, "quarantine", landing, Feed("events", header=False, rules=AS_EVENTS))
    zone.ingest()
    _load_events_registry(zone)
    zone.refresh_silver(mode="permissive", **_PICK)
    aside = zone.quarantine("events")
    kept = stage(zone.bronze(), EVENTS_DDL, mode="drop").select(
        "event_id", F.lit(None).cast("string").alias("line"), F.lit("kept").alias("reason")
    )
    if aside is None:
        return kept
    return kept.unionByName(
        aside.select(
            F.split_part("value", F.lit(","), F.lit(1)).cast("bigint").alias("event_id"),
            F.col("value").alias("line"),
            "reason",
        )
    )


@query("flatten_struct", "SELECT o_orderkey, o_orderstatus, o_custkey, o_totalprice FROM orders")
def flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    nested = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.struct("o_custkey", "o_totalprice").alias("payment")
    )
    return flatten(nested)


@query("explode_arrays", "SELECT vec_id, label, unnest(embedding) AS embedding FROM embeddings")
def explode(spark: SparkSession, sf: str) -> DataFrame:
    return explode_arrays(table(spark, sf, "embeddings")).select("vec_id", "label", "embedding")


@query(
    "explode_empty",
    "SELECT user_id, event_id, NULL AS tag FROM events WHERE event_type NOT IN ('error', 'view')"
    " UNION ALL SELECT user_id, event_id, unnest(['a', 'b']) FROM events WHERE event_type = 'error'"
    " UNION ALL SELECT user_id, event_id, NULL FROM events WHERE event_type = 'view'",
)
def explode_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Empty and null arrays keep their row."""
    tags = (
        F.when(F.col("event_type") == "error", F.array(F.lit("a"), F.lit("b")))
        .when(F.col("event_type") != "view", F.array().cast("array<string>"))
    )
    return explode_arrays(table(spark, sf, "events").select("user_id", "event_id", tags.alias("tag")))


# --- keyed targets -------------------------------------------------------------

_LATEST = (
    "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,"
    " arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id"
)


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")


_EVENT_ORDER = ("ts", "event_id")
_PICK = {"columns": ["event_type", "value"]}


def _load_events_registry(zone: DropZone) -> None:
    Folder(zone.spark, f"{zone.root}/ddl").publish("events.ddl", EVENTS_DDL)
    zone.load_registry(f"{zone.root}/ddl", {"events": ["user_id"]})


@query("drop_to_silver", _LATEST)
def drop_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Dropped files to bronze to a keyed table, every step of the way."""
    zone = _zone(spark, "drop-to-silver", land_events(spark, sf), Feed("events", rules=AS_EVENTS))
    zone.ingest()
    _load_events_registry(zone)
    zone.refresh_silver(sequence_by=_EVENT_ORDER, **_PICK)
    return zone.silver("events")


@query("scd1_latest", _LATEST)
def scd1_latest(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes(_changes(spark, sf), ["user_id"], _EVENT_ORDER, **_PICK)


_DELETED = (
    "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,"
    " arg_max(value, (ts, event_id)) AS value FROM (SELECT *, max(ts) FILTER (WHERE event_type = 'error')"
    " OVER (PARTITION BY user_id) AS gone FROM events) WHERE gone IS NULL OR ts > gone GROUP BY user_id"
)


def _silver(spark: SparkSession, sf: str, name: str, **options: object) -> DataFrame:
    """Applied in several batches; a file holds one event type, so none comes in order."""
    landing = land_events(spark, sf)
    feed = Feed("events", max_files=_quarter_of_files(spark, landing), rules=AS_EVENTS)
    zone = _zone(spark, name, landing, feed)
    zone.ingest()
    _load_events_registry(zone)
    zone.refresh_silver(**options)
    return zone.silver("events")


@query("silver_deletes", _DELETED)
def silver_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(
        spark, sf, "silver-deletes", sequence_by=_EVENT_ORDER, delete_when="event_type = 'error'", **_PICK
    )


@query("scd1_out_of_order", _LATEST)
def scd1_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """Three drops, the newest first, each run to its end before the next lands."""
    landing = work_folder(spark, "late-landing")
    zone = _zone(spark, "late", landing, Feed("events", rules=AS_EVENTS))
    _load_events_registry(zone)
    lines = _event_lines(spark, sf)
    first, last = table(spark, sf, "events").agg(F.min("ts"), F.max("ts")).first()
    third = (last - first) / 3
    cuts = [first, first + third, first + 2 * third, None]
    for i in (2, 1, 0):
        at = F.col("ts").cast("timestamp_ntz")
        slot = (at >= F.lit(cuts[i])) if cuts[i + 1] is None else (at >= F.lit(cuts[i])) & (at < F.lit(cuts[i + 1]))
        lines.where(slot).write.option("header", True).csv(f"{landing}/drop{i}")
        zone.ingest()
        zone.refresh_silver(sequence_by=_EVENT_ORDER, **_PICK)
    return zone.silver("events")


@query("scd1_replayed", f"SELECT *, 2 AS flows FROM ({_LATEST})")
def scd1_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of several batches, and then all of it once more under another name."""
    landing = land_events(spark, sf)
    root = work_folder(spark, "replayed")
    lines = read_lines(spark, landing, max_files=_quarter_of_files(spark, landing))
    changes = stage(to_bronze(lines, landing), EVENTS_DDL).select(
        "user_id", "ts", "event_id", "event_type", "value"
    )
    target = ChangeTable(
        spark, f"{root}/latest", ChangeRules.of(changes, ["user_id"], _EVENT_ORDER, **_PICK), fan_in=3
    )
    for flow in ("first", "again"):
        apply_stream(changes, target, f"{root}/checkpoints/{flow}", flow=flow).awaitTermination()
    return target.read().withColumn("flows", F.lit(len(target.applied())))


_STAR = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name"),
    "customer": ("c_custkey", "c_name"),
    "part": ("p_partkey", "p_name"),
    "supplier": ("s_suppkey", "s_name"),
}


@query(
    "silver_many_sources",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {k} AS key, {n} AS name FROM {t}" for t, (k, n) in _STAR.items()
    ),
)
def silver_many_sources(spark: SparkSession, sf: str) -> DataFrame:
    """One pass over bronze for all tables; the last is registered after the others were filled."""
    zone = _zone(
        spark, "many-sources", _land_star(spark, sf), Feed("star", rules=((r"/(\w+)/[^/]+\.csv$", "$1_csv"),))
    )
    zone.ingest()
    folder = Folder(spark, f"{zone.root}/ddl")
    late = "supplier"
    for names in ([t for t in _STAR if t != late], [late]):
        for name in names:
            folder.publish(f"{name}.ddl", table(spark, sf, name).schema.simpleString())
        zone.load_registry(f"{zone.root}/ddl", {t: [k] for t, (k, _) in _STAR.items()})
        zone.refresh_silver()
    parts = [
        zone.silver(t).select(F.lit(t).alias("table_name"), F.col(k).alias("key"), F.col(n).alias("name"))
        for t, (k, n) in _STAR.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# What counts is when a line's file was changed, its path, and its place in the file.
_BY_PLACE = """
  WITH span AS (SELECT min(ts) AS a, (max(ts) - min(ts)) / 3 AS third FROM events),
  placed AS (
    SELECT user_id, event_type, value,
      (CASE WHEN ts >= a + 2 * third THEN 2 WHEN ts >= a + third THEN 1 ELSE 0 END, event_id % 3,
       row_number() OVER (ORDER BY event_id DESC)) AS place
    FROM events, span
  )
  SELECT user_id, arg_max(event_type, place) AS event_type, arg_max(value, place) AS value
  FROM placed GROUP BY user_id
"""


@query("silver_by_file_time", _BY_PLACE)
def silver_by_file_time(spark: SparkSession, sf: str) -> DataFrame:
    """All events in files of one name, ordered by modification time, path and line; the newest land first.

    A file has many lines of a user, and within it the last line counts: events stand there
    in an order that is not that of their times.
    """
    landing = work_folder(spark, "by-time-landing")
    files = Folder(spark, landing)
    events = table(spark, sf, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    third = (last - first) / 3
    cuts = [first, first + third, first + 2 * third, None]
    zone = _zone(spark, "by-time", landing, Feed("landed"))
    _load_events_registry(zone)
    for i in (2, 1, 0):
        span = F.col("ts") >= F.lit(cuts[i])
        if cuts[i + 1] is not None:
            span = span & (F.col("ts") < F.lit(cuts[i + 1]))
        if i == 0:
            span = ~F.coalesce(F.col("ts") >= F.lit(cuts[1]), F.lit(False))
        lines = _as_text(events.where(span).select(*EVENT_COLUMNS)).withColumn("n", F.col("event_id") % 3)
        # One file for each n, as a sender would write it from end to end.
        lines = lines.repartition("n").sortWithinPartitions("n", F.col("event_id").desc())
        lines.write.partitionBy("n").option("header", True).csv(f"{landing}/_drop{i}")
        for n in range(3):
            for part in files.names(f"_drop{i}/n={n}"):
                if part.startswith("part-"):
                    files.move(f"_drop{i}/n={n}/{part}", f"drop{i}/{n}/events.csv", at=1_700_000_000 + 86_400 * i)
        files.delete(f"_drop{i}")
        zone.ingest()
        zone.refresh_silver(**_PICK)
    return zone.silver("events")


@query(
    "silver_expectations",
    "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,"
    " arg_max(value, (ts, event_id)) AS value FROM events"
    " WHERE value >= 10 AND event_type <> 'error' GROUP BY user_id",
)
def silver_expectations(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that break a rule are set aside and not applied."""
    return _silver(
        spark, sf, "silver-expectations", sequence_by=_EVENT_ORDER, expectations=_RULES, on_violation="drop", **_PICK
    )


@query(
    "published_table",
    f"SELECT *, 'last event of each user' AS comment, 'silver' AS quality FROM ({_LATEST})",
)
def published_table(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed table by its name in the catalog, with its comment and properties."""
    zone = _zone(spark, "published", land_events(spark, sf), Feed("events", rules=AS_EVENTS))
    zone.ingest()
    name = f"events_{uuid.uuid4().hex[:12]}"
    Folder(spark, f"{zone.root}/ddl").publish(f"{name}.ddl", EVENTS_DDL)
    zone.load_registry(f"{zone.root}/ddl", {name: ["user_id"]})
    zone.start_silver(
        name, EVENTS_DDL, ["user_id"], sequence_by=_EVENT_ORDER, source="events_csv", **_PICK
    ).awaitTermination()
    zone.publish(name, comment="last event of each user", properties={"quality": "silver"})
    comment, quality, rows = _catalogued(spark, name)
    return rows.withColumns({"comment": F.lit(comment), "quality": F.lit(quality)})


@query(
    "scd1_ignore_nulls",
    "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,"
    " arg_max(value, (ts, event_id)) FILTER (WHERE event_type <> 'error') AS value"
    " FROM events GROUP BY user_id",
)
def scd1_ignore_nulls(spark: SparkSession, sf: str) -> DataFrame:
    changes = _changes(spark, sf).withColumn(
        "value", F.when(F.col("event_type") != "error", F.col("value"))
    )
    return apply_changes(changes, ["user_id"], _EVENT_ORDER, **_PICK)


@query(
    "scd1_replace_nulls",
    "SELECT user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM ("
    + _LATEST
    + ")",
)
def scd1_replace_nulls(spark: SparkSession, sf: str) -> DataFrame:
    changes = _changes(spark, sf).withColumn(
        "value", F.when(F.col("event_type") != "error", F.col("value"))
    )
    return apply_changes(changes, ["user_id"], _EVENT_ORDER, ignore_null_updates=False, **_PICK)


@query(
    "scd1_null_key",
    "SELECT k AS user_id, event_type AS kind, arg_max(value, (ts, event_id)) AS value FROM"
    " (SELECT *, CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS k FROM events)"
    " GROUP BY k, event_type",
)
def scd1_null_key(spark: SparkSession, sf: str) -> DataFrame:
    """A key of two columns, of which one may be null."""
    changes = _changes(spark, sf).select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"),
        F.col("event_type").alias("kind"), "ts", "event_id", "value",
    )
    return apply_changes(changes, ["user_id", "kind"], _EVENT_ORDER, columns=["value"])


@query(
    "scd1_columns",
    "SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id",
)
def scd1_columns(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes(
        _changes(spark, sf), ["user_id"], _EVENT_ORDER, except_columns=["ts", "event_id", "event_type"]
    )


@query("scd1_deletes", _DELETED)
def scd1_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes(
        _changes(spark, sf), ["user_id"], _EVENT_ORDER, delete_when="event_type = 'error'", **_PICK
    )


_TRUNCATED = (
    "WITH cut AS (SELECT max(event_id) AS cleared FROM events WHERE event_type = 'error' AND value > 200)"
    " SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,"
    " arg_max(value, (ts, event_id)) AS value FROM events"
    " WHERE event_id > coalesce((SELECT cleared FROM cut), -1) GROUP BY user_id"
)


@query("silver_truncate", _TRUNCATED)
def silver_truncate(spark: SparkSession, sf: str) -> DataFrame:
    """The clearing error may come in an earlier batch than what it clears."""
    return _silver(
        spark, sf, "silver-truncate", sequence_by="event_id",
        truncate_when="event_type = 'error' AND value > 200", **_PICK,
    )


@query("scd1_truncate", _TRUNCATED)
def scd1_truncate(spark: SparkSession, sf: str) -> DataFrame:
    """A great error clears the whole target."""
    return apply_changes(
        _changes(spark, sf), ["user_id"], "event_id",
        truncate_when="event_type = 'error' AND value > 200", **_PICK,
    )


_HISTORY = (
    'SELECT user_id, event_type, ts AS "__START_AT", lead(ts) OVER (PARTITION BY user_id ORDER BY ts)'
    ' AS "__END_AT" FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before'
    " FROM events) WHERE before IS DISTINCT FROM event_type"
)


@query("silver_history", _HISTORY)
def silver_history(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(
        spark, sf, "silver-history", scd_type=2, sequence_by=["ts", "event_id"],
        ignore_null_updates=False, columns=["event_type"],
    )


@query("scd2_history", _HISTORY)
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes_history(
        _changes(spark, sf), ["user_id"], "ts", tie_breakers=["event_id"], columns=["event_type"]
    )


@query(
    "scd2_untracked",
    """
    WITH marked AS (
      SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS starts
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    ), spans AS (
      SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts) AS span FROM marked
    ), rows AS (
      SELECT user_id, any_value(event_type) AS event_type, arg_max(value, ts) AS value,
             min(ts) AS "__START_AT" FROM spans GROUP BY user_id, span
    )
    SELECT *, lead("__START_AT") OVER (PARTITION BY user_id ORDER BY "__START_AT") AS "__END_AT" FROM rows
    """,
)
def scd2_untracked(spark: SparkSession, sf: str) -> DataFrame:
    """Only the type makes history; the value is updated in place."""
    return apply_changes_history(
        _changes(spark, sf), ["user_id"], "ts", tie_breakers=["event_id"],
        columns=["event_type", "value"], track_except=["value"],
    )


@query(
    "scd2_ignore_nulls",
    """
    WITH given AS (
      SELECT user_id, ts, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
             CASE WHEN value >= 10 THEN floor(value / 50) END AS band FROM events
    ), filled AS (
      SELECT user_id, ts, last_value(event_type IGNORE NULLS) OVER w AS event_type,
             last_value(band IGNORE NULLS) OVER w AS band
      FROM given WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    ), marked AS (
      SELECT *, row_number() OVER w AS n, lag(event_type) OVER w AS e, lag(band) OVER w AS b
      FROM filled WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    )
    SELECT user_id, event_type, band, ts AS "__START_AT",
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT"
    FROM marked WHERE n = 1 OR event_type IS DISTINCT FROM e OR band IS DISTINCT FROM b
    """,
)
def scd2_ignore_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A null leaves the value of the span before in place."""
    changes = _changes(spark, sf).select(
        "user_id", "ts", "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") >= 10, F.floor(F.col("value") / 50).cast("double")).alias("band"),
    )
    return apply_changes_history(
        changes, ["user_id"], "ts", tie_breakers=["event_id"], columns=["event_type", "band"]
    )


@query(
    "scd2_deletes",
    """
    WITH marked AS (
      SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events
    ), bounds AS (
      SELECT user_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until
      FROM marked WHERE before IS DISTINCT FROM event_type
    )
    SELECT user_id, event_type, ts AS "__START_AT", until AS "__END_AT" FROM bounds
    WHERE event_type <> 'error'
    """,
)
def scd2_deletes(spark: SparkSession, sf: str) -> DataFrame:
    """An error ends the open span and starts none."""
    return apply_changes_history(
        _changes(spark, sf), ["user_id"], "ts", tie_breakers=["event_id"], columns=["event_type"],
        delete_when="event_type = 'error'",
    )


# --- expectations --------------------------------------------------------------

_RULES = {"large enough": "value >= 10", "not an error": "event_type <> 'error'"}


@query(
    "expect_drop",
    "SELECT event_id, event_type, value FROM events WHERE value >= 10 AND event_type <> 'error'",
)
def expect_drop(spark: SparkSession, sf: str) -> DataFrame:
    return expect(
        table(spark, sf, "events").select("event_id", "event_type", "value"), _RULES, action="drop"
    )


@query(
    "expect_violations",
    "SELECT event_id, concat_ws(', ', CASE WHEN value < 10 THEN 'large enough' END,"
    " CASE WHEN event_type = 'error' THEN 'not an error' END) AS broken FROM events"
    " WHERE value < 10 OR event_type = 'error'",
)
def expect_violations(spark: SparkSession, sf: str) -> DataFrame:
    broken = violations(table(spark, sf, "events"), _RULES)
    return broken.select("event_id", F.concat_ws(", ", "broken").alias("broken"))


@query(
    "expect_warn",
    "SELECT event_id, event_type, value, (SELECT count(*) FILTER (WHERE value < 10) FROM events) AS too_small"
    " FROM events",
)
def expect_warn(spark: SparkSession, sf: str) -> DataFrame:
    """Every row passes, and the broken ones are counted while they do."""
    seen = Observation()
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    rows = materialise(expect(events, _RULES, action="warn", observe=seen), "expect-warn")
    return rows.withColumn("too_small", F.lit(seen.get["large enough"]))


@query(
    "expect_fail",
    "SELECT 'not an error' AS rule, CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'stopped'"
    " ELSE 'passed' END AS outcome FROM events"
    " UNION ALL SELECT 'has an id', CASE WHEN count(*) FILTER (WHERE event_id IS NULL) > 0 THEN 'stopped'"
    " ELSE 'passed' END FROM events",
)
def expect_fail(spark: SparkSession, sf: str) -> DataFrame:
    """A query stops at a row that breaks a rule, and at none if all rows meet it."""
    outcomes = []
    for name, rule in (("not an error", "event_type <> 'error'"), ("has an id", "event_id IS NOT NULL")):
        checked = expect(table(spark, sf, "events"), {name: rule}, action="fail")
        try:
            checked.write.format("noop").mode("overwrite").save()
            outcomes.append((name, "passed"))
        except Exception as stopped:
            if f"expectation '{name}' is broken" not in str(stopped):
                raise
            outcomes.append((name, "stopped"))
    return spark.createDataFrame(outcomes, "rule STRING, outcome STRING")
