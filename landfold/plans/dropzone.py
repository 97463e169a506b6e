"""A drop folder and the tables built from it.

Below ``root``::

    bronze/<feed>/source=<source>/   every landed line, in one copy, split by source (or in
                                     one folder, for feeds that are not split)
    registry/                        known tables: schema and keys
    silver/<table>/                  keyed targets
    quarantine/<table>/feed=<feed>/  lines that did not fit their schema or have no sequence
    landed/<feed>/                   file names and sources, a small file for each batch of bronze
    alerts/<feed>/                   landed sources, those without a schema, registry findings
    published/<table>/               keyed tables written out for the catalog
    checkpoints/                     one per stream
"""

from __future__ import annotations

import math
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from landfold.functions.names import SourceRule
from landfold.operators.bronze import PLACE, landed_sources, running_number, split_source, to_bronze, with_source
from landfold.operators.changes import ChangeRules
from landfold.operators.expectations import ACTIONS, broken_rules, expect
from landfold.operators.history import HistoryRules
from landfold.operators.records import quoted_records
from landfold.operators.registry import (
    build_registry,
    load_ddl,
    load_keys,
    registry_problems,
    unknown_sources,
)
from landfold.operators.stage import (
    CORRUPT,
    LINE_ID,
    MODES,
    ORIGIN,
    SEQUENCE,
    declared_schema,
    stage,
)
from landfold.sources.files import read_csv, read_lines, read_text
from landfold.sources.tables import SINK_LOG, read_table
from landfold.streaming.catalog import declare_table
from landfold.streaming.change_table import ChangeTable
from landfold.streaming.flows import append, apply_batch, apply_stream, await_all, flow_identity, for_each_batch
from landfold.streaming.folder import Folder

_METADATA = (
    "struct<file_path: string, file_name: string, file_size: bigint, file_block_start: bigint,"
    " file_block_length: bigint, file_modification_time: timestamp>"
)


_ASIDE = "_set_aside"
#: A running refresh and a caller may ask for the landed sources at once.
_NOTING: dict[str, threading.Lock] = defaultdict(threading.Lock)
#: Bronze files whose sources are noted in one batch.
_LISTED = 10_000


@dataclass(frozen=True)
class Feed:
    """What to ingest: a folder below the landing folder, and how to read its files.

    ``merge_small_files`` shuffles each batch so that its rows land in few files
    per source, large sources in several. It is worth its cost where many small
    files are dropped.

    ``split`` partitions bronze by source, so that a source is read without the
    others. Turn it off where nearly every file has a name, and so a source, of its own.

    ``quoted_lines`` is for CSV files whose quoted fields hold line breaks. Bronze has their
    lines as they are, headers too; stages and keyed tables are made of whole records, and
    take what a batch of bronze has at once, so that no file is torn.

    One limit paces a batch: ``max_files``, or ``max_bytes`` with ``max_files=None``. Keyed
    tables take as many files of bronze at once as a batch of landed ones became, if that is more.
    """

    table: str
    folder: str = ""
    file_type: str = "csv"
    whole_text: bool = False
    csv_schema: str | None = None
    skip_rows: int = 0
    header: bool = True
    delimiter: str = ","
    max_files: int | None = 1000
    max_bytes: int | str | None = None
    options: Mapping[str, object] | None = None
    rules: tuple[SourceRule, ...] = ()
    merge_small_files: bool = False
    split: bool = True
    quoted_lines: bool = False
    comment: str | None = None
    properties: Mapping[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        """Columns of the feed's bronze table, with a line's place and the partition column."""
        data = (
            f", data {declared_schema(self.csv_schema).simpleString()}"
            if self.csv_schema and self.file_type == "csv"
            else ""
        )
        return T.StructType.fromDDL(
            "fullFilePath string, datasource string, inputFileName string, ingestTime timestamp,"
            f" ingestDate date, value string, fileMetadata {_METADATA}{data}, {PLACE} bigint, source string"
        )

    @property
    def partitions(self) -> list[str]:
        return ["source"] if self.split else []

    def read(self, spark: SparkSession, path: str, *, streaming: bool = True) -> DataFrame:
        paced = {
            "skip_rows": self.skip_rows, "max_files": self.max_files, "max_bytes": self.max_bytes,
            "options": self.options, "streaming": streaming,
        }
        if self.quoted_lines and (self.file_type != "csv" or self.csv_schema or self.skip_rows):
            raise ValueError("quoted_lines is for CSV files that are landed as lines, from their first line on")
        if self.file_type != "csv" or self.quoted_lines:
            return read_text(spark, path, whole_text=self.whole_text, **paced)
        if self.csv_schema is None:
            return read_lines(spark, path, header=self.header, **paced)
        return read_csv(
            spark, path, self.csv_schema, header=self.header, delimiter=self.delimiter, **paced
        )


class DropZone:
    """Ingests a landing folder and keeps its bronze and silver tables.

    Every step takes what has arrived since it last ran, and can be run again
    at any time, also after being cut off.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        root: str,
        feeds: Sequence[Feed] = (Feed("bronze"),),
        *,
        suffix: str = "_csv",
        table_options: Mapping[str, object] | None = None,
    ) -> None:
        """``table_options`` are those of :class:`ChangeTable`, for all keyed tables."""
        names = [f.table for f in feeds]
        if len(set(names)) != len(names):
            raise ValueError(f"feeds need tables of their own: {names}")
        self.spark = spark
        self.landing = landing.rstrip("/")
        self.root = root.rstrip("/")
        self.feeds = {f.table: f for f in feeds}
        self.suffix = suffix
        self.table_options = dict(table_options or {})

    def __repr__(self) -> str:
        return f"DropZone(landing={self.landing!r}, root={self.root!r})"

    def _feed(self, table: str | None) -> Feed:
        return next(iter(self.feeds.values())) if table is None else self.feeds[table]

    def _bronze_path(self, feed: Feed) -> str:
        return f"{self.root}/bronze/{feed.table}"

    def _routed(self, feed: Feed, **options: object) -> DataFrame:
        return read_table(self.spark, self._bronze_path(feed), schema=feed.schema, **options)

    # --- bronze -------------------------------------------------------------

    def start_ingest(self, table: str | None = None, *, every: str | None = None) -> StreamingQuery:
        """Start ingesting a feed; one pass both lands its rows and splits them by source."""
        feed = self._feed(table)
        datasource = f"{self.landing}/{feed.folder}/" if feed.folder else f"{self.landing}/"
        lines = feed.read(self.spark, datasource).withColumn(PLACE, running_number())
        bronze = to_bronze(lines, datasource)
        routed = with_source(bronze, feed.rules)
        if feed.merge_small_files:
            routed = routed.hint("rebalance", "source")
        return append(
            routed,
            self._bronze_path(feed),
            f"{self.root}/checkpoints/bronze/{feed.table}",
            partition_by=feed.partitions,
            every=every,
            numbered=True,
        )

    def ingest(self, *tables: str) -> None:
        """Ingest what has landed for the given feeds, or for all, side by side."""
        await_all(self.start_ingest(t) for t in tables or self.feeds)

    def bronze(self, table: str | None = None) -> DataFrame:
        """All landed rows of a feed."""
        return self._routed(self._feed(table)).drop("source", PLACE)

    def sources(self, table: str | None = None) -> DataFrame:
        """File names that have landed, and their sources.

        They are noted for each batch of bronze once, so only new bronze files are looked at.
        """
        with _NOTING[self.root]:
            return self._noted_sources(self._feed(table))

    def _noted_sources(self, feed: Feed) -> DataFrame:
        noted = f"{self.root}/landed/{feed.table}"
        checkpoint = f"{self.root}/checkpoints/landed/{feed.table}"
        flow = flow_identity(self.spark, checkpoint)

        def note(batch: DataFrame, batch_id: int) -> None:
            path = f"{noted}/flow={flow}/batch_id={batch_id}"
            landed_sources(batch).write.mode("overwrite").parquet(path)

        stream = self._routed(feed, streaming=True, max_files=_LISTED).select("inputFileName", "source")
        await_all([for_each_batch(stream, note, checkpoint)])
        rows = "inputFileName string, source string"
        if not Folder(self.spark, noted).exists():
            return self.spark.createDataFrame([], rows)
        return self.spark.read.schema(rows).parquet(f"{noted}/*/*").distinct()

    def split(self, source: str, table: str | None = None) -> DataFrame:
        """Landed rows of one source; no other source is read."""
        return self._lines(source, table).drop(PLACE)

    def _lines(self, source: str, table: str | None) -> DataFrame:
        return split_source(self._routed(self._feed(table)), source)

    def _pace(self, feed: Feed) -> dict[str, object]:
        # A file's lines land with one batch of bronze, which is taken whole if nothing limits it.
        if feed.quoted_lines:
            return {}
        most = feed.max_files
        # A large file becomes several of bronze, of which a batch should not take fewer for that.
        return {"max_files": most and max(most, self._files_a_batch(feed)), "max_bytes": feed.max_bytes}

    def _files_a_batch(self, feed: Feed) -> int:
        """Bronze files that a batch of landed files has become so far, on average."""
        log = Folder(self.spark, f"{self._bronze_path(feed)}/{SINK_LOG}")
        batches = 1 + max((int(n) for n in (name.split(".")[0] for name in log.names()) if n.isdigit()), default=-1)
        # Names only, which Spark's own listing has; no file is looked at.
        return math.ceil(len(self._routed(feed).inputFiles()) / batches) if batches else 0

    @staticmethod
    def _records(feed: Feed, lines: DataFrame) -> DataFrame:
        """What one row each is to be made of."""
        return quoted_records(lines, header=feed.header) if feed.quoted_lines else lines

    def declare_bronze(self, table: str | None = None) -> list[str]:
        """Name the feed's table in the catalog, and a ``<source>_bronze`` view per source."""
        feed = self._feed(table)
        declare_table(
            self.spark, feed.table, self._bronze_path(feed),
            T.StructType([f for f in feed.schema.fields if f.name != PLACE]), comment=feed.comment, properties=feed.properties, partition_by=feed.partitions,
        )
        # One name per source, as few as there are folders.
        sources = [r.source for r in self.sources(feed.table).select("source").distinct().collect()]
        for source in sources:
            self.split(source, feed.table).createOrReplaceTempView(f"`{source}_bronze`")
        return sorted(f"{source}_bronze" for source in sources)

    # --- registry -----------------------------------------------------------

    def load_registry(
        self, ddl_folder: str, keys: str | Mapping[str, Sequence[str]]
    ) -> DataFrame:
        """Publish the registry anew from its version-controlled files."""
        registry = build_registry(load_ddl(self.spark, ddl_folder), load_keys(self.spark, keys))
        registry.write.mode("overwrite").parquet(f"{self.root}/registry")
        return self.registry()

    def registry(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/registry")

    def refresh_alerts(self, table: str | None = None) -> tuple[DataFrame, DataFrame]:
        """Write and return the sources without a schema, and what is wrong in the registry."""
        with _NOTING[self.root]:
            return self._refreshed_alerts(self._feed(table))

    def _refreshed_alerts(self, feed: Feed) -> tuple[DataFrame, DataFrame]:
        def publish(name: str, rows: DataFrame) -> DataFrame:
            path = f"{self.root}/alerts/{feed.table}/{name}"
            rows.write.mode("overwrite").parquet(path)
            return self.spark.read.schema(rows.schema).parquet(path)

        landed = publish("landed_sources", self._noted_sources(feed))
        registry = self.registry()
        return (
            publish("unknown_sources", unknown_sources(landed, registry, suffix=self.suffix)),
            publish("registry_problems", registry_problems(registry, landed, suffix=self.suffix)),
        )

    # --- silver -------------------------------------------------------------

    def stage(
        self,
        name: str,
        table: str | None = None,
        *,
        mode: str = "permissive",
        parse_options: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Typed change rows of a registered table."""
        row = self.registry().where(F.col("table_name") == name).first()
        if row is None or row.ddl is None:
            raise KeyError(f"no schema for {name!r}")
        records = self._records(self._feed(table), self._lines(name + self.suffix, table))
        return stage(records, row.ddl, mode=mode, options=parse_options)

    def _target(
        self,
        feed: Feed,
        name: str,
        lines: DataFrame,
        ddl: str,
        keys: Sequence[str],
        *,
        sequence_by: str | Sequence[str] = SEQUENCE,
        mode: str = "permissive",
        parse_options: Mapping[str, str] | None = None,
        scd_type: int = 1,
        ignore_null_updates: bool = True,
        delete_when: str | None = None,
        truncate_when: str | None = None,
        columns: Sequence[str] | None = None,
        except_columns: Sequence[str] = (),
        track: Sequence[str] | None = None,
        track_except: Sequence[str] = (),
        expectations: Mapping[str, str] | None = None,
        on_violation: str = "warn",
    ) -> tuple[DataFrame, ChangeTable, dict[str, object]]:
        """Change rows made of lines, the table they go to, and what is set aside."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if on_violation not in ACTIONS:
            raise ValueError(f"on_violation must be one of {ACTIONS}")
        sequence = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
        declared = declared_schema(ddl).fieldNames()
        # Dropping is left to the flow, which sets the dropped lines aside.
        parsing = "failfast" if mode == "failfast" else "permissive"
        staged = stage(self._records(feed, lines), ddl, mode=parsing, options=parse_options)
        if expectations and on_violation == "fail":
            staged = expect(staged, expectations, action="fail")
        unplaced = reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in sequence])
        broken = broken_rules(expectations or {})
        reason = (
            F.when(F.col(CORRUPT).isNotNull(), "does not fit the schema")
            .when(unplaced, "has no sequence")
            .when(F.size(broken) > 0, F.concat(F.lit("breaks: "), F.array_join(broken, ", ")))
        )
        refused = F.lit(mode == "drop") & F.col(CORRUPT).isNotNull()
        if on_violation == "drop":
            refused = refused | (F.size(broken) > 0)
        origin = F.struct(
            f"{ORIGIN}.fullFilePath", f"{ORIGIN}.value", reason.alias("reason"), refused.alias("refused")
        )
        changes = staged.select(
            *[F.col(f"`{c}`") for c in declared], SEQUENCE, LINE_ID,
            F.when(reason.isNotNull(), origin).alias(_ASIDE),
        )
        picked = {
            "ignore_null_updates": ignore_null_updates,
            "delete_when": delete_when,
            "columns": [
                c for c in (columns or declared) if c.lower() not in {e.lower() for e in except_columns}
            ],
        }
        if scd_type == 1:
            rules = ChangeRules.of(
                changes, keys, [*sequence, LINE_ID], truncate_when=truncate_when, **picked
            )
        elif scd_type == 2:
            if truncate_when is not None:
                raise ValueError("a history cannot be truncated")
            rules = HistoryRules.of(
                changes, keys, sequence[0], tie_breakers=[*sequence[1:], LINE_ID], track=track,
                track_except=track_except, **picked,
            )
        else:
            raise ValueError("scd_type must be 1 or 2")
        target = ChangeTable(self.spark, f"{self.root}/silver/{name}", rules, **self.table_options)
        return changes, target, {
            "set_aside": F.col(_ASIDE).isNotNull(),
            "refused": F.coalesce(F.col(_ASIDE)["refused"], F.lit(False)),
            "set_aside_path": f"{self.root}/quarantine/{name}/feed={feed.table}",
        }

    def start_silver(
        self,
        name: str,
        ddl: str,
        keys: Sequence[str],
        table: str | None = None,
        *,
        source: str | None = None,
        every: str | None = None,
        **options: object,
    ) -> StreamingQuery:
        """Start a stream that applies one source's new lines to its keyed table.

        The source is the table's own unless another is named. Options are those of :meth:`refresh_silver`. Bronze files of all sources count
        towards a batch's limit, though only one source's are read; where a feed has many
        tables, :meth:`start_all_silver` reads bronze once for all of them.
        """
        feed = self._feed(table)
        routed = self._routed(feed, streaming=True, **self._pace(feed))
        lines = split_source(routed, source or name + self.suffix)
        changes, target, aside = self._target(feed, name, lines, ddl, keys, **options)
        return apply_stream(
            changes, target, f"{self.root}/checkpoints/silver/{name}/{feed.table}",
            flow=feed.table, every=every, **aside,
        )

    def _ready(self, table: str | None, only: Sequence[str] | None) -> list[Row]:
        """Registered tables that have landed and are sound; findings are left to the alerts."""
        _, problems = self.refresh_alerts(table)
        unsound = {r.table_name for r in problems.select("table_name").collect()}
        return [
            r
            for r in self.registry().select("table_name", "ddl", "keys").orderBy("table_name").collect()
            if r.table_name not in unsound and (only is None or r.table_name in set(only))
        ]

    def start_all_silver(
        self,
        table: str | None = None,
        *,
        only: Sequence[str] | None = None,
        at_once: int = 8,
        every: str | None = None,
        **options: object,
    ) -> StreamingQuery:
        """Start one stream that applies a feed's new lines to all its registered tables.

        A batch of bronze is handed to the tables whose sources are in it, ``at_once`` side by
        side; of a split feed each reads its own files only. The registry is looked at again
        for every batch: a table registered meanwhile first gets what landed before.
        """
        feed = self._feed(table)
        return self._start_pass(feed, lambda: self._ready(feed.table, only), at_once, every, options)

    def _start_pass(
        self,
        feed: Feed,
        ready: Callable[[], list[Row]],
        at_once: int,
        every: str | None,
        options: Mapping[str, object],
    ) -> StreamingQuery:
        flow = self._silver_flow(feed)
        sources_at = f"{self.root}/landed_silver/{feed.table}/flow={flow}"

        def seen_before(source: str, batch_id: int) -> bool:
            if not Folder(self.spark, sources_at).exists():
                return False
            seen = self.spark.read.schema("source string, batch_id int").parquet(sources_at)
            return not seen.where((F.col("source") == source) & (F.col("batch_id") < batch_id)).isEmpty()

        def handle(batch: DataFrame, batch_id: int) -> None:
            own = batch.select("source").distinct()
            own.write.mode("overwrite").parquet(f"{sources_at}/batch_id={batch_id}")
            present = {r.source for r in own.collect()}

            def one(row: Row) -> None:
                source = row.table_name + self.suffix
                known = flow in ChangeTable.flows(self.spark, f"{self.root}/silver/{row.table_name}")
                if not known and seen_before(source, batch_id):
                    lines = self._lines(source, feed.table)
                elif source in present:
                    lines = split_source(batch, source)
                else:
                    return
                changes, target, aside = self._target(feed, row.table_name, lines, row.ddl, row["keys"], **options)
                apply_batch(changes, target, flow=flow, batch_id=batch_id, **aside)

            with ThreadPoolExecutor(at_once) as pool:
                list(pool.map(one, ready()))

        routed = self._routed(feed, streaming=True, **self._pace(feed))
        return for_each_batch(routed, handle, self._silver_checkpoint(feed), every=every)

    def _silver_checkpoint(self, feed: Feed) -> str:
        return f"{self.root}/checkpoints/all_silver/{feed.table}"

    def _silver_flow(self, feed: Feed) -> str:
        return f"{feed.table}#{flow_identity(self.spark, self._silver_checkpoint(feed))}"

    def refresh_silver(
        self,
        table: str | None = None,
        *,
        only: Sequence[str] | None = None,
        at_once: int = 8,
        **options: object,
    ) -> list[str]:
        """Apply new lines to every registered table that has landed and is sound.

        Tables with findings are left to the alerts; they hold up no other table. A table
        registered since the last refresh gets what landed before.

        Options, for all tables alike: ``sequence_by`` (by default when a line's file was
        modified; else columns; of a history one column and tie breakers; of lines that tie
        the one counts that stands last in the file of the last path), ``mode``
        (``permissive`` makes a row of what could be read of a malformed line and sets the line
        aside as well, ``drop`` only sets it aside, ``failfast`` stops), ``parse_options``,
        ``scd_type``, ``ignore_null_updates``, ``delete_when``, ``truncate_when``, ``columns``
        or ``except_columns``, ``track`` or ``track_except``, and ``expectations`` (name to
        SQL condition) with ``on_violation``: ``warn`` sets rows that break one aside and
        applies them, ``drop`` only sets them aside, ``fail`` stops.
        """
        feed = self._feed(table)
        ready = self._ready(table, only)
        empty = self.spark.createDataFrame([], feed.schema).drop("source")
        for r in ready:  # refuses what cannot be applied before a stream is started
            self._target(feed, r.table_name, empty, r.ddl, r["keys"], **options)
        await_all([self._start_pass(feed, lambda: ready, at_once, None, options)])
        # Without a new line no batch comes by; what was registered meanwhile is due all the same.
        flow = self._silver_flow(feed)
        batches = Folder(self.spark, f"{self._silver_checkpoint(feed)}/commits").names()
        last = max((int(n) for n in batches if n.isdigit()), default=-1)
        for r in ready:
            path = f"{self.root}/silver/{r.table_name}"
            if last >= 0 and flow not in ChangeTable.flows(self.spark, path):
                lines = self._lines(r.table_name + self.suffix, feed.table)
                changes, target, aside = self._target(feed, r.table_name, lines, r.ddl, r["keys"], **options)
                apply_batch(changes, target, flow=flow, batch_id=last, **aside)
        return [r.table_name for r in ready]

    def silver(self, name: str, where: str | None = None) -> DataFrame:
        """Published rows of a keyed table, or those of the keys that meet ``where``."""
        return ChangeTable.open(self.spark, f"{self.root}/silver/{name}").read(where)

    def declare_silver(self) -> list[str]:
        """Name the keyed tables, as they are now, as views in the session."""
        names = Folder(self.spark, f"{self.root}/silver").names()
        for name in names:
            self.silver(name).createOrReplaceTempView(f"`{name}`")
        return names

    def publish(
        self,
        name: str,
        *,
        comment: str | None = None,
        properties: Mapping[str, object] | None = None,
        staged: bool = False,
        table: str | None = None,
    ) -> str:
        """Write a keyed table's rows, or with ``staged`` its typed change rows, for the catalog.

        The catalog's table has the comment and properties given; its name is returned, ``name``
        or ``<name>_stage`` with underscores for what the catalog does not take.
        """
        shown = f"{name}_stage" if staged else name
        rows = self.stage(name, table).drop(ORIGIN) if staged else self.silver(name)
        path = f"{self.root}/published/{shown}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return declare_table(self.spark, shown, path, rows.schema, comment=comment, properties=properties)

    def quarantine(self, name: str) -> DataFrame | None:
        """Lines that did not fit the table's schema, have no sequence or break an expectation.

        None if there have been none.
        """
        path = f"{self.root}/quarantine/{name}"
        if not Folder(self.spark, path).exists():
            return None
        return self.spark.read.parquet(path).select(*[f"{_ASIDE}.{c}" for c in ("fullFilePath", "value", "reason")])

    def run(
        self, ddl_folder: str, keys: str | Mapping[str, Sequence[str]], **options: object
    ) -> list[str]:
        """Everything once: ingest, registry, alerts and silver."""
        self.ingest()
        self.load_registry(ddl_folder, keys)
        done: list[str] = []
        for table in self.feeds:
            done += self.refresh_silver(table, **options)
        return done
