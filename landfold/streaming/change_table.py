"""A keyed target kept as merged runs of change state.

Each batch of changes is folded and written as a new run; nothing that is being
read is ever overwritten. A manifest names the runs that make up the table and
the last batch applied from each flow, so a batch that comes again is passed
over, and one that was cut short leaves only an unnamed folder behind.

Runs are merged when the newer ones together outweigh an older one. A run is
then larger than all newer ones together: a table of n batches has about log n
runs, and a row is rewritten about log n times, not once per batch.

A history's spans are stored as well, in buckets by key, so that reading a
history is a scan. What is open (a key's last span, and the sequence up to which
the key is known) is kept apart from closed spans. A batch is spliced in: changes
after all that is known of their key start from its open span, and only add closed
spans; for those that come late, the versions from the span before the change on are
read, and the closed spans of their buckets are rewritten.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfold.operators.changes import ChangeRules, fold, merge, pack, resolve, unpack
from landfold.operators.history import END, START, HistoryRules, history
from landfold.streaming.folder import Folder

_LOCKS: dict[str, threading.Lock] = defaultdict(threading.Lock)
_KEPT_MANIFESTS = 5
_BUCKET = "_bucket"
#: Columns of a splice: a key's first and newest change, whether it comes late, what is known of the key.
_FIRST, _NEWEST, _LATE, _OPEN, _LAST, _LOW, _PART = "_first", "_newest", "_late", "_open", "_last", "_low", "_part"
_KINDS = {"current": ChangeRules, "history": HistoryRules}


@dataclass(frozen=True)
class Run:
    """A folder of merged state."""

    name: str
    size: int


@dataclass(frozen=True)
class _Manifest:
    version: int = -1
    schema: str | None = None
    runs: tuple[Run, ...] = ()
    retired: dict[str, float] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    rules: dict = field(default_factory=dict)
    kind: str = "current"
    #: Of a history: how many buckets it has, the folder with what is open of each, the folders
    #: with closed spans of each and their sizes, and the columns of spans.
    buckets: int = 0
    history: dict[str, str] = field(default_factory=dict)
    closed: dict[str, list[tuple[str, int]]] = field(default_factory=dict)
    history_schema: str | None = None

    def folders(self) -> set[str]:
        """Folders that spans are read from."""
        return set(self.history.values()) | {name for held in self.closed.values() for name, _ in held}

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> _Manifest:
        raw = json.loads(text)
        raw["runs"] = tuple(Run(run["name"], run["size"]) for run in raw["runs"])
        return _Manifest(**raw)


def runs_to_merge(sizes: list[int], fan_in: int) -> int | None:
    """Where the runs to merge begin: the oldest run no larger than all newer ones together."""
    for i in range(len(sizes)):
        if len(sizes) - i >= fan_in and sizes[i] <= sum(sizes[i + 1 :]):
            return i
    return None


class ChangeTable:
    """Target of :class:`ChangeRules` (current rows) or :class:`HistoryRules` (history).

    One writer at a time per table. Several flows may feed it in turn, each
    under a name and with batch numbers of its own. Columns may be added later;
    rows from before have nulls there.

    Runs that were merged, and buckets that were rewritten, stay for ``keep_for``
    seconds, for queries that still read them. ``buckets`` is for histories, and
    stays as it is when the table is made; more of them rewrite less per batch.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        rules: ChangeRules | HistoryRules,
        *,
        fan_in: int = 4,
        keep_for: float = 6 * 3600,
        buckets: int = 16,
    ) -> None:
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        if buckets < 1:
            raise ValueError("buckets must be at least 1")
        self.spark = spark
        self.path = path
        self.rules = rules
        self.fan_in = fan_in
        self.keep_for = keep_for
        self.buckets = buckets
        self._folder = Folder(spark, path)
        self._state_rules = rules.state_rules if isinstance(rules, HistoryRules) else rules
        held = self._manifest()
        if held.version >= 0:
            older = _rules_from(held)
            if type(rules) is not type(older) or not rules.extends(older):
                raise ValueError(f"the table at {path} was built with other rules; use a new path")
            if held.history and _LAST not in (held.history_schema or ""):
                raise ValueError(f"the history at {path} is laid out as it was before spans were spliced; build it anew")
            if held.history and held.buckets != buckets:
                raise ValueError(f"the table at {path} has {held.buckets} buckets, not {buckets}")

    @staticmethod
    def open(spark: SparkSession, path: str) -> ChangeTable:
        """An existing table, with the rules it was built with."""
        held = _latest(Folder(spark, path))
        if held.version < 0:
            raise FileNotFoundError(f"no change table at {path}")
        return ChangeTable(spark, path, _rules_from(held), buckets=held.buckets or 16)

    @staticmethod
    def flows(spark: SparkSession, path: str) -> dict[str, int]:
        """Number of the last batch applied to the table at ``path``, by flow; none if there is no table."""
        return _latest(Folder(spark, path)).applied

    def _manifest(self) -> _Manifest:
        return _latest(self._folder)

    def _stored(self, held: _Manifest, run: Run, buckets: Iterable[int] | None = None) -> DataFrame:
        """A run; of a history's, some buckets if they are given."""
        schema = T.StructType.fromJson(json.loads(held.schema))
        if not isinstance(self.rules, HistoryRules):
            return self.spark.read.schema(schema).parquet(f"{self.path}/runs/{run.name}")
        return self._bucketed(schema, f"runs/{run.name}", buckets)

    def _bucketed(self, schema: T.StructType, folder: str, buckets: Iterable[int] | None) -> DataFrame:
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())]))
        rows = rows.parquet(f"{self.path}/{folder}")
        return (rows if buckets is None else rows.where(F.col(_BUCKET).isin(sorted(buckets)))).drop(_BUCKET)

    def _buckets_of(self, folder: str) -> list[int]:
        """Buckets that a folder has, by its names."""
        return [int(n.removeprefix(f"{_BUCKET}=")) for n in self._folder.names(folder) if n.startswith(f"{_BUCKET}=")]

    def _merged(self, held: _Manifest, runs: tuple[Run, ...]) -> DataFrame:
        stored = [self._stored(held, run) for run in runs]
        if len(runs) == 1:  # one row per key already
            return unpack(stored[0], self._state_rules)
        return merge(reduce(DataFrame.unionByName, stored), self._state_rules)

    def _write_run(self, state: DataFrame) -> Run:
        name = uuid.uuid4().hex
        rows = pack(state, self._state_rules)
        if isinstance(self.rules, HistoryRules):
            dealt = rows.withColumn(_BUCKET, self._bucket()).hint("rebalance", _BUCKET)
            dealt.write.partitionBy(_BUCKET).parquet(f"{self.path}/runs/{name}")
        else:
            rows.write.parquet(f"{self.path}/runs/{name}")
        return Run(name, self._folder.size(f"runs/{name}"))

    # --- stored history -----------------------------------------------------

    def _bucket(self) -> Column:
        keys = [F.col(f"`{k}`") for k in self.rules.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int").alias(_BUCKET)

    def _spans(self, held: _Manifest, part: str, folders: Iterable[tuple[str, Iterable[str]]]) -> DataFrame:
        """Stored rows of one part (``open`` or ``closed``): buckets, each with the folders to read."""
        schema = T.StructType.fromJson(json.loads(held.history_schema))
        by_folder: dict[str, list[int]] = defaultdict(list)
        for bucket, names in folders:
            for name in names:
                by_folder[name].append(int(bucket))
        parts = [
            self._bucketed(schema, f"history/{name}/{_PART}={part}", own) for name, own in sorted(by_folder.items())
        ]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _opened(self, held: _Manifest, buckets: Iterable[str]) -> DataFrame:
        """Open spans, and for each key, without a start, the sequence up to which it is known."""
        return self._spans(held, "open", ((b, [held.history[b]]) for b in buckets if b in held.history))

    def _closed(self, held: _Manifest, since: dict[str, int]) -> DataFrame:
        """Closed spans of some buckets, from the given one of their folders on."""
        return self._spans(
            held, "closed", ((b, [name for name, _ in held.closed.get(b, [])[n:]]) for b, n in since.items())
        )

    def _with(self, rows: DataFrame, others: DataFrame, how: str, *conditions: Column) -> DataFrame:
        """Join on the keys, nulls being equal; ``others`` has them as ``_key0`` and so on."""
        same = [rows[f"`{k}`"].eqNullSafe(others[f"_key{i}"]) for i, k in enumerate(self.rules.keys)]
        return rows.join(others, reduce(Column.__and__, [*same, *conditions]), how)

    def _named(self, rows: DataFrame, *others: str | Column) -> DataFrame:
        return rows.select(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(self.rules.keys)], *others)

    def _spliced(self, held: _Manifest, run: Run) -> dict[str, object]:
        """The manifest's part on history once a run's changes are spliced in.

        Only folder names come to the driver, and the least sequence that late changes reach back to.
        """
        rules, at = self.rules, f"`{self.rules.sequence_by}`"
        keys = [F.col(f"`{k}`") for k in rules.keys]
        columns = [F.col(f"`{c}`") for c in rules.columns]
        name, scratch = uuid.uuid4().hex, f"scratch/{run.name}"

        def noted(df: DataFrame, what: str, *by: str) -> DataFrame:
            df.write.partitionBy(*by).parquet(f"{self.path}/{scratch}/{what}")
            return self.spark.read.schema(df.schema).parquet(f"{self.path}/{scratch}/{what}")

        buckets = [str(b) for b in self._buckets_of(f"runs/{run.name}")]
        new = resolve(unpack(self._stored(held, run), self._state_rules), self._state_rules)
        spans = new.select(*keys, *columns, F.col(at).alias(START), F.col(at).alias(END), F.col(at).alias(_LAST))
        held = replace(held, history_schema=spans.schema.json())
        opened = self._opened(held, buckets)
        no = F.lit(None)
        both = new.select(
            *keys, F.col(at).alias(_FIRST), no.cast(opened.schema[_LAST].dataType).alias(_LAST),
            F.when(F.lit(False), F.struct(F.col(at).alias(START), *columns)).alias(_OPEN),
        ).unionByName(
            opened.select(
                *keys, no.cast(opened.schema[START].dataType).alias(_FIRST), _LAST,
                F.when(F.col(START).isNotNull(), F.struct(START, *columns)).alias(_OPEN),
            )
        )
        known = both.groupBy(*keys).agg(
            F.min(_FIRST).alias(_FIRST), F.max(_FIRST).alias(_NEWEST), F.max(_LAST).alias(_LAST),
            F.first(_OPEN, ignorenulls=True).alias(_OPEN),
        ).where(F.col(_FIRST).isNotNull())
        late = F.coalesce(F.col(_FIRST) <= F.col(_LAST), F.lit(False))
        known = noted(known.withColumns({_LATE: late, _BUCKET: self._bucket()}), "known", _LATE, _BUCKET)
        late_buckets = [str(b) for b in self._buckets_of(f"{scratch}/known/{_LATE}=true")]

        at_column = F.col(at)
        seeds = known.where(~F.col(_LATE) & F.col(_OPEN).isNotNull())
        seeds = seeds.select(
            *keys, F.col(f"{_OPEN}.{START}").alias(rules.sequence_by), F.lit(False).alias("_deleted"),
            *[F.col(_OPEN)[c].alias(c) for c in rules.columns],
        )
        marks = None
        if late_buckets:
            marks = noted(self._reach(held, known.where(_LATE), late_buckets), "marks")
            least = marks.agg(F.min(_LOW)).collect()[0][0]
            stored = [self._stored(held, r, map(int, late_buckets)).where(at_column >= F.lit(least)) for r in held.runs]
            older = resolve(merge(reduce(DataFrame.unionByName, stored), self._state_rules), self._state_rules)
            low = self._named(marks, _LOW)
            older = self._with(older, low, "left_semi", older[at] >= low[_LOW])
            before = marks.where(F.col(_OPEN).isNotNull()).select(
                *keys, F.col(f"{_OPEN}.{START}").alias(rules.sequence_by), F.lit(False).alias("_deleted"),
                *[F.col(_OPEN)[c].alias(c) for c in rules.columns],
            )
            new = self._with(new, self._named(marks), "left_anti")
            new = new.unionByName(older).unionByName(before)
        found = history(new.unionByName(seeds), rules, f"{self.path}/{scratch}")
        if marks is not None:  # the span before the first that may change is there already
            low = self._named(marks, _LOW)
            found = self._with(found, low, "left_anti", found[START] < low[_LOW])

        is_open = F.when(F.col(END).isNull(), "open").otherwise("closed").alias(_PART)
        last = F.greatest(_LAST, _NEWEST).alias(_LAST)
        nothing = [F.lit(None).cast(spans.schema[c].dataType).alias(c) for c in (*rules.columns, START, END)]
        others = self._with(opened, self._named(known), "left_anti")
        # Closed spans: those behind late changes are gone through, and small folders are merged.
        since = {b: 0 for b in late_buckets}
        for b in buckets:
            start = runs_to_merge([size for _, size in held.closed.get(b, [])], self.fan_in)
            if start is not None:
                since.setdefault(b, start)
        again = self._closed(held, since)
        if marks is not None:
            low = self._named(marks, _LOW)
            again = self._with(again, low, "left_anti", again[START] >= low[_LOW])
        rows = reduce(
            DataFrame.unionByName,
            [
                found.withColumn(_LAST, F.lit(None).cast(spans.schema[_LAST].dataType)).select("*", is_open),
                known.select(*keys, *nothing, last, F.lit("open").alias(_PART)),
                others.withColumn(_PART, F.lit("open")),
                again.withColumn(_PART, F.lit("closed")),
            ],
        )
        rows = rows.withColumn(_BUCKET, self._bucket()).hint("rebalance", _PART, _BUCKET)
        rows.write.partitionBy(_PART, _BUCKET).parquet(f"{self.path}/history/{name}")
        self._folder.delete(scratch)
        closed = {b: own[: since.get(b, len(own))] for b, own in held.closed.items()}
        for b in map(str, self._buckets_of(f"history/{name}/{_PART}=closed")):
            size = self._folder.size(f"history/{name}/{_PART}=closed/{_BUCKET}={b}")
            closed[b] = [*closed.get(b, []), (name, size)]
        return {
            "history": {**held.history, **dict.fromkeys(buckets, name)},
            "closed": closed,
            "history_schema": held.history_schema,
        }

    def _reach(self, held: _Manifest, late: DataFrame, buckets: list[str]) -> DataFrame:
        """For each late key: from which sequence its versions count again, and the span before that.

        That is the start of the last span that begins before the key's first change. The span
        before it holds the values that are carried there, if it ends there.
        """
        rules = self.rules
        keys = [F.col(f"`{k}`") for k in rules.keys]
        first = self._named(late, _FIRST)
        stored = self._opened(held, buckets).unionByName(self._closed(held, dict.fromkeys(buckets, 0)))
        stored = stored.where(F.col(START).isNotNull())
        near = self._with(stored, first, "inner", stored[START] < first[_FIRST])
        latest = Window.partitionBy(*keys).orderBy(F.col(START).desc())
        near = near.withColumn("_n", F.row_number().over(latest)).where("_n <= 2")
        own = F.struct(START, END, *[F.col(f"`{c}`") for c in rules.columns])
        near = self._named(
            near.groupBy(*keys).agg(F.max(START).alias(_LOW), F.max(F.when(F.col("_n") == 2, own)).alias(_OPEN)),
            _LOW, _OPEN,
        )
        carries = F.col("_before")[END] == F.col(_LOW)
        return self._with(late.drop(_OPEN, _LOW), near.withColumnRenamed(_OPEN, "_before"), "left").select(
            *keys,
            F.coalesce(_LOW, _FIRST).alias(_LOW),
            F.when(carries, F.col("_before")).alias(_OPEN),
        )

    def _publish(self, held: _Manifest, **changes: object) -> _Manifest:
        new = replace(held, version=held.version + 1, **changes)
        self._folder.publish(f"manifests/{new.version:012d}.json", new.to_json())
        return new

    def applied(self) -> dict[str, int]:
        """Number of the last batch applied, by flow."""
        return self._manifest().applied

    def apply(self, changes: DataFrame, *, flow: str = "", batch_id: int | None = None) -> bool:
        """Fold a batch of changes in. False if it was applied before, and is passed over."""
        with _LOCKS[self.path]:
            held = self._manifest()
            last = held.applied.get(flow, -1)
            if batch_id is None:
                batch_id = last + 1
            elif batch_id <= last:
                return False
            rules = self.rules
            if isinstance(rules, HistoryRules):
                changes = rules.prepare(changes)
            state = fold(changes, self._state_rules)
            schema = self._schema(held, state)
            run = self._write_run(state)
            is_history = isinstance(rules, HistoryRules)
            # A batch may hold nothing for this table, as when a shared bronze
            # table moved on; then only its number is noted.
            if is_history:
                nothing = not self._buckets_of(f"runs/{run.name}")
            else:
                nothing = self.spark.read.parquet(f"{self.path}/runs/{run.name}").isEmpty()
            new = () if nothing else (run,)
            coming = replace(held, schema=schema, runs=(*held.runs, *new))
            spans = self._spliced(coming, run) if is_history and new else {}
            replaced = held.folders() - replace(held, **spans).folders()
            # Run, spans and batch number appear together.
            held = self._publish(
                coming,
                applied={**held.applied, flow: batch_id},
                rules=asdict(rules),
                kind="history" if is_history else "current",
                buckets=self.buckets if is_history else 0,
                retired={**held.retired, **dict.fromkeys(replaced, time.time())},
                **spans,
            )
            start = runs_to_merge([run.size for run in held.runs], self.fan_in)
            if start is not None:
                self._merge_from(held, start)
            self._tidy()
            return True

    def _schema(self, held: _Manifest, state: DataFrame) -> str:
        """Schema of the stored state, which may gain columns but keeps their types."""
        schema = pack(state, self._state_rules).schema
        if held.schema is not None:
            older, newer = _types(T.StructType.fromJson(json.loads(held.schema))), _types(schema)
            changed = sorted(name for name in older if newer.get(name) != older[name])
            if changed:
                raise ValueError(f"columns of {self.path} changed their type: {changed}")
        return schema.json()

    def _merge_from(self, held: _Manifest, start: int) -> None:
        runs = held.runs[start:]
        run = self._write_run(self._merged(held, runs))
        present = {**self._folder.ages("runs"), **self._folder.ages("history")}
        retired = {name: at for name, at in held.retired.items() if name in present}
        retired |= {old.name: time.time() for old in runs}
        self._publish(held, runs=(*held.runs[:start], run), retired=retired)

    def compact(self) -> None:
        """Merge all runs into one, so that reading current rows needs no shuffle."""
        with _LOCKS[self.path]:
            held = self._manifest()
            if len(held.runs) < 2:
                return
            self._merge_from(held, 0)
            self._tidy()

    def _tidy(self) -> None:
        """Delete what was replaced long ago, or left by a batch that was cut short."""
        held = self._manifest()
        long_ago = time.time() - self.keep_for
        live = {run.name for run in held.runs} | held.folders()
        for kind in ("runs", "history", "scratch"):
            for name, changed in self._folder.ages(kind).items():
                if name not in live and held.retired.get(name, changed) < long_ago:
                    self._folder.delete(f"{kind}/{name}")
        for name in [n for n in self._folder.names("manifests") if n.endswith(".json")][:-_KEPT_MANIFESTS]:
            self._folder.delete(f"manifests/{name}")

    def state(self) -> DataFrame:
        """Merged state, one row per state key."""
        held = self._manifest()
        if held.schema is None:
            raise FileNotFoundError(f"nothing has been applied to {self.path}")
        if not held.runs:
            schema = T.StructType.fromJson(json.loads(held.schema))
            return unpack(self.spark.createDataFrame([], schema), self._state_rules)
        return self._merged(held, held.runs)

    def read(self, where: str | None = None) -> DataFrame:
        """The published rows, or those of the keys that meet ``where``. Reading writes nothing."""
        if isinstance(self.rules, HistoryRules):
            held = self._manifest()
            if held.schema is None:
                raise FileNotFoundError(f"nothing has been applied to {self.path}")
            if held.history_schema is None:  # batches without a row so far
                rows = resolve(self.state(), self._state_rules).drop("_deleted")
                at = F.col(f"`{self.rules.sequence_by}`")
                order = [*self.rules.keys, *self.rules.columns]
                rows = rows.select(*[F.col(f"`{c}`") for c in order], at.alias(START), at.alias(END)).where("false")
            else:
                rows = self._opened(held, held.history).unionByName(self._closed(held, dict.fromkeys(held.closed, 0)))
                rows = rows.where(F.col(START).isNotNull()).drop(_LAST)
        else:
            rows = resolve(self.state(), self._state_rules)
        if where is not None:
            keys = T.StructType([f for f in rows.schema.fields if f.name in self.rules.keys])
            self.spark.createDataFrame([], keys).where(where)  # refuses any other column
            rows = rows.where(where)
        return rows


def _types(schema: T.StructType, prefix: str = "") -> dict[str, str]:
    """Type of every leaf column, by its path."""
    found: dict[str, str] = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            found |= _types(f.dataType, f"{prefix}{f.name}.")
        else:
            found[prefix + f.name] = f.dataType.simpleString()
    return found


def _latest(folder: Folder) -> _Manifest:
    names = [n for n in folder.names("manifests") if n.endswith(".json")]
    return _Manifest.from_json(folder.read(f"manifests/{names[-1]}")) if names else _Manifest()


def _rules_from(held: _Manifest) -> ChangeRules | HistoryRules:
    raw = {k: tuple(v) if isinstance(v, list) else v for k, v in held.rules.items()}
    return _KINDS[held.kind](**raw)
