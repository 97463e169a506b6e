"""Change history (SCD type 2): one row per key and span of unchanged values.

A key may have more changes than a task can hold, so nothing here puts a whole
key in one window. Change rows are range-partitioned by key and sequence into
slices of even size; a window covers one key in one slice, and starts with a
seed row that brings what the key's earlier slices end with.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfold.operators.changes import ChangeRules, actual_names, fold, resolve
from landfold.workspace import materialise

START, END = "__START_AT", "__END_AT"
_DELETED, _SLICE, _SEED, _AT = "_deleted", "_slice", "_seed", "_at"
#: Columns that the steps below add for themselves.
_RESERVED = {
    _DELETED, _SLICE, _SEED, _AT, "_was_deleted", "_cleared", "_old", "_starts", "_stops", "_span", "_last",
    START.lower(), END.lower(),
    # Those of a stored history.
    "_first", "_newest", "_late", "_open", "_low", "_part", "_bucket", "_before", "_n",
}


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class HistoryRules:
    """How change rows build a history.

    The history's state is one row per key and sequence, which is a keyed state
    like any other: ``state_rules`` describes it.
    """

    keys: tuple[str, ...]
    sequence_by: str
    columns: tuple[str, ...]
    tracked: tuple[str, ...]
    tie_breakers: tuple[str, ...] = ()
    ignore_null_updates: bool = True
    delete_when: str | None = None

    @staticmethod
    def of(
        changes: DataFrame,
        keys: Sequence[str],
        sequence_by: str,
        *,
        tie_breakers: Sequence[str] = (),
        track: Sequence[str] | None = None,
        track_except: Sequence[str] = (),
        ignore_null_updates: bool = True,
        delete_when: str | None = None,
        columns: Sequence[str] | None = None,
        except_columns: Sequence[str] = (),
    ) -> HistoryRules:
        if track is not None and track_except:
            raise ValueError("give track or track_except, not both")
        base = ChangeRules.of(
            changes, keys, [sequence_by, *tie_breakers], columns=columns, except_columns=except_columns
        )
        reserved = {
            c.lower() for c in (*base.keys, *base.columns) if c.lower() in _RESERVED or c.lower().startswith("_old_")
        }
        if reserved:
            raise ValueError(f"columns have reserved names: {sorted(reserved)}")
        at, *ties = base.sequence_by
        if at in base.keys:
            raise ValueError("the sequence cannot be a key")
        kept = tuple(c for c in base.columns if c != at)
        names = actual_names(changes)
        tracked, untracked = set(kept if track is None else names(track)), set(names(track_except))
        if not (tracked | untracked) <= set(kept):
            raise ValueError(f"not among the history's columns: {sorted((tracked | untracked) - set(kept))}")
        return HistoryRules(
            base.keys, at, kept, tuple(c for c in kept if c in tracked - untracked), tuple(ties),
            ignore_null_updates, delete_when,
        )

    def extends(self, older: HistoryRules) -> bool:
        """Whether these are the older rules, perhaps with columns added."""
        return (
            set(older.columns) <= set(self.columns)
            and set(older.tracked) == set(self.tracked) & set(older.columns)
            and replace(self, columns=older.columns, tracked=older.tracked) == older
        )

    @property
    def state_rules(self) -> ChangeRules:
        return ChangeRules(
            keys=(*self.keys, self.sequence_by),
            sequence_by=(self.sequence_by, *self.tie_breakers),
            columns=(_DELETED, *self.columns),
            ignore_null_updates=False,
        )

    def prepare(self, changes: DataFrame) -> DataFrame:
        """Change rows with deletes as a column, as the state keeps them."""
        deleted = F.coalesce(F.expr(self.delete_when), F.lit(False)) if self.delete_when else F.lit(False)
        return changes.withColumn(_DELETED, deleted)


def _carry(
    rows: DataFrame, keys: Sequence[str], at: str, values: Mapping[str, Column], *, forward: bool = True
) -> DataFrame:
    """Add to each row the nearest non-null ``values`` of its key before it (after it, backward).

    The row's own values do not count. ``rows`` carry their slice.
    """
    names = list(values)
    by_key = [_col(k) for k in keys]
    rows = rows.withColumns(dict(values))
    edge = F.max if forward else F.min
    ends = rows.groupBy(*by_key, _SLICE).agg(
        *[
            edge(F.when(_col(n).isNotNull(), F.struct(_col(at).alias("at"), _col(n).alias("v")))).alias(n)
            for n in names
        ]
    )
    slices = (
        Window.partitionBy(*by_key)
        .orderBy(F.col(_SLICE).asc() if forward else F.col(_SLICE).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seeds = ends.select(
        *by_key, _SLICE, *[F.last(_col(n)["v"], ignorenulls=True).over(slices).alias(n) for n in names],
        F.lit(True).alias(_SEED),
    ).where(F.coalesce(*[F.when(_col(n).isNotNull(), F.lit(True)) for n in names]))
    near = (
        Window.partitionBy(*by_key, _SLICE)
        .orderBy(F.col(_SEED).desc(), _col(at).asc() if forward else _col(at).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn(_SEED, F.lit(False))
        .unionByName(seeds, allowMissingColumns=True)
        .withColumns({n: F.last(_col(n), ignorenulls=True).over(near) for n in names})
        .where(~F.col(_SEED))
        .drop(_SEED)
    )


def versions(changes: DataFrame, rules: HistoryRules) -> DataFrame:
    """One row per key and sequence; ties go to the greatest tie breaker, whole."""
    state = rules.state_rules
    return resolve(fold(rules.prepare(changes), state), state)


def history(rows: DataFrame, rules: HistoryRules, scratch: str | None = None) -> DataFrame:
    """Spans of unchanged tracked values, from one row per key and sequence.

    A span starts where a tracked column changes and ends where the next one
    starts or the key is deleted. Columns that are not tracked show their last
    value in the span.

    Intermediate tables go to ``scratch``, which the caller may delete once the
    result is written, or else to the session's shared folder.
    """

    def kept(df: DataFrame, name: str) -> DataFrame:
        if scratch is None:
            return materialise(df, name)
        df.write.parquet(f"{scratch}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{scratch}/{name}")

    keys, at = rules.keys, rules.sequence_by
    rows = rows.withColumnRenamed(at, _AT)
    sliced = kept(
        rows.repartitionByRange(*[_col(k) for k in keys], F.col(_AT)).withColumn(
            _SLICE, F.spark_partition_id()
        ),
        "history",
    )
    deleted = F.col(_DELETED)

    if rules.ignore_null_updates:
        carried = _carry(
            sliced, keys, _AT,
            {
                "_was_deleted": deleted,
                "_cleared": F.when(deleted, F.col(_AT)),
                **{
                    f"_old_{c}": F.when(
                        ~deleted & _col(c).isNotNull(), F.struct(F.col(_AT).alias("at"), _col(c).alias("v"))
                    )
                    for c in rules.columns
                },
            },
        )
        # Values from before a delete do not come back.
        old = {
            c: F.when(
                F.col("_cleared").isNull() | (_col(f"_old_{c}")["at"] > F.col("_cleared")),
                _col(f"_old_{c}")["v"],
            )
            for c in rules.columns
        }
        new = {c: F.coalesce(_col(c), old[c]) for c in rules.columns}
    else:
        carried = _carry(
            sliced, keys, _AT,
            {
                "_was_deleted": deleted,
                "_old": F.struct(*[_col(c).alias(c) for c in rules.tracked] or [F.lit(0).alias("none")]),
            },
        )
        old = {c: F.col("_old")[c] for c in rules.tracked}
        new = {c: _col(c) for c in rules.columns}

    changed = F.col("_was_deleted").isNull() | F.col("_was_deleted")
    for c in rules.tracked:
        changed = changed | ~new[c].eqNullSafe(old[c])
    marked = carried.select(
        *[_col(k) for k in keys], _AT, _SLICE, _DELETED,
        *[new[c].alias(c) for c in rules.columns],
        (~deleted & changed).alias("_starts"),
        (deleted & F.coalesce(~F.col("_was_deleted"), F.lit(False))).alias("_stops"),
    )

    if set(rules.tracked) == set(rules.columns):
        bounds = marked.where(F.col("_starts") | F.col("_stops"))
    else:
        marked = kept(marked, "marked")
        spans = _carry(marked, keys, _AT, {"_span": F.when(F.col("_starts"), F.col(_AT))}).withColumn(
            "_span", F.when(F.col("_starts"), F.col(_AT)).otherwise(F.col("_span"))
        )
        last = F.max(F.struct(_AT, *[_col(c) for c in rules.columns])).alias("_last")
        live = (
            spans.where(~deleted)
            .groupBy(*[_col(k) for k in keys], F.col("_span").alias(_AT))
            .agg(F.min(_SLICE).alias(_SLICE), last)
            .select(
                *[_col(k) for k in keys], _AT, _SLICE, F.lit(False).alias(_DELETED),
                *[F.col("_last")[c].alias(c) for c in rules.columns],
            )
        )
        bounds = live.unionByName(marked.where("_stops").select(live.columns))

    # Each step reads its rows twice, so they are worked out once and kept.
    bounds = kept(bounds, "spans")
    return (
        _carry(bounds, keys, _AT, {END: F.col(_AT)}, forward=False)
        .where(~deleted)
        .select(
            *[_col(k) for k in keys], *[_col(c) for c in rules.columns],
            F.col(_AT).alias(START), END,
        )
    )


def apply_changes_history(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, **options: object
) -> DataFrame:
    """The history of every key (SCD type 2), with its spans in ``__START_AT`` and ``__END_AT``.

    Options are those of :meth:`HistoryRules.of`. An open span has a null end.
    """
    rules = HistoryRules.of(changes, keys, sequence_by, **options)
    return history(versions(changes, rules), rules)
