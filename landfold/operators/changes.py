"""Keyed change application (upserts, deletes, truncates) without a merge command.

Everything kept per key is a maximum over change rows, so state can be built in
any order, from any batches, with any batch repeated, and come out the same. A
state is therefore a plain DataFrame, and making or merging states is one
``groupBy`` with partial aggregation: however many rows a key has, one row per
key and task is shuffled.

State columns, beside the keys:

``_upsert``      order of the last upsert
``_delete``      order of the last delete (only with ``delete_when``/``truncate_when``)
``_truncate``    part of the key: true on the one row that holds the last truncate
one per column   (order, value) of the last value that counts, when null updates
                 are ignored
``_row``         (order, all columns) of the last upsert, when they are not
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UPSERT, _DELETE, _TRUNCATE, _ROW = "_upsert", "_delete", "_truncate", "_row"
_VALUE, _ORDER = "_value", "_order"


def actual_names(df: DataFrame) -> Callable[[Iterable[str]], tuple[str, ...]]:
    """Looks column names up as Spark does, without regard to case."""
    known = {c.lower(): c for c in df.columns}

    def look_up(names: Iterable[str]) -> tuple[str, ...]:
        missing = [c for c in names if c.lower() not in known]
        if missing:
            raise ValueError(f"not among the change columns: {missing}")
        return tuple(known[c.lower()] for c in names)

    return look_up


@dataclass(frozen=True)
class ChangeRules:
    """How change rows apply to a keyed target.

    ``sequence_by`` names the columns that order the changes of a key. Changes
    that tie on all of them are told apart by their values, so the result is
    still the same in any order; name a tie breaker last to keep rows whole.

    ``delete_when`` and ``truncate_when`` are SQL predicates over the change rows.
    """

    keys: tuple[str, ...]
    sequence_by: tuple[str, ...]
    columns: tuple[str, ...]
    ignore_null_updates: bool = True
    delete_when: str | None = None
    truncate_when: str | None = None

    @staticmethod
    def of(
        changes: DataFrame,
        keys: Sequence[str],
        sequence_by: str | Sequence[str],
        *,
        ignore_null_updates: bool = True,
        delete_when: str | None = None,
        truncate_when: str | None = None,
        columns: Sequence[str] | None = None,
        except_columns: Sequence[str] = (),
    ) -> ChangeRules:
        """Rules for the given change rows; ``columns`` or ``except_columns`` pick the target's."""
        names = actual_names(changes)
        keys = names(keys)
        sequence = names([sequence_by] if isinstance(sequence_by, str) else sequence_by)
        dropped = set(names(except_columns))
        if not keys:
            raise ValueError("a keyed target needs keys")
        if not sequence:
            raise ValueError("changes need a sequence")
        if columns is not None and except_columns:
            raise ValueError("give columns or except_columns, not both")
        if dropped & set(keys):
            raise ValueError(f"keys cannot be left out: {sorted(dropped & set(keys))}")
        picked = changes.columns if columns is None else names(columns)
        kept = tuple(c for c in picked if c not in dropped and c not in keys)
        reserved = {_UPSERT, _DELETE, _TRUNCATE, _ROW} & {c.lower() for c in (*keys, *kept)}
        if reserved:
            raise ValueError(f"columns have reserved names: {sorted(reserved)}")
        for c in kept:
            if isinstance(changes.schema[c].dataType, (T.MapType, T.VariantType)):
                raise ValueError(f"column {c!r} has a type without an order")
        return ChangeRules(keys, sequence, kept, ignore_null_updates, delete_when, truncate_when)

    def extends(self, older: ChangeRules) -> bool:
        """Whether these are the older rules, perhaps with columns added."""
        return set(older.columns) <= set(self.columns) and replace(self, columns=older.columns) == older

    @property
    def has_deletes(self) -> bool:
        return self.delete_when is not None or self.truncate_when is not None

    @property
    def state_keys(self) -> tuple[str, ...]:
        return self.keys if self.truncate_when is None else (*self.keys, _TRUNCATE)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _holds(predicate: str | None) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False)) if predicate is not None else F.lit(False)


def _sequenced(rules: ChangeRules) -> Column:
    cond = F.lit(True)
    for c in rules.sequence_by:
        cond = cond & _col(c).isNotNull()
    return cond


def unsequenced(changes: DataFrame, rules: ChangeRules) -> DataFrame:
    """Change rows that cannot be placed because their sequence is null."""
    return changes.where(~_sequenced(rules))


def _order(rules: ChangeRules) -> Column:
    return F.struct(*[_col(c).alias(f"o{i}") for i, c in enumerate(rules.sequence_by)])


def _lifted(rules: ChangeRules) -> tuple[list[Column], list[Column]]:
    """State keys of a change row, and its part in each state column."""
    truncates = _holds(rules.truncate_when)
    deletes = _holds(rules.delete_when) & ~truncates
    upserts = ~deletes & ~truncates
    always = not rules.has_deletes
    order = _order(rules)

    keys = [_col(k) for k in rules.keys]
    if rules.truncate_when is not None:
        # All truncates share one row, whatever keys their change rows carry.
        keys = [F.when(~truncates, _col(k)).alias(k) for k in rules.keys]
        keys.append(truncates.alias(_TRUNCATE))
    parts: list[Column] = []
    if rules.has_deletes:
        parts.append(F.when(~upserts, order))
    if rules.ignore_null_updates:
        parts.append(order if always else F.when(upserts, order))
        for c in rules.columns:
            counts = _col(c).isNotNull() if always else upserts & _col(c).isNotNull()
            parts.append(F.when(counts, F.struct(order.alias(_ORDER), _col(c).alias(_VALUE))))
    else:
        row = F.struct(order.alias(_ORDER), *[_col(c).alias(c) for c in rules.columns])
        parts.append(row if always else F.when(upserts, row))
    return keys, parts


def _greatest(rows: DataFrame, keys: list[Column], parts: dict[str, Column]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.max(part).alias(name) for name, part in parts.items()])


def fold(changes: DataFrame, rules: ChangeRules) -> DataFrame:
    """The state of a set of change rows; rows without a sequence are left out.

    State columns are made inside the aggregation, so that change rows are
    sorted as they are and not with the order repeated for every column.
    """
    keys, parts = _lifted(rules)
    named = dict(zip(_state_columns(rules), parts, strict=True))
    return _greatest(changes.where(_sequenced(rules)), keys, named)


def _state_columns(rules: ChangeRules) -> list[str]:
    names = [_DELETE] if rules.has_deletes else []
    return [*names, _UPSERT, *rules.columns] if rules.ignore_null_updates else [*names, _ROW]


def pack(state: DataFrame, rules: ChangeRules) -> DataFrame:
    """State as it is stored: a column's order only where it is not the row's own.

    Most values come with the last upsert of their key, so most of these are null.
    """
    if not (rules.ignore_null_updates and rules.columns):
        return state
    return state.withColumns(
        {
            c: F.struct(
                F.nullif(_col(c)[_ORDER], _col(_UPSERT)).alias(_ORDER), _col(c)[_VALUE].alias(_VALUE)
            )
            for c in rules.columns
        }
    )


def _unpacked(c: str) -> Column:
    return F.when(
        _col(c)[_VALUE].isNotNull(),
        F.struct(
            F.coalesce(_col(c)[_ORDER], _col(_UPSERT)).alias(_ORDER), _col(c)[_VALUE].alias(_VALUE)
        ),
    )


def unpack(stored: DataFrame, rules: ChangeRules) -> DataFrame:
    """The state that :func:`pack` stored."""
    if not (rules.ignore_null_updates and rules.columns):
        return stored
    return stored.withColumns({c: _unpacked(c) for c in rules.columns})


def merge(stored: DataFrame, rules: ChangeRules) -> DataFrame:
    """Stored states with any number of rows per key, merged to the state of one row per key."""
    packed = rules.columns if rules.ignore_null_updates else ()
    parts = {c: _unpacked(c) if c in packed else _col(c) for c in _state_columns(rules)}
    return _greatest(stored, [_col(k) for k in rules.state_keys], parts)


def resolve(state: DataFrame, rules: ChangeRules) -> DataFrame:
    """The target's rows: keys that are upserted and not deleted since, with their values."""
    upsert = _col(_UPSERT) if rules.ignore_null_updates else _col(_ROW)[_ORDER]
    tomb: Column | None = None
    rows = state
    if rules.has_deletes:
        tomb = _col(_DELETE)
        if rules.truncate_when is not None:
            # One value for the whole table, worked out as a scalar subquery.
            cleared = state.where(_TRUNCATE).agg(F.max(_DELETE).alias("at")).scalar()
            tomb = F.greatest(tomb, cleared)
            rows = rows.where(~_col(_TRUNCATE))
        rows = rows.withColumn(_DELETE, tomb).where(
            upsert.isNotNull() & (_col(_DELETE).isNull() | (upsert > _col(_DELETE)))
        )

    def value(c: str) -> Column:
        if not rules.ignore_null_updates:
            return _col(_ROW)[c].alias(c)
        held = _col(c)[_VALUE]
        if tomb is None:
            return held.alias(c)
        # A value from before the last delete is gone, even if nothing replaced it.
        return F.when(_col(_DELETE).isNull() | (_col(c)[_ORDER] > _col(_DELETE)), held).alias(c)

    return rows.select(*[_col(k) for k in rules.keys], *[value(c) for c in rules.columns])


def apply_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    *,
    ignore_null_updates: bool = True,
    delete_when: str | None = None,
    truncate_when: str | None = None,
    columns: Sequence[str] | None = None,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """The current row of every key after all changes (SCD type 1).

    For each key the change with the greatest sequence wins, whatever the order
    the rows come in. With ``ignore_null_updates`` a null in a change leaves the
    earlier value in place. Null keys count as equal.
    """
    rules = ChangeRules.of(
        changes, keys, sequence_by, ignore_null_updates=ignore_null_updates,
        delete_when=delete_when, truncate_when=truncate_when, columns=columns,
        except_columns=except_columns,
    )
    return resolve(fold(changes, rules), rules)
