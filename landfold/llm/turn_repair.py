r"""Repair of conversation structure by the cheapest edits, found with a checkpointed DP.

A conversation's turns are taken by ``turn`` (nulls first), then by role and a digest of the
text, so that its order is the same in every run. The first of these faults counts for each:
blank (nothing but white space), duplicate (role and text seen earlier in the conversation),
truncated (the last visible character is none of ``.!?``). Edits make the initials of the
roles read ``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 3, Delete 4 and is
forced on blank and duplicate turns, Insert of an empty user or assistant turn 3; a truncated
turn that is not deleted costs 3 more. Of the cheapest edits those are taken whose initials,
in order, are the ASCII-least string.

The DP runs backwards over the turns with a vector of one cost for each of four states. Only
the vectors at every square-root-th turn are kept; walking forward, the vectors of one block
at a time are worked out again, and the least letter among the tight edits is emitted. A
conversation of any length is cut into slices of bounded size by a range partitioning of
all turns. A slice is summed up by the costs from each state to each other; folding these
gives the vectors at the slices' ends, which are the checkpoints between tasks, and then all
slices are walked at once, from each state that they may be entered in. Texts take no part
in this: a turn is three letters, its turn number and a digest.

Inputs: null roles and texts count as one space, which makes such turns blank. A role that
begins with none of ``s``, ``u``, ``a`` cannot be kept. Rows without a ``conv_id`` are one
conversation. Repeated rows are turns like others. An empty table gives no rows. Texts of any
length are only digested. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import islice
from math import isqrt
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from landfold.llm.shared import materialise

#: Turns of a slice, about; a conversation with more is cut.
SLICE = 200_000

#: White space, and what ends a whole sentence.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
NEVER = 1 << 40

# States: nothing yet, after s, after u, after a. An insert can only be the role that is due.
_AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_DUE = (2, 2, 3, 2)
_START = 0
#: Costs of ending in each state, without and with inserts at the end.
_ACCEPTED = (0, NEVER, NEVER, 0)

Vector = tuple[int, int, int, int]


def _edits(role: str, fault: str) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """By state, the edits of one turn as (letter, cost, state after), in the order of their letters."""
    out = []
    for state in range(4):
        edits = [("D", DELETE, state)]
        if fault not in "bd":
            extra = TRUNCATED if fault == "t" else 0
            if role in _AFTER[state]:
                edits.append(("K", extra, _AFTER[state][role]))
            edits.append(("R", REROLE + extra, _DUE[state]))
        out.append(tuple(edits))
    return tuple(out)


EDITS = {r + f: _edits(r, f) for r in "suao" for f in "bdtc"}


def _with_inserts(v: tuple[int, ...] | list[int]) -> Vector:
    """The least costs where turns may be inserted first."""
    two, three = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return min(v[0], INSERT + two), min(v[1], INSERT + two), two, three


def _back(turn: str, after: Vector) -> Vector:
    """The cost vector before a turn from the one after it."""
    return _with_inserts([min(cost + after[to] for _, cost, to in edits) for edits in EDITS[turn]])


def through(turns: list[str]) -> list[Vector]:
    """For each state at the end, the costs to get there from each state at the start."""
    out = []
    for state in range(4):
        v: Vector = tuple(0 if s == state else NEVER for s in range(4))  # type: ignore[assignment]
        for turn in reversed(turns):
            v = _back(turn, v)
        out.append(v)
    return out


def walk(turns: list[str], end: Vector | None, states: list[int]) -> list[tuple[str, int, int]]:
    """For each state at the start: the initials of the ASCII-least tight edits, the state after them, their cost.

    ``end`` holds the costs of what follows; None stands for the conversation's end. Of the
    cost vectors, no more are held than two square roots of the number of turns.
    """
    n = len(turns)
    step = isqrt(n) + 1
    v = _with_inserts(_ACCEPTED) if end is None else end
    kept = {n: v}
    for i in range(n - 1, -1, -1):
        v = _back(turns[i], v)
        if i % step == 0:
            kept[i] = v
    at, letters, cost = list(states), [[] for _ in states], [v[s] for s in states]
    for start in range(0, n, step):
        stop = min(n, start + step)
        block = [kept[stop]]
        for i in range(stop - 1, start - 1, -1):
            block.append(_back(turns[i], block[-1]))
        block.reverse()
        for k, out in enumerate(letters):
            state = at[k]
            for i in range(start, stop):
                before, after = block[i - start], block[i - start + 1]
                edits = EDITS[turns[i]][state]
                while before[state] != edits[0][1] + after[state] and before[state] == INSERT + before[_DUE[state]]:
                    out.append("I")
                    state = _DUE[state]
                    edits = EDITS[turns[i]][state]
                letter, _, state = next(e for e in edits if e[1] + after[e[2]] == before[state])
                out.append(letter)
            at[k] = state
    if end is None:
        for k, out in enumerate(letters):
            while _ACCEPTED[at[k]]:
                out.append("I")
                at[k] = _DUE[at[k]]
    return [("".join(out), state, c) for out, state, c in zip(letters, at, cost, strict=True)]


def faults(turns: DataFrame) -> DataFrame:
    """``turns`` as conv_id, turn, role, text and what order and repair look at: digest and letters."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    seen = F.rtrim(text, F.lit(BLANKS))
    initial = F.substring(role, 1, 1)
    return turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.concat(
            F.when(initial.isin("s", "u", "a"), initial).otherwise("o"),
            F.when(seen == "", "b").when(~F.substring(seen, -1, 1).isin(*ENDS), "t").otherwise("c"),
        ).alias("letters"),
    )


_SCORED = (
    "conv_id {id}, slice int, many boolean, letters array<string>, costs array<bigint>, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first bigint, last bigint"
)
_LEGAL = {"su", "ua", "au"}


def _scored(row: dict[str, Any]) -> list[dict[str, Any]]:
    """Letters of a slice of a conversation with duplicates marked, its counts, and its sum of costs."""
    seen, letters, again = set(), [], set(row["again"] or ())
    for i, r in enumerate(row["rows"]):
        own, letter = (r["role"], r["digest"]), r["letters"]
        if letter[1] != "b" and (own in seen or i in again):
            letter = letter[0] + "d"
        seen.add(own)
        letters.append(letter)
    numbers = [r["turn"] for r in row["rows"] if r["turn"] is not None]
    kinds = [letter[1] for letter in letters]
    return [
        {
            "conv_id": row["conv_id"],
            "slice": row["slice"],
            "many": row["many"],
            "letters": letters,
            "costs": [c for v in through(letters) for c in v] if row["many"] else None,
            "blank": kinds.count("b"),
            "duplicate": kinds.count("d"),
            "truncated": kinds.count("t"),
            "illegal": sum(a[0] + b[0] not in _LEGAL for a, b in zip(letters, letters[1:])),
            "turns": len(set(numbers)),
            "first": numbers[0] if numbers else None,
            "last": numbers[-1] if numbers else None,
        }
    ]


def _ends(row: dict[str, Any]) -> list[dict[str, Any]]:
    """The checkpoint after each slice of a conversation, by folding the slices' sums from the end."""
    out, v = [], _with_inserts(_ACCEPTED)
    for part in reversed(row["parts"]):
        out.append({"conv_id": row["conv_id"], "slice": part["slice"], "end": list(v)})
        c = part["costs"]
        v = tuple(min(c[4 * q + p] + v[q] for q in range(4)) for p in range(4))
    out[0]["end"] = None
    return out


def _walked(row: dict[str, Any]) -> list[dict[str, Any]]:
    """A slice walked from each state it may be entered in: from the first one only where it is all there is."""
    found = walk(row["letters"], tuple(row["end"]) if row["end"] else None, [0, 1, 2, 3] if row["many"] else [_START])
    audits, exits, prices = (list(c) for c in zip(*found, strict=True))
    initials = row["letters"][0][0] + row["letters"][-1][0]
    kept = {k: v for k, v in row.items() if k not in ("letters", "costs", "end", "many")}
    return [kept | {"audits": audits, "exits": exits, "prices": prices, "initials": initials}]


def _joined(row: dict[str, Any]) -> list[dict[str, Any]]:
    """A conversation from its slices, each walked from the state that the one before ends in."""
    parts, state, audit = row["parts"], _START, []
    for part in parts:
        audit.append(part["audits"][state])
        state = part["exits"][state]
    total = {k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    for a, b in zip(parts, parts[1:]):
        total["illegal"] += a["initials"][1] + b["initials"][0] not in _LEGAL
        total["turns"] -= a["last"] is not None and a["last"] == b["first"]
    first = [p["first"] for p in parts if p["first"] is not None]
    last = [p["last"] for p in parts if p["last"] is not None]
    turns = total.pop("turns")
    return [
        total
        | {
            "conv_id": row["conv_id"],
            "gaps": last[-1] - first[0] + 1 - turns if first else 0,
            "cost": parts[0]["prices"][_START],
            "audit": "".join(audit),
        }
    ]


def _map(df: DataFrame, fn: Callable[[pa.Schema], Any], schema: str) -> DataFrame:
    return df.mapInArrow(fn(to_arrow_schema(StructType.fromDDL(schema))), schema)


def _map_rows(df: DataFrame, fn: Callable[[dict[str, Any]], list[dict[str, Any]]], ddl: str) -> DataFrame:
    """``fn`` of each row, a few dozen at a time."""

    def make(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    found = [out for row in batch.slice(at, 64).to_pylist() for out in fn(row)]
                    yield pa.RecordBatch.from_pylist(found, schema=schema)

        return run

    return _map(df, make, ddl)


def _slices(turns: DataFrame) -> DataFrame:
    """(conv_id, slice, many, rows, again): turns in order, cut into slices of bounded size.

    ``again`` holds the places of turns that an earlier slice of the conversation has too.
    """
    spark = turns.sparkSession
    light = faults(turns).select("conv_id", "turn", "role", "digest", "letters")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns.count() // SLICE))
    dealt = (
        light.withColumn("n", F.monotonically_increasing_id())
        .repartitionByRange(parts, "conv_id", "turn", "role", "digest", "n")
        .withColumn("slice", F.spark_partition_id())
    )
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "letters")))
    slices = materialise(dealt.groupBy("conv_id", "slice").agg(rows.alias("rows")), "slices")
    # A slice begins and ends inside one conversation at most, so few of them are cut.
    cut = slices.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("k")).where("k > 1").select("c")
    cut = materialise(cut.withColumn("is_cut", F.lit(True)), "cut")
    of_cut = slices.join(cut, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    first = (
        of_cut.select("conv_id", "slice", F.posexplode("rows").alias("i", "r"))
        .where(F.substring("r.letters", 2, 1) != "b")
        .groupBy("conv_id", "slice", "r.role", "r.digest")
        .agg(F.min("i").alias("i"))
    )
    first = materialise(first, "firsts")
    earliest = first.groupBy("conv_id", "role", "digest").agg(F.min("slice").alias("e"))
    earliest = earliest.select(*[F.col(k).alias(f"_{k}") for k in ("conv_id", "role", "digest")], "e")
    again = (
        first.join(
            earliest,
            F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role"))
            & (F.col("digest") == F.col("_digest")) & (F.col("slice") > F.col("e")),
        )
        .groupBy(F.col("conv_id").alias("a"), F.col("slice").alias("s"))
        .agg(F.collect_list("i").alias("again"))
    )
    return (
        slices.join(cut, F.col("conv_id").eqNullSafe(F.col("c")), "left")
        .join(again, F.col("conv_id").eqNullSafe(F.col("a")) & (F.col("slice") == F.col("s")), "left")
        .select(
            "conv_id",
            "slice",
            F.coalesce("is_cut", F.lit(False)).alias("many"),
            "rows",
            "again",
        )
    )


def plan_repairs(turns: DataFrame) -> DataFrame:
    """A row for each conversation: its faults, and the cost and initials of its cheapest edits.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit. ``gaps``
    counts the turn numbers that are missing between the least and the greatest, ``illegal``
    the neighbours whose initials are none of su, ua and au.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    scored = materialise(_map_rows(_slices(turns), _scored, _SCORED.format(id=kind)), "scored")
    folded = (
        scored.where("many")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("slice", "costs"))).alias("parts"))
    )
    ends = _map_rows(folded, _ends, f"conv_id {kind}, slice int, end array<bigint>")
    ends = ends.select(F.col("conv_id").alias("c"), F.col("slice").alias("s"), "end")
    known = scored.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s")), "left")
    counts = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
    walked = _map_rows(
        known.drop("c", "s"),
        _walked,
        f"conv_id {kind}, slice int, {counts}, turns bigint, first bigint, last bigint, initials string, "
        "audits array<string>, exits array<int>, prices array<bigint>",
    )
    parts = F.struct("slice", *[c for c in walked.columns if c not in ("conv_id", "slice")])
    whole = walked.groupBy("conv_id").agg(F.sort_array(F.collect_list(parts)).alias("parts"))
    return _map_rows(whole, _joined, f"conv_id {kind}, gaps bigint, {counts}, cost bigint, audit string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, bool, str, str, str]]:
    """What becomes of turns that follow their conversation's audit: (conv_id, new, edit, role, text) as a stream."""
    conv, audit, at, state, new = None, "", 0, _START, True

    def inserted() -> Iterator[tuple[Any, bool, str, str, str]]:
        nonlocal at, state, new
        while at < len(audit) and audit[at] == "I":
            state = _DUE[state]
            yield conv, new, "I", "user" if state == 2 else "assistant", ""
            at, new = at + 1, False

    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256).select(["conv_id", "audit", "role", "text"])
            for c, plan, role, text in zip(*(col.to_pylist() for col in part.columns), strict=True):
                if plan is not None:
                    yield from inserted()
                    conv, audit, at, state, new = c, plan, 0, _START, True
                    yield conv, True, "", "", ""
                    continue
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                if edit == "K":
                    state = _AFTER[state][role[0]]
                else:
                    state = _DUE[state]
                    role = "user" if state == 2 else "assistant"
                yield conv, new, edit, role, text
                new = False
    yield from inserted()


def _beside(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan and then its turns in order, together in a partition."""
    rows = faults(turns).select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "digest", "text")
    heads = plans.select("conv_id", "audit")
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn("_turn", F.col("audit").isNull())
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "_turn", "turn", "role", "digest")


def _batches(rows: Iterator[tuple[Any, ...]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a few hundred."""
    while held := list(islice(rows, 256)):
        columns = zip(zip(*held, strict=True), schema.types, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=schema)


def apply_repairs(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), edit (K, R or I), role and text.

    ``plans`` is what ``plan_repairs`` gave for the same turns. Texts are shuffled once and
    stream through their conversation's task, a batch at a time.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, place bigint, edit string, role string, text string"

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, ...]]:
        place = 0
        for conv, new, edit, role, text in _edited(batches):
            place = 0 if new else place + 1
            if edit:
                yield conv, place, edit, role, text

    return _map(_beside(turns, plans), lambda schema: lambda batches: _batches(placed(batches), schema), ddl)


def repaired_digests(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of each repaired conversation's ``role:text``, joined by newlines.

    SHA-256 has to see a conversation's text in order, so one task reads it, a batch at a time.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, repaired_sha256 string"

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, str]]:
        conv, sha = None, None
        for c, new, edit, role, text in _edited(batches):
            if edit:
                sha.update(f"{'' if new else chr(10)}{role}:{text}".encode())
                continue
            if sha is not None:
                yield conv, sha.hexdigest()
            conv, sha = c, hashlib.sha256()
        if sha is not None:
            yield conv, sha.hexdigest()

    return _map(_beside(turns, plans), lambda schema: lambda batches: _batches(digested(batches), schema), ddl)


def in_turn(expr: Column) -> Column:
    """``expr`` as text, one space where it is null."""
    return F.coalesce(expr.cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults that the checksum of ``conv_id:turn`` chooses, as contracts ask for.

    Modulo 20: 0 drops a turn, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes it the user's.
    """
    key = F.concat(in_turn(F.col("conv_id")), F.lit(":"), in_turn(F.col("turn")))
    text = in_turn(F.col("text"))
    return (
        conversations.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("_d"))
        .where("_d <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_d") == 4, "user").otherwise(in_turn(F.col("role"))).alias("role"),
            F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate(text, "".join(ENDS), "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )
