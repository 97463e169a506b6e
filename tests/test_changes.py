from __future__ import annotations

import datetime as dt
import os
import random
import re
import shutil
from dataclasses import replace

import pytest

from landfold import ChangeRules, ChangeTable, HistoryRules, apply_changes, apply_changes_history
from landfold.operators.changes import unsequenced
from landfold.streaming.change_table import runs_to_merge

SCHEMA = "k STRING, seq INT, tie INT, op STRING, a INT, b STRING"


def random_changes(n, seed, truncates=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        op = rng.choices(["up", "del"], [9, 1])[0]
        rows.append(
            (
                rng.choice([None, "k1", "k2", "k3", "k4", "hot", "hot", "hot"]),
                rng.randrange(n // 3),
                i,
                op,
                rng.choice([None, rng.randrange(3)]),
                rng.choice([None, "x", "y"]),
            )
        )
    for i in range(truncates):
        rows.append((None, rng.randrange(n // 3), n + i, "trunc", None, None))
    rng.shuffle(rows)
    return rows


def one_by_one(rows, *, ignore_nulls, deletes=True, truncates=True):
    """Changes applied one after the other to a dictionary."""
    target = {}
    for k, seq, tie, op, a, b in sorted(rows, key=lambda r: (r[1], r[2])):
        if op == "trunc" and truncates:
            target.clear()
        elif op == "del" and deletes:
            target.pop(k, None)
        else:
            old = target.get(k, (None, None))
            target[k] = (
                (a if a is not None else old[0], b if b is not None else old[1])
                if ignore_nulls
                else (a, b)
            )
    return {k: v for k, v in target.items()}


def as_dict(df):
    return {r.k: (r.a, r.b) for r in df.select("k", "a", "b").collect()}


@pytest.mark.parametrize("ignore_nulls", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_one_by_one(spark, ignore_nulls, seed):
    rows = random_changes(300, seed, truncates=2)
    df = spark.createDataFrame(rows, SCHEMA)
    common = {"ignore_null_updates": ignore_nulls, "columns": ["a", "b"]}
    got = apply_changes(df, ["k"], ["seq", "tie"], delete_when="op = 'del'", truncate_when="op = 'trunc'", **common)
    assert as_dict(got) == one_by_one(rows, ignore_nulls=ignore_nulls)
    assert got.count() == len(as_dict(got))
    rows = [r for r in rows if r[3] != "trunc"]
    df = spark.createDataFrame(rows, SCHEMA)
    got = apply_changes(df, ["k"], ["seq", "tie"], delete_when="op = 'del'", **common)
    assert as_dict(got) == one_by_one(rows, ignore_nulls=ignore_nulls)
    got = apply_changes(df, ["k"], ["seq", "tie"], **common)
    assert as_dict(got) == one_by_one(rows, ignore_nulls=ignore_nulls, deletes=False)


def test_composite_keys_with_nulls(spark):
    df = spark.createDataFrame(
        [("a", None, 1, 1), ("a", None, 2, 2), (None, None, 1, 3), ("a", "b", 1, 4)],
        "k1 STRING, k2 STRING, seq INT, v INT",
    )
    got = {(r.k1, r.k2): r.v for r in apply_changes(df, ["k1", "k2"], "seq").collect()}
    assert got == {("a", None): 2, (None, None): 3, ("a", "b"): 4}


def test_column_lists(spark):
    df = spark.createDataFrame([("a", 1, 1, 2)], "k STRING, seq INT, x INT, y INT")
    assert apply_changes(df, ["k"], "seq").columns == ["k", "seq", "x", "y"]
    assert apply_changes(df, ["k"], "seq", columns=["y"]).columns == ["k", "y"]
    assert apply_changes(df, ["k"], "seq", except_columns=["seq", "x"]).columns == ["k", "y"]
    for wrong in (
        {"columns": ["y"], "except_columns": ["x"]}, {"columns": ["z"]}, {"except_columns": ["k"]},
    ):
        with pytest.raises(ValueError):
            apply_changes(df, ["k"], "seq", **wrong)
    with pytest.raises(ValueError):
        apply_changes(df, [], "seq")


def test_names_without_regard_to_case(spark):
    df = spark.createDataFrame([("a", 1, 2, 3), ("a", 2, 4, 5)], "Key STRING, Seq INT, Val INT, other INT")
    got = apply_changes(df, ["KEY"], "seq", columns=["vaL"])
    assert got.columns == ["Key", "Val"] and got.first() == ("a", 4)
    spans = apply_changes_history(df, ["key"], "SEQ", track_except=["OTHER"])
    assert spans.columns == ["Key", "Val", "other", "__START_AT", "__END_AT"]
    with pytest.raises(ValueError, match="reserved"):
        apply_changes_history(df.withColumnRenamed("other", "_Slice"), ["key"], "seq")
    with pytest.raises(ValueError, match="reserved"):
        apply_changes(df.withColumnRenamed("other", "_Row"), ["key"], "seq")


def test_rows_without_sequence_are_set_aside(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 1, 2), ("b", None, 3)], "k STRING, seq INT, v INT")
    rules = ChangeRules.of(df, ["k"], "seq")
    assert [(r.k, r.v) for r in apply_changes(df, ["k"], "seq").collect()] == [("a", 2)]
    assert sorted((r.k, r.v) for r in unsequenced(df, rules).collect()) == [("a", 1), ("b", 3)]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("a", 1, 1, "z"), ("a", 1, 2, "b")]
    seen = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k STRING, seq INT, v INT, w STRING").coalesce(1)
        r = apply_changes(df, ["k"], "seq", ignore_null_updates=False).first()
        seen.add((r.v, r.w))
    assert seen == {(2, "b")}


def test_types_without_order_are_refused(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1})], "k STRING, seq INT, m MAP<STRING, INT>")
    with pytest.raises(ValueError, match="without an order"):
        apply_changes(df, ["k"], "seq")


def test_rows_of_a_key_are_combined_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("'hot' AS k", "id AS seq", "id AS v")
    plan = apply_changes(df, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")  # printed from the top down


@pytest.mark.parametrize("batches", [1, 3, 8])
@pytest.mark.parametrize("ignore_nulls", [True, False])
def test_batches_replays_and_merges_change_nothing(spark, tmp_path, batches, ignore_nulls):
    rows = random_changes(240, batches, truncates=1)
    df = spark.createDataFrame(rows, SCHEMA)
    rules = ChangeRules.of(
        df, ["k"], ["seq", "tie"], columns=["a", "b"], ignore_null_updates=ignore_nulls,
        delete_when="op = 'del'", truncate_when="op = 'trunc'",
    )
    table = ChangeTable(spark, str(tmp_path / "t"), rules, fan_in=3, keep_for=0)
    for i in range(batches):
        part = spark.createDataFrame(rows[i::batches], SCHEMA)
        assert table.apply(part, batch_id=i)
        assert not table.apply(part, batch_id=i)
        if i % 2:
            table.apply(part, flow="again", batch_id=i)
    expected = one_by_one(rows, ignore_nulls=ignore_nulls)
    assert as_dict(table.read()) == expected
    reopened = ChangeTable.open(spark, str(tmp_path / "t"))
    assert reopened.rules == rules
    reopened.compact()
    assert as_dict(reopened.read()) == expected
    plan = reopened.state()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_batch_cut_short_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a", 1, 1, "up", 1, "x")], SCHEMA)
    rules = ChangeRules.of(df, ["k"], ["seq", "tie"], columns=["a", "b"])
    table = ChangeTable(spark, str(tmp_path / "t"), rules)
    table.apply(df, batch_id=0)
    later = spark.createDataFrame([("a", 2, 2, "up", 5, None), ("b", 2, 3, "up", 7, "y")], SCHEMA)

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ChangeTable, "_publish", crash)
        with pytest.raises(RuntimeError):
            table.apply(later, batch_id=1)
    assert as_dict(table.read()) == {"a": (1, "x")}
    assert table.apply(later, batch_id=1)
    assert as_dict(table.read()) == {"a": (5, "x"), "b": (7, "y")}


@pytest.mark.parametrize("ignore_nulls", [True, False])
def test_columns_may_be_added(spark, tmp_path, ignore_nulls):
    first = spark.createDataFrame([("x", 1, 1), ("y", 1, 2)], "k STRING, seq INT, b INT")
    second = spark.createDataFrame([("x", 2, 5, 6), ("z", 2, 7, 8)], "k STRING, seq INT, a INT, b INT")

    def table(df, columns):
        rules = ChangeRules.of(df, ["k"], "seq", columns=columns, ignore_null_updates=ignore_nulls)
        return ChangeTable(spark, str(tmp_path / "t"), rules, fan_in=2)

    for _ in range(3):
        table(first, ["b"]).apply(first)
    table(second, ["a", "b"]).apply(second)
    expected = {"x": (5, 6), "y": (None, 2), "z": (7, 8)}
    assert as_dict(ChangeTable.open(spark, str(tmp_path / "t")).read()) == expected
    table(second, ["a", "b"]).compact()
    assert as_dict(table(second, ["a", "b"]).read()) == expected
    with pytest.raises(ValueError, match="other rules"):
        table(first, ["b"])
    with pytest.raises(ValueError, match="changed their type"):
        table(second, ["a", "b"]).apply(second.withColumn("a", second.a.cast("string")))


def test_history_columns_may_be_added(spark, tmp_path):
    first = spark.createDataFrame([("x", 1, 1)], "k STRING, seq INT, a INT")
    second = spark.createDataFrame([("x", 2, 1, None), ("x", 3, 1, "n")], "k STRING, seq INT, a INT, b STRING")
    for df in (first, second):
        rules = HistoryRules.of(df, ["k"], "seq")
        ChangeTable(spark, str(tmp_path / "t"), rules).apply(df)
    got = ChangeTable.open(spark, str(tmp_path / "t")).read()
    assert as_spans(got) == {("x", 1, None, 1, 3), ("x", 1, "n", 3, None)}


def test_merged_runs_stay_for_their_readers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1, "up", 1, "x")], SCHEMA)
    rules = ChangeRules.of(df, ["k"], ["seq", "tie"], columns=["a", "b"])

    def runs():
        return {p.name for p in (tmp_path / "t" / "runs").iterdir()}

    table = ChangeTable(spark, str(tmp_path / "t"), rules, fan_in=2)
    table.apply(df)
    reading = table.read()
    for _ in range(12):
        table.apply(df)
    assert as_dict(reading) == {"a": (1, "x")}
    assert len(list((tmp_path / "t" / "manifests").glob("*.json"))) == 5
    assert len(runs()) > len(table._manifest().runs)
    table = ChangeTable(spark, str(tmp_path / "t"), rules, fan_in=2, keep_for=0)
    table.apply(df)
    assert runs() == {run.name for run in table._manifest().runs}


@pytest.mark.parametrize("kind", [ChangeRules, HistoryRules])
def test_a_batch_with_nothing_adds_no_run(spark, tmp_path, kind):
    df = spark.createDataFrame([("a", 1, 1, "up", 1, "x")], SCHEMA)
    rules = kind.of(df, ["k"], "seq", columns=["a", "b"])
    table = ChangeTable(spark, str(tmp_path / "t"), rules)
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.apply(df.where("false"), batch_id=0)
    assert table.read().collect() == []
    assert not table.apply(df, batch_id=0)
    assert table.apply(df, batch_id=1)
    assert as_dict(table.read()) == {"a": (1, "x")}
    assert len(table._manifest().runs) == 1


def test_other_rules_need_another_table(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1, "up", 1, "x")], SCHEMA)
    rules = ChangeRules.of(df, ["k"], ["seq", "tie"], columns=["a", "b"])
    ChangeTable(spark, str(tmp_path / "t"), rules).apply(df)
    with pytest.raises(ValueError, match="other rules"):
        ChangeTable(spark, str(tmp_path / "t"), replace(rules, ignore_null_updates=False))
    with pytest.raises(FileNotFoundError):
        ChangeTable.open(spark, str(tmp_path / "none"))


def test_rows_are_rewritten_a_logarithm_of_times():
    sizes, written, most = [], 0, 0
    for _ in range(1000):
        sizes.append(1)
        written += 1
        start = runs_to_merge(sizes, 4)
        if start is not None:
            written += sum(sizes[start:])
            sizes = [*sizes[:start], sum(sizes[start:])]
        most = max(most, len(sizes))
    assert sum(sizes) == 1000
    assert most <= 14
    assert written <= 1000 * 11


# --- history ----------------------------------------------------------------


def spans_one_by_one(rows, *, tracked, ignore_nulls):
    """History of each key from a plain walk over its versions."""
    latest = {}
    for k, seq, tie, op, a, b in rows:
        if (k, seq) not in latest or latest[k, seq][0] < tie:
            latest[k, seq] = (tie, op, a, b)
    by_key = {}
    for (k, seq), (_, op, a, b) in latest.items():
        by_key.setdefault(k, []).append((seq, op, {"a": a, "b": b}))
    out = set()
    for k, changes in by_key.items():
        spans, open_span, held = [], None, {}
        for seq, op, vals in sorted(changes, key=lambda c: c[0]):
            if op == "del":
                if open_span:
                    open_span["end"] = seq
                open_span, held = None, {}
                continue
            if ignore_nulls:
                vals = {c: held.get(c) if v is None else v for c, v in vals.items()}
            if open_span is None or any(vals[c] != held[c] for c in tracked):
                if open_span:
                    open_span["end"] = seq
                open_span = {"start": seq, "end": None}
                spans.append(open_span)
            open_span["vals"], held = vals, vals
        out |= {(k, s["vals"]["a"], s["vals"]["b"], s["start"], s["end"]) for s in spans}
    return out


def as_spans(df):
    rows = [(r.k, r.a, r.b, r["__START_AT"], r["__END_AT"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("ignore_nulls", [False, True])
@pytest.mark.parametrize("tracked", [["a", "b"], ["a"], ["b"]])
def test_history_same_as_a_walk(spark, ignore_nulls, tracked):
    rows = random_changes(400, 7)
    got = apply_changes_history(
        spark.createDataFrame(rows, SCHEMA).repartition(5), ["k"], "seq", tie_breakers=["tie"],
        columns=["a", "b"], track=tracked, ignore_null_updates=ignore_nulls, delete_when="op = 'del'",
    )
    assert as_spans(got) == spans_one_by_one(rows, tracked=tracked, ignore_nulls=ignore_nulls)


def test_a_hot_key_is_cut_into_slices(spark):
    rows = [("hot", i, 0, "up", (i // 3) % 2, None) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = apply_changes_history(df, ["k"], "seq", columns=["a", "b"], tie_breakers=["tie"])
        assert as_spans(got) == spans_one_by_one(rows, tracked=["a", "b"], ignore_nulls=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_history_of_late_batches(spark, tmp_path):
    rows = random_changes(200, 11)
    df = spark.createDataFrame(rows, SCHEMA)
    rules = HistoryRules.of(
        df, ["k"], "seq", tie_breakers=["tie"], columns=["a", "b"], track_except=["b"],
        delete_when="op = 'del'",
    )
    assert rules.tracked == ("a",)
    table = ChangeTable(spark, str(tmp_path / "t"), rules, fan_in=2)
    for i in range(4):
        table.apply(spark.createDataFrame(rows[i::4], SCHEMA), batch_id=i)
    expected = spans_one_by_one(rows, tracked=["a"], ignore_nulls=True)
    table = ChangeTable.open(spark, str(tmp_path / "t"))
    assert as_spans(table.read()) == expected
    assert as_spans(table.read("k = 'hot'")) == {s for s in expected if s[0] == "hot"}
    assert as_spans(table.read("k IS NULL")) == {s for s in expected if s[0] is None}
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        table.read("a = 1")


@pytest.mark.parametrize("buckets", [1, 3])
def test_reading_a_stored_history_writes_nothing(spark, tmp_path, buckets):
    rows = random_changes(200, 12)
    df = spark.createDataFrame(rows, SCHEMA)
    rules = HistoryRules.of(df, ["k"], "seq", tie_breakers=["tie"], columns=["a", "b"], delete_when="op = 'del'")
    table = ChangeTable(spark, str(tmp_path / "t"), rules, buckets=buckets, keep_for=0, fan_in=2)
    for i in range(5):
        table.apply(spark.createDataFrame(rows[i::5], SCHEMA))
    files = lambda: sorted(str(p) for p in tmp_path.rglob("*"))
    before, scratch = files(), spark.conf.get("spark.checkpoint.dir")
    shared = sorted(os.listdir(scratch))
    table = ChangeTable.open(spark, str(tmp_path / "t"))
    assert as_spans(table.read()) == spans_one_by_one(rows, tracked=["a", "b"], ignore_nulls=True)
    assert (files(), sorted(os.listdir(scratch))) == (before, shared)
    assert not any("scratch/" in f for f in before)
    assert len(list((tmp_path / "t" / "history").iterdir())) <= buckets
    with pytest.raises(ValueError, match="buckets"):
        ChangeTable(spark, str(tmp_path / "t"), rules, buckets=buckets + 1)


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i}", 1, 1, "up", i, "x") for i in range(40)], SCHEMA)
    rules = HistoryRules.of(df, ["k"], "seq", columns=["a", "b"])
    table = ChangeTable(spark, str(tmp_path / "t"), rules, buckets=8)
    table.apply(df)
    table.apply(spark.createDataFrame([("k7", 2, 1, "up", 99, "x")], SCHEMA))
    held = table._manifest().history
    assert sorted(list(held.values()).count(f) for f in set(held.values())) == [1, len(held) - 1]
    got = {r for r in as_spans(table.read()) if r[0] == "k7"}
    assert got == {("k7", 7, "x", 1, 2), ("k7", 99, "x", 2, None)}
    assert table.read().count() == 41


def test_history_of_timestamps(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([("a", t[0], 1), ("a", t[1], 1), ("a", t[2], 2)], "k STRING, at TIMESTAMP, v INT")
    got = apply_changes_history(df, ["k"], "at")
    assert got.columns == ["k", "v", "__START_AT", "__END_AT"]
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, t[0], t[2]), ("a", 2, t[2], None)]


def test_history_arguments(spark):
    df = spark.createDataFrame([], SCHEMA)
    for wrong in ({"track": ["a"], "track_except": ["b"]}, {"track": ["zz"]}):
        with pytest.raises(ValueError):
            HistoryRules.of(df, ["k"], "seq", **wrong)
    with pytest.raises(ValueError):
        HistoryRules.of(df, ["k", "seq"], "seq")
    with pytest.raises(ValueError, match="reserved"):
        HistoryRules.of(df.withColumnRenamed("b", "_old_a"), ["k"], "seq")


def _in_batches(spark, path, batches, rules, **options):
    table = ChangeTable(spark, str(path), rules, **options)
    for batch in batches:
        table.apply(spark.createDataFrame(batch, SCHEMA))
    return table


@pytest.mark.parametrize(
    ("ignore_nulls", "tracked", "order"),
    [(True, ["a"], "as they come"), (True, ["a", "b"], "late"), (True, ["a"], "mixed"), (False, ["a"], "mixed")],
)
def test_spliced_batches_same_as_a_walk(spark, tmp_path, ignore_nulls, tracked, order):
    """Batches after, before and between what is stored, with deletes, ties and null keys."""
    rows = random_changes(160, 21)
    if order != "mixed":
        rows = sorted(rows, key=lambda r: r[1], reverse=order == "late")
    batches = [rows[:70], rows[70:120], rows[120:]] if order != "mixed" else [rows[i::3] for i in range(3)]
    rules = HistoryRules.of(
        spark.createDataFrame(rows, SCHEMA), ["k"], "seq", tie_breakers=["tie"], columns=["a", "b"], track=tracked,
        ignore_null_updates=ignore_nulls, delete_when="op = 'del'",
    )
    table = _in_batches(spark, tmp_path / "t", batches, rules, buckets=3, fan_in=2)
    assert as_spans(table.read()) == spans_one_by_one(rows, tracked=tracked, ignore_nulls=ignore_nulls)


def test_late_deletes_and_equal_sequences(spark, tmp_path):
    """A delete without a span before it, one between spans, and a change that replaces a delete."""
    batches = [
        [("x", 9, 1, "del", None, None), ("y", 5, 1, "up", 1, "p"), ("y", 9, 1, "up", 2, "q"), ("z", 4, 1, "up", 1, "m"), ("z", 6, 1, "del", None, None)],
        [("x", 3, 1, "up", 1, "a"), ("y", 7, 1, "del", None, None), ("z", 6, 2, "up", 2, None)],
        [("x", 12, 1, "up", None, "b"), ("y", 9, 2, "up", 1, None), ("z", 5, 1, "up", None, "n")],
    ]
    rows = [r for b in batches for r in b]
    rules = HistoryRules.of(
        spark.createDataFrame(rows, SCHEMA), ["k"], "seq", tie_breakers=["tie"], columns=["a", "b"], delete_when="op = 'del'"
    )
    for n in range(1, 4):
        table = _in_batches(spark, tmp_path / str(n), batches[:n], rules, buckets=2)
        held = [r for b in batches[:n] for r in b]
        assert as_spans(table.read()) == spans_one_by_one(held, tracked=["a", "b"], ignore_nulls=True)


def _rows_in(spark, path):
    return spark.read.parquet(str(path)).count() if path.exists() else 0


def test_a_splice_reads_and_rewrites_its_own_buckets_only(spark, tmp_path):
    """2000 keys with three versions each, 60 of which change: what the batch must not read is gone."""
    first = [(f"k{i}", s, 1, "up", s * i, "x") for i in range(2000) for s in (1, 2, 3)]
    rules = HistoryRules.of(spark.createDataFrame(first, SCHEMA), ["k"], "seq", columns=["a", "b"])
    table = _in_batches(spark, tmp_path / "t", [first], rules, buckets=256)
    held = table._manifest()
    changed = [(f"k{i}", 4, 1, "up", -1, "y") for i in range(60)]
    touched = {
        str(r[0]) for r in spark.createDataFrame(changed, SCHEMA).select(table._bucket()).distinct().collect()
    }
    assert len(touched) < 60
    for run in held.runs:  # no version is read again
        shutil.rmtree(tmp_path / "t" / "runs" / run.name)
    for folder in held.folders():
        for part in (tmp_path / "t" / "history" / folder).glob("_part=*/_bucket=*"):
            if part.name.removeprefix("_bucket=") not in touched or part.parent.name == "_part=closed":
                for file in part.glob("*"):
                    file.write_bytes(b"not read")
                (part / f".{next(iter(part.glob('part-*'))).name}.crc").unlink(missing_ok=True)
    table.apply(spark.createDataFrame(changed, SCHEMA))
    now = table._manifest()
    (new,) = now.folders() - held.folders()
    assert {b for b, name in now.history.items() if name == new} == touched
    # Open rows of the touched buckets (a span and a mark each), and one closed span for each change.
    in_touched = sum(1 for i in range(2000) if _bucket_of(spark, table, f"k{i}") in touched)
    assert _rows_in(spark, tmp_path / "t" / "history" / new / "_part=closed") == 60
    assert _rows_in(spark, tmp_path / "t" / "history" / new / "_part=open") == 2 * in_touched


def _bucket_of(spark, table, key, held={}):  # noqa: B006
    if id(table) not in held:
        keys = spark.createDataFrame([(f"k{i}",) for i in range(2000)], "k STRING")
        held[id(table)] = {r["k"]: str(r["_bucket"]) for r in keys.select("k", table._bucket()).collect()}
    return held[id(table)][key]


def test_a_late_change_reads_versions_from_the_span_before(spark, tmp_path):
    """Versions of other buckets are gone, and closed spans of other buckets stay where they are."""
    first = [(f"k{i}", s, 1, "up", s * i, "x") for i in range(1, 41) for s in (10, 20, 30, 40)]
    rules = HistoryRules.of(spark.createDataFrame(first, SCHEMA), ["k"], "seq", columns=["a", "b"])
    table = _in_batches(spark, tmp_path / "t", [first], rules, buckets=16)
    held = table._manifest()
    late = [("k7", 25, 1, "up", -5, None)]
    (own,) = {str(r[0]) for r in spark.createDataFrame(late, SCHEMA).select(table._bucket()).collect()}
    for run in held.runs:
        for part in (tmp_path / "t" / "runs" / run.name).glob("_bucket=*"):
            if part.name != f"_bucket={own}":
                shutil.rmtree(part)
    table.apply(spark.createDataFrame(late, SCHEMA))
    now = table._manifest()
    assert {b for b in now.closed if now.closed[b] != [list(x) for x in held.closed[b]] and now.closed[b] != held.closed[b]} == {own}
    assert as_spans(table.read()) == spans_one_by_one(first + late, tracked=["a", "b"], ignore_nulls=True)
