from __future__ import annotations

import hashlib
import random
import re
from functools import cache

import pytest

from landfold.llm import turn_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TEXTS = ["Good.", "Cut", "  ", "", "Why?\n", "and then", "No!", None, "x" * 5000 + "."]
ROLES = ["user", "assistant", "system", "tool", "", None]


def ordered(rows):
    """A conversation's turns as (turn, role, text), as they are defined to be taken."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def cheapest(rows):
    """(cost, audit, lines) by looking at all edits from the end, and the faults."""
    faults, seen = [], set()
    for _, role, text in rows:
        visible = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not visible else "d" if (role, text) in seen else "c" if visible[-1] in ".!?" else "t")
        seen.add((role, text))

    @cache
    def rest(i, state, inserts):
        """``state`` is the initials so far, shortened to their last letter."""
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        due = "a" if state == "u" else "u"
        long = {"u": "user", "a": "assistant"}[due]
        if inserts < 2:
            c, a, t = rest(i, due, inserts + 1)
            options.append((c + 3, "I" + a, (f"{long}:", *t)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, t = rest(i + 1, state, 0)
            options.append((c + 4, "D" + a, t))
            if faults[i] in "ct":
                extra = 3 * (faults[i] == "t")
                if role[:1] == due or (state == "" and role[:1] == "s"):
                    c, a, t = rest(i + 1, role[0], 0)
                    options.append((c + extra, "K" + a, (f"{role}:{text}", *t)))
                c, a, t = rest(i + 1, due, 0)
                options.append((c + extra + 3, "R" + a, (f"{long}:{text}", *t)))
        return min(options, default=(10**9, "", ()))

    return rest(0, "", 0), faults


def expected(conversation):
    rows = ordered(conversation)
    (cost, audit, lines), faults = cheapest(rows)
    turns = [t for t, _, _ in rows if t is not None]
    first = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("b"),
        faults.count("d"),
        faults.count("t"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    ), lines


@pytest.mark.parametrize("slice_", [200_000, 7])
def test_against_all_edits(spark, monkeypatch, slice_):
    """Short conversations, a long one, one without an id; small slices cut them all."""
    monkeypatch.setattr(turn_repair, "SLICE", slice_)
    r = random.Random(5)
    conversations = {}
    for conv in [None, *range(60)]:
        n = 150 if conv == 7 else r.randint(1, 9)
        turn = [None if r.random() < 0.1 else r.randint(-1, n) for _ in range(n)]
        conversations[conv] = [(conv, t, r.choice(ROLES[: 3 if r.random() < 0.8 else 6]), r.choice(TEXTS)) for t in turn]
    rows = [row for c in conversations.values() for row in c]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS slice", "2 AS digest", "3 AS audit", "4 AS n")
    plans = turn_repair.plan_repairs(turns).cache()
    digests = {r["conv_id"]: r["repaired_sha256"] for r in turn_repair.repaired_digests(turns, plans).collect()}
    lines = {}
    for row in sorted(turn_repair.apply_repairs(turns, plans).collect(), key=lambda r: r["place"]):
        assert row["place"] == len(lines.setdefault(row["conv_id"], []))
        lines[row["conv_id"]].append(f"{row['role']}:{row['text']}")
    got = {p["conv_id"]: (*tuple(p)[1:], digests[p["conv_id"]]) for p in plans.collect()}
    assert got.keys() == conversations.keys()
    for conv, rows in conversations.items():
        want, kept = expected(rows)
        assert got[conv] == want
        assert lines.get(conv, []) == list(kept)
        initials = "".join(line[0] for line in kept)
        assert re.fullmatch("(s?(ua)+)?", initials)


def test_few_cost_vectors_are_held():
    """The walk of a long conversation equals that of one with all vectors, for each state it may begin in."""
    r = random.Random(2)
    turns = [r.choice("suao") + r.choice("bdtcc") for _ in range(3000)]
    whole = turn_repair.walk(turns, None, [0])[0]
    v = turn_repair.walk(turns[1700:], None, [0, 1, 2, 3])
    head = turn_repair.walk(turns[:1700], tuple(c for _, _, c in v), [0])[0]
    tail = v[head[1]]
    assert head[0] + tail[0] == whole[0] and head[2] == whole[2]


def test_empty_tables_and_damage(spark):
    none = spark.createDataFrame([], SCHEMA)
    plans = turn_repair.plan_repairs(none)
    assert plans.collect() == [] and turn_repair.repaired_digests(none, plans).collect() == []
    rows = [(c, t, "assistant", "A. b!") for c in (None, 1, 2) for t in (None, *range(40))]
    got = turn_repair.damage(spark.createDataFrame(rows, SCHEMA).withColumn("_d", turn_repair.F.lit(1))).collect()
    import zlib

    want = []
    for c, t, role, text in rows:
        m = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "A b"}.get(m, text)
        want += [(c, t, "user" if m == 4 else role, text)] * {0: 0, 3: 2}.get(m, 1)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
