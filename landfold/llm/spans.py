"""Spans of pattern matches in a text, as column expressions.

A span is a struct of kind, start and end; start and end count code points and end is
exclusive. Patterns must not match the empty string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfold.llm.shared import let

SPAN = "struct<kind:string,start:int,end:int>"
#: Matches whose places are summed up in one go; a text's matches are cut into such slices.
_SLICE = 128


def find(text: Column, pattern: str | Column, kind: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the leftmost non-overlapping matches whose text ``keep`` accepts, in order."""
    found = matches(text, pattern)
    if keep is not None:
        found = F.filter(found, lambda m: keep(m["text"]))
    return F.transform(
        found,
        lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")
        ).cast(SPAN),
    )


def matches(text: Column, pattern: str | Column) -> Column:
    """Array of struct(start, end, text) of all matches of a pattern."""
    kind = "array<struct<start:int,end:int,text:string>>"
    none = F.array().cast(kind)
    of = F.lit(pattern) if isinstance(pattern, str) else pattern
    return let(
        F.struct(text.alias("whole"), F.regexp_extract_all(text, of, 0).alias("found")),
        lambda s: F.when(F.size(s["found"]) == 0, none).otherwise(
            let(
                # What lies before each match; what lies behind the last is of no use.
                F.slice(F.split(s["whole"], of, -1), F.lit(1), F.size(s["found"])),
                lambda gaps: _placed(gaps, s["found"]),
            ).cast(kind)
        ),
    )


def _placed(gaps: Column, found: Column) -> Column:
    pairs = F.zip_with(
        gaps,
        found,
        lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("length"), m.alias("text")),
    )
    return let(
        pairs,
        lambda p: let(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(p) - 1) / _SLICE).cast("int")),
                lambda i: F.slice(p, i * _SLICE + 1, F.lit(_SLICE)),
            ),
            lambda slices: let(
                F.transform(
                    slices,
                    lambda s: F.aggregate(s, F.lit(0), lambda n, x: n + x["gap"] + x["length"]),
                ),
                lambda sums: F.flatten(
                    F.transform(
                        slices,
                        lambda s, i: _run(
                            s, F.aggregate(F.slice(sums, F.lit(1), i), F.lit(0), lambda n, x: n + x)
                        ),
                    )
                ),
            ),
        ),
    )


def _run(pairs: Column, at: Column) -> Column:
    """Matches of one slice whose first gap starts at ``at``."""
    out = "array<struct<start:int,end:int,text:string>>"
    return F.aggregate(
        pairs,
        F.struct(at.alias("at"), F.array().cast(out).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["length"]).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + x["gap"]).alias("start"),
                        (acc["at"] + x["gap"] + x["length"]).alias("end"),
                        x["text"].alias("text"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )


def in_order(spans: Column, kinds: list[str]) -> Column:
    """Spans by start, then by kind as listed, then by end."""
    rank = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(rank, s["kind"]).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """The text with each span replaced by its label; spans that overlap become one, labelled as the first."""
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )

    def piece(whole: Column, past: Column, s: Column) -> Column:
        before = F.substring(whole, past + 1, F.greatest(s["start"] - past, F.lit(0)))
        name = F.when(s["start"] >= past, label(s["kind"])).otherwise(F.lit(""))
        return F.when(s["end"] <= past, F.lit("")).otherwise(F.concat(before, name))

    def part(whole: Column, past: Column, some: Column) -> Column:
        """What a slice of the spans makes of the text from ``past`` on."""
        return F.aggregate(
            some,
            F.struct(past.alias("past"), F.array().cast("array<string>").alias("out")),
            lambda a, s: F.struct(
                F.greatest(a["past"], s["end"]).alias("past"),
                F.concat(a["out"], F.array(piece(whole, a["past"], s))).alias("out"),
            ),
        )

    def joined_up(t: Column) -> Column:
        slices = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(t["spans"]) - 1) / _SLICE).cast("int")),
            lambda i: F.slice(t["spans"], i * _SLICE + 1, F.lit(_SLICE)),
        )
        return F.aggregate(
            slices,
            F.struct(F.lit(0).alias("past"), F.lit("").alias("out")),
            lambda a, some: let(
                part(t["whole"], a["past"], some),
                lambda r: F.struct(
                    r["past"].alias("past"), F.concat(a["out"], F.array_join(r["out"], "")).alias("out")
                ),
            ),
            lambda a: F.concat(a["out"], F.substring(t["whole"], a["past"] + 1, F.length(t["whole"]))),
        )

    return F.when(F.size(spans) == 0, text).otherwise(
        let(F.struct(text.alias("whole"), ordered.alias("spans")), joined_up)
    )
