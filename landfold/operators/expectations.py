"""Row expectations: note, drop or refuse rows that break a rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


def _condition(rule: str | Column) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def _holds(rule: str | Column) -> Column:
    # A rule that comes out null does not hold.
    return F.coalesce(_condition(rule), F.lit(False))


def expect(
    df: DataFrame,
    rules: Mapping[str, str | Column],
    *,
    action: str = "warn",
    observe: Observation | str | None = None,
) -> DataFrame:
    """Check named rules on every row.

    ``warn`` lets all rows pass, ``drop`` keeps those that meet every rule and
    ``fail`` stops the query at the first that does not. With ``observe`` the
    broken rows are counted per rule while the query runs, without a pass of
    their own.
    """
    if action not in ACTIONS:
        raise ValueError(f"action must be one of {ACTIONS}")
    if not rules:
        return df
    if observe is not None:
        counts = [F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items()]
        df = df.observe(observe, F.count(F.lit(1)).alias("rows"), *counts)
    if action == "warn":
        return df
    if action == "drop":
        for rule in rules.values():
            df = df.where(_holds(rule))
        return df
    for name, rule in rules.items():
        df = df.where(
            F.when(_holds(rule), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"expectation {name!r} is broken")).cast("boolean")
            )
        )
    return df


def broken_rules(rules: Mapping[str, str | Column]) -> Column:
    """Names of the rules that a row breaks, as an array."""
    return F.array_compact(
        F.array(*[F.when(~_holds(rule), F.lit(name)) for name, rule in rules.items()]).cast("array<string>")
    )


def violations(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Rows that break a rule, with the names of those they break in ``broken``."""
    return df.withColumn("broken", broken_rules(rules)).where(F.size("broken") > 0)
