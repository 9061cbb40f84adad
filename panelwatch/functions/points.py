"""Additive point rules: each rule gives the points of its first tier that holds."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Tier(NamedTuple):
    """``holds`` and ``reason`` are SQL expressions over a firm's feature row."""

    holds: str
    points: int
    reason: str | None = None


class Rule(NamedTuple):
    """``needs`` names the feature columns without which the rule is left out of the plan."""

    needs: tuple[str, ...]
    tiers: tuple[Tier, ...]


def usable(rules: list[Rule], columns: list[str]) -> list[Rule]:
    return [rule for rule in rules if set(rule.needs) <= set(columns)]


def points_sql(rules: list[Rule]) -> str:
    cases = (
        "CASE " + " ".join(f"WHEN {t.holds} THEN {t.points}" for t in rule.tiers) + " ELSE 0 END" for rule in rules
    )
    return " + ".join(["0", *cases])


def reasons_sql(rules: list[Rule]) -> str:
    """Reasons of all rules that hold, in rule order, joined by '; '."""
    cases = (
        "CASE " + " ".join(f"WHEN {t.holds} THEN {t.reason or 'NULL'}" for t in rule.tiers) + " END" for rule in rules
    )
    return f"array_join(array_compact(cast(array({', '.join(cases)}) AS array<string>)), '; ')"


def total_points(rules: list[Rule]) -> Column:
    return F.expr(points_sql(rules))


def joined_reasons(rules: list[Rule]) -> Column:
    return F.expr(reasons_sql(rules))


def with_score(df: DataFrame, rules: list[Rule], score: str, reasons: str | None = None) -> DataFrame:
    """Add the score (and the reason text) of the rules whose columns ``df`` has."""
    live = usable(rules, df.columns)
    added = {score: total_points(live)}
    if reasons is not None:
        added[reasons] = joined_reasons(live)
    return df.withColumns(added)
