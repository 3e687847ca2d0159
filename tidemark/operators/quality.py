"""Quality rules evaluated in one pass: what to keep, and a journal of what broke."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coding import any_of

JOURNAL = ("source", "natural_key", "rule", "detail", "detected_at")


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a violating row; only ``drops`` rules remove the row."""

    code: str
    broken: Column
    detail: Column = field(default_factory=lambda: F.lit(""))
    drops: bool = True

    @property
    def fires(self) -> Column:
        return F.coalesce(self.broken, F.lit(False))


def kept(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break no dropping rule."""
    dropping = [rule.fires for rule in rules if rule.drops]
    return df.filter(~any_of(dropping)) if dropping else df


def rejects(
    df: DataFrame,
    rules: Sequence[Rule],
    source: str,
    natural_key: Column,
    detected_at: datetime | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """One journal row per broken rule, so a row that breaks two appears twice."""
    entries = [
        F.when(
            rule.fires,
            F.struct(
                F.lit(rule.code).alias("rule"), F.coalesce(rule.detail, F.lit("")).alias("detail")
            ),
        )
        for rule in rules
    ]
    stamp = F.current_timestamp() if detected_at is None else F.lit(detected_at)
    return (
        df.filter(any_of([rule.fires for rule in rules]))
        .select(
            natural_key.alias("natural_key"),
            F.explode(F.array_compact(F.array(*entries))).alias("_e"),
            *carried,
        )
        .select(
            F.lit(source).alias("source"),
            "natural_key",
            F.col("_e.rule").alias("rule"),
            F.col("_e.detail").alias("detail"),
            F.date_trunc("second", stamp).alias("detected_at"),
            *carried,
        )
    )


def journal(parts: Sequence[DataFrame]) -> DataFrame:
    """All sources' rejects as one table; carried columns are NULL where a source has none."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def summary(rejected: DataFrame) -> DataFrame:
    return (
        rejected.groupBy("source", "rule")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "source", "rule")
    )
