"""Reconciliation: queries that return the violating rows, none when all is well."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


class VerificationError(RuntimeError):
    """Some check returned violating rows."""


def scalar_mismatch(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-value tables; the pair is returned when the values differ."""
    (a,), (b,) = left.columns, right.columns
    return left.withColumn(b, right.scalar()).filter(~F.col(a).eqNullSafe(F.col(b)))


def tagged(df: DataFrame, tag: str, label: str, columns: Mapping[str, Column]) -> DataFrame:
    return df.select(F.lit(label).alias(tag), *[c.alias(name) for name, c in columns.items()])


def tagged_union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def expected_mismatch(
    expected: DataFrame, actual: DataFrame, key: str, tolerance: str, value: str, wanted: str
) -> DataFrame:
    """Expected values that the actual table misses or contradicts.

    Starting from the expected side makes a missing row a violation too.
    """
    off = F.abs(F.col(value) - F.col(wanted)) > F.col(tolerance)
    return expected.join(actual, key, "left").filter(F.col(value).isNull() | off)


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with its number of violations, all in one Spark job."""
    return tagged_union(
        [
            violations.agg(F.count("*").alias("n_violations")).select(
                F.lit(name).alias("check"), "n_violations"
            )
            for name, violations in checks.items()
        ]
    )


def verify(checks: Mapping[str, DataFrame], samples: int = 3) -> DataFrame:
    """The report; raises with up to ``samples`` rows of each check that failed."""
    result = report(checks)
    failed = [row.check for row in result.filter("n_violations > 0").orderBy("check").collect()]
    if failed:
        shown = {name: [row.asDict() for row in checks[name].take(samples)] for name in failed}
        raise VerificationError(f"checks failed: {shown}")
    return result
