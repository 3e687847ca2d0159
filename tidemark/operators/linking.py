"""Joins against reference tables: lookups, gaps, observed codes, orphans.

No side is ever hinted for broadcast: Spark compares the size it knows (from the files,
or from the finished shuffle under adaptive execution) with its own limit, and shuffles
both sides when the reference is larger. Facts linked to large parents go through
``skew.link``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coding import flag


def lookup(df: DataFrame, reference: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to a reference that has one row per key."""
    return df.join(reference, [on] if isinstance(on, str) else list(on), "left")


def mark_known(df: DataFrame, reference: DataFrame, key: str, mark: str) -> DataFrame:
    """Add a boolean telling whether ``key`` is in the reference; rows never multiply.

    The distinct keys are partitioned by more than the join needs, so the join shuffles them
    once more; with a shuffle right below it on both sides, a skewed key of ``df`` is split.
    """
    known = reference.select(key, F.xxhash64(key).alias("_finer")).distinct()
    marked = lookup(df, known.select(key, F.lit(True).alias(mark)), key)
    return marked.withColumn(mark, F.coalesce(mark, F.lit(False)))


def only_known(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    return df.join(reference.select(key), key, "left_semi")


def only_unknown(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key is missing from the reference; unlike NOT IN, NULLs do no harm."""
    return df.join(reference.select(key), key, "left_anti")


def observed_codes(reference: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """The part of a reference that facts use. Codes are reduced before the shuffle."""
    return reference.join(facts.select(key).distinct(), key, "left_semi")


def enrich_with_gaps(
    listed: DataFrame,
    description: DataFrame,
    key: str,
    labels: Sequence[str],
    values: Sequence[str],
    described: str,
    missing: str,
) -> DataFrame:
    """Every listed row once described; gaps are kept, flagged and labelled ``missing``."""
    matched = description.select(key, *labels, *values, F.lit(True).alias("_found"))
    found = F.col("_found").isNotNull()
    return lookup(listed, matched, key).select(
        *listed.columns,
        *[F.when(found, F.col(name)).otherwise(F.lit(missing)).alias(name) for name in labels],
        *[F.col(name) for name in values],
        flag(found).alias(described),
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill the columns a missed left join leaves NULL with the type's default."""
    filled: dict[str, Column] = {
        name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()
    }
    return df.withColumns(filled)
