"""Latest version per key, column by column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    version: Sequence[str],
    columns: Mapping[str, Column] | Sequence[str],
) -> DataFrame:
    """For each key, the newest non-NULL value of every column.

    A grouped ``max_by`` keeps one candidate per key and task before the shuffle, so a
    key with millions of versions costs one row per task; a window would bring them all
    to one. Further ``version`` columns break ties of the first.
    """
    state = latest_state(df, key, version, columns)
    return state.select(*[name for name in state.columns if not name.endswith(SINCE)])


# Ends the name of the column that holds the version a value is from.
SINCE = "_since"


def latest_state(
    df: DataFrame,
    key: str | Sequence[str],
    version: Sequence[str],
    columns: Mapping[str, Column] | Sequence[str],
) -> DataFrame:
    """``latest_per_key`` with the version of each value beside it, so that it can be kept and
    merged with the state of rows that come later."""
    if not isinstance(columns, Mapping):
        columns = {name: F.col(name) for name in columns}
    newest = F.struct(*version) if len(version) > 1 else F.col(version[0])
    kept = []
    for name, value in columns.items():
        # An aggregate ignores the rows where the ordering is NULL, hence the CASE.
        known = F.when(value.isNotNull(), newest)
        kept += [F.max_by(value, known).alias(name), F.max(known).alias(f"{name}{SINCE}")]
    return df.groupBy(*([key] if isinstance(key, str) else key)).agg(*kept)


def merged_state(one: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The state of all rows from the states of two parts of them."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = []
    for name in one.columns:
        if name not in keys and not name.endswith(SINCE):
            since = f"{name}{SINCE}"
            kept += [F.max_by(name, since).alias(name), F.max(since).alias(since)]
    return one.unionByName(other).groupBy(*keys).agg(*kept)
