"""Measures over groups and sequences: shares, next events, protected cohorts, top rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numbers import percent
from tidemark.functions.timestamps import calendar_days
from tidemark.operators.skew import heat, key_hash
from tidemark.session import written

K_MIN = 5


def share_of_total(grouped: DataFrame, count: str, share: str, digits: int = 1) -> DataFrame:
    """Each group's percentage of the sum over all groups.

    The total is a scalar subquery over the grouped rows (whose shuffle is reused), so
    groups stay spread out; an unpartitioned window would move them all to one task.
    """
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(share, percent(F.col(count), total, digits))


def subjects_per_group(df: DataFrame, keys: Sequence[str], subject: str, count: str) -> DataFrame:
    """Exact distinct subjects per group.

    Repeats of a (group, subject) pair vanish before the shuffle, which is on the pair:
    a group holding a third of the rows is counted by many tasks.
    """
    return df.groupBy(*keys).agg(F.count_distinct(subject).alias(count))


def k_anonymous(
    df: DataFrame, keys: Sequence[str], subject: str, count: str = "n", k: int = K_MIN
) -> DataFrame:
    """Distinct subjects per group, groups below ``k`` subjects left out."""
    return subjects_per_group(df, keys, subject, count).filter(F.col(count) >= k)


def next_event(
    df: DataFrame,
    key: str,
    at: str,
    tie_break: str,
    name: str,
    hot: Iterable[int] | None = None,
) -> DataFrame:
    """Add the time of the same key's next event, NULL for its last.

    Events without a time come first; rows equal in key, time and ``tie_break`` follow one
    another. Ordinary keys are one window each. The rows of hot keys (hashes, see ``skew.heat``)
    are cut into ordered pieces, see ``ordered_pieces``: a window runs inside each piece, and the
    last row of a piece takes the time of the first in the next from a table with one row per
    key and piece. So no task gets more than a piece, even of rows that agree in everything.
    """
    hot = heat(df, [key]) if hot is None else hot
    window = Window.partitionBy(key).orderBy(at, tie_break)
    if not hot:
        return df.withColumn(name, F.lead(at).over(window))
    is_hot = key_hash([key]).isin(*hot)
    pieces = ordered_pieces(df.filter(is_hot), [key, at, tie_break])
    # One struct is the join key, since a NULL key inside it equals another.
    pieces = pieces.withColumn("_spot", F.struct(F.col(key).alias("key"), "_piece"))
    first = F.when(F.count("*") == F.count(at), F.min(at)).alias("_first")  # no time comes first
    along = Window.partitionBy("_spot.key").orderBy("_spot._piece")
    firsts = pieces.groupBy("_spot").agg(first).select("_spot", F.lead("_first").over(along).alias("_carry"))
    inside = Window.partitionBy("_spot").orderBy(at, tie_break, "_row")
    led = pieces.withColumns({name: F.lead(at).over(inside), "_inner": F.lead(F.lit(True)).over(inside)})
    carried = led.join(firsts, "_spot").withColumn(name, F.when(F.col("_inner"), F.col(name)).otherwise(F.col("_carry")))
    cold = df.filter(~is_hot).withColumn(name, F.lead(at).over(window))
    return cold.unionByName(carried.select(*cold.columns))


def ordered_pieces(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows cut into pieces of like size, each wholly before the next in ``order``, as a written
    table with ``_piece`` and a ``_row`` that tells equal rows apart.

    Rows are numbered by their content inside an input partition, so that one read again after
    an executor was lost numbers them alike. Written, since a second pass would sample other
    borders.
    """
    content = [F.col(f"`{field.name}`") for field in rows.schema if "map<" not in field.dataType.simpleString()]
    numbered = rows.sortWithinPartitions(F.xxhash64(*content)).withColumn("_row", F.monotonically_increasing_id())
    cut = numbered.repartitionByRange(*order, "_row").withColumn("_piece", F.spark_partition_id())
    return written(cut, "pieces")


def followed_within(end: Column, following: Column, days: int) -> Column:
    """True when the next event falls 0 to ``days`` calendar days after ``end``."""
    return F.coalesce(calendar_days(end, following).between(0, days), F.lit(False))


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows by an order that must end in a unique column."""
    return df.orderBy(*order).limit(n)
