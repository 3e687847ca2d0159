"""Parquet tables: full rebuilds, partitioned and clustered layouts, slices, appends.

Tables that are replaced, whole or in slices, are kept as versions (see ``snapshots``) and read
with ``read``; tables that only grow are plain folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.session import inline
from tidemark.sources.snapshots import Write, read, remove, slice_name

__all__ = [
    "append",
    "laid_out",
    "names",
    "read",
    "read_or_empty",
    "rebuild",
    "remove",
    "replace_slices",
    "write_clustered",
    "write_partitioned",
]


def names(partition: str | Sequence[str] | None) -> list[str]:
    return [partition] if isinstance(partition, str) else list(partition or ())


def rebuild(df: DataFrame, path: str, partition: str | Sequence[str] | None = None) -> DataFrame:
    """Replace a table, schema included; running it again changes nothing.

    Readers see the old rows until the new ones are complete, so a table may be computed from
    its own content, and a write that fails leaves it as it was.
    """
    write = Write(df.sparkSession, path, names(partition))
    write.stage(df)
    write.commit()
    return read(df.sparkSession, path)


def replace_slices(
    df: DataFrame,
    path: str,
    partition: Sequence[str],
    values: Sequence[object],
    cluster: Sequence[str] = (),
) -> DataFrame:
    """Replace the rows of a table whose first partition column has one of ``values``.

    ``df`` holds the new rows of all of them, written by one job and shown at once; None stands
    for NULL. Other slices keep their files, and a slice without rows goes.
    """
    spark = df.sparkSession
    write = Write(spark, path, partition)
    write.stage(laid_out(df, partition, cluster))
    write.commit(gone=[slice_name(spark, partition, [value]) for value in values])
    return read(spark, path)


def laid_out(
    df: DataFrame, partition: str | Sequence[str] | None, cluster: Sequence[str]
) -> DataFrame:
    """Few, well-sized, sorted files per partition value.

    REBALANCE gathers a partition value's rows but splits it again when it is large, so
    a day holding a third of the table is written by many tasks; the sort inside each
    file narrows its row groups' ranges for later scans.
    """
    if partition:
        df = df.hint("rebalance", *names(partition))
    order = [*names(partition), *cluster]
    return df.sortWithinPartitions(*order) if order else df


def write_partitioned(
    df: DataFrame,
    path: str,
    partition: str | Sequence[str],
    cluster: Sequence[str] = (),
    only_given: bool = False,
) -> DataFrame:
    """Rebuild a partitioned table, or with ``only_given`` just the values in ``df``."""
    rows = laid_out(df, partition, cluster)
    if not only_given:
        return rebuild(rows, path, partition)
    return replace_slices(df, path, names(partition), (), cluster)


def write_clustered(df: DataFrame, path: str, cluster: Sequence[str]) -> DataFrame:
    return rebuild(laid_out(df, None, cluster), path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_or_empty(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """A table of appended rows that may not have been written yet."""
    try:
        return spark.read.schema(columns).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return inline(spark, (), columns)
