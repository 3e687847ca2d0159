"""Written intermediate tables, stable row numbers and Arrow sizes shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import configure, shared_folder

#: Rows whose numbers are counted by one task; a hot key is cut into blocks of this size.
BLOCK_BITS = 18


def ready(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: small Arrow batches, since rows may be long."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")
    return spark


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: lineage ends there, and executors
    lost later cost only a read."""
    return stored(frame, shared_folder(frame.sparkSession, purpose))


def stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Remove a table made by ``stored`` that no later result reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def blocked(frame: DataFrame, keys: Sequence[str], purpose: str, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``frame`` written once, its rows in blocks, and one row per block with where it begins.

    Rows count in the order of partitions and, inside one, of ``keys`` and ``order``; a frame
    range partitioned by these is numbered in that order. In a sorted partition the rows of a
    key follow each other, so a row's place is its distance from the first row of its key in
    its block of 2 ** BLOCK_BITS rows. Only block counts are added up per key: a key holding
    all rows is no single task. Key columns must not be null. What is known per key may be
    joined to the blocks before ``positioned`` joins these to the rows, so that no join of
    rows has a hot key.
    """
    ranked = frame.sortWithinPartitions(*keys, *order).withColumn("_at", F.monotonically_increasing_id())
    table = written(ranked, purpose).withColumn("_block", F.shiftright("_at", BLOCK_BITS))
    blocks = table.groupBy(*keys, "_block").agg(F.count("*").alias("_rows"), F.min("_at").alias("_start"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    return table, blocks.select(*keys, "_block", (before - F.col("_start")).alias("_shift"))


def positioned(table: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` with ``position``, gapless from 0 within a key, and what ``blocks`` carry."""
    joined = table.join(blocks, [*keys, "_block"])
    return joined.withColumn("position", F.col("_at") + F.col("_shift")).drop("_at", "_block", "_shift")


def numbered(frame: DataFrame, keys: Sequence[str], purpose: str, order: Sequence[str] = ()) -> DataFrame:
    return positioned(*blocked(frame, keys, purpose, order), keys)
