"""File arrivals as a stream: each run takes the files that appeared since the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.identity import require_salt
from tidemark.plans.model import DropFile
from tidemark.sources.drops import csv_options
from tidemark.sources.ingest import Lake, glob, land, prepare, read_drop, record


def arriving(
    spark: SparkSession, root: str, file: DropFile, json_lines: bool = False
) -> DataFrame | None:
    """The drops of one kind of file as a stream of rows; None before the first drop.

    Files that carry their own schema are read with that of the drops present; a file whose
    types differ stops the stream, and is for the batch reader.
    """
    columns = file.schema
    if columns is None:
        present = read_drop(spark, glob(root, file, None), file)
        if not present:
            return None
        columns = present[0].schema
    reader = spark.readStream.schema(columns)
    if file.format == "csv":
        reader = reader.options(**csv_options(file.multi_line))
    elif file.format == "json":
        reader = reader.option("multiLine", not json_lines)
    return reader.format(file.format).load(glob(root, file, None))


def ingest_arrivals(
    spark: SparkSession, root: str, file: DropFile, lake: Lake, json_lines: bool = False
) -> None:
    """Land everything that has arrived, then stop.

    The stream's own checkpoint skips files it has read; the ledger skips content it has
    seen. A batch repeated after a failure lands on the same folders.
    """
    require_salt(lake.salt)
    rows = arriving(spark, root, file, json_lines)
    if rows is None:
        return

    def take(batch: DataFrame, _: int) -> None:
        landed = land(batch, file, lake)
        if landed:
            record(landed, None, spark, lake)

    query = (
        rows.transform(lambda rows: prepare(rows, file, lake.salt))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{lake.root}/meta/arrivals/{file.source}-{file.name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
