"""Audit rows: one per job with its outcome, and in/kept/rejected counts per step."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.model import RUNS
from tidemark.session import inline
from tidemark.sources import tables

ERROR_LENGTH = 500


@contextmanager
def tracked(
    spark: SparkSession, path: str, action: str, layer: str = "", business_date: str = ""
) -> Iterator[str]:
    """Record how a job ended; an error is recorded and raised again."""
    run_id, started = str(uuid.uuid4()), datetime.now(UTC)
    day = date.fromisoformat(business_date) if business_date else None

    def record(status: str, error: str) -> None:
        ended = datetime.now(UTC).replace(microsecond=0)
        row = (run_id, action, layer, day, started.replace(microsecond=0), ended, status, error)
        tables.append(inline(spark, [row], RUNS), path)

    try:
        yield run_id
    except Exception as error:
        record("error", str(error)[:ERROR_LENGTH])
        raise
    record("success", "")


def last_runs(spark: SparkSession, path: str, n: int = 15) -> DataFrame:
    runs = tables.read_or_empty(spark, path, RUNS)
    return runs.orderBy(F.desc("started_at"), "run_id").limit(n)


def step_counts(step: str, given: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows a step was given and kept, and distinct rows' keys it put in the journal."""
    return given.agg(F.count("*").alias("rows_in")).select(
        F.lit(step).alias("step"),
        "rows_in",
        kept.agg(F.count("*")).scalar().alias("rows_kept"),
        rejected.agg(F.count("*")).scalar().alias("journal_rows"),
    )
