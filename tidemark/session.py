"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, ANSI errors, adaptive execution and no web page."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


# The literal a pseudonym's digest begins with, wherever Spark prints a plan.
SALT_IN_PLANS = r"(?<=sha2\((cast\()?'?concat\()[^,]*(?=,)"


def configure(spark: SparkSession) -> SparkSession:
    """Set what results and plans rely on, and keep the salt out of printed plans.

    Day and hour boundaries are defined in UTC, whatever the cluster's zone. Once a join's
    shuffles are done and every partition of its smaller side is known to fit, adaptive
    execution may hash that side instead of sorting both. A skewed join is split even where
    that costs one more shuffle.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    hidden = spark.conf.get("spark.sql.redaction.string.regex", None)
    if SALT_IN_PLANS not in (hidden or ""):
        both = f"{hidden}|{SALT_IN_PLANS}" if hidden else SALT_IN_PLANS
        spark.conf.set("spark.sql.redaction.string.regex", both)
    return spark


@cache
def local_folder() -> str:
    """One temporary folder for this process, for a local master only."""
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master may fall back to the machine's own temporary folder: on a
    cluster the executors would each write to a different disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = local_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: lineage ends there, and executors
    lost later cost only a read. It stays until that folder is cleared."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def inline(spark: SparkSession, rows: Sequence[tuple], columns: StructType) -> DataFrame:
    """A few constant rows as part of the plan, so that Spark knows how small they are."""
    values = list(zip(*rows, strict=True)) if rows else [()] * len(columns)
    named = {field.name: list(column) for field, column in zip(columns, values, strict=True)}
    return spark.createDataFrame(pa.table(named), schema=columns)


def side_by_side(jobs: Iterable[Callable], at_once: int = 4) -> list:
    """Submit independent jobs together, so small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(at_once) as pool:
        return [job.result() for job in [pool.submit(job) for job in jobs]]
