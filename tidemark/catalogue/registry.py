"""The registered queries: what runs on Spark, and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure, shared_folder

TABLE_NAMES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


@lru_cache
def given_table(spark: SparkSession, application: str, path: str) -> DataFrame:
    """A table's files are listed, and their schema read, once per application."""
    return spark.read.parquet(path)


class Inputs:
    """The given tables of one scale folder, read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = configure(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        return given_table(self.spark, self.spark.sparkContext.applicationId, path)

    def scratch(self, purpose: str) -> str:
        return shared_folder(self.spark, purpose)

    @cached_property
    def clinic(self):
        from tidemark.catalogue.bindings import Clinic

        return Clinic(self)

    @cached_property
    def activity(self):
        from tidemark.catalogue.bindings import Activity

        return Activity(self)


@dataclass(frozen=True)
class Query:
    run: Callable[[Inputs], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Inputs(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under the id of the operator it shows."""

    def register(run: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(run, oracle)
        return run

    return register
