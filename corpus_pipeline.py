"""From documents to packed training batches: five stages, each one of the corpus operators.

Every stage takes the documents that its predecessor wrote and returns a DataFrame, which is
written as Parquet and read again before the next. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, neardup, packing, secrets, toxicity
from tidemark.llm.tables import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents called toxic go; a text without words is judged like any other and stays.

    A null text counts as empty, repeated rows are judged alike, and an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.drop_toxic(docs, labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays; texts without words all stay.

    The smallest id of a class stays, once if its row is repeated; see ``neardup.drop_copies``.
    """
    return neardup.drop_copies(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; secrets in its text give way to their kind in brackets.

    A null text stays null, an empty one empty; ``n_chars``, where there is one, counts anew.
    """
    cleaned = secrets.redact(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times.

    A null source is a source. Texts without words have no size and may be taken or not; equal
    rows are taken independently; an empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every row; a document taken twice is packed twice.

    Null and empty texts have length 0 and are packed with the shortest; a row longer than the
    budget has a batch of its own; an empty table gives an empty one.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_batches),
]

#: A trained classifier comes first, which SQL cannot express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
