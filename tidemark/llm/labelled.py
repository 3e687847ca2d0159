"""Which labelled rows a classifier may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for documents whose labels are never learned from. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def first_by_hash(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``doc_id``, so reruns choose alike."""
    return rows.orderBy(F.xxhash64(F.col("doc_id").cast("long"), F.lit(17)), "doc_id").limit(most)


def known_labels(labels: DataFrame, name: str) -> DataFrame:
    """``doc_id, label`` (0 or 1) outside the held-out fold; several labels of a document
    count by majority, a tie as 1; null ids and labels are left out."""
    usable = labels.select("doc_id", F.col(name).alias("label")).where("doc_id is not null and label is not null")
    usable = usable.where(~held_out(F.col("doc_id")))
    return usable.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))


def texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One text for each of a bounded sample of ids, of several the first by hash, so an id with
    many rows neither weighs more nor fills a task. The sample is small enough to broadcast."""
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    first = F.min_by("text", F.xxhash64("text")).alias("text")
    return found.groupBy(*chosen.columns).agg(first).select("doc_id", "text", *chosen.drop("doc_id").columns)
