"""Packing into token-budget batches of similar length: optimal length buckets.

Dynamic programming over the histogram of all lengths chooses the bucket boundaries that
minimise padding; inside a bucket, batches take as many rows as fit the token budget when
each is padded to the bucket's longest row.

The histogram has one row per length that occurs, and every length may end a bucket. Rows are
numbered by length, then id, so reruns pack alike however the table is partitioned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm.tables import numbered, ready, written
from tidemark.llm.texts import word_count
from tidemark.session import inline

BUCKETS = 16
#: Padded tokens of one batch; a longer row has a batch of its own.
BUDGET = 16384


def best_buckets(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Last place of each bucket, in order, for the least padding; ``lengths`` rise.

    The padding of places i..j in one bucket is ``lengths[j] * rows - words``. ``best[j]`` is
    the least padding of the first j places; each round allows one bucket more. As the best
    start of the last bucket never moves back when j grows, a round halves its ranges: all
    middles of a level are solved at once, each within what its neighbours leave.
    """
    size = len(lengths)
    if not size:
        return []
    rows = np.concatenate(([0], np.cumsum(counts)))
    words = np.concatenate(([0], np.cumsum(counts * lengths)))
    tops = np.concatenate(([0], lengths))
    best = tops * rows - words
    cuts = [np.zeros(size + 1, dtype=np.int64)]
    for _ in range(min(buckets, size) - 1):
        now, cut = _one_more(best, tops, rows, words)
        best = now
        cuts.append(cut)
    ends, j = [], size
    for cut in reversed(cuts):
        if j == 0:
            break
        ends.append(j - 1)
        j = int(cut[j])
    return ends[::-1]


def _one_more(best: np.ndarray, tops: np.ndarray, rows: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``best`` with one bucket more, and where the last bucket starts for each place."""
    size = len(best) - 1
    now, cut = np.zeros_like(best), np.zeros(size + 1, dtype=np.int64)
    low, high = np.array([1]), np.array([size])  # open ranges of places, and of their starts
    least, most = np.array([0]), np.array([size - 1])
    while len(low):
        middle = (low + high) // 2
        width = np.minimum(most, middle - 1) - least + 1
        first = np.cumsum(width) - width
        which = np.repeat(np.arange(len(middle)), width)
        start = np.arange(width.sum()) - first[which] + least[which]
        j = middle[which]
        cost = best[start] + tops[j] * (rows[j] - rows[start]) - (words[j] - words[start])
        now[middle] = np.minimum.reduceat(cost, first)
        hit = np.flatnonzero(cost == now[j])
        found = start[hit[np.searchsorted(which[hit], np.arange(len(middle)))]]
        cut[middle] = found
        low, high, least, most = (
            np.concatenate([low, middle + 1]),
            np.concatenate([middle - 1, high]),
            np.concatenate([least, found]),
            np.concatenate([found, most]),
        )
        some = low <= high
        low, high, least, most = low[some], high[some], least[some], most[some]
    return now, cut


def choose_boundaries(lengths: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket_start, bucket_length`` (shortest and longest length) per ``bucket``.

    One row per distinct length is collected; n rows of distinct lengths hold n * n / 2 tokens
    at least, so these are few whatever the corpus.
    """
    spark = lengths.sparkSession
    histogram = lengths.groupBy("n_tokens").agg(F.count("*").alias("rows")).orderBy("n_tokens").toPandas()
    found = histogram["n_tokens"].to_numpy(dtype=np.int64)
    tops = [int(found[end]) for end in best_buckets(found, histogram["rows"].to_numpy(dtype=np.int64), buckets)]
    rows = [(number, ([-1, *tops])[number] + 1, top) for number, top in enumerate(tops)]
    fields = [StructField("bucket", IntegerType()), StructField("bucket_start", LongType()), StructField("bucket_length", LongType())]
    return inline(spark, rows, StructType(fields))


def pack(
    docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: Column | None = None
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, bucket, bucket_length, batch, slot, n_padding``.

    ``length`` is a column of ``docs`` counting tokens; words are counted by default. Null and
    empty texts have length 0 and are packed with the shortest. A row longer than the budget
    fills a batch alone; nothing is cut or dropped. Repeated rows each take a slot. An empty
    table gives an empty table. ``batch`` counts from 0 in a bucket, ``slot`` from 0 in a batch.
    """
    ready(docs.sparkSession)
    tokens = word_count(F.col("text")) if length is None else F.coalesce(length, F.lit(0)).cast("long")
    rows = written(docs.select("doc_id", tokens.alias("n_tokens")), "lengths")
    bounds = choose_boundaries(rows, buckets).collect()  # at most ``buckets`` rows
    tops = F.array(*[F.lit(row["bucket_length"]) for row in bounds]) if bounds else F.array(F.lit(0).cast("long"))
    bucket = F.size(F.filter(tops, lambda top: top < F.col("n_tokens"))).cast("int")
    order = ["n_tokens", "doc_id"]
    ranged = rows.withColumn("bucket", bucket).repartitionByRange("bucket", *order)
    placed = numbered(ranged, ["bucket"], "packing", order)
    top = F.element_at(tops, F.col("bucket") + 1).cast("long")
    fitting = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_length", F.lit(1))), F.lit(1)).cast("long")
    placed = placed.withColumn("bucket_length", top).withColumn("_fit", fitting)
    return placed.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "bucket_length",
        F.floor(F.col("position") / F.col("_fit")).cast("long").alias("batch"),
        F.pmod(F.col("position"), F.col("_fit")).cast("long").alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("n_padding"),
    )
