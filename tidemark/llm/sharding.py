"""Shards of near-equal bytes for indivisible groups: Karmarkar-Karp differencing.

Documents with the same text form one group, which never leaves its shard. Differencing
starts from one partial partition per item, ``(size, 0, ..., 0)`` over all shards, and keeps
combining the two partial partitions of largest spread, the largest shard of one with the
smallest of the other, until one is left.

No task sees all groups. Groups are dealt by hash into chunks; each chunk is differenced
into as many bins as there are shards, and every bin is one item of the next level, until
the items fit one chunk. The groups of one chunk of the first level skip the coarsening and
stay single items: combined last, being small, they even out what the bins left over. A
group larger than the rest of its chunk stays alone in its bin, so it is placed last too,
at full size.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import numbered, ready, written

SHARDS = 40
#: Bytes counted for a document beside its text.
OVERHEAD = 16
#: Items differenced by one task.
CHUNK = 8192


def difference(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item by differencing; ties in spread go to the earlier partial."""
    count = len(sizes)
    if not count:
        return np.zeros(0, dtype=np.int64)
    if count == 1 or shards == 1:
        return np.zeros(count, dtype=np.int64)
    heap = [(-int(size), node) for node, size in enumerate(sizes)]
    heapq.heapify(heap)
    sums: dict[int, np.ndarray] = {}
    made: list[tuple[int, int, np.ndarray]] = []

    def taken(node: int) -> np.ndarray:
        if node >= count:
            return sums.pop(node)
        alone = np.zeros(shards, dtype=np.int64)
        alone[0] = sizes[node]
        return alone

    while len(heap) > 1:
        _, one = heapq.heappop(heap)
        _, other = heapq.heappop(heap)
        total = taken(one) + taken(other)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        node = count + len(made)
        made.append((one, other, order.astype(np.int32)))
        sums[node] = total
        heapq.heappush(heap, (-int(total[0] - total[-1]), node))
    shard = np.zeros(count, dtype=np.int64)
    places = {count + len(made) - 1: np.arange(shards)}
    for node in range(count + len(made) - 1, count - 1, -1):
        one, other, order = made[node - count]
        final = np.empty(shards, dtype=np.int64)
        final[order] = places.pop(node)
        for child, place in ((one, final), (other, final[::-1])):
            if child < count:
                shard[child] = place[0]
            else:
                places[child] = place
    return shard


def _binned(items: DataFrame, shards: int) -> DataFrame:
    """``bin`` of each item within its chunk."""

    def place(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        return chunk.assign(bin=difference(chunk["size"].to_numpy(np.int64), shards))

    return items.groupBy("chunk").applyInPandas(place, "item string, size long, chunk long, bin long")


def place_items(items: DataFrame, shards: int = SHARDS, chunk: int = CHUNK) -> DataFrame:
    """``item`` (unique string) with ``size`` to ``shard``: every item, none split."""
    level, bins, count = 0, [], items.count()
    current = items.select("item", F.col("size").cast("long").alias("size"))
    direct = None
    while True:
        chunks = max(1, math.ceil(count / chunk))
        current = current.withColumn(
            "chunk", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(chunks)).cast("long") if chunks > 1 else F.lit(0).cast("long")
        )
        if chunks == 1:
            break
        if level == 0:
            direct = current.where("chunk = 0").select("item", "size")
            current = current.where("chunk > 0")
        table = written(_binned(current, shards), f"bins-{level}")
        table = table.withColumn("parent", F.concat_ws(":", F.lit(level), "chunk", "bin"))
        bins.append(table.select("item", "parent"))
        current = table.groupBy(F.col("parent").alias("item")).agg(F.sum("size").alias("size"))
        level, count = level + 1, chunks * shards
    if direct is not None:
        current = current.select("item", "size").unionByName(direct).withColumn("chunk", F.lit(0).cast("long"))
    placed = _binned(current, shards).select("item", F.col("bin").cast("int").alias("shard"))
    if not bins:
        return placed
    placed = written(placed, "placed")
    for table in reversed(bins):
        below = table.join(placed.withColumnRenamed("item", "parent"), "parent").select("item", "shard")
        placed = below.unionByName(placed.join(below, "item", "left_anti"))
    return placed


def shard_documents(docs: DataFrame, shards: int = SHARDS, chunk: int = CHUNK) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length of the text plus OVERHEAD. Texts that are null count as no
    bytes (crc 0) and form one group of their own, as do empty texts. Repeated rows each take
    a slot. An empty table gives an empty table. Other columns are not read. The law is
    ``bytes``, so ``grown_shard`` is null. Balance is as tight as the largest group allows.
    """
    ready(docs.sparkSession)
    text = F.col("text")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("item"),
    )
    groups = written(rows.groupBy("item").agg(F.sum("size").alias("size")), "groups")
    placed = rows.join(place_items(groups, shards, chunk), "item").drop("item")
    return numbered(placed, ["shard"], "sharded").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
