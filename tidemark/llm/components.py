"""Connected components of a table of links, by alternating star contractions.

Each round gives every node's larger neighbours to the smallest neighbour (large star), then
every node's smaller neighbours to the smallest (small star), until the links form stars.
Neighbours are never gathered: a node's smallest neighbour is an aggregate combined before
the shuffle, joined back to the links, and a node with very many links is a skewed join,
which adaptive execution splits. Before the rounds, tasks contract the links they hold, a
bounded number at a time, so long chains rarely reach them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import release, stored
from tidemark.session import shared_folder

#: Links contracted at once by one task.
HELD = 1 << 20
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def roots(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """Smallest node reachable from each of ``count`` nodes over the links ``a - b``."""
    parent = np.arange(count)
    while len(a):
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        np.minimum.at(parent, high, low)
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent = above
        open_links = parent[a] != parent[b]
        a, b = a[open_links], b[open_links]
    return parent


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as stars: each node but the smallest, and the smallest."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = roots(places[: len(a)], places[len(a) :], len(nodes))
    leaf = root != np.arange(len(nodes))
    return nodes[leaf], nodes[root[leaf]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return contracted(np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts]))

    for batch in batches:
        parts.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        held += batch.num_rows
        if held >= HELD:
            parts = [merged()]
            held = len(parts[0][0])
            if 2 * held >= HELD:
                yield pa.RecordBatch.from_arrays([pa.array(part) for part in parts[0]], schema=_LINKS)
                parts, held = [], 0
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(part) for part in merged()], schema=_LINKS)


def locally(links: DataFrame) -> DataFrame:
    return links.mapInArrow(_local, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node that is not the smallest of its component.

    ``links`` holds non-null longs ``a`` and ``b`` in any order, repeats and loops allowed.
    The result is a written table; the tables of earlier rounds are removed.
    """
    spark = links.sparkSession
    path = shared_folder(spark, "links")
    either = locally(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"))
    stars = stored(either.distinct(), path)
    size = _measure(stars)
    while size[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours to the smallest neighbour (or the node itself)
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: smaller neighbours and the node itself to the smallest neighbour
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        moved = large.join(least, F.col("a") == F.col("n"))
        small = moved.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        newer = shared_folder(spark, "links")
        contracted_stars = stored(small.distinct(), newer)
        now = _measure(contracted_stars)
        release(spark, path)
        stars, path = contracted_stars, newer
        if now == size:
            break
        size = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _measure(links: DataFrame) -> tuple:
    """Number of links and an order-free checksum, equal when nothing has moved."""
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.max("a").alias("m")).first()
    return row["n"], row["x"], row["m"]
