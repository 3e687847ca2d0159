"""Exact nearest neighbours by integer inner product: columnar branch and bound.

Vectors are cut into blocks of rows and of queries; every pair of a query block and a row
block is one row of a join, which a task searches by itself. Inside, the row block is laid
out by dimension. For each query, scores are accumulated one block of dimensions after the
other, heaviest dimensions of the query first; the remaining mass of both vectors bounds
what the dimensions still to come can add, and rows whose upper bound lies below the k-th
best lower bound are compacted away before the next block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import ready, written

SCALE = 256
TOP = 5
EVERY = 50
ROW_BLOCK = 8192
QUERY_BLOCK = 2048
#: Dimensions accumulated between two prunings.
STEP = 16
#: Integers up to here are exact in a double, and so are their sums.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, q``: each component x as ``floor(SCALE * x)``, for vectors that take part."""
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    floors = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return vectors.where(F.col("vec_id").isNotNull() & usable).select(F.col("vec_id").cast("long"), floors.alias("q"))


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows of one length packed into blocks: ids and a dimension-major matrix, as bytes."""
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    held: dict[int, int] = {}

    def block(width: int) -> pa.RecordBatch:
        parts = waiting.pop(width)
        held.pop(width)
        ids = np.concatenate([part[0] for part in parts])
        matrix = np.concatenate([part[1] for part in parts])
        small = np.abs(matrix).max(initial=0) < 2**15
        columns = np.ascontiguousarray(matrix.T, dtype=np.int16 if small else np.float64)
        row = {"width": [width], "small": [bool(small)], "ids": [ids.tobytes()], "columns": [columns.tobytes()]}
        return pa.RecordBatch.from_pydict(row, _PACKED)

    for batch in batches:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
        column = batch.column("q")
        widths = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.cumsum(widths)))[:-1]
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            matrix = flat[starts[rows][:, None] + np.arange(width)]
            for start in range(0, len(rows), size):
                part = slice(start, start + size)
                if held.get(width, 0) + len(rows[part]) > size:
                    yield block(width)
                waiting.setdefault(width, []).append((ids[rows[part]], matrix[part]))
                held[width] = held.get(width, 0) + len(rows[part])
    for width in list(waiting):
        yield block(width)


_PACKED = pa.schema([("width", pa.int64()), ("small", pa.bool_()), ("ids", pa.binary()), ("columns", pa.binary())])
_PACKED_SQL = "width long, small boolean, ids binary, columns binary"


def best_rows(query: np.ndarray, columns: np.ndarray, allowed: np.ndarray, ids: np.ndarray, top: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the ``top`` best of ``allowed`` rows: larger score, then smaller id.

    ``columns`` holds one dimension per row of the matrix. Bounds are widened by a relative
    margin, so rounding in the square roots never drops a row that could still win.
    """
    alive = allowed
    order = np.argsort(-np.abs(query), kind="stable")
    partial = np.zeros(len(alive))
    mass = np.einsum("ij,ij->j", columns, columns)[alive]
    rest = float(query @ query)
    for start in range(0, len(order), step):
        dims = order[start : start + step]
        values = columns[np.ix_(dims, alive)]
        partial = partial + query[dims] @ values
        mass = np.maximum(mass - np.einsum("ij,ij->j", values, values), 0.0)
        rest = max(rest - float(query[dims] @ query[dims]), 0.0)
        if len(alive) > top and start + step < len(order):
            bound = np.sqrt(mass * rest) * (1 + 1e-9)
            lower = np.partition(partial - bound, len(alive) - top)[len(alive) - top]
            stay = partial + bound >= lower
            alive, partial, mass = alive[stay], partial[stay], mass[stay]
    chosen = np.lexsort((ids[alive], -partial))[:top]
    return alive[chosen], partial[chosen]


def _exact_rows(query: np.ndarray, columns: np.ndarray, allowed: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for components too large for exact doubles: Python integers, no bounds; a
    score outside the range of a long is reported as the nearest long."""
    whole = [int(value) for value in query]
    scores = [sum(a * int(b) for a, b in zip(whole, columns[:, row], strict=True)) for row in allowed]
    chosen = sorted(range(len(allowed)), key=lambda i: (-scores[i], ids[allowed[i]]))[:top]
    return allowed[chosen], np.array([max(-_LONG - 1, min(_LONG, scores[i])) for i in chosen], dtype=object)


def _searched(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pair in batch.to_pylist():
            width = pair["width"]

            def unpacked(side: str, pair: dict = pair, width: int = width) -> tuple[np.ndarray, np.ndarray]:
                ids = np.frombuffer(pair[f"{side}_ids"], dtype=np.int64)
                kind = np.int16 if pair[f"{side}_small"] else np.float64
                return ids, np.frombuffer(pair[f"{side}_columns"], dtype=kind).reshape(width, len(ids)).astype(np.float64)

            query_ids, queries = unpacked("query")
            ids, columns = unpacked("row")
            everyone = np.arange(len(ids))
            largest = np.abs(queries).max(initial=0) * np.abs(columns).max(initial=0) * max(width, 1)
            search = best_rows if max(largest, np.square(columns).max(initial=0) * width, np.square(queries).max(initial=0) * width) < _EXACT else _exact_rows
            found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
            for number, query_id in enumerate(query_ids):
                places, scores = search(queries[:, number], columns, everyone[ids != query_id], ids, top)
                found["query_id"] += [int(query_id)] * len(places)
                found["vec_id"] += ids[places].tolist()
                found["score"] += [int(score) for score in scores]
            yield pa.RecordBatch.from_pydict(found, _FOUND)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def nearest(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` best rows of each query.

    Queries are the vectors whose id is divisible by ``every``; an id that occurs several
    times asks once, with its smallest vector. Candidates are all rows of other ids and of
    the query's length, repeated ids once per row. Null ids, and vectors that are null or
    hold null or non-finite components, take no part; empty vectors score 0 with each other.
    Ties go to the smaller ``vec_id``. An empty table gives an empty table.
    """
    ready(vectors.sparkSession)
    rows = quantised(vectors)
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("q").alias("q"))
    sides = {}
    for side, frame, size in (("row", rows, ROW_BLOCK), ("query", asked, QUERY_BLOCK)):
        blocks = frame.mapInArrow(lambda batches, size=size: _packed(batches, size), _PACKED_SQL)
        renamed = blocks.select("width", *[F.col(name).alias(f"{side}_{name}") for name in ("small", "ids", "columns")])
        sides[side] = written(renamed.withColumn(f"{side}_block", F.monotonically_increasing_id()), f"search-{side}")
    # one row per pair of blocks; the contents follow by two joins on the block number
    pairs = sides["query"].select("width", "query_block").join(sides["row"].select("width", "row_block"), "width")
    pairs = pairs.repartition("query_block", "row_block")
    tiles = pairs.join(sides["row"].drop("width"), "row_block").join(sides["query"].drop("width"), "query_block")
    best = tiles.mapInArrow(lambda batches: _searched(batches, top), "query_id long, vec_id long, score long")
    best = written(best, "search-found")  # ``top`` rows per query and row block
    ahead = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(ahead)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
