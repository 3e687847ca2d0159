"""Links between vectors of one label at a least cosine: epsilon grid order join.

Unit vectors at cosine c lie sqrt(2 - 2c) apart; call that epsilon. Vectors are turned so that
their leading axes are principal ones, put in order of label and of their grid cells of side
epsilon on these axes, and cut into intervals of LEAF rows. Every interval knows the box of
its leading coordinates and a ball around its vectors. Starting from the whole sequence joined
with itself, pairs of intervals are split into pairs of parts, and a pair is

* skipped when boxes or balls prove that all of it is farther apart than epsilon,
* settled when the balls prove that all of it is closer, so that each side gains the other's
  number of rows as links without one being computed,
* split further otherwise; a task compares pairs of pieces of PIECE rows exactly.

The upper levels of that recursion are joins of a table of interval pairs with the intervals'
bounds, the lower ones run inside the task that holds both intervals. Links are counted, never
listed: a pair of intervals returns counts and at most one link per row, enough to connect.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType

from tidemark.llm.components import components, contracted
from tidemark.llm.tables import numbered, ready, written

COSINE = 0.93
LEAF, PIECE = 1024, 256
#: Parts a pair's sides are split into by one join of the upper levels, as a power of two.
SPLIT_BITS = 6
#: Leading axes of the grid.
AXES = 8
#: Vectors, about, that the axes are fitted on. Any axes give the same links.
SAMPLE = 4096
#: Bounds closer than this to epsilon settle nothing.
MARGIN = 1e-9


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Orthonormal rows, the direction of largest variance first, AXES at most."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    _, vectors = np.linalg.eigh(np.cov(unit.T).reshape(unit.shape[1], unit.shape[1]))
    return vectors.T[::-1][:AXES]


def _unit(rows: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _keyed(batches: Iterator[pa.RecordBatch], axes: np.ndarray, epsilon: float, kind: str) -> Iterator[pa.RecordBatch]:
    """Usable vectors with the key they are ordered by."""
    for batch in batches:
        column = batch.column("embedding")
        widths = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        flat = pa.compute.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.cumsum(widths)))[:-1]
        for width in np.unique(widths[widths > 0]):
            rows = np.flatnonzero(widths == width)
            matrix = flat[starts[rows][:, None] + np.arange(width)]
            good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
            rows, matrix = rows[good], matrix[good]
            if not len(rows):
                continue
            unit = _unit(matrix)
            lead = unit @ axes.T if width == axes.shape[1] else unit[:, :AXES]
            cells = np.floor(lead / epsilon).astype(np.int64) + 128  # one byte each: unit vectors span few cells
            cells = np.clip(cells, 0, 255).astype(np.uint8)
            columns = [
                batch.column("vec_id").take(pa.array(rows)),
                batch.column("label").take(pa.array(rows)),
                pa.array(np.full(len(rows), width), pa.int64()),
                pa.array([row.tobytes() for row in cells], pa.binary()),
                pa.array([row.tobytes() for row in matrix.astype(kind)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "width", "cells", "data"])


def _bounds(unit: np.ndarray, lead: np.ndarray) -> dict:
    centre = unit.mean(axis=0)
    radius = float(np.sqrt(((unit - centre) ** 2).sum(axis=1).max()))
    return {"centre": centre.tobytes(), "radius": radius, "low": lead.min(axis=0).tobytes(), "high": lead.max(axis=0).tobytes()}


def _leaves(batches: Iterator[pa.RecordBatch], axes: np.ndarray, kind: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one label and length, LEAF at most, as one row with its bounds."""
    held: list[tuple[int, bytes]] = []
    now: tuple | None = None

    def leaf() -> pa.RecordBatch:
        label, width = now
        unit = _unit(np.frombuffer(b"".join(data for _, data in held), dtype=kind).reshape(len(held), width).astype(np.float64))
        lead = unit @ axes.T if width == axes.shape[1] else unit[:, :AXES]
        row = {
            "label_low": label, "label_high": label, "width_low": width, "width_high": width, "n": len(held),
            "first": held[0][0], "ids": [number for number, _ in held], "data": b"".join(data for _, data in held),
        }
        row |= _bounds(unit, lead)
        return pa.RecordBatch.from_pylist([row], _LEAVES)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("label", "width", "vec_id", "data")]
        for label, width, number, data in zip(*columns, strict=True):
            if held and (len(held) == LEAF or now != (label, width)):
                yield leaf()
                held = []
            now = (label, width)
            held.append((number, data))
    if held:
        yield leaf()


_LEAVES = pa.schema(
    [
        ("label_low", pa.int64()), ("label_high", pa.int64()), ("width_low", pa.int64()), ("width_high", pa.int64()),
        ("n", pa.int64()), ("first", pa.int64()), ("ids", pa.list_(pa.int64())), ("data", pa.binary()),
        ("centre", pa.binary()), ("radius", pa.float64()), ("low", pa.binary()), ("high", pa.binary()),
    ]
)
_BOUNDS_SQL = (
    "node long, label_low long, label_high long, width_low long, width_high long, n long, first long, "
    "centre binary, radius double, low binary, high binary"
)
_LEAVES_SQL = _BOUNDS_SQL.removeprefix("node long, ").replace("first long, ", "first long, ids array<long>, data binary, ")


def _parents(children: pd.DataFrame) -> pd.DataFrame:
    """Bounds of the interval that the children make up; no ball or box across lengths."""
    one = {name: children[name].min() for name in ("label_low", "width_low", "first")}
    one |= {name: children[name].max() for name in ("label_high", "width_high")}
    one |= {"node": children["node"].iloc[0] >> SPLIT_BITS, "n": children["n"].sum(), "centre": b"", "radius": 0.0, "low": b"", "high": b""}
    if one["width_low"] == one["width_high"] and (children["centre"].str.len() > 0).all():
        centres = np.stack([np.frombuffer(value) for value in children["centre"]])
        centre = np.average(centres, axis=0, weights=children["n"])
        one["centre"] = centre.tobytes()
        one["radius"] = float((np.sqrt(((centres - centre) ** 2).sum(axis=1)) + children["radius"]).max())
        one["low"] = np.min([np.frombuffer(value) for value in children["low"]], axis=0).tobytes()
        one["high"] = np.max([np.frombuffer(value) for value in children["high"]], axis=0).tobytes()
    return pd.DataFrame([one])


def _judge(one: dict, other: dict, epsilon: float) -> int:
    """-1 if no row of one can link with the other, 1 if all rows do, 0 if unknown."""
    key = lambda node, end: (node[f"label_{end}"], node[f"width_{end}"])
    if key(one, "high") < key(other, "low") or key(other, "high") < key(one, "low"):
        return -1
    if not len(one["centre"]) or len(one["centre"]) != len(other["centre"]):
        return 0
    sides = [[np.frombuffer(node["centre"]), node["radius"], np.frombuffer(node["low"]), np.frombuffer(node["high"])] for node in (one, other)]
    verdict = _distance(*sides, epsilon)
    single = key(one, "low") == key(one, "high") == key(other, "low") == key(other, "high")
    return verdict if single else min(verdict, 0)


def _distance(one: tuple, other: tuple, epsilon: float) -> int:
    between = float(np.sqrt(((one[0] - other[0]) ** 2).sum()))
    if between - one[1] - other[1] > epsilon + MARGIN:
        return -1
    if between + one[1] + other[1] < epsilon - MARGIN:
        return 1
    gap = np.maximum(np.maximum(one[2] - other[3], other[2] - one[3]), 0)
    return -1 if float(np.sqrt((gap**2).sum())) > epsilon + MARGIN else 0


def _judged(batches: Iterator[pa.RecordBatch], epsilon: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept: dict[str, list] = {name: [] for name in _JUDGED.names}
        for row in batch.to_pylist():
            verdict = _judge(row["one"], row["other"], epsilon)
            if verdict >= 0:
                values = (row["a"], row["b"], verdict, row["one"]["n"], row["other"]["n"], row["one"]["first"], row["other"]["first"])
                for name, value in zip(_JUDGED.names, values, strict=True):
                    kept[name].append(value)
        yield pa.RecordBatch.from_pydict(kept, _JUDGED)


_JUDGED = pa.schema([(name, pa.int64()) for name in ("a", "b", "verdict", "n_a", "n_b", "first_a", "first_b")])
_JUDGED_SQL = ", ".join(f"{name} long" for name in _JUDGED.names)


class Interval:
    """Rows of one leaf inside a task, with the bounds of the parts asked for."""

    def __init__(self, unit: np.ndarray, lead: np.ndarray) -> None:
        self.unit, self.lead, self.known = unit, lead, {}

    def bounds(self, start: int, stop: int) -> tuple:
        if (start, stop) not in self.known:
            part, lead = self.unit[start:stop], self.lead[start:stop]
            centre = part.mean(axis=0)
            radius = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
            self.known[start, stop] = (centre, radius, lead.min(axis=0), lead.max(axis=0))
        return self.known[start, stop]


def join_intervals(one: Interval, other: Interval | None, epsilon: float, cosine: float) -> tuple:
    """Links per row of ``one`` and of ``other`` (None: itself), and links that connect them as
    two arrays of places, those of ``other`` after those of ``one``."""
    second = other or one
    counts = np.zeros(len(one.unit), dtype=np.int64)
    others = np.zeros(len(second.unit), dtype=np.int64) if other else counts
    shift = len(one.unit) if other else 0
    found: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(0, len(one.unit), 0, len(second.unit))]
    while todo:
        a, b, c, d = todo.pop()
        same = other is None and (a, b) == (c, d)
        verdict = 0 if same and b - a == 1 else _distance(one.bounds(a, b), second.bounds(c, d), epsilon)
        if verdict < 0:
            continue
        if verdict > 0:
            counts[a:b] += d - c - (1 if same else 0)
            if not same:
                others[c:d] += b - a
            found.append((np.arange(a, b), np.full(b - a, c + shift)))
            found.append((np.full(d - c, a), np.arange(c, d) + shift))
        elif max(b - a, d - c) > PIECE:
            left, right = (a + b) // 2, (c + d) // 2
            parts = [(a, left, c, right), (left, b, right, d), (a, left, right, d)]
            if b - a <= PIECE:
                parts = [(a, b, c, right), (a, b, right, d)]
            elif d - c <= PIECE:
                parts = [(a, left, c, d), (left, b, c, d)]
            elif not same:
                parts.append((left, b, c, right))
            todo += parts
        else:
            near = one.unit[a:b] @ second.unit[c:d].T >= cosine
            if same:
                np.fill_diagonal(near, False)
            counts[a:b] += near.sum(axis=1)
            if not same:
                others[c:d] += near.sum(axis=0)
            rows, columns = np.nonzero(near)
            found.append(contracted(rows + a, columns + c + shift))
    if not found:
        return counts, others, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return counts, others, *contracted(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))


def _compared(batches: Iterator[pa.RecordBatch], axes: np.ndarray, kind: str, epsilon: float, cosine: float) -> Iterator[pa.RecordBatch]:
    """Counts (``leaf, place, n``) and links (``a, b``) of pairs of leaves."""

    def interval(leaf: dict) -> Interval:
        width = leaf["width_low"]
        unit = _unit(np.frombuffer(leaf["data"], dtype=kind).reshape(-1, width).astype(np.float64))
        return Interval(unit, unit @ axes.T if width == axes.shape[1] else unit[:, :AXES])

    for batch in batches:
        for row in batch.to_pylist():
            same = row["a"] == row["b"]
            one, other = interval(row["one"]), None if same else interval(row["other"])
            counts, others, a, b = join_intervals(one, other, epsilon, cosine)
            ids = np.array(row["one"]["ids"] + ([] if same else row["other"]["ids"]), dtype=np.int64)
            for leaf, each in ((row["a"], counts), (row["b"], others))[: 1 if same else 2]:
                place = np.flatnonzero(each)
                yield _result(leaf=np.full(len(place), leaf), place=place, n=each[place])
            yield _result(a=ids[a], b=ids[b])


def _result(**columns: np.ndarray) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], pa.int64()) if name in columns else pa.nulls(size, pa.int64()) for name in _RESULT.names], schema=_RESULT
    )


_RESULT = pa.schema([(name, pa.int64()) for name in ("leaf", "place", "n", "a", "b")])
_RESULT_SQL = ", ".join(f"{name} long" for name in _RESULT.names)


def link(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link if labels are equal and not null, lengths are equal, and their cosine in
    double precision is ``cosine`` or more. Vectors that are null, empty, zero or hold null or
    non-finite components, and those without ``vec_id``, link with nothing. Repeated rows are
    vectors of their own: they link with each other, and share a component. ``kept`` is false
    where ``vec_id`` is null. An empty table gives an empty table; other columns are not read.
    """
    spark = ready(vectors.sparkSession)
    epsilon = float(np.sqrt(2 - 2 * cosine))
    kind = "<f8" if vectors.schema["embedding"].dataType.elementType == DoubleType() else "<f4"
    label = F.col("label")
    if not isinstance(vectors.schema["label"].dataType, IntegralType):  # a number for each label as given
        label = F.when(label.isNotNull(), F.xxhash64(label))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", label.cast("long").alias("label"))
    asked = rows.where("vec_id is not null and label is not null and embedding is not null and size(embedding) > 0")
    axes = _fitted_axes(asked)

    keyed = asked.mapInArrow(
        lambda batches: _keyed(batches, axes, epsilon, kind), "vec_id long, label long, width long, cells binary, data binary"
    )
    order = ["label", "width", "cells", "vec_id"]
    sequence = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    leaves = sequence.mapInArrow(lambda batches: _leaves(batches, axes, kind), _LEAVES_SQL)
    leaves = leaves.withColumns({"_all": F.lit(0), "_seq": F.monotonically_increasing_id()})
    leaves = numbered(leaves, ["_all"], "leaves", order=["_seq"]).drop("_all", "_seq").withColumnRenamed("position", "node")
    # numbers come from the written table by one join; written again, later joins only read
    leaves = written(leaves, "sequence")

    levels = [leaves.select(*[part.split()[0] for part in _BOUNDS_SQL.split(", ")])]
    count = leaves.count()
    while count > 1:
        up = levels[-1].groupBy(F.shiftright("node", SPLIT_BITS).alias("_up")).applyInPandas(_parents, _BOUNDS_SQL)
        levels.append(written(up, "intervals"))
        count = math.ceil(count / (1 << SPLIT_BITS))
    settled, pairs = [], levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in range(len(levels) - 1, -1, -1):
        bounds = F.struct(*[name for name in levels[level].columns if name != "node"])
        for side, name in (("a", "one"), ("b", "other")):
            pairs = pairs.join(levels[level].select(F.col("node").alias(side), bounds.alias(name)), side)
        judged = pairs.select("a", "b", "one", "other").mapInArrow(lambda batches: _judged(batches, epsilon), _JUDGED_SQL)
        judged = written(judged, "judged")
        settled.append(judged.where("verdict = 1").withColumn("level", F.lit(level)))
        pairs = judged.where("verdict = 0").select("a", "b")
        if level:
            parts = F.array([F.lit(n) for n in range(1 << SPLIT_BITS)])
            for side in ("a", "b"):
                pairs = pairs.withColumn(f"_{side}", F.explode(parts)).withColumn(side, F.shiftleft(side, SPLIT_BITS) + F.col(f"_{side}"))
            pairs = pairs.where("a <= b").select("a", "b")
    for side, name in (("a", "one"), ("b", "other")):
        contents = F.struct("width_low", "ids", "data")
        pairs = pairs.join(leaves.select(F.col("node").alias(side), contents.alias(name)), side)
    compared = written(
        pairs.select("a", "b", "one", "other").mapInArrow(lambda batches: _compared(batches, axes, kind, epsilon, cosine), _RESULT_SQL), "compared"
    )

    whole = settled[0]
    for more in settled[1:]:
        whole = whole.unionByName(more)
    sides = whole.select(
        "level",
        F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.when(F.col("a") == F.col("b"), F.col("n_b") - 1).otherwise(F.col("n_b")).alias("more"), F.col("first_b").alias("anchor")),
                F.struct(F.col("b").alias("node"), F.when(F.col("a") == F.col("b"), F.lit(0)).otherwise(F.col("n_a")).alias("more"), F.col("first_a").alias("anchor")),
            )
        ).alias("s"),
    ).select("level", "s.*")
    gained = sides.groupBy("level", "node").agg(F.sum("more").alias("more"), F.min("anchor").alias("anchor"))
    above = F.array([F.struct(F.lit(n).alias("level"), F.shiftright("node", SPLIT_BITS * n).alias("up")) for n in range(len(levels))])
    gained = (
        leaves.select(F.col("node").alias("leaf"), F.explode(above).alias("at"))
        .select("leaf", "at.level", F.col("at.up").alias("node"))
        .join(gained, ["level", "node"])
    )
    per_leaf = gained.groupBy("leaf").agg(F.sum("more").alias("more"), F.collect_set("anchor").alias("anchors"))
    members = leaves.select(F.col("node").alias("leaf"), F.posexplode("ids").alias("place", "vec_id")).withColumn("place", F.col("place").cast("long"))
    counts = compared.where("leaf is not null").groupBy("leaf", "place").agg(F.sum("n").alias("n"))
    counted = members.join(counts, ["leaf", "place"], "left").join(per_leaf, "leaf", "left")
    counted = counted.withColumn("n_links", F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0)))
    counted = written(counted.select("vec_id", "n_links", "anchors"), "counted")

    links = compared.where("a is not null").select("a", "b")
    links = links.unionByName(whole.select(F.col("first_a").alias("a"), F.col("first_b").alias("b")))
    links = links.unionByName(counted.select(F.col("vec_id").alias("a"), F.explode("anchors").alias("b")))
    root = components(links)
    counted = counted.select("vec_id", "n_links").join(root, F.col("vec_id") == F.col("node"), "left")
    counted = counted.select("vec_id", "n_links", F.coalesce("root", "vec_id").alias("component_id"))
    return counted.unionByName(_unlinked(rows)).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _usable() -> F.Column:
    values = F.col("embedding")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & values.isNotNull() & finite & F.exists(values, lambda x: x != 0)
    )


def _unlinked(rows: DataFrame) -> DataFrame:
    out = rows.where(~F.coalesce(_usable(), F.lit(False)))
    return out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))


def _fitted_axes(rows: DataFrame) -> np.ndarray:
    """Axes for the most frequent length, from about SAMPLE vectors chosen by a hash of the id."""
    usable = rows.where(_usable()).withColumn("width", F.size("embedding"))
    widths = usable.groupBy("width").count().orderBy(F.col("count").desc(), "width").first()
    if widths is None:
        return np.zeros((0, 0))
    share = max(1, widths["count"] // SAMPLE)
    picked = usable.where((F.col("width") == widths["width"]) & (F.pmod(F.xxhash64("vec_id"), F.lit(share)) == 0))
    table = picked.select("embedding").limit(2 * SAMPLE).toArrow()
    sample = np.array(table.column("embedding").to_pylist(), dtype=np.float64)
    return principal_axes(sample) if len(sample) > widths["width"] else np.eye(widths["width"])[:AXES]
