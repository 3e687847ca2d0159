"""Near-duplicate texts by weighted MinHash: BagMinHash, banding, exact verification.

A text is the multiset of its runs of SHINGLE words (one run of all words if it has fewer).
Two texts are linked if the weighted Jaccard similarity of these multisets, the sum of the
smaller over the sum of the larger multiplicities, is at least SIMILARITY.

BagMinHash: for every shingle a Poisson process of rate M drops points on time and weight. The
weight axis is cut at the discrete weights 1, 2, 4, 8, ...; each stretch between two cuts is
a process of its own, whose points fall evenly on its discrete levels, found by halving it.
A point counts for a text if its level lies below the shingle's multiplicity there, and goes
to one of the M components of the signature, which keep their earliest point. Two texts
agree in a component with the probability of their similarity. Points come in order of time,
so a text needs those up to its latest component only: about M log M, whatever its length.

Texts that agree in all ROWS components of a band are in one bucket. Exact copies are folded
before, and pairs are never written. Every text of a bucket is first compared with one centre,
its smallest, and verified exactly: linear work, which closes groups of near copies. Then only
texts outside the largest class of their bucket are compared with the others of it. A bucket
is cut into chunks; a task holds one chunk, or two, compares their signatures, and returns the
texts that may be similar to one of another class. Every pair belongs to one of the bands that
it shares, so it is looked at once. Another task holds the texts so chosen, takes their pairs
by falling agreement, skips what is already connected there, verifies the rest exactly, and
returns at most one link per text. Classes are the connected components of all links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import ready, written
from tidemark.llm.texts import as_bytes, hashed_words, mixed, windows

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
M = BANDS * ROWS
#: A pair is verified unless its signatures agree in a smaller share of components. At
#: similarity 0.8 at most 70 of 128 do with chance 9e-11, far below what the bands miss.
LEAST_AGREEMENT = 0.55
#: Texts of one bucket that a task compares with each other or with as many others.
CHUNK = 1024

_STEP = np.uint64(0x9E3779B97F4A7C15)


def bag(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text, sorted, and their multiplicities."""
    if not len(words):
        return words, np.zeros(0, dtype=np.int64)
    return np.unique(windows(words, min(SHINGLE, len(words))), return_counts=True)


def similarity(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags; 0 if either is empty."""
    if not len(one[0]) or not len(other[0]):
        return 0.0
    _, left, right = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    shared = np.minimum(one[1][left], other[1][right]).sum()
    return float(shared / (one[1].sum() + other[1].sum() - shared))


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int = M) -> np.ndarray:
    """One row of ``size`` 32-bit components per bag, none of them empty.

    Every stretch of weight of every shingle is a process: ``start`` is its first level and
    ``width`` the number of its levels; it runs at rate ``size * width``.
    """
    sizes = np.array([len(shingles) for shingles, _ in bags])
    doc = np.repeat(np.arange(len(bags)), sizes)
    shingle = np.concatenate([shingles for shingles, _ in bags])
    weight = np.concatenate([counts for _, counts in bags]).astype(np.int64)
    total = np.add.reduceat(weight, np.concatenate(([0], np.cumsum(sizes)[:-1])))
    starts = [np.zeros(len(doc), dtype=np.int64)]
    chosen = [np.arange(len(doc))]
    level = 1
    while (weight > level).any():
        more = np.flatnonzero(weight > level)
        chosen.append(more)
        starts.append(np.full(len(more), level))
        level *= 2
    start = np.concatenate(starts)
    pick = np.concatenate(chosen)
    width = np.maximum(start, 1)
    doc, top, seed = doc[pick], weight[pick], mixed(shingle[pick] + start.astype(np.uint64) * _STEP)
    earliest = np.full((len(bags), size), np.inf)
    identity = np.zeros((len(bags), size), dtype=np.uint32)
    # earliest time by which all components of a text are filled, almost surely
    horizon = (np.log(size) + 5.0) / total
    open_docs = np.ones(len(bags), dtype=bool)
    while True:
        active = np.flatnonzero(open_docs[doc])
        time = np.zeros(len(active))
        turn = 0
        while len(active):
            turn += 1
            bits = mixed(seed[active] + np.uint64(turn * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(_uniform(bits)) / (size * width[active])
            due = time <= horizon[doc[active]]
            active, time, bits = active[due], time[due], bits[due]
            if not len(active):
                break
            drawn = mixed(bits ^ _STEP)
            # the point's level: halving the stretch picks its leading bits
            at = start[active] + (drawn >> np.uint64(32)).astype(np.int64) % width[active]
            counts = at < top[active]
            slot = doc[active][counts] * size + (drawn[counts] & np.uint64(0xFFFFFFFF)).astype(np.int64) % size
            when = time[counts]
            flat, names = earliest.reshape(-1), identity.reshape(-1)
            before = flat[slot].copy()
            np.minimum.at(flat, slot, when)
            won = (flat[slot] == when) & (when < before)
            names[slot[won]] = (mixed(drawn[counts][won]) >> np.uint64(32)).astype(np.uint32)
        open_docs = np.isinf(earliest).any(axis=1)
        if not open_docs.any():
            return identity
        horizon[open_docs] *= 2
        earliest[open_docs] = np.inf


_SIGNED = pa.schema([("doc_id", pa.int64()), ("body", pa.string()), ("signature", pa.binary())])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, bodies = batch.column("doc_id"), batch.column("body")
        for first, (texts,) in hashed_words(as_bytes(batch.column("text"))):
            bags = [bag(words) for words in texts]
            rows = np.array([first + n for n, (shingles, _) in enumerate(bags) if len(shingles)], dtype=np.int64)
            if len(rows):
                signature = signatures([one for one in bags if len(one[0])])
                signed = pa.array([row.tobytes() for row in signature], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), bodies.take(pa.array(rows)), signed], schema=_SIGNED)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows of equal keys, also across batches."""
    waiting: list[pa.RecordBatch] = []
    now: tuple | None = None
    for batch in batches:
        columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in keys]
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for start, stop in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(int(column[start]) for column in columns)
            if waiting and key != now:
                yield now, pa.Table.from_batches(waiting)
                waiting = []
            now = key
            waiting.append(batch.slice(start, stop - start))
    if waiting:
        yield now, pa.Table.from_batches(waiting)


def _agreements(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Number of equal components for each row of ``one`` with each of ``other``."""
    total = np.zeros((len(one), len(other)), dtype=np.uint8 if M < 256 else np.uint16)
    for component in range(M):
        total += one[:, component, None] == other[None, :, component]
    return total


def _owned(nodes_a: np.ndarray, nodes_b: np.ndarray, a: np.ndarray, b: np.ndarray, band: int) -> np.ndarray:
    """Whether ``band`` is the one, of those a pair shares, in which it is looked at: the first
    from a band that the pair's own hash names."""
    first = (mixed(np.minimum(nodes_a, nodes_b).astype(np.uint64) * _STEP + np.maximum(nodes_a, nodes_b).astype(np.uint64)) % np.uint64(BANDS)).astype(np.int64)
    shared = (a.reshape(-1, BANDS, ROWS) == b.reshape(-1, BANDS, ROWS)).all(axis=2)
    turned = np.take_along_axis(shared, (first[:, None] + np.arange(BANDS)) % BANDS, axis=1)
    return (first + turned.argmax(axis=1)) % BANDS == band


_STAR = ["centre", "chunk"]
_ALIKE = pa.schema([("centre", pa.int64()), ("chunk", pa.int64()), ("node", pa.int64())])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each star to verify with its centre, and the centre if there are any."""
    for star, group in _groups(batches, _STAR):
        nodes, signature = group["node"].to_numpy(), _matrix(group)
        near = _agreements(signature, signature[nodes == star[0]][:1])[:, 0] >= LEAST_AGREEMENT * M
        if near.sum() > 1:
            rows = [(*star, node) for node in nodes[near].tolist()]
            yield _rows(rows, _ALIKE)


def _starred(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """A link from each text of a star to its centre, if they are similar."""
    for (centre, _), group in _groups(batches, _STAR):
        nodes, texts = group["node"].to_pylist(), as_bytes(group["text"].combine_chunks())
        middle = bag(next(hashed_words([texts[nodes.index(centre)]]))[1][0][0])
        links = [
            (nodes[first + n], centre)
            for first, (part,) in hashed_words(texts)
            for n, words in enumerate(part)
            if nodes[first + n] != centre and similarity(bag(words), middle) >= least
        ]
        if links:
            yield _rows(links, _LINKS)


_TILE = ["key", "low", "high"]
_CHOSEN = pa.schema([(name, pa.int64()) for name in (*_TILE, "band", "chunk", "node")])


def _matrix(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group["signature"].to_pylist()), dtype=np.uint32).reshape(-1, M)


def _near(tile: tuple, group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs of a tile to verify, and their agreement."""
    nodes, signature = group["node"].to_numpy(), _matrix(group)
    chunk, own = group["chunk"].to_numpy(), group["class"].to_numpy()
    left, right = np.flatnonzero(chunk == tile[1]), np.flatnonzero(chunk == tile[2])
    agreed = _agreements(signature[left], signature[right])
    near = (agreed >= LEAST_AGREEMENT * M) & (own[left][:, None] != own[right][None, :])
    if tile[1] == tile[2]:
        near &= np.tri(len(left), k=-1, dtype=bool).T
    x, y = np.nonzero(near)
    keep = np.zeros(len(x), dtype=bool)
    for start in range(0, len(x), 1 << 16):
        part = slice(start, start + (1 << 16))
        i, j = left[x[part]], right[y[part]]
        keep[part] = _owned(nodes[i], nodes[j], signature[i], signature[j], int(group["band"][0].as_py()))
    x, y = x[keep], y[keep]
    return left[x], right[y], agreed[x, y]


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each tile that have a pair to verify."""
    for tile, group in _groups(batches, _TILE):
        one, other, _ = _near(tile, group)
        if len(one):
            yield from group.take(np.union1d(one, other)).select(_CHOSEN.names).cast(_CHOSEN).combine_chunks().to_batches()


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)], schema=schema)


def verified(own: list[int], texts: list[bytes], pairs: Iterable[tuple[int, int]], least: float) -> list[tuple[int, int]]:
    """Links among ``pairs`` of places, in their order, enough to connect what they connect;
    texts of one class in ``own`` are connected already."""
    first = {group: place for place, group in reversed(list(enumerate(own)))}
    parent = [first[group] for group in own]

    def top(number: int) -> int:
        while parent[number] != number:
            parent[number] = number = parent[parent[number]]
        return number

    bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bag_of(number: int) -> tuple[np.ndarray, np.ndarray]:
        if number not in bags:
            bags[number] = bag(next(hashed_words([texts[number]]))[1][0][0])
        return bags[number]

    links = []
    for one, other in pairs:
        if top(one) != top(other) and similarity(bag_of(one), bag_of(other)) >= least:
            parent[top(one)] = top(other)
            links.append((one, other))
    return links


def _verified(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for tile, group in _groups(batches, _TILE):
        one, other, agreed = _near(tile, group)
        order = np.argsort(-agreed.astype(np.int64), kind="stable")
        pairs = zip(one[order].tolist(), other[order].tolist(), strict=True)
        nodes, texts = group["node"].to_pylist(), as_bytes(group["text"].combine_chunks())
        links = [(nodes[a], nodes[b]) for a, b in verified(group["class"].to_pylist(), texts, pairs, least)]
        if links:
            yield _rows(links, _LINKS)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id, class_id, kept``.

    A class is a connected component of linked texts; its id is its smallest ``doc_id``, whose
    row is ``kept``. Copies are in one class. A text without words (null, empty, blank) is a
    class of its own and kept. Null ids never name a class unless all of its ids are null;
    repeated rows share class and decision. An empty table gives an empty table. Other
    columns are not read.
    """
    return _classified(_identified(docs), least).select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.col("class_id").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
    )


def _identified(docs: DataFrame) -> DataFrame:
    ready(docs.sparkSession)
    text = F.col("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_id"),
        F.md5(text.cast("binary")).alias("body"),
        "text",
    )


def _classified(rows: DataFrame, least: float) -> DataFrame:
    """``doc_id, _id, body`` of every row with the class of its text (null without words)."""
    found = _class_of_bodies(rows, least).drop("_id")
    return rows.drop("text").join(found, "body", "left")


def _class_of_bodies(rows: DataFrame, least: float) -> DataFrame:
    """``body, _id, root, class_id`` for every text that has words: its smallest id, and the
    name and smallest id of its class."""
    signed = rows.select(F.col("_id").alias("doc_id"), "body", "text").mapInArrow(_signed, "doc_id long, body string, signature binary")
    signed = signed.groupBy("body").agg(F.min("doc_id").alias("_id"), F.first("signature").alias("signature"))
    signed = written(signed.withColumn("node", F.monotonically_increasing_id()), "signed")

    slices = [
        F.struct(F.xxhash64(F.substring("signature", 4 * ROWS * band + 1, 4 * ROWS), F.lit(band)).alias("key"), F.lit(band).alias("band"))
        for band in range(BANDS)
    ]
    bands = F.explode(F.array(*slices)).alias("at")

    def texts_of(chosen: DataFrame) -> DataFrame:
        needed = signed.select("node", "_id", "body").join(chosen.select("node").distinct(), "node")
        found = rows.select("_id", "body", "text").join(needed, ["_id", "body"])
        return found.groupBy("_id", "body", "node").agg(F.first("text").alias("text")).select("node", "text")

    def dealt(members: DataFrame, keys: list[str]) -> DataFrame:
        return members.repartition(*keys).sortWithinPartitions(*keys)

    # every text with the centre of each of its buckets
    inside = signed.select("node", bands).select("node", "at.key")
    centres = inside.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1")
    pairs = inside.join(centres, "key").where("node <> centre").select("centre", "node").distinct()
    chunks = pairs.groupBy("centre").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks"))
    leaves = pairs.join(chunks, "centre").select("centre", F.pmod(F.xxhash64("node"), "chunks").alias("chunk"), "node")
    middles = chunks.select("centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.col("centre").alias("node"))
    stars = leaves.unionByName(middles).join(signed.select("node", "signature"), "node")
    alike = written(dealt(stars, _STAR).select(*_STAR, "node", "signature").mapInArrow(_alike, "centre long, chunk long, node long"), "alike")
    starred = dealt(alike.join(texts_of(alike), "node"), _STAR).select(*_STAR, "node", "text")
    root = components(starred.mapInArrow(lambda batches: _starred(batches, least), "a long, b long"))

    # texts outside the largest class of a bucket, with the others of it
    classed = signed.select("node", "signature").join(root, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")
    members = classed.select("node", "class", bands).select("node", "class", "at.*")
    largest = members.groupBy("key", "class").agg(F.count("*").alias("n")).groupBy("key")
    largest = largest.agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("top")).where("n > top.n")
    outer, inner = (F.ceil(size / CHUNK).cast("long") for size in (F.col("n") - F.col("top.n"), F.col("top.n")))
    members = members.join(largest.select("key", F.col("top.class").alias("largest"), outer.alias("outer"), inner.alias("inner")), "key")
    apart, spread = F.col("class") != F.col("largest"), F.xxhash64("node")
    members = members.withColumn("chunk", F.when(apart, F.pmod(spread, "outer")).otherwise(F.col("outer") + F.pmod(spread, "inner")))
    met = F.when(apart, F.col("outer") + F.col("inner")).otherwise(F.col("outer"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), met - 1)))
    members = members.select("key", F.col("band").cast("long"), "node", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    tiled = dealt(members.join(classed, "node"), _TILE)
    chosen = written(tiled.mapInArrow(_chosen, ", ".join(f"{name} long" for name in _CHOSEN.names)), "chosen")
    held = dealt(chosen.join(classed, "node").join(texts_of(chosen), "node"), _TILE)
    links = held.mapInArrow(lambda batches: _verified(batches, least), "a long, b long")
    root = components(links.unionByName(root.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    whole = signed.select("node", "_id", "body").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = whole.groupBy("root").agg(F.min("_id").alias("class_id"))
    whole = whole.join(smallest, "root")
    return whole.select("body", "_id", "root", F.when(F.col("class_id") < (1 << 63) - 1, F.col("class_id")).alias("class_id"))


def drop_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all its columns: the one ``classes`` keeps.

    Texts without words all stay. Of repeated rows of the document kept, one stays.
    """
    names = docs.columns
    rows = _identified(docs)
    found = _class_of_bodies(rows, least)
    whole = (1 << 63) - 1
    chosen = found.groupBy("root").agg(F.min(F.struct("_id", "body")).alias("pick")).select("pick.*")
    chosen = chosen.select(F.col("_id").alias("_keep_id"), F.col("body").alias("_keep_body"))
    source = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("_row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(whole)).alias("_keep_id"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("_keep_body"),
        (~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).alias("_blank"),
    )
    kept = source.where("not _blank").join(chosen, ["_keep_id", "_keep_body"])
    first = F.row_number().over(Window.partitionBy("_keep_id", "_keep_body").orderBy(F.lit(0)))
    kept = kept.withColumn("_turn", first).where("_turn = 1")
    return kept.select("_row.*").unionByName(source.where("_blank").select("_row.*"))
