"""Ranked lexical search over bit-sliced Bloom signatures.

Every document has a Bloom signature of its terms. A term that occurs more than 1, 2, 4, 8 ...
times is entered once more for each of these levels. Documents of about the same number of
entries share a block and a signature width; the block keeps its signatures sliced: one bitmap
over its documents per signature bit. ANDing the slices of a term gives the documents that may
hold it, and how often at most: never too few, sometimes too many. Weighted sums over the slices
of an item's terms are then upper bounds of its scores.

A task goes through its blocks with the best scores that each item has so far. Documents whose
bound lies below an item's last kept score are provably out; all others are scored exactly from
their text. Nothing else is left out, so the answer is that of a full scan.

Items are taken in blocks of bounded size, one pass over the signatures for each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tidemark.llm.tables import ready, shared_folder, stored, written
from tidemark.llm.terms import folded, hashed
from tidemark.llm.texts import as_bytes, hashed_words, mixed

TOP = 10
#: Documents and bytes of text in one block, and bits of all its signatures.
BLOCK_DOCS, BLOCK_BYTES, BLOCK_BITS = 512, 1 << 21, 1 << 25
#: Bits set per entry; signatures have 8 to 16 bits per entry, up to the widest. A document with
#: more entries has a fuller signature, so it is scored exactly more often.
PROBES, NARROWEST, WIDEST = 4, 9, 22
#: Items in one block, and the terms after which a block is closed (an item stays whole).
ITEMS, ITEM_TERMS = 256, 1 << 16
#: Pairs of an item and a term summed at once.
SUMMED = 1 << 12
_LEVEL = np.uint64(0x9E3779B97F4A7C15)


def levels(times: np.ndarray) -> np.ndarray:
    """How many levels a term enters: level 0 always, level j when it occurs over 2 ** (j - 1) times."""
    return 1 + np.ceil(np.log2(times)).astype(np.int64)


def places(terms: np.ndarray, level: int | np.ndarray, bits: int) -> np.ndarray:
    """Signature bits of entries, one row per probe."""
    seed = mixed(terms + np.uint64(1) + np.asarray(level).astype(np.uint64) * _LEVEL)
    step = (seed >> np.uint64(32)) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((seed + probes * step) & np.uint64(bits - 1)).astype(np.int64)


@dataclass
class _Block:
    """Documents waiting for their block to fill."""

    ids: list = field(default_factory=list)
    texts: list[bytes] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    terms: list[np.ndarray] = field(default_factory=list)
    entered: list[np.ndarray] = field(default_factory=list)
    held: int = 0

    def sliced(self, bits: int) -> np.ndarray:
        signatures = np.zeros((bits, len(self.ids)), dtype=bool)
        for doc, (terms, entered) in enumerate(zip(self.terms, self.entered, strict=True)):
            each = np.repeat(terms, entered)
            level = np.arange(len(each)) - np.repeat(np.cumsum(entered) - entered, entered)
            signatures[places(each, level, bits).ravel(), doc] = True
        return np.packbits(signatures, axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: dict[int, _Block] = {}

    def row(bits: int) -> pa.RecordBatch:
        block = waiting.pop(bits)
        terms, holders = np.unique(np.concatenate(block.terms), return_counts=True)
        values = (block.ids, block.lengths, block.texts, bits, block.sliced(bits).tobytes(), terms.view(np.int64), holders)
        return pa.RecordBatch.from_arrays([pa.array([value], f.type) for value, f in zip(values, schema, strict=True)], schema=schema)

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        texts = [folded(text) for text in as_bytes(batch.column("text"))]
        for first, (found,) in hashed_words(texts):
            for number, words in enumerate(found, first):
                if not len(words):
                    continue
                terms, times = np.unique(words, return_counts=True)
                entered = levels(times)
                width = max(math.ceil(math.log2(int(entered.sum()))) + 3, NARROWEST)
                bits = 1 << min(width, WIDEST)
                block = waiting.setdefault(bits, _Block())
                block.ids.append(ids[number])
                block.texts.append(texts[number])
                block.lengths.append(len(words))
                block.terms.append(terms)
                block.entered.append(entered)
                block.held += len(texts[number])
                if len(block.ids) >= min(BLOCK_DOCS, BLOCK_BITS // bits) or block.held >= BLOCK_BYTES:
                    yield row(bits)
    for bits in list(waiting):
        yield row(bits)


def index(docs: DataFrame) -> DataFrame:
    """One row per block of documents with a term: ``ids, lengths, texts`` (folded), ``bits,
    slices``, and the block's distinct ``terms`` with the number of its documents that hold each."""
    ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    names = ("ids", "lengths", "texts", "bits", "slices", "terms", "holders")
    types = (pa.list_(_arrow(kind)), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    schema = pa.schema(list(zip(names, types, strict=True)))
    columns = f"ids array<{kind.simpleString()}>, lengths array<long>, texts array<binary>, bits int, slices binary, terms array<long>, holders array<int>"
    return written(docs.select("doc_id", "text").mapInArrow(lambda batches: _blocks(batches, schema), columns), "signatures")


def _arrow(kind: DataType) -> pa.DataType:
    return to_arrow_type(kind)


def _asked(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Items packed into blocks: their ids, how many terms each has, the terms and their hashes."""
    ids: list = []
    sizes: list[int] = []
    terms: list[bytes] = []

    def row() -> pa.RecordBatch:
        values = (ids, sizes, terms, hashed(terms).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array([value], f.type) for value, f in zip(values, schema, strict=True)], schema=schema)

    for batch in batches:
        for item, text in zip(batch.column("item_id").to_pylist(), as_bytes(batch.column("text")), strict=True):
            own = sorted(set(folded(text).split()))
            if own:
                ids.append(item)
                sizes.append(len(own))
                terms.extend(own)
            if len(ids) >= ITEMS or len(terms) >= ITEM_TERMS:
                yield row()
                ids, sizes, terms = [], [], []
    if ids:
        yield row()


@dataclass
class Asked:
    """A block of items: ``wording`` names, for each item in turn, its terms."""

    ids: list
    starts: np.ndarray
    wording: np.ndarray
    item: np.ndarray
    number: dict[bytes, int]
    hashes: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, ids: list, sizes: list[int], terms: list[bytes], holders: dict[int, int], documents: int) -> Asked:
        number = {term: at for at, term in enumerate(sorted(set(terms)))}
        hashes = hashed(list(number))
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * holders.get(key, 0) + 1))) for key in hashes.view(np.int64).tolist()]
        size = np.array(sizes)
        return cls(
            ids,
            np.cumsum(size) - size,
            np.array([number[term] for term in terms], dtype=np.int64),
            np.repeat(np.arange(len(ids)), size),
            number,
            hashes,
            np.array(weights, dtype=np.int64),
        )

    def bounds(self, slices: np.ndarray, bits: int, lengths: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Upper bound of the score of every item and document of a block."""
        total = np.zeros((len(self.ids), len(lengths)), dtype=np.int64)
        alive, seen = np.arange(len(self.hashes)), None
        level, reached = 0, np.zeros(len(lengths), dtype=np.int64)
        while len(alive) and (level == 0 or 1 << (level - 1) < lengths.max()):
            probes = slices[places(self.hashes[alive], level, bits)]
            held = np.bitwise_and.reduce(probes, axis=0)
            held = held if seen is None else held & seen
            some = held.any(axis=1)
            alive, seen = alive[some], held[some]
            most = saturated(np.minimum(1 << level, lengths), norm)
            self._add(total, np.unpackbits(seen, axis=1, count=len(lengths)), alive, most - reached)
            level, reached = level + 1, most
        return total

    def _add(self, total: np.ndarray, held: np.ndarray, alive: np.ndarray, gain: np.ndarray) -> None:
        row = np.full(len(self.hashes), -1)
        row[alive] = np.arange(len(alive))
        pairs = np.flatnonzero(row[self.wording] >= 0)
        for start in range(0, len(pairs), SUMMED):
            some = pairs[start : start + SUMMED]
            weighted = held[row[self.wording[some]]] * self.weights[self.wording[some], None]
            cuts = np.flatnonzero(np.diff(self.item[some], prepend=-1))
            total[self.item[some][cuts]] += np.add.reduceat(weighted, cuts, axis=0) * gain

    def scores(self, text: bytes, norm: int) -> np.ndarray:
        """Exact score of one document for every item."""
        times = np.zeros(len(self.hashes), dtype=np.int64)
        number = self.number
        for term, count in Counter(text.split()).items():
            at = number.get(term)
            if at is not None:
                times[at] = count
        return np.add.reduceat((self.weights * saturated(times, norm))[self.wording], self.starts)


def saturated(times: np.ndarray, norm: np.ndarray | int) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 8 * norm)


class _Best:
    """The best documents of every item so far, and the score below which none can enter."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.rows: list[list[tuple]] = [[] for _ in range(items)]
        self.floor = np.zeros(items, dtype=np.int64)

    def raised(self, scores: np.ndarray) -> np.ndarray:
        """The floor with some documents' scores (items by documents) taken in."""
        kept = np.zeros((len(self.rows), self.top), dtype=np.int64)
        for item, rows in enumerate(self.rows):
            kept[item, : len(rows)] = [row[0] for row in rows]
        return np.sort(np.concatenate([kept, scores], axis=1), axis=1)[:, -self.top]

    def take(self, ids: list, scores: np.ndarray, floor: np.ndarray) -> None:
        enters = (scores >= floor[:, None]) & (scores > 0)
        for item in np.flatnonzero(enters.any(axis=1)).tolist():
            docs = np.flatnonzero(enters[item]).tolist()
            rows = self.rows[item] + [(int(scores[item, doc]), ids[doc]) for doc in docs]
            rows.sort(key=lambda row: (-row[0], row[1] is None, row[1] if row[1] is not None else 0))
            self.rows[item] = rows[: self.top]
            if len(rows) >= self.top:
                self.floor[item] = rows[self.top - 1][0]


def _searched(batches: Iterator[pa.RecordBatch], asked: Asked, documents: int, words: int, top: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    best = _Best(len(asked.ids), top)
    for batch in batches:
        for number in range(batch.num_rows):
            row = {name: batch.column(name)[number] for name in batch.schema.names}
            ids, lengths = row["ids"].as_py(), row["lengths"].as_py()
            bits = row["bits"].as_py()
            slices = np.frombuffer(row["slices"].as_buffer(), dtype=np.uint8).reshape(bits, -1)
            norm = np.array([10 + (90 * length * documents) // words for length in lengths], dtype=np.int64)
            bound = asked.bounds(slices, bits, np.array(lengths, dtype=np.int64), norm)
            undecided = (bound >= best.floor[:, None]) & (bound > 0)
            if not undecided.any():
                continue
            texts = row["texts"].values
            # each item's highest bounds first, so that the others meet a high floor
            leading = np.zeros_like(undecided)
            first = np.argsort(-bound, axis=1, kind="stable")[:, :top]
            np.put_along_axis(leading, first, True, axis=1)
            docs = np.flatnonzero((undecided & leading).any(axis=0))
            scores = np.stack([asked.scores(texts[doc].as_py(), int(norm[doc])) for doc in docs.tolist()], axis=1)
            floor = best.raised(scores)
            undecided &= bound >= floor[:, None]
            undecided[:, docs] = False
            rest = np.flatnonzero(undecided.any(axis=0))
            if len(rest):
                more = [asked.scores(texts[doc].as_py(), int(norm[doc])) for doc in rest.tolist()]
                docs, scores = np.concatenate([docs, rest]), np.concatenate([scores, np.stack(more, axis=1)], axis=1)
            best.take([ids[doc] for doc in docs.tolist()], scores, floor)
    found = [(item, doc, score) for item, rows in zip(asked.ids, best.rows, strict=True) for score, doc in rows]
    columns = list(zip(*found, strict=True)) or [[], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(columns, schema, strict=True)], schema=schema)


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item, score above 0.

    Null and empty texts have no terms: such documents are in no count and no answer, such
    items have no answer. Every row of ``docs`` is a document, so repeated rows are found each.
    Equal scores go by ascending ``doc_id``, null last. An id given to several items asks once,
    with its smallest text; a null item id is an id. Empty tables give an empty table. Other
    columns are not read.

    Terms are matched by their bytes when scored and by 64-bit hashes when documents that hold
    them are counted.
    """
    spark = ready(docs.sparkSession)
    blocks = index(docs)
    documents, words = blocks.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    kinds = items.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    columns = f"item_id {kinds[0].simpleString()}, doc_id {kinds[1].simpleString()}, score long"
    found_schema = pa.schema([("item_id", _arrow(kinds[0])), ("doc_id", _arrow(kinds[1])), ("score", pa.int64())])
    asked_schema = pa.schema([("items", pa.list_(_arrow(kinds[0]))), ("sizes", pa.list_(pa.int32())), ("terms", pa.list_(pa.binary())), ("hashes", pa.list_(pa.int64()))])

    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    once = items.groupBy("item_id").agg(F.min("text").alias("text")).coalesce(1 + size // (ITEM_TERMS * 8))
    asked = once.mapInArrow(
        lambda batches: _asked(batches, asked_schema),
        f"items array<{kinds[0].simpleString()}>, sizes array<int>, terms array<binary>, hashes array<long>",
    )
    asked = written(asked.withColumn("block", F.monotonically_increasing_id()), "asked")
    wanted = asked.select(F.explode("hashes").alias("term")).distinct()
    entries = blocks.select(F.explode(F.arrays_zip("terms", "holders")).alias("entry")).select("entry.*").withColumnRenamed("terms", "term")
    holders = written(entries.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("holders").alias("holders")), "holders")

    folder = shared_folder(spark, "ranked")
    found = spark.createDataFrame([], columns)
    searched = blocks.select("ids", "lengths", "texts", "bits", "slices")
    for number, key in enumerate(row["block"] for row in asked.select("block").orderBy("block").collect()):
        one = asked.where(F.col("block") == key)
        own = one.select(F.explode("hashes").alias("term")).distinct().join(holders, "term")
        given = one.first()  # ITEMS items, and ITEM_TERMS terms or those of the last item
        block = Asked.of(given["items"], given["sizes"], [bytes(term) for term in given["terms"]], {row["term"]: row["holders"] for row in own.collect()}, documents or 0)
        if documents:
            part = searched.mapInArrow(lambda batches, block=block: _searched(batches, block, documents, words, top, found_schema), columns)
            stored(part, f"{folder}/part={number}")
            found = spark.read.schema(found.schema).parquet(*[f"{folder}/part={n}" for n in range(number + 1)])
    ahead = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(ahead)).where(F.col("rank") <= top)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
