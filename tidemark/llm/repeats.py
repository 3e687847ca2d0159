"""Removing long repeated passages: fixed-block anchors.

A window is WINDOW consecutive words of one document. Any window holds a whole block of
BLOCK words at a multiple of BLOCK, so a window that occurs twice holds a block whose words
occur twice. The steps:

1. Index the non-overlapping blocks of every document, and probe the index with every rolling
   run of BLOCK words. A block is hit if its words start at two places or more.
2. Only windows around hit blocks can be repeats. Their hashes (over 96 bits) tell which of
   them start at two places or more; runs of such windows are the maximal exact repeats.
3. Every word under a repeated window is removed.

No pair of occurrences is ever formed: both steps only count, see ``exchange``. Texts move
once to meet their hit blocks and, if they have any, once more to meet their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.exchange import PACKET_KEYS, bucket_bits, expanded, heads, squeezed, tails, trimmed, unique_flags
from tidemark.llm.tables import ready, written
from tidemark.llm.texts import as_bytes, hashed_words, windows

WINDOW = 35
#: Bytes of text per word assumed when buckets are sized.
WORD_BYTES = 6


def _probes(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    block = (window + 1) // 2
    rolling: list[np.ndarray] = []
    anchors: list[np.ndarray] = []
    held = 0

    def packet() -> Iterator[pa.RecordBatch]:
        keys, fixed = trimmed(np.concatenate(rolling), bits), np.unique(trimmed(np.concatenate(anchors), bits))
        first, repeated = unique_flags(keys)
        keys = keys[first]
        edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(32)
        cut, fixed_cut = np.searchsorted(keys, edges), np.searchsorted(fixed, edges)
        parts = zip(np.split(keys, cut), np.split(repeated, cut), np.split(fixed, fixed_cut), strict=True)
        for bucket, (own, flags, index) in enumerate(parts):
            if len(own):
                yield _row(_PROBES, bucket, squeezed(own), np.packbits(flags).tobytes(), squeezed(index))

    for batch in batches:
        for _, (texts,) in hashed_words(as_bytes(batch.column("text"))):
            for words in texts:
                if len(words) >= window:
                    runs = windows(words, block)
                    rolling.append(runs)
                    anchors.append(runs[::block])
                    held += len(runs)
            if held >= PACKET_KEYS:
                yield from packet()
                rolling, anchors, held = [], [], 0
    if held:
        yield from packet()


def _row(schema: pa.Schema, *values: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


_PROBES = pa.schema([("bucket", pa.int64()), ("probes", pa.binary()), ("repeated", pa.binary()), ("anchors", pa.binary())])


def _hit_anchors(packets: pd.DataFrame) -> pd.DataFrame:
    """Anchors whose words start at two places or more."""
    index = np.unique(np.concatenate([expanded(data) for data in packets["anchors"]]))
    seen = np.zeros(len(index), dtype=np.int64)
    for probes, flags in zip(packets["probes"], packets["repeated"], strict=True):
        values = expanded(probes)
        twice = np.unpackbits(np.frombuffer(flags, dtype=np.uint8), count=len(values))
        place = np.minimum(np.searchsorted(index, values), max(len(index) - 1, 0))
        known = index[place] == values if len(index) else np.zeros(len(values), dtype=bool)
        seen[place[known]] += 1 + twice[known]
    return pd.DataFrame({"anchor": (np.int64(packets["bucket"].iloc[0]) << np.int64(32)) | index[seen > 1].astype(np.int64)})


def _anchors(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """``doc, body, block, anchor`` of every document's non-overlapping blocks."""
    size = (window + 1) // 2
    for batch in batches:
        doc, body = batch.column("doc").to_numpy(), batch.column("body").to_numpy()
        for first, (texts,) in hashed_words(as_bytes(batch.column("text"))):
            found = [(first + n, trimmed(_blocks(words, size), bits)) for n, words in enumerate(texts) if len(words) >= window]
            if found:
                rows = np.repeat([row for row, _ in found], [len(keys) for _, keys in found])
                columns = {
                    "doc": doc[rows],
                    "body": body[rows],
                    "block": np.concatenate([np.arange(len(keys)) for _, keys in found]),
                    "anchor": np.concatenate([keys for _, keys in found]).astype(np.int64),
                }
                yield pa.RecordBatch.from_pydict(columns, _ANCHORS)


def _blocks(words: np.ndarray, size: int) -> np.ndarray:
    """The same hashes as ``windows(words, size)[::size]``, without the runs between."""
    count = len(words) // size
    cut = words[: count * size].reshape(count, size)
    return windows(cut.T.reshape(size, count), size)[0] if count else np.zeros(0, dtype=np.uint64)


_ANCHORS = pa.schema([("doc", pa.int64()), ("body", pa.int64()), ("block", pa.int32()), ("anchor", pa.int64())])


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without a hit are finished; the others are gathered into packets."""
    group: list[tuple[int | None, bytes, list[int]]] = []
    held = 0

    def packet() -> pa.RecordBatch:
        ids, texts, blocks = (list(part) for part in zip(*group, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array([value], field.type) for value, field in zip(([], [], [], ids, texts, blocks), _PACKETS, strict=True)],
            schema=_PACKETS,
        )

    for batch in batches:
        ids, texts, hits = batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), batch.column("blocks").to_pylist()
        done: tuple[list, list, list] = ([], [], [])
        for doc_id, text, blocks in zip(ids, texts, hits, strict=True):
            if blocks:
                group.append((doc_id, text, blocks))
                held += len(text)
                if held >= PACKET_KEYS * WORD_BYTES:
                    yield packet()
                    group, held = [], 0
            else:
                words = text.split()
                for column, value in zip(done, (doc_id, len(words), _digest(words)), strict=True):
                    column.append(value)
        values = [[column] for column in done] + [[[]]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _PACKETS, strict=True)], schema=_PACKETS)
    if group:
        yield packet()


_PACKETS = pa.schema(
    [
        ("done_ids", pa.list_(pa.int64())),
        ("done_words", pa.list_(pa.int64())),
        ("done_sha256", pa.list_(pa.string())),
        ("ids", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.binary())),
        ("blocks", pa.list_(pa.list_(pa.int32()))),
    ]
)
_PACKETS_SQL = "done_ids array<long>, done_words array<long>, done_sha256 array<string>, ids array<long>, texts array<binary>, blocks array<array<int>>"


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _candidates(texts: list[bytes], blocks: list[list[int]], window: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Places of the windows around hit blocks per text, and both hashes of all of them."""
    size = (window + 1) // 2
    places, one, other = [], [], []
    for first, (left, right) in hashed_words(texts, hashes=2):
        for number, (a, b) in enumerate(zip(left, right, strict=True)):
            near = np.zeros(len(a) + size, dtype=bool)
            starts = np.unique(np.asarray(blocks[first + number], dtype=np.int64)) * size
            for back in range(window - size + 1):
                near[starts[starts >= back] - back] = True
            place = np.flatnonzero(near[: max(len(a) - window + 1, 0)])
            places.append(place)
            one.append(windows(a, window, 0)[place])
            other.append(windows(b, window, 1)[place])
    return places, np.concatenate(one), np.concatenate(other)


def _windows(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            _, one, other = _candidates(row["texts"], row["blocks"], window)
            one = trimmed(one, bits)
            first, repeated = unique_flags(one, other)
            one, other = one[first], other[first]
            cut = np.searchsorted(one, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(32))
            for bucket, (a, b, flags) in enumerate(zip(np.split(one, cut), np.split(other, cut), np.split(repeated, cut), strict=True)):
                if len(a):
                    yield _row(_WINDOWS, row["packet"], bucket, squeezed(a), b.tobytes(), np.packbits(flags).tobytes())


_WINDOWS = pa.schema([("packet", pa.int64()), ("bucket", pa.int64()), ("one", pa.binary()), ("other", pa.binary()), ("repeated", pa.binary())])


def _repeated_windows(packets: pd.DataFrame) -> pd.DataFrame:
    """For each packet of a bucket, which of its distinct windows start at two places or more."""
    one = [expanded(data) for data in packets["one"]]
    sizes = [len(part) for part in one]
    keys = np.concatenate(one)
    other = np.concatenate([np.frombuffer(data, dtype=np.uint64) for data in packets["other"]])
    flags = [np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=size) for data, size in zip(packets["repeated"], sizes, strict=True)]
    order = np.lexsort((other, keys))
    ranked, second = keys[order], other[order]
    same = (ranked[1:] == ranked[:-1]) & (second[1:] == second[:-1])
    found = np.concatenate(flags).astype(bool)
    again = np.zeros(len(keys), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    found[order] |= again
    parts = np.split(found, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"packet": packets["packet"], "bucket": packets["bucket"], "found": [np.packbits(part).tobytes() for part in parts]})


def _finished(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            places, one, other = _candidates(row["texts"], row["blocks"], window)
            one = trimmed(one, bits)
            first, _ = unique_flags(one, other)
            keys = one[first]
            edges = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
            flags = np.zeros(len(keys), dtype=bool)
            for reply in row["replies"] or []:
                start, stop = edges[reply["bucket"]], edges[reply["bucket"] + 1]
                flags[start:stop] = np.unpackbits(np.frombuffer(reply["found"], dtype=np.uint8), count=stop - start)
            # back from distinct windows to all windows of the packet
            order = np.lexsort((other, one))
            rank = np.empty(len(one), dtype=np.int64)
            rank[order] = np.arange(len(one))
            each = np.searchsorted(rank[first], rank, side="right") - 1
            hit = flags[each]
            rows: list[tuple] = []
            at = 0
            for doc_id, text, place in zip(row["ids"], row["texts"], places, strict=True):
                words = text.split()
                repeated = place[hit[at : at + len(place)]]
                at += len(place)
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(cover, repeated, 1)
                np.add.at(cover, repeated + window, -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = [word for word, out in zip(words, gone.tolist(), strict=True) if not out] if len(repeated) else words
                rows.append((doc_id, len(words), int(gone.sum()), _digest(kept), b" ".join(kept).decode()))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _FINISHED, strict=True)], schema=_FINISHED)


_FINISHED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, kept``.

    ``kept`` is the remaining words joined by one space if something was looked at closely,
    else null (every word stays then). A null or empty text has no words. Documents shorter
    than ``window`` lose nothing. Repeated rows are documents of their own, so their windows
    repeat. Equal ids with different texts are told apart by the text. An empty table gives
    an empty table; other columns are not read.
    """
    ready(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("body"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bucket_bits(size // WORD_BYTES)
    probes = rows.select("text").mapInArrow(
        lambda batches: _probes(batches, window, bits), "bucket long, probes binary, repeated binary, anchors binary"
    )
    hit = written(probes.groupBy("bucket").applyInPandas(_hit_anchors, "anchor long"), "anchors")
    own = rows.select("doc", "body", "text").mapInArrow(
        lambda batches: _anchors(batches, window, bits), "doc long, body long, block int, anchor long"
    )
    blocks = own.join(hit, "anchor").groupBy("doc", "body").agg(F.collect_set("block").alias("blocks"))
    met = rows.join(blocks, ["doc", "body"], "left").select("doc_id", "text", "blocks")
    table = met.mapInArrow(_sorted_out, _PACKETS_SQL).withColumn("packet", F.monotonically_increasing_id())
    table = written(table, "packets")
    packets = table.where(F.size("ids") > 0).select("packet", "texts", "blocks", "ids")
    sent = packets.select("packet", "texts", "blocks").mapInArrow(
        lambda batches: _windows(batches, window, bits), "packet long, bucket long, one binary, other binary, repeated binary"
    )
    found = sent.groupBy("bucket").applyInPandas(_repeated_windows, "packet long, bucket long, found binary")
    replies = found.groupBy("packet").agg(F.collect_list(F.struct("bucket", "found")).alias("replies"))
    finished = packets.join(replies, "packet", "left").mapInArrow(
        lambda batches: _finished(batches, window, bits),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string",
    )
    done = table.select(F.explode(F.arrays_zip("done_ids", "done_words", "done_sha256")).alias("d"))
    done = done.select(
        F.col("d.done_ids").alias("doc_id"),
        F.col("d.done_words").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"),
        F.col("d.done_sha256").alias("kept_sha256"),
        F.lit(None).cast("string").alias("kept"),
    )
    return finished.unionByName(done)
