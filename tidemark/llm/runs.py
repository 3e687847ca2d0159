"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run is a stretch of words with smallest period q, at least ``max(least, 2 q)`` long, that no
neighbouring word extends. Each of its words occurs again q words away, so within the segment
that holds the run no word of it stands alone:

1. A word without a second occurrence within half its segment's length is in no run of that
   segment. All such words split their segments; pieces too short for a run are dropped.
   Shorter segments make further words rare, so this is repeated until nothing splits.
2. A surviving segment is scanned lag by lag. A run of period q covers two neighbouring
   multiples of q, so for lag q only the words there are compared, and matches are extended to
   both sides by blocks of 2 ** k words whose numbers tell exactly whether two of them are equal.

Neither step forms pairs of occurrences; a segment of m words costs m log m comparisons. Words
are told apart by 64-bit hashes. Texts are cut at no place but between documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.tables import ready
from tidemark.llm.texts import as_bytes, hashed_words

LEAST = 12
#: Rounds that split all segments at once; segments still splitting then are split from their ends.
ROUNDS = 24
#: Words looked at from either end at first.
REACH = 256
#: Pairs of anchors compared at once.
PAIRS = 1 << 20


@dataclass
class Runs:
    start: np.ndarray
    stop: np.ndarray
    period: np.ndarray


def _neighbours(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the same word's occurrence before and after each; far outside if there is none."""
    order = np.argsort(words, kind="stable")
    same = words[order[1:]] == words[order[:-1]]
    far = 4 * len(words) + 4
    before, after = np.full(len(words), -far), np.full(len(words), far)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def _alone(at: np.ndarray, start: np.ndarray | int, stop: np.ndarray | int, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    half = (stop - start) // 2
    left, right = before[at], after[at]
    return ((left < start) | (at - left > half)) & ((right >= stop) | (right - at > half))


def surviving(before: np.ndarray, after: np.ndarray, start: np.ndarray, stop: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the segments in which no word is too rare to join a run, from ``start``
    and ``stop`` of disjoint ones in order."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ROUNDS):
        long = stop - start >= least
        start, stop = start[long], stop[long]
        if not len(start):
            break
        size = stop - start
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(start - first, size)
        rare = _alone(at, np.repeat(start, size), np.repeat(stop, size), before, after)
        split = np.add.reduceat(rare, first) > 0
        done.append((start[~split], stop[~split]))
        # a piece begins after a rare word or at a segment's start, and ends before one or at its stop
        edges = at[rare]
        start, stop = np.sort(np.concatenate([start[split], edges + 1])), np.sort(np.concatenate([stop[split], edges]))
    else:
        found = [piece for left, right in zip(start.tolist(), stop.tolist(), strict=True) for piece in _from_ends(before, after, left, right, least)]
        done.append((np.array([a for a, _ in found], dtype=np.int64), np.array([b for _, b in found], dtype=np.int64)))
    starts, stops = (np.concatenate([np.zeros(0, dtype=np.int64), *parts]) for parts in (list(zip(*done, strict=True)) or [(), ()]))
    order = np.argsort(starts, kind="stable")
    return starts[order], stops[order]


def _from_ends(before: np.ndarray, after: np.ndarray, start: int, stop: int, least: int) -> Iterator[tuple[int, int]]:
    """The same for one segment. A rare word is looked for from both ends, twice as far each
    time, so a split costs as much as its smaller part is long: n log n in the worst case."""
    waiting = [(start, stop)]
    while waiting:
        start, stop = waiting.pop()
        if stop - start < least:
            continue
        reach, left, right = REACH, start, stop
        cut = None
        while cut is None and left < right:
            near = np.arange(left, min(left + reach, right))
            rare = near[_alone(near, start, stop, before, after)]
            if not len(rare):
                left = int(near[-1]) + 1
                near = np.arange(max(right - reach, left), right)
                rare = near[_alone(near, start, stop, before, after)]
                right = max(right - reach, left)
            cut = int(rare[0]) if len(rare) else None
            reach *= 2
        if cut is None:
            yield start, stop
        else:
            waiting += [(start, cut), (cut + 1, stop)]


class _Equal:
    """Numbers of all blocks of 2 ** k words, and how far two places agree in either direction."""

    def __init__(self, words: np.ndarray, longest: int):
        ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
        while 2 << len(ranks) <= longest:
            half = 1 << (len(ranks) - 1)
            last = ranks[-1]
            pair = last[: max(len(last) - half, 0)] * (int(last.max()) + 1) + last[half:]
            if not len(pair):
                break
            ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        self.ranks = ranks

    def forward(self, one: np.ndarray, other: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Words from ``one`` and ``other`` (the later) on that agree before ``stop``."""
        agreed = np.zeros(len(one), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            # the largest block may fit more than once
            while True:
                a, b = one + agreed, other + agreed
                fits = b + (1 << k) <= stop
                a, b = np.where(fits, a, 0), np.where(fits, b, 0)
                same = fits & (self.ranks[k][a] == self.ranks[k][b])
                agreed += np.where(same, 1 << k, 0)
                if k < len(self.ranks) - 1 or not same.any():
                    break
        return agreed

    def backward(self, one: np.ndarray, other: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Words before ``one`` (the earlier) and ``other`` that agree from ``start`` on."""
        agreed = np.zeros(len(one), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            while True:
                a, b = one - agreed - (1 << k), other - agreed - (1 << k)
                fits = a >= start
                a, b = np.where(fits, a, 0), np.where(fits, b, 0)
                same = fits & (self.ranks[k][a] == self.ranks[k][b])
                agreed += np.where(same, 1 << k, 0)
                if k < len(self.ranks) - 1 or not same.any():
                    break
        return agreed


def _scanned(words: np.ndarray, start: np.ndarray, stop: np.ndarray, least: int) -> Runs:
    """Lag scan of segments: places are those of ``words``."""
    size = stop - start
    equal = _Equal(words, int(size.max()))
    lags = size // 2
    # one line per segment and lag, with the pairs of neighbouring multiples of the lag
    lag = np.arange(lags.sum()) - np.repeat(np.cumsum(lags) - lags, lags) + 1
    begin, end = np.repeat(start, lags), np.repeat(stop, lags)
    pairs = (end - begin - 1) // lag
    upto = np.cumsum(pairs)
    found = []
    first = 0
    while first < len(lag):
        # lines up to PAIRS pairs, one line at least; lag 1 has the most, as many as words
        last = max(int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PAIRS, side="right")), first + 1)
        count = pairs[first:last]
        line = np.repeat(np.arange(first, last), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        one = begin[line] + step * lag[line]
        hit = words[one] == words[one + lag[line]]
        line, one = line[hit], one[hit]
        other = one + lag[line]
        back = equal.backward(one, other, begin[line])
        # the first two multiples of the lag in a stretch stand for it
        leading = back < lag[line]
        line, one, other, back = line[leading], one[leading], other[leading], back[leading]
        ahead = equal.forward(one, other, end[line])
        whole = lag[line] + back + ahead >= np.maximum(least, 2 * lag[line])
        found.append(np.stack([(one - back)[whole], (other + ahead)[whole], lag[line][whole]]))
        first = last
    left, right, period = np.concatenate(found, axis=1)
    # a stretch with several periods is a run of the smallest
    order = np.lexsort((period, right, left))
    left, right, period = left[order], right[order], period[order]
    new = np.ones(len(left), dtype=bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return Runs(left[new], right[new], period[new])


def find_runs(words: np.ndarray, edges: np.ndarray, least: int = LEAST) -> Runs:
    """All runs of hashed words, by start, then period; none crosses one of ``edges``, which
    hold the start of every text and the end of the last."""
    none = np.zeros(0, dtype=np.int64)
    if not len(words):
        return Runs(none, none, none)
    before, after = _neighbours(words)
    start, stop = surviving(before, after, edges[:-1], edges[1:], least)
    if not len(start):
        return Runs(none, none, none)
    # only the words of surviving segments go on, put together
    size = stop - start
    own = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(start - own, size)
    runs = _scanned(words[at], own, own + size, least)
    segment = np.searchsorted(own, runs.start, side="right") - 1
    shift = (start - own)[segment]
    runs = Runs(runs.start + shift, runs.stop + shift, runs.period)
    order = np.lexsort((runs.period, runs.start))
    return Runs(runs.start[order], runs.stop[order], runs.period[order])


def planted(count: int, key: int | None) -> np.ndarray | None:
    """Which original word stands at each place of a text that is made periodic; null if none is."""
    if key is None or key % 10 or not count:
        return None
    rest = key // 10
    first = rest % count
    period = 1 + (count - first) // (3 + rest % 8)
    place = np.arange(count)
    return np.where(place < first, place, first + (place - first) % period)


def _rows(ids: list, texts: list[bytes], keys: list[int | None], hashes: list[np.ndarray], least: int) -> Iterator[tuple]:
    orders = [planted(len(words), key) for words, key in zip(hashes, keys, strict=True)]
    words = [own if order is None else own[order] for own, order in zip(hashes, orders, strict=True)]
    edges = np.cumsum([0, *[len(own) for own in words]])
    runs = find_runs(np.concatenate(words), edges, least)
    cuts = np.searchsorted(runs.start, edges)
    for number, (doc_id, text, order) in enumerate(zip(ids, texts, orders, strict=True)):
        some = slice(cuts[number], cuts[number + 1])
        start, stop, period = runs.start[some] - edges[number], runs.stop[some] - edges[number], runs.period[some]
        length = stop - start
        spoken = text.split()
        if order is not None:
            spoken = [spoken[place] for place in order.tolist()]
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
        best: tuple = (None,) * 4
        if len(start):
            first = np.lexsort((period, start, -length))[0]
            best = (int(start[first]), int(length[first]), int(period[first]), int(1000 * length[first] // period[first]))
            cover = np.zeros(len(spoken) + 1, dtype=np.int64)
            np.add.at(cover, start + period, 1)
            np.add.at(cover, stop, -1)
            spoken = [word for word, over in zip(spoken, np.cumsum(cover).tolist(), strict=False) if not over]
        collapsed = b" ".join(spoken)
        yield doc_id, len(start), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest(), listed, collapsed


_COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs string, collapsed string"


def collapse(docs: DataFrame, least: int = LEAST, plant: bool = False) -> DataFrame:
    """One row per document: its runs, the longest of them, and its text without repetitions.

    ``doc_id, n_runs``, then ``start, length, period, exponent_milli`` of the longest run (ties:
    smallest start, then period; null without a run), ``runs_sha256, collapsed_sha256`` and what
    they are the hashes of: ``runs`` (``start,length,period`` and a line feed for each, by start,
    then period) and ``collapsed`` (the words outside every run's repetitions, joined by a space).

    A null or empty text has no words and no runs. Repeated rows are documents of their own. An
    empty table gives an empty table; other columns are not read. With ``plant``, documents
    whose ``crc32(doc_id as text)`` is divisible by ten are made periodic first, as the query
    asks; a null ``doc_id`` never is.
    """
    ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    key = F.crc32(F.col("doc_id").cast("string").cast("binary")) if plant else F.lit(None).cast("long")
    schema = pa.schema(
        [("doc_id", to_arrow_type(kind)), *[(name, pa.int64()) for name in ("n_runs", "start", "length", "period", "exponent_milli")]]
        + [(name, pa.string()) for name in ("runs_sha256", "collapsed_sha256", "runs")]
        + [("collapsed", pa.string())]
    )

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), as_bytes(batch.column("text"))
            for first, (hashes,) in hashed_words(texts):
                group = slice(first, first + len(hashes))
                columns = list(zip(*_rows(ids[group], texts[group], keys[group], hashes, least), strict=True))
                columns[-1] = tuple(text.decode(errors="replace") for text in columns[-1])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = docs.select("doc_id", "text", key.alias("key"))
    return rows.mapInArrow(collapsed, f"doc_id {kind.simpleString()}, {_COLUMNS}")
