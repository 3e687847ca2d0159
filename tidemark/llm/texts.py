"""Words of texts as 64-bit hashes, computed over whole byte arrays with numpy.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form
feed and carriage return. Texts are UTF-8 bytes here, in which those six never occur inside
another character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The word pattern, as Java, Python and RE2 read it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text hashed at once; a longer text is cut between words.
SLICE = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Odd multipliers of the polynomial hashes, one per independent hash.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_ORDERS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed(value: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    value = value ^ (value >> np.uint64(33))
    value = value * np.uint64(0xFF51AFD7ED558CCD)
    value = value ^ (value >> np.uint64(33))
    value = value * np.uint64(0xC4CEB9FE1A85EC53)
    return value ^ (value >> np.uint64(33))


def _tables(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if which not in _powers or len(_powers[which][0]) < size:
        size = max(size, SLICE + 1)
        made = []
        for factor in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            table = np.full(size, factor, dtype=np.uint64)
            table[0] = 1
            made.append(np.multiply.accumulate(table))
        if size > 4 * SLICE:  # one giant word; do not keep its table
            return made[0], made[1]
        _powers[which] = (made[0], made[1])
    return _powers[which]


def _slices(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > SLICE:
        stop = start + SLICE
        while stop < len(text) and not _SPACE[text[stop]]:
            stop += 1
        yield text[start:stop]
        start = stop
    yield text[start:]


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in an array of bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def hash_spans(data: np.ndarray, start: np.ndarray, stop: np.ndarray, which: int) -> np.ndarray:
    power, inverse = _tables(which, len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    return mixed((total[stop] - total[start]) * inverse[start])


def hashed_words(texts: Iterable[bytes], hashes: int = 1) -> Iterator[tuple[int, list[list[np.ndarray]]]]:
    """Word hashes of many texts, a slice of about SLICE bytes at a time.

    Yields ``(first, [[hash array per text] per hash])`` for consecutive texts; short texts
    are hashed together, a long one in pieces, so memory follows the longest text at most.
    """
    group: list[bytes] = []
    size = first = 0
    for text in texts:
        if group and size + len(text) > SLICE:
            yield first, _hash_group(group, hashes)
            first, group, size = first + len(group), [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield first, _hash_group(group, hashes)


def _hash_group(group: list[bytes], hashes: int) -> list[list[np.ndarray]]:
    if len(group) == 1:
        parts: list[list[np.ndarray]] = [[] for _ in range(hashes)]
        for piece in _slices(group[0]):
            data = np.frombuffer(piece, dtype=np.uint8)
            start, stop = spans(data)
            for which in range(hashes):
                parts[which].append(hash_spans(data, start, stop, which))
        return [[np.concatenate(part)] for part in parts]
    data = np.frombuffer(b" ".join(group), dtype=np.uint8)
    start, stop = spans(data)
    ends = np.cumsum([len(text) + 1 for text in group])[:-1]
    cuts = np.searchsorted(start, ends)
    return [np.split(hash_spans(data, start, stop, which), cuts) for which in range(hashes)]


def windows(words: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words (none if there are fewer)."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:count].copy()
    for step in range(1, width):
        total *= np.uint64(_ORDERS[which])
        total += words[step : step + count]
    return mixed(total)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives none."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]
