"""Which keys occur more than once among all packets of a corpus.

A map task sorts the keys of a packet (some million windows), keeps each once with a flag for
those it saw twice, and deals them by their leading bits into buckets. A bucket's task thus
gets every distinct key of a packet at most once, however often a passage is repeated, and
finds the keys that two packets hold, or one packet twice. Keys travel as differences of
sorted values, laid out byte by byte, which the shuffle's compression shrinks well.
"""

from __future__ import annotations

import math

import numpy as np

#: Keys gathered into one packet, and keys one bucket's task reads on average.
PACKET_KEYS = 1 << 20
BUCKET_KEYS = 1 << 23


def bucket_bits(keys: int) -> int:
    """Leading bits that name the bucket, for a corpus of so many keys."""
    return max(4, math.ceil(math.log2(max(keys, 1) / BUCKET_KEYS)))


def squeezed(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as byte planes of their differences."""
    steps = np.diff(values.astype(np.uint32), prepend=np.uint32(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def expanded(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def tails(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits after the bucket's."""
    return (keys >> np.uint64(32 - bits)).astype(np.uint32)


def heads(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def trimmed(keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys cut to the bits that travel, so that equal means equal on both sides."""
    return keys >> np.uint64(32 - bits)


def unique_flags(keys: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of first occurrences of the distinct keys, sorted, and whether each is repeated."""
    order = np.argsort(keys, kind="stable") if second is None else np.lexsort((second, keys))
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if second is not None:
        other = second[order]
        new[1:] |= other[1:] != other[:-1]
    first = np.flatnonzero(new)
    repeated = np.diff(np.append(first, len(keys))) > 1
    return order[first], repeated
