"""Terms of texts: maximal runs of ASCII letters and digits and of characters beyond ASCII.

Only A-Z are lower-cased. Texts are UTF-8 bytes, in which a character beyond ASCII holds no
byte below 0x80, so folding works byte by byte.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.texts import hashed_words

#: The term pattern, as Java, Python and RE2 read it.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_FOLD = bytearray(b" " * 128 + bytes(range(128, 256)))
for _first, _last, _shift in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0)):
    _FOLD[_first : _last + 1] = bytes(range(_first + _shift, _last + _shift + 1))
_FOLD = bytes(_FOLD)


def folded(text: bytes) -> bytes:
    """The text in lower case with a space for every byte between terms: its words are the terms."""
    return text.translate(_FOLD)


def hashed(terms: list[bytes]) -> np.ndarray:
    """The 64-bit hash of each term, as ``hashed_words`` gives it for a folded text."""
    parts = [words for _, (texts,) in hashed_words([b" ".join(terms)]) for words in texts]
    return np.concatenate(parts) if terms else np.zeros(0, dtype=np.uint64)
