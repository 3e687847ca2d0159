"""Secret scans: fixed patterns, and character Markov models of random strings.

Two first-order models give the likelihood of a token's characters, each given the one
before it: one of random strings, one of ordinary identifiers. Both are trained on samples
that the fixed patterns label in the whole corpus: what the patterns catch is random, every
other token is ordinary, and so are identifiers made of those words by the usual rules of
naming (see ``named``). A token, or what the patterns left of it, is reported when its total
log-likelihood ratio and its mean per character say random.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import ready

# Fixed patterns, in the order in which spans at one start are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Runs without 32 such characters are never looked at by Python code.
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "markov")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16

#: Least total log-likelihood ratio of a token, and least mean per character. A transition counts
#: MOST at most, since the ratio of one that is in no sample comes from smoothing alone.
TOTAL, THRESHOLD, MOST = 15.0, 0.75, 3.0
#: Tokens the models are trained on and judge; no shorter one can reach the total.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % -(-TOTAL // MOST))
#: Random by nature, but a name: a UUID is ordinary.
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: The models' alphabet; a start symbol comes before it, anything else after it.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 2
_CODES = np.full(128, STATES - 1, dtype=np.int64)
_CODES[[ord(letter) for letter in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
#: Counts added to each following character on average; chance of a sign in random strings.
SMOOTHING, RARE = 0.5, 1e-4
#: Identifiers of each style of naming for one word of the corpus, and how often a word of one
#: ends with a digit.
NAMED, NUMBERED = 0.05, 0.1

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of what the fixed patterns find, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def _outside(text: str, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """Start and end of tokens, and of what spans leave of those that they touch."""
    reach = at = 0
    for match in TOKEN.finditer(text):
        start, end = match.span()
        start = max(start, reach)
        while at < len(spans) and spans[at][0] < end:
            if start < spans[at][0]:
                yield start, spans[at][0]
            reach = max(reach, spans[at][2])
            start = max(start, reach)
            at += 1
        if start < end:
            yield start, end


def _blanked(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts.append(text[at:start])
        at = max(at, end)
    return " ".join([*parts, text[at:]])


def _totals(tokens: list[str], ratios: np.ndarray) -> np.ndarray:
    """Sum over the transitions of each token, the first from the start symbol."""
    codes = _CODES[np.frombuffer("\n".join(["", *tokens, ""]).encode("ascii"), dtype=np.uint8)]
    codes[codes == STATES - 1] = 0  # the line break between two tokens starts the next one
    scores = np.where(codes[1:] > 0, ratios[codes[:-1] * STATES + codes[1:]], 0.0)
    return np.add.reduceat(scores, np.flatnonzero(codes == 0)[:-1])


def _counted(tokens: list[str]) -> np.ndarray:
    """How often each transition occurs in the tokens."""
    codes = _CODES[np.frombuffer("\n".join(["", *tokens]).encode("ascii"), dtype=np.uint8)]
    codes[codes == STATES - 1] = 0  # the line break between two tokens starts the next one
    pairs = codes[:-1] * STATES + codes[1:]
    return np.bincount(pairs[codes[1:] > 0], minlength=STATES * STATES)


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, STATES * STATES), dtype=np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            spans = base_spans(text)
            for start, kind, end in spans:
                value = ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]
                counts[1] += _counted(TOKEN.findall(value))
            counts[0] += _counted(TOKEN.findall(_blanked(text, spans)))
    random, pair = np.nonzero(counts)
    yield pa.RecordBatch.from_pydict({"random": random, "pair": pair, "seen": counts[random, pair]}, _COUNTED)


_COUNTED = pa.schema([("random", pa.int64()), ("pair", pa.int64()), ("seen", pa.int64())])


def learn(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio (random over ordinary) of every transition, from all texts.

    Counts are summed per transition in Spark; at most 2 * STATES ** 2 of them are collected.
    """
    ready(docs.sparkSession)
    counted = docs.select("text").mapInArrow(_transitions, "random long, pair long, seen long")
    counts = np.zeros((2, STATES, STATES))
    for row in counted.groupBy("random", "pair").agg(F.sum("seen").alias("seen")).collect():
        counts[row["random"]].flat[row["pair"]] = row["seen"]
    return ratios_from(counts[1], counts[0])


def named(ordinary: np.ndarray) -> np.ndarray:
    """Expected transitions in identifiers made of the corpus's words.

    Words follow each other as in camelCase, PascalCase, snake_case, CONSTANT_CASE, kebab-case
    and paths, some with a number at the end; each style has NAMED words for a word of the
    corpus. Counted from how words begin, go on and end there, whatever their case.
    """
    lower = np.array([ALPHABET.index(letter) + 1 for letter in "abcdefghijklmnopqrstuvwxyz"])
    upper = np.array([ALPHABET.index(letter) + 1 for letter in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"])
    digit = np.array([ALPHABET.index(number) + 1 for number in "0123456789"])
    inside = sum(ordinary[np.ix_(one, other)] for one in (lower, upper) for other in (lower, upper))
    begin = ordinary[0, lower] + ordinary[0, upper]
    held = inside.sum(axis=0) + begin
    end = np.maximum(held - inside.sum(axis=1), 0)
    words = max(begin.sum(), 1.0)
    begin, end = begin / words, end / max(end.sum(), 1.0)
    inside = inside / words
    onward = inside / np.maximum(inside.sum(axis=1, keepdims=True), 1e-9)
    found = np.zeros((STATES, STATES))

    def word(letters: np.ndarray, first: np.ndarray) -> None:
        """One word; where its first letter has another case, so has what follows it."""
        found[np.ix_(letters, letters)] += inside
        if first is not letters:
            found[np.ix_(first, letters)] += begin[:, None] * onward

    def joined(last: np.ndarray, sign: str, first: np.ndarray) -> None:
        """The end of one word, a sign or none, and the beginning of the next."""
        for tail, share in ((last, 1 - NUMBERED), (digit, NUMBERED)):
            ends = end * share if tail is last else np.full(len(digit), share / len(digit))
            if sign:
                at = ALPHABET.index(sign) + 1
                found[tail, at] += ends
                found[at, first] += begin * share
            else:
                found[np.ix_(tail, first)] += ends[:, None] * begin
        found[np.ix_(last, digit)] += end[:, None] * NUMBERED / len(digit)
        found[np.ix_(digit, digit)] += NUMBERED / len(digit) ** 2

    for letters, sign, first in (
        (lower, "", upper),
        (lower, "", upper),
        (lower, "_", lower),
        (upper, "_", upper),
        (lower, "-", lower),
        (lower, "/", lower),
    ):
        word(letters, first)
        joined(letters, sign, first)
        found[0, first] += begin
    return found * words * NAMED


def ratios_from(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of every transition from counts of both kinds of samples.

    Secrets of the fixed patterns use few alphabets, so the model of random strings is the
    even mixture of what they show and of uniform letters and digits. The model of ordinary
    identifiers falls back on the overall frequencies of following characters.
    """
    uniform = np.full(STATES, RARE)
    uniform[1:63] = 1 / 62
    seen = random.sum(axis=1, keepdims=True)
    shown = np.where(seen > 0, random / np.maximum(seen, 1), uniform)
    ordinary = ordinary + named(ordinary)
    following = ordinary.sum(axis=0) + SMOOTHING
    smooth = ordinary + SMOOTHING * STATES * following / following.sum()
    ratios = np.log((shown + uniform) / 2) - np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return np.minimum(ratios, MOST).ravel()


def all_spans(text: str, ratios: np.ndarray, threshold: float = THRESHOLD, total: float = TOTAL) -> list[Span]:
    """Base spans and the tokens that the models call random, by start, then kind."""
    spans = base_spans(text)
    places = [(start, end) for start, end in _outside(text, spans) if not UUID.fullmatch(text, start, end)]
    if not places:
        return spans
    tokens = [text[start:end] for start, end in places]
    sizes = np.array([end - start for start, end in places])
    random = _totals(tokens, ratios) >= np.maximum(threshold * sizes, total)
    more = [(places[n][0], 3, places[n][1]) for n in np.flatnonzero(random).tolist()]
    return sorted(spans + more) if more else spans


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, ratios: np.ndarray | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov``.

    Spans are ``kind:start:end`` over code points, end exclusive. A null or empty text has no
    spans (empty string) and the hash of the empty string. Repeated rows are scanned each;
    other columns are not read; an empty table gives an empty table. A text without samples
    of either kind leaves the models at their smoothing and finds nothing beyond the base.
    """
    ratios = learn(docs) if ratios is None else ratios

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in _SCANNED.names[1:]}
            for text in batch.column("text").to_pylist():
                spans = all_spans(text or "", ratios, threshold)
                kinds = [kind for _, kind, _ in spans]
                for number, name in enumerate(("n_assign", "n_access", "n_hex", "n_markov")):
                    rows[name].append(kinds.count(number))
                base = _listed([span for span in spans if span[1] < 3])
                rows["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                rows["spans"].append(_listed(spans))
            columns = [batch.column("doc_id").cast(pa.int64()), *[pa.array(rows[f.name], f.type) for f in list(_SCANNED)[1:]]]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCANNED)

    ids = docs.select(F.col("doc_id").cast("long"), "text")
    return ids.mapInArrow(scanned, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long")


_SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("n_markov", pa.int64()),
    ]
)


def redacted(text: str, ratios: np.ndarray) -> str:
    """The text with every run of overlapping spans replaced by its first kind in brackets."""
    parts, at, reach = [], 0, 0
    for start, kind, end in all_spans(text, ratios):
        if start >= reach:
            parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = reach = max(reach, end)
    return "".join([*parts, text[at:]]) if parts else text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; every row and column stays, null is null."""
    ratios = learn(docs)

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda text: redacted(text, ratios), na_action="ignore")

    return docs.withColumn("text", clean("text"))
