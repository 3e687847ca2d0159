"""Quality by supervised subword embeddings.

Every word has a hashed vector, so has every run of 3 to 5 characters of the word between
boundary marks, and so has every pair of neighbouring words. Pairs are hashed by the difference
of their words' hashes, so all words that follow themselves share one vector. A document is the
average of the vectors of its words, runs and pairs; a softmax over a linear layer gives the
classes. Vectors and layer are trained together by stochastic
gradient descent in numpy.

Scoring folds the layer into the vectors: the difference of the two classes is one number per
hashed feature, so a document's score is the average of its features' numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import first_by_hash, held_out, known_labels, texts_of
from tidemark.llm.tables import ready
from tidemark.llm.texts import SLICE, as_bytes, hash_spans, mixed, spans, windows

#: Most labelled texts that the model is fitted on.
SAMPLE = 4096
FEATURE_BITS, PAIR_BITS, WIDTH, CLASSES = 16, 12, 8, 2
FEATURES = (1 << FEATURE_BITS) + (1 << PAIR_BITS)
RUNS = (3, 4, 5)
#: Rounds over the sample, more if they make fewer than STEPS batches.
EPOCHS, STEPS, BATCH, RATE = 8, 250, 128, 150.0
THRESHOLD = 0.3


def features(texts: list[bytes]) -> Iterator[tuple]:
    """For slices of texts: first text, words per text, the distinct word of each word, the
    features of the distinct words (``owner, feature``), and the feature of the pair that each
    word forms with the one after it (the last one's has no meaning)."""
    group, size, first = [], 0, 0
    for text in texts:
        if group and size + len(text) > SLICE:
            yield first, *_features(group)
            first, group, size = first + len(group), [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield first, *_features(group)


def _features(group: list[bytes]) -> tuple:
    joined = b" ".join(group)
    data = np.frombuffer(joined, dtype=np.uint8)
    start, stop = spans(data)
    ends = np.cumsum([len(text) + 1 for text in group])
    per_text = np.diff(np.searchsorted(start, ends), prepend=0)
    shift = np.uint64(64 - FEATURE_BITS)
    hashes, sample, which = np.unique(hash_spans(data, start, stop, 0), return_index=True, return_inverse=True)
    owners, found = [np.arange(len(hashes))], [(hashes >> shift).astype(np.int64)]
    if len(hashes):
        marked = "".join(f"<{joined[a:b].decode('utf-8', 'replace')}>" for a, b in zip(start[sample].tolist(), stop[sample].tolist(), strict=True))
        letters = np.frombuffer(marked.encode("utf-32-le"), dtype=np.uint32)
        lengths = np.array([len(joined[a:b].decode("utf-8", "replace")) + 2 for a, b in zip(start[sample].tolist(), stop[sample].tolist(), strict=True)])
        owner = np.repeat(np.arange(len(hashes)), lengths)
        codes = mixed(letters.astype(np.uint64) + np.uint64(1))
        for width in RUNS:
            runs = windows(codes, width)
            inside = owner[: len(runs)] == owner[width - 1 :][: len(runs)]
            owners.append(owner[: len(runs)][inside])
            found.append((mixed(runs[inside] + np.uint64(width)) >> shift).astype(np.int64))
    words = hashes[which]
    pairs = mixed(words - np.roll(words, -1)) >> np.uint64(64 - PAIR_BITS)
    return per_text.tolist(), which, np.concatenate(owners), np.concatenate(found), pairs.astype(np.int64) + (1 << FEATURE_BITS)


def average_parts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, feature, share``: what part of a text's features each hashed feature is."""
    rows, names, shares = [], [], []
    for first, per_text, which, owner, feature, pairs in features(texts):
        if not len(which):
            continue
        order = np.argsort(owner, kind="stable")
        edges = np.searchsorted(owner[order], np.arange(which.max() + 2))
        at = 0
        for number, count in enumerate(per_text):
            words, times = np.unique(which[at : at + count], return_counts=True)
            own_pairs = pairs[at : at + count - 1]
            at += count
            if not count:
                continue
            sizes = edges[words + 1] - edges[words]
            places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(edges[words], sizes)
            weight = np.bincount(feature[order[places]], np.repeat(times, sizes), minlength=FEATURES)
            weight += np.bincount(own_pairs, minlength=FEATURES)
            used = np.flatnonzero(weight)
            rows.append(np.full(len(used), first + number, dtype=np.int32))
            names.append(used.astype(np.int32))
            shares.append((weight[used] / weight.sum()).astype(np.float32))
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate(rows), np.concatenate(names), np.concatenate(shares)


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``vectors``, ``layer`` and ``intercept`` of the softmax."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (FEATURES, WIDTH))
    layer = random.normal(0, 0.5, (WIDTH, CLASSES))
    intercept = np.zeros(CLASSES)
    row, name, share = average_parts(texts)
    edges = np.searchsorted(row, np.arange(len(texts) + 1))
    batches = math.ceil(len(texts) / BATCH)
    epochs = max(EPOCHS, math.ceil(STEPS / max(batches, 1)))
    steps, done = epochs * batches, 0
    for _ in range(epochs if batches else 0):
        order = random.permutation(len(texts))
        for start in range(0, len(order), BATCH):
            docs = order[start : start + BATCH]
            sizes = edges[docs + 1] - edges[docs]
            which = np.repeat(np.arange(len(docs)), sizes)
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(edges[docs], sizes)
            names, shares = name[at], share[at].astype(np.float64)
            used, place = np.unique(names, return_inverse=True)
            table = vectors[used]
            hidden = np.stack([np.bincount(which, table[place, d] * shares, minlength=len(docs)) for d in range(WIDTH)], axis=1)
            logits = hidden @ layer + intercept
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(docs)), labels[docs]] -= 1
            chance /= len(docs)
            pulls = np.stack([np.bincount(place, chance[which, c] * shares, minlength=len(used)) for c in range(CLASSES)], axis=1)
            rate = RATE * (1 - done / steps)
            done += 1
            vectors[used] -= rate * pulls @ layer.T
            layer -= rate / RATE * (hidden.T @ chance)
            intercept -= rate / RATE * chance.sum(axis=0)
    return vectors, layer, intercept


def folded(vectors: np.ndarray, layer: np.ndarray, intercept: np.ndarray) -> np.ndarray:
    """One number per feature, the intercept's last: class 1 less class 0."""
    return np.append(vectors @ (layer[:, 1] - layer[:, 0]), intercept[1] - intercept[0]).astype(np.float32)


def scores(texts: list[bytes], numbers: np.ndarray) -> np.ndarray:
    """Chance of class 1; a text without words has the intercept's."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for first, per_text, which, owner, feature, pairs in features(texts):
        if not len(which):
            continue
        distinct = which.max() + 1
        sums = np.bincount(owner, numbers[feature], minlength=distinct)
        sizes = np.bincount(owner, minlength=distinct)
        row = np.repeat(np.arange(len(per_text)), per_text)
        paired = np.append(row[1:] == row[:-1], False)
        part = slice(first, first + len(per_text))
        total[part] = np.bincount(row, sums[which] + numbers[pairs] * paired, minlength=len(per_text))
        count[part] = np.bincount(row, sizes[which] + paired, minlength=len(per_text))
    logit = total / np.maximum(count, 1) + numbers[-1]
    return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def learn(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Fit on a bounded sample, in one task; the folded model returns as one row."""
    ready(docs.sparkSession)
    sample = texts_of(docs, first_by_hash(known_labels(labels, "quality"), SAMPLE))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = list(batches)
        texts = [text for batch in table for text in as_bytes(batch.column("text"))]
        known = np.array([label for batch in table for label in batch.column("label").to_pylist()], dtype=np.int64)
        model = folded(*fit(texts, known)).tobytes()
        yield pa.RecordBatch.from_pydict({"model": [model]}, pa.schema([("model", pa.binary())]))

    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text").mapInArrow(fitted, "model binary")
    found = [row["model"] for row in one.collect()]
    return np.frombuffer(found[0], dtype=np.float32) if found else folded(*fit([], np.zeros(0, dtype=np.int64)))


def score_column(numbers: np.ndarray, text: Column) -> Column:
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(scores([(text or "").encode() for text in texts], numbers))

    return scored(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null or empty text gets the score of the intercept. A null id is not held out. Repeated
    rows are scored alike. Without labels every score is the intercept's, near one half. An
    empty table gives an empty table. Only ``doc_id`` and ``text`` are read, and ``doc_id``
    decides on folds and samples only.
    """
    numbers = learn(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(numbers, F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
