"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts and unlabelled texts are learned from. With the class prior p, the
risk of a classifier g on the clean class is estimated as R_u(-) - p R_p(-): what unlabelled
texts cost as clean, less the share that toxic ones among them cost. A flexible model drives
that estimate below zero by overfitting; when a batch does so, the step goes against it
instead. The model is logistic over the shares of hashed words, trained by numpy in
batches with a step per word that shrinks as it is used, and a soft threshold that keeps only
words that matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import first_by_hash, held_out, known_labels, texts_of
from tidemark.llm.tables import ready
from tidemark.llm.texts import as_bytes, hashed_words

#: Most confirmed toxic and most unlabelled texts that the model is fitted on.
TOXIC, UNLABELLED = 4096, 8192
WORD_BITS = 18
EPOCHS, BATCHES, RATE, SPARSITY = 100, 4, 1.0, 1e-4  # SPARSITY at full samples; see ``fit_shares``
#: Words in fewer texts of the sample than this are left out: they only tell texts apart.
MIN = 10
#: Shares of words are multiplied by SCALE, and none weighs more than CAP: in a short text
#: every word has a large share.
SCALE, CAP = 100.0, 1.0

#: Lower-case ASCII letters, digits and all of UTF-8's other bytes stay; the rest ends a word.
_KEPT = bytes(byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in range(256))


def word_shares(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, word, share`` (scaled) of every distinct hashed word, case and punctuation aside."""
    plain = (text.decode("utf-8", "replace").lower().encode().translate(_KEPT) for text in texts)
    rows, words, shares = [], [], []
    for first, (parts,) in hashed_words(plain):
        sizes = np.array([len(part) for part in parts], dtype=np.int64)
        row = np.repeat(np.arange(first, first + len(parts)), sizes)
        word = (np.concatenate(parts) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        keys, counts = np.unique((row << WORD_BITS) | word, return_counts=True)
        rows.append((keys >> WORD_BITS).astype(np.int32))
        words.append((keys & ((1 << WORD_BITS) - 1)).astype(np.int32))
        shares.append(np.minimum(counts / sizes[rows[-1] - first] * SCALE, CAP).astype(np.float32))
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate(rows), np.concatenate(words), np.concatenate(shares)


def _sigmoid(value: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value, -50, 50)))


def fit(toxic: list[bytes], unlabelled: list[bytes], prior: float) -> np.ndarray:
    """Weights of the hashed words, the intercept last."""
    return fit_shares(word_shares([*unlabelled, *toxic]), len(unlabelled), len(toxic), prior)


def fit_shares(parts: tuple[np.ndarray, np.ndarray, np.ndarray], n_unlabelled: int, n_toxic: int, prior: float, seed: int = 7) -> np.ndarray:
    """The same from ``word_shares`` of the unlabelled texts followed by the toxic ones."""
    weights = np.zeros((1 << WORD_BITS) + 1)
    gathered = np.zeros_like(weights)
    if not n_toxic or not n_unlabelled:
        weights[-1] = 0.0 if n_toxic else -5.0
        return weights
    row, word, share = parts
    common = np.bincount(word, minlength=1 << WORD_BITS)[word] >= MIN
    row, word, share = row[common], word[common], share[common]
    edges = np.searchsorted(row, np.arange(n_unlabelled + n_toxic + 1))
    random = np.random.default_rng(seed)
    # chance effects, which the threshold is to outweigh, shrink with the root of the sample
    sparsity = SPARSITY * np.sqrt((TOXIC + UNLABELLED) / (n_toxic + n_unlabelled))
    weights[-1] = np.log(prior / (1 - prior))

    def entries(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = edges[docs + 1] - edges[docs]
        which = np.repeat(np.arange(len(docs)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(edges[docs], sizes)
        return which, word[at], share[at]

    for _ in range(EPOCHS):
        confirmed = np.array_split(random.permutation(n_toxic) + n_unlabelled, BATCHES)
        others = np.array_split(random.permutation(n_unlabelled), BATCHES)
        for p_docs, u_docs in zip(confirmed, others, strict=True):
            if not len(p_docs) or not len(u_docs):
                continue
            which, words, shares = entries(np.concatenate([p_docs, u_docs]))
            count = len(p_docs) + len(u_docs)
            score = np.bincount(which, weights[words] * shares, minlength=count) + weights[-1]
            chance = _sigmoid(score)
            is_toxic = np.arange(count) < len(p_docs)
            cost = np.logaddexp(0, score)  # of being called clean
            clean_risk = cost[~is_toxic].mean() - prior * cost[is_toxic].mean()
            # slopes of the two parts of the risk with respect to the scores
            clean = np.where(is_toxic, -prior * chance / len(p_docs), chance / len(u_docs))
            positive = np.where(is_toxic, prior * (chance - 1) / len(p_docs), 0.0)
            slope = positive + clean if clean_risk >= 0 else -clean
            step = np.bincount(words, slope[which] * shares, minlength=len(weights))
            step[-1] = slope.sum()
            gathered += step**2
            rate = RATE / (np.sqrt(gathered) + 1e-8)
            weights -= rate * step
            # soft threshold: a word that does not keep earning its weight has none
            weights[:-1] = np.sign(weights[:-1]) * np.maximum(np.abs(weights[:-1]) - sparsity * rate[:-1], 0)
    return weights


def scores(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Chance of each text to be toxic; an empty one has the intercept's."""
    row, word, share = word_shares(texts)
    return _sigmoid(np.bincount(row, weights[word] * share, minlength=len(texts)) + weights[-1])


def learn(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Fit on bounded samples, in one task; the weights return as one row."""
    ready(docs.sparkSession)
    known = known_labels(labels, "toxic")
    row = known.agg(F.avg("label").alias("prior")).first()
    prior = min(max(row["prior"] or 0.0, 1e-3), 0.9)
    confirmed = first_by_hash(known.where("label = 1"), TOXIC).select("doc_id", F.lit(1).alias("label"))
    others = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    others = first_by_hash(others, UNLABELLED).select("doc_id", F.lit(0).alias("label"))
    sample = texts_of(docs, confirmed.unionByName(others))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by label: the unlabelled texts come first
        parts: list[tuple] = []
        counts = [0, 0]
        for batch in batches:
            row, word, share = word_shares(as_bytes(batch.column("text")))
            parts.append((row + np.int32(sum(counts)), word, share))
            toxic = sum(batch.column("label").to_pylist())
            counts = [counts[0] + batch.num_rows - toxic, counts[1] + toxic]
        columns = tuple(np.concatenate(part) for part in zip(*parts, strict=True)) if parts else word_shares([])
        parts.clear()
        model = fit_shares(columns, *counts, prior).astype(np.float32).tobytes()
        yield pa.RecordBatch.from_pydict({"model": [model]}, pa.schema([("model", pa.binary())]))

    one = sample.repartition(1).sortWithinPartitions("label", "doc_id", "text").mapInArrow(fitted, "model binary")
    found = [row["model"] for row in one.collect()]
    return np.frombuffer(found[0], dtype=np.float32).astype(np.float64) if found else fit([], [], prior)


def score_column(weights: np.ndarray, text: Column) -> Column:
    small = weights.astype(np.float32)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(scores([(text or "").encode() for text in texts], small))

    return scored(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null or empty text gets the score of the intercept. A null id is not held out. Repeated
    rows are scored alike. Without confirmed toxic texts everything scores near 0. An empty
    table gives an empty table. Only ``doc_id`` and ``text`` are read, and ``doc_id`` decides
    on folds and samples only.
    """
    weights = learn(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(weights, F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not called toxic, with all their columns.

    Null and empty texts score the intercept, repeated rows go or stay together, columns of any
    name are kept as they are, and an empty table stays empty.
    """
    return docs.where(score_column(learn(docs, labels), F.col("text")) < 0.5)
