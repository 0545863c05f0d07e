"""A quality classifier from weak labels.

Overlapping heuristic labelers vote on every text. Expectation-maximisation over
the counts of vote patterns (all documents, one row a pattern) estimates how
accurate each is. The patterns' posteriors are then the labels of a hashed linear
scorer: words and word shapes, hashed into a fixed number of buckets, and how
varied the text is, with a logistic loss. The scorer is trained on a bounded sample and applied to all.

A text without words, null or not, scores 0. Rows are scored alone, so repeated
rows, null ids and extra columns need no care. An empty table gives no rows.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobuse.llm.common import row_key, small_batches
from jobuse.llm.pieces import text_slices
from jobuse.llm.rules import MEASURES, statistics
from jobuse.llm.weak_labels import estimate
from jobuse.llm.words import SLICE_BYTES, WORD_STEP, Sums, mixed, word_hashes

BINS = 10


def _against(bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).otherwise(F.lit(0))


def _for(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def _measure(s: Column, name: str) -> Column:
    return MEASURES[name](s)


# What speaks for a text (1) and against it (-1). Most labelers look for one fault and say nothing without it.
LABELERS: dict[str, Callable[[Column], Column]] = {
    "symbols": lambda s: _against(_measure(s, "symbols_per_word") > 0.2),
    "shouting": lambda s: _against(_measure(s, "upper_case") > 0.3),
    "repeats": lambda s: _against(_measure(s, "repeated_words") > 0.4),
    "lines": lambda s: _against(_measure(s, "duplicate_lines") > 0.4),
    "word_length": lambda s: _against((_measure(s, "chars_per_word") < 2.5) | (_measure(s, "chars_per_word") > 9.0)),
    "length": lambda s: _for(_measure(s, "words") >= 60, _measure(s, "words") < 8),
    "variety": lambda s: _for(_measure(s, "distinct_words") > 0.4, _measure(s, "distinct_words") < 0.2),
    "prose": lambda s: _for((_measure(s, "symbols_per_word") < 0.02) & (_measure(s, "upper_case") < 0.1) & (_measure(s, "repeated_words") < 0.2),
                            (_measure(s, "symbols_per_word") > 0.2) | (_measure(s, "upper_case") > 0.3)),
}


@dataclass(frozen=True)
class Trainer:
    """``max_training`` bounds the documents that the scorer is trained on."""

    max_training: int = 6_000
    buckets: int = 1 << 14
    rounds: int = 80
    rate: float = 3.0
    ridge: float = 1e-4


def _shapes() -> np.ndarray:
    """Bytes as kinds: capitals A, other letters a (all of UTF-8's upper half), digits 9, the rest as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91], table[97:123], table[48:58], table[128:] = 65, 97, 57, 97
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of every text's words and shapes, flat; the text of each; words of each text; how varied it is.

    ``varied`` is a bin (0 .. ``BINS`` - 1) of the share of 3-word windows that are distinct.
    """
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    columns, counts = [], None
    for k, table in enumerate((_lower(), _shapes())):
        mapped = pa.Array.from_buffers(pa.large_string(), len(texts), [None, texts.buffers()[1], pa.py_buffer(table[data])], 0, texts.offset)
        hashes, counts = word_hashes(mapped)
        columns.append((hashes % np.uint64(buckets // 2)).astype(np.int64) + k * (buckets // 2))
        if k == 0:
            owner = np.repeat(np.arange(len(counts)), counts)
            at = np.arange(max(0, len(hashes) - 2))
            at = at[owner[at] == owner[at + 2]] if len(at) else at
            windows = Sums(hashes, WORD_STEP).runs(at, at + 3) ^ mixed(owner[at].astype(np.uint64))
            distinct = np.bincount(owner[at][np.unique(windows, return_index=True)[1]], minlength=len(counts))
            share = distinct / np.maximum(counts - 2, 1)
            varied = np.where(counts > 2, np.minimum((share * BINS).astype(np.int64), BINS - 1), BINS - 1)
    return np.concatenate(columns), np.concatenate([owner, owner]), counts, varied


def _scores(bucket: np.ndarray, owner: np.ndarray, counts: np.ndarray, varied: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The probability of each text: the mean weight of its words, the weight of its variety, and a bias (the last)."""
    total = np.bincount(owner, weights[bucket], len(counts)) / np.maximum(counts, 1)
    total += weights[len(weights) - 1 - BINS + varied] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def train(rows: Iterator[tuple[pa.Array, np.ndarray]], t: Trainer) -> np.ndarray:
    """Weights of the scorer, by gradient descent (Adagrad) on the labelled texts."""
    parts, labels, n = [], [], 0
    for texts, label in rows:
        bucket, owner, counts, varied = features(texts, t.buckets)
        parts.append((bucket, owner + n, counts, varied))
        labels.append(label)
        n += len(counts)
    weights = np.zeros(t.buckets + BINS + 1)
    if not n:
        return weights
    bucket, owner, counts, varied = (np.concatenate(x) for x in zip(*parts))
    labels, share = np.concatenate(labels), 1 / np.maximum(counts, 1)
    seen = np.full(len(weights), 1e-8)
    for _ in range(t.rounds):
        error = _scores(bucket, owner, counts, varied, weights) - labels
        slope = np.concatenate([np.bincount(bucket, (error * share)[owner], t.buckets), np.bincount(varied, error, BINS), [error.sum()]])
        slope = slope / n + t.ridge * weights
        seen += slope * slope
        weights -= t.rate * slope / np.sqrt(seen)
    return weights


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray
    accuracies: dict[str, dict[int, tuple[float, float]]]


def votes(text: Column) -> Column:
    return F.transform(F.array(statistics(text)), lambda s: F.array(*(f(s) for f in LABELERS.values())))[0]


def training_rows(docs: DataFrame, t: Trainer, total: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts that the scorer is trained on, ``t.max_training`` of ``total`` at most.

    They follow from a hash of each row, so that of rows alike some are in and some out.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    pick = F.xxhash64(row_key(F.col(f"`{id_col}`"), text), F.monotonically_increasing_id(), F.lit("train"))
    share = min(1.0, 1.25 * t.max_training / total)
    near = docs.select(pick.alias("pick"), text.alias("text")).where(F.pmod("pick", F.lit(1 << 30)) < int(share * (1 << 30)))
    return near.orderBy("pick").limit(t.max_training).select("text")


def fit(docs: DataFrame, t: Trainer = Trainer(), id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Labelers' accuracies from all documents; the scorer from a sample of them."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = docs.select(votes(text).alias("votes")).groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    patterns = [(tuple(r["votes"]), r["n"]) for r in found]
    total = sum(n for _, n in patterns)
    if not total:
        return Classifier(np.zeros(t.buckets + BINS + 1), {})
    posterior, accuracies, _ = estimate(patterns, list(LABELERS), silence_tells=True)
    label = dict(zip((v for v, _ in patterns), posterior))
    sample = training_rows(docs, t, total, id_col, text_col).select(votes(F.col("text")).alias("votes"), "text").coalesce(1)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                given, done = [label.get(tuple(v), 0.5) for v in batch.column("votes").to_pylist()], 0
                for texts in text_slices(batch.column("text"), SLICE_BYTES):
                    yield texts, np.array(given[done: done + len(texts)])
                    done += len(texts)

        yield pa.RecordBatch.from_pydict({"weights": pa.array([train(rows(), t)], pa.list_(pa.float64()))})

    weights = sample.mapInArrow(learn, "weights array<double>").first()["weights"]
    return Classifier(np.array(weights), accuracies)


def score(docs: DataFrame, model: Classifier, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of each text. The weights broadcast are as many as there are buckets."""
    small_batches(docs.sparkSession)
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)

    def of(texts: pa.Array) -> pa.Array:
        out = []
        for part in text_slices(texts, SLICE_BYTES):
            found = features(part, len(weights.value) - 1 - BINS)
            out.append(np.where(found[2] > 0, _scores(*found, weights.value), 0.0))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(score_col, F.arrow_udf(of, T.DoubleType())(F.col(f"`{text_col}`")))
