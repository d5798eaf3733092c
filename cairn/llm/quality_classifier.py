"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Each document becomes a vector of statistics of its whole text (``FEATURES`` of them, shares under a
square root, counts under a logarithm). Each class has a normal density whose covariance is shrunk
towards the pooled one and towards its own mean variance. The Cholesky factors are inverted once; a
score is the logistic of the difference of the two log densities plus the log of the prior odds.

All labelled rows given are learned from: their moments are sums in Spark, one row for each class.
Null and empty texts have the statistics of a text without words, and get the score these give. A
null label is no label; a document labelled twice counts twice. With one class or none in the labels
every score is that class's share (0.5 for none). Columns other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cairn.llm.quality_rules import SYMBOLS, repeated_words
from cairn.llm.texts import Texts, chunks, mix, record_batch, sums, utf8

_TABLES = {name: np.zeros(256, bool) for name in ("upper", "digit", "stop", "mark", "pipe", "wide", "comma")}
_TABLES["upper"][0x41:0x5B] = _TABLES["digit"][0x30:0x3A] = _TABLES["wide"][0x80:] = True
_TABLES["stop"][list(b".")] = _TABLES["mark"][list(b"!?")] = True
_TABLES["pipe"][list(b"|")] = _TABLES["comma"][list(b",")] = True
FEATURES = 13


def statistics(texts: Texts) -> np.ndarray:
    words, lines = texts.words(), texts.lines()
    hashes = words.hashes()
    n_words, size = words.counts, np.diff(texts.offsets)
    some, bytes_ = np.maximum(n_words, 1), np.maximum(size, 1)
    keys = mix(hashes + words.owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    again = np.zeros(len(words), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    share = {name: texts.count(table[texts.data]) / bytes_ for name, table in _TABLES.items()}
    return np.stack(
        [
            np.log1p(n_words),
            np.log1p(size / some),
            np.log1p(n_words / np.maximum(lines.counts, 1)),
            np.sqrt(texts.count(SYMBOLS[texts.data]) / bytes_),
            np.sqrt(sums(repeated_words(words, hashes), words.first) / some),
            np.sqrt(sums(again, words.first) / some),
            *(np.sqrt(x) for x in share.values()),
        ],
        1,
    )


def features(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` of every document."""

    def run(batches):
        for batch, texts in chunks(batches):
            yield record_batch(doc_id=batch.column(0), features=list(statistics(texts)))

    return documents.select(F.col("doc_id").cast("long"), utf8()).mapInArrow(run, "doc_id long, features array<double>")


@dataclass(frozen=True)
class Discriminant:
    """For each class the mean and the inverse Cholesky factor; ``offset`` has the rest of the log odds."""

    means: np.ndarray
    factors: np.ndarray
    offset: float

    def score(self, vectors: np.ndarray) -> np.ndarray:
        odds = np.full(len(vectors), self.offset)
        for sign, mean, factor in zip((-1, 1), self.means, self.factors, strict=True):
            odds -= sign * 0.5 * np.square((vectors - mean) @ factor.T).sum(1)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(labelled: DataFrame, pooled: float = 0.3, ridge: float = 0.05) -> Discriminant:
    """``labelled`` has ``quality`` 0 or 1 and ``features``. Sums are over all its rows."""
    pairs = [(i, j) for i in range(FEATURES) for j in range(i + 1)]
    value = lambda i: F.get("features", F.lit(i))
    rows = {
        row["quality"]: row
        for row in labelled.where("quality in (0, 1)")
        .groupBy("quality")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*(F.sum(value(i)) for i in range(FEATURES))).alias("first"),
            F.array(*(F.sum(value(i) * value(j)) for i, j in pairs)).alias("second"),
        )
        .collect()
    }
    counts = np.array([rows[k]["n"] if k in rows else 0 for k in (0, 1)], float)
    zero = np.zeros((2, FEATURES))
    if not counts.all():
        share = 0.5 if not counts.sum() else min(max(counts[1] / counts.sum(), 1e-6), 1 - 1e-6)
        return Discriminant(zero, np.zeros((2, FEATURES, FEATURES)), float(np.log(share / (1 - share))))
    means, spread = zero.copy(), np.zeros((2, FEATURES, FEATURES))
    for k in (0, 1):
        means[k] = np.array(rows[k]["first"]) / counts[k]
        for (i, j), total in zip(pairs, rows[k]["second"], strict=True):
            spread[k, i, j] = spread[k, j, i] = total / counts[k] - means[k, i] * means[k, j]
    both = np.tensordot(counts / counts.sum(), spread, 1)
    factors, halves = [], []
    for k in (0, 1):
        shrunk = (1 - pooled) * spread[k] + pooled * both
        shrunk = (1 - ridge) * shrunk + ridge * (np.trace(shrunk) / FEATURES + 1e-9) * np.eye(FEATURES)
        root = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(root))
        halves.append(np.log(np.diag(root)).sum())
    return Discriminant(means, np.stack(factors), float(np.log(counts[1] / counts[0]) - halves[1] + halves[0]))


def score_features(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """``vectors`` with a column ``score`` in place of ``features``."""
    kept = [c for c in vectors.columns if c != "features"]

    def run(batches):
        for batch in batches:
            table = np.asarray(batch.column(len(kept)).flatten()).reshape(-1, FEATURES)
            yield record_batch(**{c: batch.column(i) for i, c in enumerate(kept)}, score=model.score(table))

    schema = StructType([*vectors.select(*kept).schema.fields, StructField("score", DoubleType())])
    return vectors.select(*kept, F.col("features").cast(ArrayType(DoubleType()))).mapInArrow(run, schema)


def score_documents(documents: DataFrame, model: Discriminant) -> DataFrame:
    """``row`` (the whole document, as a struct) and ``score``."""
    schema = StructType([StructField("row", documents.schema), StructField("score", DoubleType())])

    def run(batches):
        for batch, texts in chunks(batches):
            yield record_batch(row=batch.column(0), score=model.score(statistics(texts)))

    return documents.select(F.struct("*").alias("row"), utf8()).mapInArrow(run, schema)
