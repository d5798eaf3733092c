"""Quality rules: a linear-chain conditional random field labels each line content or boilerplate.

A text is kept when it passes the base rules (enough words, few repeated ones) and the best label
sequence of its lines, found by Viterbi decoding, gives content at least half of its words.

The field has one weight for each line feature and one for each pair of neighbouring labels. It is
fitted by conditional likelihood on the lines of a bounded sample of labelled documents: at most ``sample`` of them,
chosen by the hash of id and text among those of at most ``LONGEST`` lines, and at most ``LINES`` lines in all. Lines of a
bad document count as boilerplate. So do, in a good one, lines that would fail on their own: those the text has had
already, those mostly made of repeated windows, and those full of symbols; its other lines are content. Labels thus change
inside documents, and the field learns how they follow one another. Features are computed in tasks; the driver gets
nine numbers a line. Features, base rules and decoding see all lines of all documents.

Null and empty texts have no words, so they fail the base rules. Repeated rows are scored each on
its own, and learned from once. Of several labels of an id the largest counts. Without labelled documents every weight is 0: ties go to content. Columns other than id and
text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.texts import Spans, Texts, chunks, mix, record_batch, sums, utf8

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER, _DIGIT, _STOP, _CLOSE = (np.zeros(256, bool) for _ in range(4))
_UPPER[0x41:0x5B] = _DIGIT[0x30:0x3A] = True
_STOP[list(b"!?;:=_~^/\\{}[]@+")] = True
_CLOSE[list(b".?!")] = True
WINDOW = 8
FEATURES = 9
#: Places of two features: symbols times four, and words in repeated windows plus one for a line had already.
SYMBOLIC, REPEATED = 3, 7
#: Bounds of the sample: lines of a document, and of all.
LONGEST, LINES = 1000, 100_000


@dataclass(frozen=True)
class LineField:
    """Weights of the label 'content' against 'boilerplate', and of label pairs (before, after)."""

    emission: np.ndarray
    transition: np.ndarray


def repeated_words(words: Spans, hashes: np.ndarray) -> np.ndarray:
    """Flags words in a window of eight that its text has twice or more."""
    starts, windows = words.windows(hashes, WINDOW)
    keys = mix(windows + words.owner[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int32)
    cover[starts[twice]] += 1
    cover[starts[twice] + WINDOW] -= 1
    return np.cumsum(cover)[:-1] > 0


def measure(texts: Texts) -> tuple[dict[str, np.ndarray], np.ndarray, Spans, np.ndarray]:
    """Base columns of each text; features, spans and number of words of each line."""
    words = texts.words()
    repeated = repeated_words(words, words.hashes())
    lines = texts.lines()
    line_words = np.searchsorted(words.start, np.append(lines.start, len(texts.data)))
    line_end = np.searchsorted(words.start, lines.start + lines.length)
    n_words = line_end - line_words[:-1]
    hashes = mix(lines.hashes() + lines.owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    filled = np.flatnonzero(n_words)
    order = filled[np.lexsort((filled, hashes[filled]))]
    earlier = np.zeros(len(lines), bool)
    earlier[order[1:]] = hashes[order[1:]] == hashes[order[:-1]]
    character = (texts.data & 0xC0) != 0x80
    base = {
        "n_words": words.counts,
        "word_chars": texts.count(character & ~np.isin(texts.data, (0x20, *range(0x09, 0x0E)))),
        "n_symbols": texts.count(SYMBOLS[texts.data]),
        "n_dup_lines": sums(earlier, lines.first),
        "n_repeat_words": sums(repeated, words.first),
    }

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[texts.data])])
        return (total[lines.start + lines.length] - total[lines.start]) / np.maximum(lines.length, 1)

    covered = np.concatenate([[0], np.cumsum(repeated)])
    last = texts.data[np.maximum(lines.start + lines.length - 1, 0)] if len(texts.data) else np.zeros(len(lines), np.uint8)
    features = np.stack(
        [
            np.ones(len(lines)),
            np.log1p(n_words) / 4,
            np.minimum(lines.length / np.maximum(n_words, 1) / 10, 2),
            4 * share(SYMBOLS),
            4 * share(_STOP),
            share(_UPPER),
            4 * share(_DIGIT),
            (covered[line_end] - covered[line_words[:-1]]) / np.maximum(n_words, 1) + earlier,
            _CLOSE[last] & (lines.length > 0),
        ],
        1,
    )
    return base, features, lines, n_words


def _columns(first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each place in a sequence: which texts reach it, longest first, and their lines there."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    longest = int(counts.max(initial=0))
    reach = np.searchsorted(-counts[order], -np.arange(longest), "left")
    return [(order[:n], first[order[:n]] + t) for t, n in enumerate(reach)]


def decode(field: LineField, features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Viterbi: for each line of each text whether the best sequence calls it content."""
    score = features @ field.emission
    best = np.zeros((len(first) - 1, 2))
    back = np.zeros((len(score), 2), bool)
    steps = _columns(first)
    for t, (texts, lines) in enumerate(steps):
        if t:
            ways = best[texts][:, :, None] + field.transition
            back[lines] = ways[:, 1] >= ways[:, 0]
            best[texts] = ways.max(1)
        best[texts, 1] += score[lines]
    content = np.zeros(len(score), bool)
    state = np.zeros(len(first) - 1, bool)
    reached = np.zeros(len(first) - 1, bool)
    for texts, lines in reversed(steps):
        new = ~reached[texts]
        state[texts] = np.where(new, best[texts, 1] >= best[texts, 0], state[texts])
        reached[texts] = True
        content[lines] = state[texts]
        state[texts] = back[lines, state[texts].astype(int)]
    return content


def seeds(quality: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Labels to learn from: 1 for the lines of good documents that would not fail on their own."""
    return ((quality == 1) & (features[:, REPEATED] <= 0.3) & (features[:, SYMBOLIC] <= 4 * 0.1)).astype(int)


def fit(features: np.ndarray, first: np.ndarray, truth: np.ndarray, rounds: int = 150, ridge: float = 1e-2) -> LineField:
    """Gradient ascent on the conditional likelihood of the lines' labels, by forward and backward sums."""
    weights, pairs = np.zeros(FEATURES), np.zeros((2, 2))
    steps = _columns(first)
    n_lines = max(len(truth), 1)
    follows = np.zeros((2, 2))
    inner = np.ones(len(truth), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    np.add.at(follows, (truth[at - 1], truth[at]), 1)
    for round_ in range(rounds):
        emit = np.stack([np.zeros(len(truth)), features @ weights], 1)
        ahead, behind = np.zeros((len(truth), 2)), np.zeros((len(truth), 2))
        for t, (_, lines) in enumerate(steps):
            ahead[lines] = emit[lines]
            if t:
                ahead[lines] += np.logaddexp.reduce(ahead[lines - 1][:, :, None] + pairs, axis=1)
        for (_, lines), (_, after) in zip(reversed(steps[:-1]), reversed(steps[1:]), strict=True):
            behind[lines[: len(after)]] = np.logaddexp.reduce(pairs + (emit[after] + behind[after])[:, None, :], axis=2)
        whole = ahead + behind
        chance = np.exp(whole - np.logaddexp.reduce(whole, axis=1)[:, None])
        joint = ahead[at - 1][:, :, None] + pairs + (emit[at] + behind[at])[:, None, :]
        joint = np.exp(joint - np.logaddexp.reduce(joint.reshape(len(at), 4), axis=1)[:, None, None])
        rate = 4.0 / (1 + round_ / 50)
        weights = weights + rate * (features.T @ (truth - chance[:, 1]) / n_lines - ridge * weights)
        pairs = pairs + rate * ((follows - joint.sum(0)) / n_lines - ridge * pairs)
    return LineField(weights, pairs)


def fit_lines(documents: DataFrame, labels: DataFrame, sample: int = 2000, longest: int = LONGEST, most: int = LINES) -> LineField:
    """Fits the field on the sample."""
    chosen = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )

    def describe(batches):
        for batch, texts in chunks(batches):
            _, features, lines, _ = measure(texts)
            rows = [features[a:b].ravel() if b - a <= longest else None for a, b in zip(lines.first, lines.first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rows, pa.list_(pa.float64()))], names=["place", "quality", "features"])

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select("doc_id", F.xxhash64("doc_id", text).alias("place"), utf8()).join(F.broadcast(chosen), "doc_id")
    described = rows.select("place", "quality", "text").mapInArrow(describe, "place long, quality int, features array<double>").where("features is not null")
    parts, counts, truth, total = [np.zeros((0, FEATURES))], [0], [np.zeros(0, int)], 0
    for row in described.groupBy("place").agg(F.first("quality").alias("quality"), F.first("features").alias("features")).orderBy("place").limit(sample).toLocalIterator():
        features = np.array(row["features"]).reshape(-1, FEATURES)
        if total + len(features) > most:
            break
        total += len(features)
        parts.append(features)
        counts.append(total)
        truth.append(seeds(np.full(len(features), row["quality"]), features))
    return fit(np.concatenate(parts), np.array(counts), np.concatenate(truth))


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, n_lines long, n_content_lines long"


def quality_rules(documents: DataFrame, field: LineField, min_words: int = 20, max_repeat: int = 30, min_content: float = 0.5) -> DataFrame:
    """One row for each document: base columns, content lines and the verdict."""

    def judge(batches):
        for batch, texts in chunks(batches):
            base, features, lines, n_words = measure(texts)
            content = decode(field, features, lines.first)
            share = sums(n_words * content, lines.first) / np.maximum(base["n_words"], 1)
            failed = (base["n_words"] < min_words) | (100 * base["n_repeat_words"] > max_repeat * base["n_words"])
            yield record_batch(
                doc_id=batch.column(0), **base, base_failed=failed, kept=~failed & (share >= min_content),
                content_share=share, n_lines=lines.counts, n_content_lines=sums(content, lines.first),
            )

    return documents.select(F.col("doc_id").cast("long"), utf8()).mapInArrow(judge, SCHEMA)
