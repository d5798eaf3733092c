"""Language identification: script ranges narrow the candidates, Viterbi labels the words.

A word is a run of letters. Its score under a language is the sum of the log probabilities of its
letter triples (with a blank at both ends), whose counts come from all learning documents, hashed to
``SLOTS`` slots. Only languages that were seen with the word's script (at least ``SCRIPT_SHARE`` of
their letters) are candidates, if there are any. Over a text's words Viterbi finds the labels with
the best sum of scores less ``penalty`` for each change of language; runs of equal labels are the
spans. A text's language is the one with most letters (the first in order of names, if equal), its
score their share.

A text without letters, empty or null, is ``und`` with score 0; so is every text when no learning
document has a language. Null languages teach nothing. Columns other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.quality_rules import _columns
from cairn.llm.texts import Spans, Texts, chunks, mix, record_batch, utf8

SLOTS = 1 << 14
SCRIPT_SHARE = 0.01
MOST_LANGUAGES = 2000
#: Fixed: where scripts begin in Unicode; the letters from one number up to the next are one script.
SCRIPTS = [0x0, 0x250, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xA00, 0xB80, 0xC00, 0xD80, 0xE00, 0xE80, 0xF00, 0x1000, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2C00, 0x3040, 0x30A0, 0x3100, 0x4E00, 0xA000, 0xAC00, 0xF900, 0x10000, 0x20000]


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        if (c := chr(point)).isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def code_points(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Code points, and the bounds of each text among them."""
    lead = (texts.data & 0xC0) != 0x80
    place = np.flatnonzero(lead)
    data = np.concatenate([texts.data, np.zeros(4, np.uint8)])
    first = texts.data[place].astype(np.uint32)
    points = first.copy()
    for low, high, bits, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        found = np.flatnonzero((first >= low) & (first < high))
        value = points[found] & bits
        for k in range(1, more + 1):
            value = (value << 6) | (data[place[found] + k] & 0x3F)
        points[found] = np.minimum(value, 0x10FFFF)
    return points, np.searchsorted(place, texts.offsets)


def letter_words(texts: Texts) -> tuple[Spans, np.ndarray, np.ndarray]:
    """Runs of letters, the slots of their triples, and the script of each run."""
    points, bounds = code_points(texts)
    low = letters()[points]
    flags = np.zeros(len(low) + 2, bool)
    flags[1:-1] = low > 0
    begin, end = flags[1:-1] & ~flags[:-2], flags[1:-1] & ~flags[2:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(low))]
    begin[edges], end[edges - 1] = low[edges] > 0, low[edges - 1] > 0
    start = np.flatnonzero(begin)
    words = Spans(texts, start, np.flatnonzero(end) + 1 - start, np.searchsorted(start, bounds))
    wide = low.astype(np.uint64)
    before, after = np.zeros_like(wide), np.zeros_like(wide)
    before[1:], after[:-1] = wide[:-1], wide[1:]
    before[begin], after[end] = 0, 0
    slots = (mix(before << np.uint64(42) | wide << np.uint64(21) | after) >> np.uint64(50)).astype(np.int64)
    scripts = np.searchsorted(SCRIPTS, low[start], "right") - 1
    return words, slots[low > 0], scripts


@dataclass(frozen=True)
class Languages:
    names: list[str]
    #: log probability of each slot in each language
    slots: np.ndarray
    #: whether a language is a candidate for a script
    scripts: np.ndarray

    def spans(self, texts: Texts, penalty: float) -> tuple[Spans, np.ndarray]:
        """The words of the texts and the language number of each."""
        words, slots, scripts = letter_words(texts)
        label = np.zeros(len(words), np.int64)
        if not len(words) or not self.names:
            return words, label
        bounds = np.cumsum(words.length) - words.length
        scores = np.add.reduceat(self.slots[slots], bounds, axis=0)
        scores[~self.scripts[scripts]] = -1e6
        best = np.zeros((len(texts), len(self.names)), np.float32)
        back = np.full(len(words), -1, np.int64)
        moved = np.zeros(scores.shape, bool)
        steps = _columns(words.first)
        for t, (docs, at) in enumerate(steps):
            now = best[docs]
            if t:
                top = now.argmax(1)
                change = now[np.arange(len(docs)), top] - np.float32(penalty)
                back[at] = top
                moved[at] = now < change[:, None]
                now = np.maximum(now, change[:, None])
                now -= now.max(1)[:, None]
            best[docs] = now + scores[at]
        state = best.argmax(1)
        for docs, at in reversed(steps):
            label[at] = now = state[docs]
            state[docs] = np.where(moved[at, now], back[at], now)
        return words, label


def count_letters(documents: DataFrame) -> DataFrame:
    """``lang``, ``slot``, ``n``: how often each slot, and after them each script, occurs in each language."""
    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def rows():
            out = record_batch(lang=pa.array(list(counts), pa.string()), counts=pa.array([list(x) for x in counts.values()], pa.list_(pa.int64())))
            counts.clear()
            return out

        for batch, texts in chunks(batches):
            words, slots, scripts = letter_words(texts)
            names, codes = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            of_word = codes[words.owner]
            seen = np.bincount(np.repeat(of_word, words.length) * SLOTS + slots, minlength=len(names) * SLOTS)
            written = np.bincount(of_word * len(SCRIPTS) + scripts, words.length, len(names) * len(SCRIPTS))
            both = np.concatenate([seen.reshape(-1, SLOTS), written.astype(np.int64).reshape(-1, len(SCRIPTS))], 1)
            if len(counts) >= 32:
                yield rows()
            for name, own in zip(names.tolist(), both, strict=True):
                counts[name] = counts[name] + own if name in counts else own
        yield rows()

    learn = documents.where("lang is not null and text is not null").select(F.col("lang").cast("string"), utf8())
    parts = learn.mapInArrow(run, "lang string, counts array<long>")
    flat = parts.select("lang", F.posexplode("counts").alias("slot", "n")).where("n > 0")
    return flat.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def learn(documents: DataFrame, smoothing: float = 0.1) -> Languages:
    """``documents`` has ``text`` and ``lang``; all of them are counted."""
    counts = count_letters(documents)
    names = [row["lang"] for row in counts.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = np.zeros((SLOTS + len(SCRIPTS), len(names)))
    rows = counts.toPandas()
    table[rows["slot"], rows["lang"].map({name: i for i, name in enumerate(names)}).astype(int)] = rows["n"]
    slots = table[:SLOTS] + smoothing
    shares = table[SLOTS:] / np.maximum(table[SLOTS:].sum(0), 1)
    scripts = shares >= SCRIPT_SHARE
    scripts[~scripts.any(1)] = True
    return Languages(names, np.log(slots / slots.sum(0)).astype(np.float32) if names else slots, scripts)


SPANS = "array<struct<first_word: long, n_words: long, lang: string>>"


def identify(documents: DataFrame, model: Languages, penalty: float = 8.0, keep_spans: bool = False) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``n_spans``; with ``keep_spans`` also the spans themselves."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, n_spans long" + f", spans {SPANS}" * keep_spans

    def run(batches):
        model = shared.value
        names = np.array([*model.names, "und"], object)
        for batch, texts in chunks(batches):
            words, label = model.spans(texts, penalty)
            letters_of = np.bincount(words.owner * len(names) + label, words.length, len(texts) * len(names)).reshape(-1, len(names))
            total = letters_of.sum(1)
            known = (total > 0) & bool(model.names)
            top = np.where(known, letters_of.argmax(1), len(names) - 1)
            score = np.where(known, letters_of[np.arange(len(texts)), top] / np.maximum(total, 1), 0.0)
            fresh = np.ones(len(words), bool)
            fresh[1:] = label[1:] != label[:-1]
            fresh[words.first[:-1][words.counts > 0]] = True
            begin = np.flatnonzero(fresh)
            bounds = np.searchsorted(begin, words.first)
            columns = dict(doc_id=batch.column(0), lang_pred=pa.array(names[top], pa.string()), score=score, n_spans=np.diff(bounds))
            if keep_spans:
                size = np.diff(np.append(begin, len(words)))
                rows = [[{"first_word": int(begin[k] - words.first[i]), "n_words": int(size[k]), "lang": names[label[begin[k]]]} for k in range(bounds[i], bounds[i + 1])] for i in range(len(texts))]
                columns["spans"] = pa.array(rows, pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())])))
            yield record_batch(**columns)

    return documents.select(F.col("doc_id").cast("long"), utf8()).mapInArrow(run, schema)
