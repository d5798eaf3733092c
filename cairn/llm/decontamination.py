"""Benchmark decontamination: sorted suffixes of the training texts, searched for every test suffix.

A training shard is a run of whole documents. Its suffix array holds the word positions from which a
match can start, sorted by the words that follow; every suffix of every test item is found in it by
binary search, as a range of positions. Neighbouring matches join to the longest verbatim passages.

A *window* is ``width`` (13) consecutive words of an item, or the whole item when it is shorter. A
document word is hit when it lies inside any occurrence of a window. A document is contaminated when
20 * hit words >= all words and any word is hit.

Which items a document holds comes from the distinct windows found in it, so text that repeats itself costs no more
than other text. ``matches`` has every longest passage that document and item share, with its places in both; where
both repeat themselves these are as many as the ways to lay one over the other, so they are found on request only.

The items are taken in blocks of at most ``BLOCK`` bytes of text (or one item): a block is what a
task holds, and the documents pass each block in turn. Null and empty texts and items have no words
and match nothing. Equal items are found together and count by their distinct ids; a null id is
written as ``null``. Repeated documents each get their own row. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.types import _parse_datatype_string as parse

from cairn.llm.staging import stage
from cairn.llm.texts import WORD_LIKE, Spans, Texts, chunks, utf8

BLOCK = 16 << 20
#: Pairs of a document and an item that are looked at together.
PAIRS = 4_000_000
WIDTH = 13
MATCHES = "array<struct<item_id: string, doc_word: long, item_word: long, n_words: long>>"


def spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges ``low:high``, and the range each is from."""
    size = high - low
    owner = np.repeat(np.arange(len(low)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner], owner


class TestSuffixes:
    """The suffixes of one block of items, ready to be searched for."""

    __test__ = False  # for pytest

    def __init__(self, ids: list[str], items: list[bytes], width: int):
        self.ids, self.width = ids, width
        data = np.frombuffer(b"".join(items), np.uint8)
        words = Texts(data, np.cumsum([0, *map(len, items)])).lower().words(WORD_LIKE)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes).astype(np.int64) + 1
        length = np.minimum(np.repeat(words.counts, words.counts), width)
        self.place = np.flatnonzero(np.arange(len(words)) + length <= np.repeat(words.first[1:], words.counts))
        self.item = words.owner[self.place]
        self.at = self.place - words.first[self.item]
        lengths = length[self.place]
        ahead = np.arange(width)
        table = np.concatenate([numbers, np.zeros(width, np.int64)])[self.place[:, None] + ahead]
        table[ahead >= lengths[:, None]] = 0
        table, same = np.unique(table, axis=0, return_inverse=True)
        self.lengths = np.count_nonzero(table, axis=1)
        self.shortest = int(self.lengths.min(initial=width))
        order = np.argsort(same.reshape(-1), kind="stable")
        self.members, self.bounds = order, np.searchsorted(same.reshape(-1)[order], np.arange(len(table) + 1))
        # the items of each distinct window, each once
        held = np.unique(same.reshape(-1).astype(np.int64) * max(1, len(ids)) + self.item)
        self.holders, self.held = held % max(1, len(ids)), np.searchsorted(held // max(1, len(ids)), np.arange(len(table) + 1))
        self.bits = int(len(self.vocabulary) + 1).bit_length()
        self.low = self.pack(table)
        beyond = (ahead >= self.lengths[:, None]) * ((1 << self.bits) - 1)
        self.high = self.pack(table + beyond)

    def pack(self, table: np.ndarray) -> list[np.ndarray]:
        """Rows of word numbers as few 64-bit keys that sort alike."""
        each = 64 // self.bits
        keys = []
        for k in range(0, self.width, each):
            key = np.zeros(len(table), np.uint64)
            for j in range(k, min(k + each, self.width)):
                key = (key << np.uint64(self.bits)) | table[:, j].astype(np.uint64)
            keys.append(key)
        return keys

    def suffix_array(self, numbers: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Positions followed by enough known words, sorted by these words, with their keys."""
        place = np.arange(len(numbers))
        stop = np.where(numbers == 0, place, len(numbers))
        run = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], end) - place
        found = np.flatnonzero(run >= self.shortest)
        ahead = np.arange(self.width)
        table = np.concatenate([numbers, np.zeros(self.width, np.int64)])[found[:, None] + ahead]
        table[ahead >= run[found][:, None]] = 0
        keys = self.pack(table)
        order = np.lexsort(keys[::-1])
        return found[order], [key[order] for key in keys]

    def search(self, keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """Binary search of all wanted rows at once: the first place not below (or, after, above) each."""
        low = np.zeros(len(wanted[0]), np.int64)
        high = np.full(len(wanted[0]), len(keys[0]), np.int64)
        while (open_ := low < high).any():
            middle = np.minimum((low + high) // 2, len(keys[0]) - 1)
            less, equal = np.zeros(len(low), bool), np.ones(len(low), bool)
            for key, want in zip(keys, wanted, strict=True):
                less |= equal & (key[middle] < want)
                equal &= key[middle] == want
            up = open_ & (less | (equal & after))
            low = np.where(up, middle + 1, low)
            high = np.where(open_ & ~up, middle, high)
        return low

    def found(self, texts: Texts, passages: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]], list[list]]:
        """Words of each text, hit flags with their bounds, the items of each text, and its longest passages with each."""
        words = texts.lower().words(WORD_LIKE)
        items: list[list[str]] = [[] for _ in range(len(texts))]
        matches: list[list] = [[] for _ in range(len(texts))]
        if not len(self.lengths) or not len(words):
            return words.counts, np.zeros(len(words), bool), words.first, items, matches
        hashes = words.hashes()
        near = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        numbers = np.where(self.vocabulary[near] == hashes, near + 1, 0)
        suffixes, keys = self.suffix_array(numbers, np.repeat(words.first[1:], words.counts))
        low, high = self.search(keys, self.low, False), self.search(keys, self.high, True)
        rank, window = spans(low, high)
        place = suffixes[rank]
        cover = np.bincount(place, minlength=len(words) + 1)
        cover -= np.bincount(place + self.lengths[window], minlength=len(words) + 1)
        owner = np.searchsorted(words.first, place, "right") - 1
        once = np.unique(owner * len(self.lengths) + window)
        doc, window_of = once // len(self.lengths), once % len(self.lengths)
        for part in self.portions(doc, np.diff(self.held)[window_of]):
            which, pair = spans(self.held[window_of[part]], self.held[window_of[part] + 1])
            for both in np.unique(doc[part][pair] * len(self.ids) + self.holders[which]).tolist():
                items[both // len(self.ids)].append(self.ids[both % len(self.ids)])
        if passages:
            order = np.argsort(owner, kind="stable")
            place, window, owner = place[order], window[order], owner[order]
            for part in self.portions(owner, np.diff(self.bounds)[window]):
                self.passages(words, place[part], window[part], matches)
        return words.counts, np.cumsum(cover)[:-1] > 0, words.first, items, matches

    @staticmethod
    def portions(doc: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
        """Cuts rows sorted by document so that each part holds whole documents of at most ``PAIRS`` in all, or one."""
        ends = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, len(doc)) if len(doc) else []
        total, low, last = np.append(0, np.cumsum(sizes)), 0, 0
        for end in ends:
            if last > low and total[end] - total[low] > PAIRS:
                yield slice(low, last)
                low = last
            last = int(end)
        if last > low:
            yield slice(low, last)

    def passages(self, words: Spans, place: np.ndarray, window: np.ndarray, matches: list[list]) -> None:
        """Joins windows that follow one another in a text and in an item."""
        which, pair = spans(self.bounds[window], self.bounds[window + 1])
        test = self.members[which]
        place, width = place[pair], self.lengths[window[pair]]
        owner = np.searchsorted(words.first, place, "right") - 1
        diagonal = place - self.place[test]
        order = np.lexsort((place, diagonal, self.item[test], owner))
        place, test, width, owner, diagonal = (x[order] for x in (place, test, width, owner, diagonal))
        fresh = np.ones(len(place), bool)
        fresh[1:] = (place[1:] != place[:-1] + 1) | (diagonal[1:] != diagonal[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(place)) - 1
        size = place[last] + width[last] - place[first] if len(first) else first
        columns = (owner[first], self.item[test[first]], place[first] - words.first[owner[first]], self.at[test[first]], size)
        for doc, item, at, there, n in zip(*(x.tolist() for x in columns), strict=True):
            matches[doc].append({"item_id": self.ids[item], "doc_word": at, "item_word": there, "n_words": n})


def blocks(benchmark: DataFrame, width: int, limit: int) -> Iterator[TestSuffixes]:
    ids, items, size = [], [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), utf8()).toLocalIterator():
        text = bytes(row["text"] or b"")
        if items and size + len(text) > limit:
            yield TestSuffixes(ids, items, width)
            ids, items, size = [], [], 0
        ids.append(row["item_id"])
        items.append(text)
        size += len(text)
    yield TestSuffixes(ids, items, width)


def find_matches(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK, passages: bool = True) -> DataFrame:
    """``row`` (the whole document as a struct), ``n_words``, ``n_hit``, ``items``, ``contaminated`` and, with ``passages``, ``matches``."""
    spark = documents.sparkSession
    state = f"n_words long, n_hit long, hits binary, items array<string>, matches {MATCHES}"
    schema = StructType([StructField("row", documents.schema), *parse(state).fields])
    arrow = pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())]))
    df = documents.select(F.struct("*").alias("row"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]))
    todo = blocks(benchmark, width, block)
    suffixes: TestSuffixes | None = next(todo)
    while suffixes is not None:
        shared = spark.sparkContext.broadcast(suffixes)
        suffixes = next(todo, None)

        def run(batches, shared=shared):
            test = shared.value
            for batch, texts in chunks(batches):
                n_words, hit, first, items, matches = test.found(texts, passages)
                hits = []
                before = [batch.column(k).to_pylist() for k in (3, 4, 5)]
                for i, (known, had, shown) in enumerate(zip(*before, strict=True)):
                    own = np.packbits(hit[first[i] : first[i + 1]])
                    hits.append(own if known is None else own | np.frombuffer(known, np.uint8))
                    items[i] = (had or []) + items[i]
                    matches[i] = (shown or []) + matches[i]
                n_hit = np.array([np.bitwise_count(x).sum() for x in hits], np.int64)
                arrays = [
                    batch.column(0), pa.array(n_words), pa.array(n_hit), pa.array([x.tobytes() for x in hits], pa.binary()),
                    pa.array(items, pa.list_(pa.string())), pa.array(matches, arrow),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

        df = df.select("*", F.col("row.text").cast("binary").alias("text")).mapInArrow(run, schema)
        if suffixes is not None:
            df = stage(df, "decontamination")
    found = df.drop("hits") if passages else df.drop("hits", "matches")
    return found.withColumns(
        {
            "items": F.array_sort(F.array_distinct("items")),
            "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
        }
    )
