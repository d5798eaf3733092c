"""Whole texts of an Arrow batch as numpy arrays: words, lines, windows, and their 64-bit hashes.

Texts come as UTF-8 bytes (``cast('binary')``), laid end to end. A null text has no bytes, as an
empty one. Hashes compare words, lines and windows; two different ones of the same corpus meet with
a probability of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once. A longer text is worked on alone.
CHUNK = 2 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Words of digits, lower-case letters and everything beyond ASCII.
WORD_LIKE = np.zeros(256, bool)
WORD_LIKE[0x30:0x3A] = WORD_LIKE[0x61:0x7B] = WORD_LIKE[0x80:] = True

_U = np.uint64
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=_U)
_ODD = (np.random.default_rng(20).integers(0, 2**63, 64, dtype=np.uint64) << _U(1)) | _U(1)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits; a bijection."""
    values = values ^ (values >> _U(32))
    values *= _U(0xD6E8FEB86659FD93)
    values ^= values >> _U(29)
    values *= _U(0x9E3779B97F4A7C15)
    values ^= values >> _U(32)
    return values


def utf8(column: str = "text") -> Column:
    return F.col(column).cast("binary").alias(column)


def remainder(identifier: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(identifier).cast("string"), F.lit(""))) % F.lit(modulus)


class Texts:
    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> Texts:
        """A-Z in lower case, all other bytes as they are."""
        return Texts(LOWER[self.data], self.offsets)

    def count(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        return sums(flags, self.offsets)

    def words(self, inside: np.ndarray | None = None) -> Spans:
        """Longest runs of bytes for which the table ``inside`` (by default: no blank) holds."""
        flags = ~BLANK[self.data] if inside is None else inside[self.data]
        begin, end = flags.copy(), flags.copy()
        begin[1:] &= ~flags[:-1]
        end[:-1] &= ~flags[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(flags))]
        begin[edges] = flags[edges]
        end[edges - 1] = flags[edges - 1]
        start = np.flatnonzero(begin)
        return Spans(self, start, np.flatnonzero(end) + 1 - start, np.searchsorted(start, self.offsets))

    def lines(self) -> Spans:
        """Parts between line feeds; a text with none is one line, also when it is empty."""
        feeds = np.flatnonzero(self.data == 10)
        owner = np.searchsorted(self.offsets, feeds, "right") - 1
        first = np.searchsorted(feeds, self.offsets) + np.arange(len(self.offsets))
        start = np.empty(first[-1], np.int64)
        end = np.empty(first[-1], np.int64)
        place = np.arange(len(feeds)) + owner
        start[first[:-1]], start[place + 1] = self.offsets[:-1], feeds + 1
        end[first[1:] - 1], end[place] = self.offsets[1:], feeds
        return Spans(self, start, end - start, first)


class Spans:
    """Parts of texts: byte ``start`` and ``length``; those of text ``i`` are ``first[i]:first[i+1]``."""

    def __init__(self, texts: Texts, start: np.ndarray, length: np.ndarray, first: np.ndarray):
        self.texts, self.start, self.length, self.first = texts, start, length, first

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.counts)

    def eights(self) -> tuple[np.ndarray, np.ndarray]:
        """``(words, read)``: ``read(k, chosen)`` has bytes 8k to 8k+7 of the chosen spans, zero-filled."""
        padded = np.concatenate([self.texts.data, np.zeros(8, np.uint8)])
        window = np.ndarray(len(self.texts.data) + 1, "<u8", buffer=padded.data, strides=(1,))

        def read(k: int, chosen: np.ndarray | slice) -> np.ndarray:
            rest = np.clip(self.length[chosen] - 8 * k, 0, 8)
            at = np.minimum(self.start[chosen] + 8 * k, len(window) - 1)
            return window[at] & _MASK[rest]

        return read

    def hashes(self) -> np.ndarray:
        read = self.eights()
        values = mix(self.length.astype(_U) * _ODD[0] + read(0, slice(None)))
        step, long = 1, np.flatnonzero(self.length > 8)
        while len(long):
            values[long] = mix(values[long] * _ODD[1] + read(step, long))
            step += 1
            long = long[self.length[long] > 8 * step]
        return values

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all windows of ``width`` spans inside one text."""
        last = np.repeat(self.first[1:], self.counts) - width
        starts = np.flatnonzero(np.arange(len(self)) <= last)
        total = np.zeros(max(0, len(hashes) - width + 1), _U)
        for k in range(width):
            total += hashes[k : len(total) + k] * _ODD[2 + k]
        return starts, mix(total[starts])


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over ``values[bounds[i]:bounds[i+1]]``."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cuts batches so that each part has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        array = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
        data = np.frombuffer(array.buffers()[2] or b"", np.uint8)
        low = 0
        while low < len(array):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
            high = min(high, len(array))
            yield batch.slice(low, high - low), Texts(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            low = high


def record_batch(**columns: np.ndarray | pa.Array | list) -> pa.RecordBatch:
    arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
