"""Byte-level BPE by forced boundaries, for a vocabulary file of the tokenizers library.

A pair of neighbouring bytes that no vocabulary token has inside is a certain cut: no merge can ever
join what stands on its two sides. Each word of the file's own splitting rule is cut at such pairs;
the fragments are encoded independently, by merging the best-ranked pair until none is left, and
their ids are concatenated. A word's ids are kept for the next time it occurs, for at most ``CACHE``
words a task.

Special tokens of the file are cut out of a text first, as the library does. Null and empty texts
have no ids and decode to an empty text. Decoding replaces bytes that are no UTF-8.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 300_000
#: Fixed: the splitting rule of byte-level vocabularies.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed: letters and numbers that Unicode has since version 17. The library's splitting rule is of
#: version 16 and takes them for signs; the regex module knows them.
SINCE_17 = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE),
    (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
NEW = frozenset(chr(c) for low, high in SINCE_17 for c in range(low, high + 1))
MASK = dict.fromkeys(map(ord, NEW), "\ue000")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: itself if printable, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Words(dict):
    """Ids of words, as little-endian 32-bit integers; a missing word is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        self[word] = ids = array("I", self.encode(word.encode())).tobytes()
        return ids


class BytePairs:
    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]):
        letters = byte_letters()
        raw = {token: bytes(letters[c] for c in token) for token in vocabulary if all(c in letters for c in token)}
        self.text = {vocabulary[token]: word for token, word in raw.items()} | {i: s.encode() for s, i in special.items()}
        self.letter = [0] * 256
        for token, word in raw.items():
            if len(word) == 1:
                self.letter[word[0]] = vocabulary[token]
        self.merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(merges)}
        self.inside = np.zeros(65536, bool)
        for word in raw.values():
            for pair in zip(word, word[1:], strict=False):
                self.inside[pair[0] << 8 | pair[1]] = True
        self.joined = self.inside.tobytes()
        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.word = regex.compile(WORD)
        self.words = Words(self.encode_word)

    def fragments(self, word: bytes) -> list[bytes]:
        """The parts of a word between its certain cuts."""
        joined = self.joined
        cuts = [i for i in range(1, len(word)) if not joined[word[i - 1] << 8 | word[i]]]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def encode_word(self, word: bytes) -> list[int]:
        return [i for fragment in self.fragments(word) for i in self.merge(fragment)]

    def merge(self, fragment: bytes) -> list[int]:
        """Merges the pair of the lowest rank, the leftmost of equals, until no pair is known."""
        ids = [self.letter[b] for b in fragment]
        known, n = self.merges, len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(known[pair][0], i, pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if pair in known]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = known[pair][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if new := known.get((ids[i], ids[k])):
                    heapq.heappush(heap, (new[0], i, (ids[i], ids[k])))
            if (h := before[i]) >= 0 and (new := known.get((ids[h], ids[i]))):
                heapq.heappush(heap, (new[0], h, (ids[h], ids[i])))
        return [i for i in ids if i >= 0]

    def split(self, text: str) -> list[str]:
        """The words of a text by the library's rule."""
        if text.isascii() or NEW.isdisjoint(text):
            return self.word.findall(text)
        return [text[slice(*match.span())] for match in self.word.finditer(text.translate(MASK))]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as little-endian 32-bit integers."""
        get = self.words.__getitem__
        if self.cut is None or not self.cut.search(text):
            return b"".join(map(get, self.split(text)))
        parts, at = [], 0
        for match in self.cut.finditer(text):
            parts += map(get, self.split(text[at : match.start()]))
            parts.append(array("I", [self.special[match.group()]]).tobytes())
            at = match.end()
        return b"".join([*parts, *map(get, self.split(text[at:]))])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.text.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def from_json(content: str) -> BytePairs:
    """One encoder for a Python worker, kept for its next tasks."""
    file = json.loads(content)
    model, before = file["model"], file["pre_tokenizer"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if file["normalizer"] is not None or {k: before.get(k) for k in plain} != plain or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError("only plain byte-level BPE files are understood")
    pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in file["added_tokens"]):
        raise ValueError("special tokens must stand for their own text alone")
    return BytePairs(model["vocab"], pairs, {x["content"]: x["id"] for x in file["added_tokens"]})


def encode_documents(documents: DataFrame, vocabulary: str, keep: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and digests of ids and decoded text; with ``keep`` also ``ids`` and ``decoded``.

    ``vocabulary`` is the path of the file on the driver; its content (a few MB) is sent to the tasks.
    """
    with open(vocabulary, encoding="utf-8") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * keep]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep

    def run(batches):
        pairs = from_json(shared.value)
        for whole in batches:
            for low in range(0, whole.num_rows, 500):
                batch = whole.slice(low, 500)
                ids = [pairs.encode(text or "") for text in batch.column(1).to_pylist()]
                decoded = [pairs.decode(x) for x in ids]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                arrays = [
                    batch.column(0), pa.array(sizes), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
                ]
                if keep:
                    flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                    arrays += [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), flat), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
