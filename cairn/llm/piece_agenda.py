"""SentencePiece BPE by a score-ordered agenda, for a model file whose pieces are merge-type.

A text is normalised as the model says (here: a space in front, every space as the mark U+2581), and
taken apart into characters. The agenda of a fragment holds its adjacent symbol pairs that join to a piece,
best score first, the leftmost of equals; the best pair is joined and its two new neighbours enter, until the
agenda is empty. Characters left that are no piece become their bytes.

No piece has a mark behind another character (or it is refused, and a text is one fragment), so a text falls into
fragments before its marks, and at characters that no piece holds, which no join can cross. All short
fragments that a batch brings anew run their agendas side by side, one join a step for each, as rows of
numpy arrays; a long one has a heap of its own. What a short fragment gave is kept for at most ``CACHE`` of them.

Every Arrow batch is checked against the sentencepiece library: ``agrees`` says whether ids and decoded text are
its own. Null and empty texts have no ids and decode to an empty text.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
SHORT = 24
CACHE = 400_000
#: Texts that are worked on at once: this many, or this many characters.
ROWS, CHARACTERS = 2000, 4 << 20
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.int32(2**31 - 1)


def _byte_by_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


class PieceAgenda:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        trainer, normal = proto.trainer_spec, proto.normalizer_spec
        kinds = {piece.type for piece in proto.pieces}
        if trainer.model_type != trainer.BPE or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or trainer.treat_whitespace_as_suffix:
            raise ValueError("only merge-type models of normal, byte and control pieces are understood")
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces or not trainer.byte_fallback:
            raise ValueError("only models that keep every character and fall back to bytes are understood")
        self.dummy = normal.add_dummy_prefix
        self.pieces = {piece.piece: (i, piece.score) for i, piece in enumerate(proto.pieces) if piece.type == NORMAL}
        self.bytes = {int(piece.piece[3:5], 16): i for i, piece in enumerate(proto.pieces) if piece.type == BYTE}
        spoken = {i: piece.replace(MARK, " ").encode() for piece, (i, _) in self.pieces.items()} | {i: bytes([b]) for b, i in self.bytes.items()}
        spoken |= {i: trainer.unk_surface.encode() for i, piece in enumerate(proto.pieces) if piece.type == UNKNOWN}
        self.spoken = [spoken.get(i, b"") for i in range(len(proto.pieces))]
        self.spaced = {i for piece, (i, _) in self.pieces.items() if piece.startswith(MARK)}
        self.written = list(map(str, range(len(proto.pieces))))
        self._number()
        cut = not any(MARK in piece.lstrip(MARK) for piece in self.pieces)
        alone = "".join(c for c in "\n\t\r" if not any(c in piece for piece in self.pieces))
        whole = f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else "")
        self.split = re.compile(whole if cut else r"(?s).+").findall
        self.ids: dict[str, bytes] = {}
        codecs.register_error("cairn-byte-by-byte", _byte_by_byte)

    def _number(self) -> None:
        """Numbers for all symbols: pieces and the single characters of pieces. Pairs of symbols that join to a piece."""
        names = list(self.pieces)
        names += sorted({c for piece in names for c in piece} - set(names))
        self.symbol = {name: k for k, name in enumerate(names)}
        self.names = names
        # of equal scores all have the same rank, so the leftmost is first
        scores = sorted({score for _, score in self.pieces.values()}, reverse=True)
        place = {score: k for k, score in enumerate(scores)}
        left, right, joined, rank = [], [], [], []
        for piece, (_, score) in self.pieces.items():
            for at in range(1, len(piece)):
                a, b = self.symbol.get(piece[:at]), self.symbol.get(piece[at:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    joined.append(self.symbol[piece])
                    rank.append(place[score])
        keys = np.array(left, np.int64) * len(names) + np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.joined, self.rank = np.array(joined, np.int32)[order], np.array(rank, np.int32)[order]
        # a character that no piece holds is the symbol below zero of its code point
        self.letters = -1 - np.arange(0x110000, dtype=np.int32)
        for name, k in self.symbol.items():
            if len(name) == 1:
                self.letters[ord(name)] = k
        self.id = np.array([self.pieces[name][0] if name in self.pieces else -1 for name in names], np.int32)
        self.pairs = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.joined.tolist(), strict=True), strict=True))

    def ids_of(self, symbols: list[int]) -> bytes:
        """Ids, of 32 bits each: of a piece its own, of another character those of its bytes."""
        out: list[int] = []
        for k in symbols:
            if k >= 0 and (known := int(self.id[k])) >= 0:
                out.append(known)
            else:
                out += [self.bytes[b] for b in (self.names[k] if k >= 0 else chr(-1 - k)).encode()]
        return array("i", out).tobytes()

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` where they do not join) and joined symbol of pairs; a negative symbol joins nothing."""
        if not len(self.keys):
            return np.full(left.shape, NONE), np.zeros(left.shape, np.int32)
        keys = left.astype(np.int64) * len(self.names) + right
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[place] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.rank[place], NONE), self.joined[place]

    def agendas(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Runs the agendas of fragments of one length, a row each; gives row numbers and symbols of those that end."""
        rows = np.arange(len(symbols))
        rank, joined = self.look_up(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            if symbols.shape[1] == 1:
                yield rows, symbols
                return
            at = rank.argmin(1)
            each = np.arange(len(rows))
            best = rank[each, at]
            if (done := best == NONE).any():
                yield rows[done], symbols[done]
                on = ~done
                rows, symbols, rank, joined, at = rows[on], symbols[on], rank[on], joined[on], at[on]
                each = np.arange(len(rows))
            if not len(rows):
                return
            new = joined[each, at]
            places = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, places + (places > at[:, None]), 1)
            symbols[each, at] = new
            if symbols.shape[1] == 1:
                continue
            places = places[:-1]
            kept = places + (places >= at[:, None])
            rank, joined = np.take_along_axis(rank, kept, 1), np.take_along_axis(joined, kept, 1)
            for side in (-1, 0):
                near = at + side
                has = (near >= 0) & (near < rank.shape[1])
                r, n = each[has], near[has]
                rank[r, n], joined[r, n] = self.look_up(symbols[r, n], symbols[r, n + 1])

    def agenda(self, symbols: list[int]) -> list[int]:
        """The symbols that are left of one fragment of any length, by a heap."""
        n, many = len(symbols), len(self.names)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int]] = []

        def enter(i: int, j: int) -> None:
            if symbols[i] >= 0 and symbols[j] >= 0 and (found := self.pairs.get(symbols[i] * many + symbols[j])):
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j]))

        for i in range(n - 1):
            enter(i, i + 1)
        gone = bytearray(n)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i] = self.pairs[left * many + right][1]
            gone[j] = 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                enter(i, k)
            if before[i] >= 0:
                enter(before[i], i)
        return [k for k, away in zip(symbols, gone, strict=True) if not away]

    def symbols_of(self, text: str) -> np.ndarray:
        return self.letters[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def learn(self, fragments: set[str]) -> dict[str, bytes]:
        """Encodes fragments that are not kept yet. Long ones are given back, not kept."""
        if len(self.ids) + len(fragments) > CACHE:
            self.ids.clear()
        by_length: dict[int, list[str]] = {}
        long: dict[str, bytes] = {}
        for fragment in fragments.difference(self.ids):
            if len(fragment) <= SHORT:
                by_length.setdefault(len(fragment), []).append(fragment)
            else:
                long[fragment] = self.ids_of(self.agenda(self.symbols_of(fragment).tolist()))
        for length, several in by_length.items():
            for rows, symbols in self.agendas(self.symbols_of("".join(several)).reshape(-1, length)):
                ids = np.where(symbols >= 0, self.id[np.maximum(symbols, 0)], -1)
                width = 4 * ids.shape[1]
                odd = np.flatnonzero((ids < 0).any(1)).tolist()
                blob = ids.tobytes()
                self.ids.update([(several[row], blob[k * width : (k + 1) * width]) for k, row in enumerate(rows.tolist())])
                self.ids.update([(several[rows[k]], self.ids_of(symbols[k].tolist())) for k in odd])
        return long

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, of 32 bits each."""
        front = MARK if self.dummy else ""
        parts = [self.split(front + text.replace(" ", MARK)) if text else [] for text in texts]
        long = self.learn(set().union(*parts))
        if not long:
            return [b"".join(map(self.ids.__getitem__, fragments)) for fragments in parts]
        return [b"".join([self.ids[f] if f in self.ids else long[f] for f in fragments]) for fragments in parts]

    def decode(self, ids: list[int]) -> str:
        text = b"".join([self.spoken[i] for i in ids]).decode("utf-8", "cairn-byte-by-byte")
        # the space that was put in front goes, if the first piece that says anything has it
        first = next((i for i in ids if self.spoken[i]), None)
        return text[1:] if self.dummy and first in self.spaced else text

    def write(self, ids: list[int]) -> bytes:
        """Decimal ids, joined by commas."""
        return ",".join([self.written[i] for i in ids]).encode()


@lru_cache(maxsize=2)
def from_model(model: bytes) -> tuple[PieceAgenda, object]:
    """One encoder and one library processor for a Python worker, kept for its next tasks."""
    import sentencepiece

    return PieceAgenda(model), sentencepiece.SentencePieceProcessor(model_proto=model)


def portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text or "")
        if size >= CHARACTERS or at - low + 1 >= ROWS:
            yield low, at + 1
            low, size = at + 1, 0
    if low < len(texts):
        yield low, len(texts)


def encode_documents(documents: DataFrame, model: str, keep: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, digests of ids and decoded text, ``agrees``; with ``keep`` also ``ids`` and ``decoded``.

    ``model`` is the path of the file on the driver; its content (half a MB) is sent to the tasks. Each row stands for
    itself, so repeated rows and ids, null ids and other columns change nothing; no rows give no rows.
    """
    with open(model, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees", *["ids", "decoded"] * keep]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean" + ", ids array<int>, decoded string" * keep

    def run(batches):
        agenda, library = from_model(shared.value)
        for whole in batches:
            texts = whole.column(1).to_pylist()
            for low, high in portions(texts):
                packed = agenda.encode(texts[low:high])
                theirs = library.encode([text or "" for text in texts[low:high]], num_threads=1)
                ids = [memoryview(x).cast("i").tolist() for x in packed]
                said = [agenda.decode(x) for x in ids]
                agrees = [x == array("i", other).tobytes() and text == library.decode(other) for x, text, other in zip(packed, said, theirs, strict=True)]
                arrays = [
                    whole.column(0).slice(low, high - low),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(agenda.write(x)).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for text in said], pa.string()),
                    pa.array(agrees, pa.bool_()),
                ]
                if keep:
                    arrays += [pa.array(ids, pa.list_(pa.int32())), pa.array(said, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
