"""LM scoring: a causal self-attention model over subword ids, trained in numpy by Spark tasks.

A text (A-Z in lower case) is its words and one end. Its *units* are what the model sees: a word of at most ``PIECE``
bytes, a longer word's subwords of ``PIECE`` bytes, and the end. The ``CLUSTERS * MEMBERS`` most frequent units of the
training documents have ids of their own, in clusters; any other belongs to one of ``SUFFIXES`` classes of words or ``PIECES``
classes of subwords, by its last two bytes, and has the id of that class. The model is

    P(text) = product over units of P(cluster or class | ids before) * P(unit | its cluster, ids before)  or  P(unit | its class)

The first factor and, for units with ids, the second come from one layer of masked self-attention over windows of
``WINDOW`` units. A window begins ``STRIDE`` units after the one before; what it shares with that one is context only, so
each unit is scored once. Within a class every unit has its share of the training count. Units never seen share as
much as those seen once have, and are spelled byte by byte, each by the three before it (backing off to fewer).

From the corpus come, over all training documents: the counts of all words and subwords, every one of which the scores
use; how words are spelled; and the weights. Every task takes its training documents through Adam, with windows that tile
each of them whole, so that every unit is a target once, in a seeded order; the tasks' weights are averaged, weighted by
their number of windows. The first weights give every unit its frequency.

Texts are staged in chunks of ``CHUNK`` bytes or one text. A chunk's distinct units are staged as well, one row each with
what the chunk adds to its count. A join gives every chunk the whole counts of its units, which meet its texts; so the rows
grow with the input and nothing else.

The base score is that of the words' counts alone. A null text is empty: its only token is the end. A null id counts as
empty text for the hold-out. Repeated rows are scored each on its own. With no training documents all counts are 0.
Columns other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.staging import stage
from cairn.llm.texts import _ODD, LOWER, Spans, Texts, chunks, mix, remainder, sums, utf8

PIECE = 16
CLUSTERS, MEMBERS = 32, 64
SUFFIXES, PIECES = 32, 8
LISTED = CLUSTERS * MEMBERS
OUTCOMES = CLUSTERS + SUFFIXES + PIECES
BEGIN = LISTED + SUFFIXES + PIECES
WINDOW, STRIDE, WIDTH = 32, 24, 16
BATCH = 256
CHUNK = 32 << 20
#: Sequences of four bytes that the spelling keeps.
SPELLED = 1 << 18
_U = np.uint64
#: Kinds of keys, in their last two bits.
QUAD, LONG_WORD, SUBWORD, WORD = 0, 1, 2, 3
END = np.int64(WORD)


# ---- texts to units ------------------------------------------------------------------------------------------------


def _suffix(spans: Spans) -> np.ndarray:
    data, end = spans.texts.data, spans.start + spans.length
    last = data[end - 1].astype(_U)
    last += np.where(spans.length > 1, data[end - 2], 0).astype(_U) << _U(8)
    return mix(last + _U(1)) >> _U(59)


def _keys(hashes: np.ndarray, spans: Spans, kinds: np.ndarray | int) -> np.ndarray:
    """57 bits of the hash, the class by suffix, and the kind."""
    return (hashes << _U(7) | _suffix(spans) << _U(2) | np.asarray(kinds, _U)).view(np.int64)


@dataclass
class Units:
    """``tokens`` are keys of words and ends, ``keys`` those of the units; both have bounds by text. ``spans`` are the units
    without the ends, and ``last`` says which of them end their word. ``head`` has the place of each token's first unit."""

    tokens: np.ndarray
    token_bounds: np.ndarray
    keys: np.ndarray
    bounds: np.ndarray
    spans: Spans
    last: np.ndarray
    head: np.ndarray


def units(texts: Texts) -> Units:
    words = texts.lower().words()
    long = words.length > PIECE
    tokens = _keys(words.hashes(), words, np.where(long, LONG_WORD, WORD))
    many = -(-words.length // PIECE)
    of = np.repeat(np.arange(len(words)), many)
    step = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    last = step == many[of] - 1
    first = np.concatenate([[0], np.cumsum(many)])[words.first]
    spans = Spans(words.texts, words.start[of] + PIECE * step, np.minimum(words.length[of] - PIECE * step, PIECE), first)
    keys = tokens[of]
    cut = np.flatnonzero(long[of])
    if len(cut):
        pieces = Spans(words.texts, spans.start[cut], spans.length[cut], np.array([0, len(cut)]))
        keys[cut] = _keys(mix(pieces.hashes() + _ODD[50] * (last[cut].astype(_U) + _U(1))), pieces, SUBWORD)
    ends = np.arange(len(words.first))
    wide = np.insert(many, words.first[1:], 1)
    return Units(
        np.insert(tokens, words.first[1:], END), words.first + ends, np.insert(keys, first[1:], END), first + ends, spans, last, np.cumsum(wide) - wide
    )


def class_of(keys: np.ndarray) -> np.ndarray:
    """Class of a unit without an id, from 0."""
    suffix = (keys >> 2) & 31
    return np.where((keys & 3) == SUBWORD, SUFFIXES + suffix % PIECES, suffix)


def quads(spans: Spans, chosen: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each byte of the chosen spans with the three before it, a blank before the first and, where it is the
    last of its word, one after it; and their bounds by span."""
    start, size, closed = spans.start[chosen], spans.length[chosen], last[chosen].astype(np.int64)
    # each span with two zeros and a blank in front, and room for a blank behind
    wide = size + closed + 3
    first = np.cumsum(wide) - wide
    row = np.zeros(int(wide.sum()) + 3, np.uint32)
    row[first + 2] = 0x20
    row[(first + 3 + size)[closed > 0]] = 0x20
    inside = np.cumsum(size) - size
    step = np.arange(int(size.sum()))
    row[step + np.repeat(first + 3 - inside, size)] = spans.texts.data[step + np.repeat(start - inside, size)]
    code = row[:-3] << np.uint32(24) | row[1:-2] << np.uint32(16) | row[2:-1] << np.uint32(8) | row[3:]
    length = size + closed
    bounds = np.concatenate([[0], np.cumsum(length)])
    return code[np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], length)].astype(np.int64), bounds


def totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def found_in(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys there are, and their places."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[place] == keys, place


# ---- what the corpus tells -----------------------------------------------------------------------------------------


def unit_rows(staged: DataFrame) -> DataFrame:
    """``chunk``, ``key``, ``n``: every distinct word, subword and end of each chunk of texts, and how often its training documents
    have it, perhaps never. Chunk -1 has byte quads: how often they spell the words of two megabytes of training text."""

    def run(batches):
        chunk, held, spelled = None, [], []

        def rows(number, parts):
            keys, n = totals(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), number, np.int64)), pa.array(keys), pa.array(n)], names=["chunk", "key", "n"])

        # a chunk's rows come one after the other, as they were staged; if they come in parts, each part is rows of its own
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            bounds = np.append(np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])), len(numbers)) if len(numbers) else []
            for low, high in zip(bounds, bounds[1:], strict=False):
                if held and chunk != numbers[low]:
                    yield rows(chunk, held)
                    held = []
                chunk = int(numbers[low])
                for part, texts in chunks([batch.slice(low, high - low)]):
                    cut, learned = units(texts), ~part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                    # short words and ends are tokens and units at once
                    long = np.flatnonzero((cut.tokens & 3) == LONG_WORD)
                    of_unit = np.repeat(learned, np.diff(cut.bounds))
                    of_token = np.repeat(learned, np.diff(cut.token_bounds))[long]
                    held.append(totals(np.concatenate([cut.keys, cut.tokens[long]]), np.concatenate([of_unit, of_token]).astype(np.int64)))
                    spoken = cut.keys != END
                    _, at = np.unique(np.where(of_unit, cut.keys, END)[spoken], return_index=True)
                    at = at[of_unit[spoken][at]]
                    codes, _ = quads(cut.spans, at, cut.last)
                    spelled.append(totals(codes << 2, np.ones(len(codes), np.int64)))
            if sum(len(x) for x, _ in spelled) > 2_000_000:
                yield rows(-1, spelled)
                spelled = []
        if held:
            yield rows(chunk, held)
        if spelled:
            yield rows(-1, spelled)

    return stage(staged.select("chunk", "held_out", "text").mapInArrow(run, "chunk long, key long, n long"), "units")


def count_units(rows: DataFrame) -> DataFrame:
    """``key``, ``n``: training counts of all words, ends, subwords and byte quads."""
    return stage(rows.where("n > 0").groupBy("key").agg(F.sum("n").alias("n")), "unit-counts")


class Spelling:
    """Chance of a byte after three others, by the kept quads, backing off to fewer of those; sums to one over the bytes."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.tables = []
        for known in (1, 2, 3):
            mask = (1 << 8 * (known + 1)) - 1
            grams, grams_n = totals(codes & mask, n)
            contexts, contexts_n = totals(grams >> 8, grams_n)
            self.tables.append((grams, grams_n, contexts, contexts_n))

    def logs(self, codes: np.ndarray) -> np.ndarray:
        chance = np.full(len(codes), 1 / 256)
        for known, (grams, grams_n, contexts, contexts_n) in zip((1, 2, 3), self.tables, strict=True):
            seen, place = found_in(grams, codes & ((1 << 8 * (known + 1)) - 1))
            listed, where = found_in(contexts, (codes >> 8) & ((1 << 8 * known) - 1))
            count = np.where(seen, grams_n[place], 0) if len(grams) else np.zeros(len(codes))
            total = np.where(listed, contexts_n[where], 0) if len(contexts) else np.zeros(len(codes))
            chance = (count + 2 * chance) / (total + 2)
        return np.log(chance)


@dataclass
class Vocabulary:
    """Units with ids, sorted by key, their ids and counts; and the numbers of every class over all its counted units."""

    keys: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    total: int
    kinds: int
    whole: np.ndarray
    unseen: np.ndarray
    outcome_prior: np.ndarray
    member_prior: np.ndarray
    spelling: Spelling

    def identify(self, keys: np.ndarray) -> np.ndarray:
        listed, place = found_in(self.keys, keys)
        return np.where(listed, self.ids[place], LISTED + class_of(keys)) if len(self.keys) else LISTED + class_of(keys)


def at_most(counts: DataFrame, size: int) -> DataFrame:
    """The rows with the largest ``n``, at most ``size`` of them: all with n from a level on."""
    level = F.floor(F.log2("n") * 8).cast("int")
    room, least = size, None
    for number, many in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        room -= many
        if room < 0:
            break
        least = number
    return counts.where(level >= least) if least is not None else counts.limit(0)


def vocabulary(counts: DataFrame, listed: int = LISTED, spelled: int = SPELLED) -> Vocabulary:
    """The driver gets the units with ids, 128 sums, and at most ``spelled`` quads."""
    kind: Column = F.col("key").bitwiseAND(3)
    total, kinds = counts.where(kind.isin(LONG_WORD, WORD)).agg(F.sum("n"), F.count(F.lit(1))).first()
    end = counts.where(F.col("key") == int(END)).agg(F.sum("n")).first()[0] or 0
    seen = counts.where(kind.isin(SUBWORD, WORD) & (F.col("key") != int(END)))
    ranked = [(row["key"], row["n"]) for row in seen.orderBy(F.desc("n"), "key").limit(listed - 1).collect()]
    ranked = sorted([(int(END), int(end)), *ranked], key=lambda x: (-x[1], x[0]))
    known, once = np.zeros(SUFFIXES + PIECES), np.zeros(SUFFIXES + PIECES)
    low = F.col("key").bitwiseAND(127)
    for row in seen.groupBy(low.alias("low")).agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once")).collect():
        at = int(class_of(np.array([row["low"]]))[0])
        known[at] += row["n"]
        once[at] += row["once"]
    for key, n in ranked:
        if key != END:
            at = int(class_of(np.array([key]))[0])
            known[at] -= n
            once[at] -= n == 1
    members = np.full(LISTED, 1e-3)
    members[: len(ranked)] += [n for _, n in ranked]
    members = members.reshape(CLUSTERS, MEMBERS)
    outcomes = np.concatenate([members.sum(1), known + once + 1e-3])
    whole = np.log(known + once + 1)
    keys = np.array([key for key, _ in ranked], np.int64)
    order = np.argsort(keys)
    quad = at_most(counts.where(kind == QUAD), spelled).toPandas()
    spelling = Spelling(quad["key"].to_numpy(np.int64) >> 2, quad["n"].to_numpy(np.int64))
    return Vocabulary(
        keys[order], order, np.array([n for _, n in ranked], np.int64)[order], int(total or 0), int(kinds), whole, np.log(once + 1) - whole,
        np.log(outcomes / outcomes.sum()), np.log(members / members.sum(1, keepdims=True)), spelling,
    )


# ---- the attention model -------------------------------------------------------------------------------------------

SHAPES = {
    "embed": (BEGIN + 1, WIDTH), "place": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH),
    "out": (WIDTH, OUTCOMES), "inner": (CLUSTERS, WIDTH, MEMBERS), "inner_bias": (CLUSTERS, MEMBERS), "bias": (OUTCOMES,),
}
MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)


def initial(outcome_prior: np.ndarray, member_prior: np.ndarray, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    spread = {"embed": 0.5, "place": 0.02, "out": 0.02, "inner": 0.02}
    parts = {name: rng.normal(0, spread.get(name, WIDTH**-0.5), shape) for name, shape in SHAPES.items()}
    parts |= {"inner_bias": member_prior, "bias": outcome_prior}
    return np.concatenate([x.ravel() for x in parts.values()]).astype(np.float32)


def split(weights: np.ndarray) -> dict[str, np.ndarray]:
    ends = np.cumsum([int(np.prod(shape)) for shape in SHAPES.values()])
    return {name: x.reshape(shape) for (name, shape), x in zip(SHAPES.items(), np.split(weights, ends[:-1]), strict=True)}


def attend(w: dict[str, np.ndarray], before: np.ndarray) -> tuple[np.ndarray, ...]:
    """Masked self-attention over a batch of windows of the ids before each unit."""
    x = w["embed"][before] + w["place"]
    flat = x.reshape(-1, WIDTH)
    q, k, v = ((flat @ w[name]).reshape(x.shape) for name in "qkv")
    a = np.matmul(q, k.transpose(0, 2, 1))
    a *= np.float32(WIDTH**-0.5)
    a += MASK
    a -= a.max(2, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(2, keepdims=True)
    return x + np.matmul(a, v), x, q, k, v, a


def softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= 1 / logits.sum(1, keepdims=True)
    return logits


def log_picked(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log of the softmax at one place of each row."""
    logits -= logits.max(1, keepdims=True)
    picked = logits[np.arange(len(at)), at]
    np.exp(logits, out=logits)
    return picked - np.log(logits.sum(1))


def outcome_of(ids: np.ndarray) -> np.ndarray:
    return np.where(ids < LISTED, ids // MEMBERS, ids - LISTED + CLUSTERS)


def by_cluster(ids: np.ndarray):
    """For each cluster that occurs: its number, where it does, and the members there."""
    listed = np.flatnonzero(ids < LISTED)
    cluster = ids[listed] // MEMBERS
    order = np.argsort(cluster, kind="stable")
    bounds = np.searchsorted(cluster[order], np.arange(CLUSTERS + 1))
    for number in np.flatnonzero(np.diff(bounds)).tolist():
        at = listed[order[bounds[number] : bounds[number + 1]]]
        yield number, at, ids[at] % MEMBERS


def log_chances(w: dict[str, np.ndarray], h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log probability of cluster and member, or of the class, of each target, given its state."""
    out = log_picked(h @ w["out"] + w["bias"], outcome_of(ids))
    for number, at, member in by_cluster(ids):
        out[at] += log_picked(h[at] @ w["inner"][number] + w["inner_bias"][number], member)
    return out


def gradient(w: dict[str, np.ndarray], before: np.ndarray, target: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Of the mean negative log probability of the real targets."""
    h, x, q, k, v, a = attend(w, before)
    kept = np.flatnonzero(real.ravel())
    flat, ids = h.reshape(-1, WIDTH)[kept], target.ravel()[kept]
    scale = np.float32(1 / max(1, len(kept)))
    g = softmax(flat @ w["out"] + w["bias"])
    g[np.arange(len(ids)), outcome_of(ids)] -= 1
    g *= scale
    out = {"out": flat.T @ g, "bias": g.sum(0), "inner": np.zeros_like(w["inner"]), "inner_bias": np.zeros_like(w["inner_bias"])}
    back = g @ w["out"].T
    for number, at, member in by_cluster(ids):
        state = flat[at]
        g = softmax(state @ w["inner"][number] + w["inner_bias"][number])
        g[np.arange(len(at)), member] -= 1
        g *= scale
        out["inner"][number] = state.T @ g
        out["inner_bias"][number] = g.sum(0)
        back[at] += g @ w["inner"][number].T
    dh = np.zeros((h.size // WIDTH, WIDTH), h.dtype)
    dh[kept] = back
    dh = dh.reshape(h.shape)
    da = np.matmul(dh, v.transpose(0, 2, 1))
    dv = np.matmul(a.transpose(0, 2, 1), dh)
    da -= (da * a).sum(2, keepdims=True)
    da *= a
    da *= np.float32(WIDTH**-0.5)
    dq, dk = np.matmul(da, k), np.matmul(da.transpose(0, 2, 1), q)
    dx, xs = dh.copy(), x.reshape(-1, WIDTH)
    for name, d in (("q", dq), ("k", dk), ("v", dv)):
        d = d.reshape(-1, WIDTH)
        out[name] = xs.T @ d
        dx += (d @ w[name].T).reshape(x.shape)
    out["place"] = dx.sum(0)
    ids, rows = before.ravel(), dx.reshape(-1, WIDTH)
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1]))
    out["embed"] = np.zeros_like(w["embed"])
    out["embed"][ids[order[first]]] = np.add.reduceat(rows[order], first, axis=0)
    return np.concatenate([out[name].ravel() for name in SHAPES])


def windows(ids: np.ndarray, low: np.ndarray, start: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids before and at each place of windows from ``start``, and which places are of the text ``low:high``."""
    at = start[:, None] + np.arange(WINDOW)
    real = at < high[:, None]
    target = ids[np.minimum(at, high[:, None] - 1)]
    before = np.where(at > low[:, None], ids[np.clip(at - 1, 0, high[:, None] - 1)], BEGIN)
    return before, target, real


def tiles(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows that have every unit once: where their texts begin, where they do, where their texts end."""
    many = -(-np.diff(bounds) // WINDOW)
    of = np.repeat(np.arange(len(many)), many)
    step = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    return bounds[of], bounds[of] + WINDOW * step, bounds[of + 1]


def train(training: DataFrame, words: Vocabulary, rate: float = 0.01) -> np.ndarray:
    """Weights after every unit of the training documents was a target once; one row a task and weight goes to the average."""
    start = initial(words.outcome_prior, words.member_prior)
    shared = training.sparkSession.sparkContext.broadcast((words.identify, start))

    def run(batches):
        identify, weights = shared.value
        weights = weights.copy()
        first, second, step, taken = np.zeros_like(weights), np.zeros_like(weights), 0, 0
        for _, texts in chunks(batches):
            cut = units(texts)
            ids = identify(cut.keys)
            low, begin, high = tiles(cut.bounds)
            order = np.random.default_rng([len(ids), int(cut.tokens[0] & 0xFFFFFFFF)]).permutation(len(begin))
            # little text still makes a few dozen steps
            many = max(16, min(BATCH, len(order) // 60))
            for at in range(0, len(order), many):
                part = order[at : at + many]
                g = gradient(split(weights), *windows(ids, low[part], begin[part], high[part]))
                step += 1
                first += 0.1 * (g - first)
                g *= g
                g -= second
                second += 0.01 * g
                weights -= np.float32(rate / (1 - 0.9**step)) * first / (np.sqrt(second) * np.float32((1 - 0.99**step) ** -0.5) + np.float32(1e-6))
            taken += len(order)
        if taken:
            yield pa.RecordBatch.from_arrays([pa.array([taken]), pa.array([weights.astype(float)], pa.list_(pa.float64()))], names=["n", "weights"])

    parts = training.select("text").mapInArrow(run, "n long, weights array<double>")
    flat = parts.select("n", F.posexplode("weights").alias("at", "w")).groupBy("at").agg((F.sum(F.col("n") * F.col("w")) / F.sum("n")).alias("w"))
    found = flat.toPandas()
    weights = start.copy()
    weights[found["at"].to_numpy()] = found["w"].to_numpy()
    return weights


def score_windows(weights: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log probability of every id's cluster and member, or class, given those before it in its window."""
    w = split(weights)
    out = np.zeros(len(ids), np.float32)
    size = np.diff(bounds)
    many = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    of = np.repeat(np.arange(len(size)), many)
    step = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    start, low, high = bounds[of] + STRIDE * step, bounds[of], bounds[of + 1]
    places = np.arange(WINDOW)
    for at in range(0, len(of), BATCH):
        part = slice(at, at + BATCH)
        before, target, real = windows(ids, low[part], start[part], high[part])
        fresh = real & ((places >= WINDOW - STRIDE) | (step[part] == 0)[:, None])
        out[(start[part][:, None] + places)[fresh]] = log_chances(w, attend(w, before)[0][fresh], target[fresh])
    return out


# ---- scores --------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    words: Vocabulary
    weights: np.ndarray
    counts: DataFrame
    rows: DataFrame


def staged_texts(documents: DataFrame) -> DataFrame:
    """``chunk``, ``doc_id``, ``held_out``, ``text``: the texts as bytes, dealt in chunks of ``CHUNK`` bytes or one text."""

    def deal(batches):
        number, size = TaskContext.get().partitionId() << 32, 0
        for batch, texts in chunks(batches, limit=CHUNK):
            lengths = np.diff(texts.offsets)
            chunk = np.empty(len(lengths), np.int64)
            for row, length in enumerate(lengths.tolist()):
                if size and size + length > CHUNK:
                    number, size = number + 1, 0
                chunk[row] = number
                size += length + 64
            yield pa.RecordBatch.from_arrays([pa.array(chunk), *batch.columns], names=["chunk", "doc_id", "held_out", "text"])

    rows = documents.select(F.col("doc_id").cast("long"), (remainder("doc_id", 10) == 0).alias("held_out"), utf8())
    return stage(rows.mapInArrow(deal, "chunk long, doc_id long, held_out boolean, text binary"), "texts")


def fit(staged: DataFrame) -> Model:
    rows = unit_rows(staged)
    counts = count_units(rows)
    words = vocabulary(counts)
    return Model(words, train(staged.where("not held_out"), words), counts, rows)


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def score_texts(texts: Texts, words: Vocabulary, weights: np.ndarray, keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens, known tokens, sum of log10(count + 0.1) and natural log probability of each text; ``keys`` are the counted ones,
    sorted, and ``n`` their counts."""
    cut = units(texts)

    def counted(wanted: np.ndarray) -> np.ndarray:
        listed, place = found_in(words.keys, wanted)
        there, where = found_in(keys, wanted)
        out = np.where(there, n[where], 0) if len(n) else np.zeros(len(wanted), np.int64)
        return np.where(listed, words.counts[place], out) if len(words.keys) else out

    ids, of_units = words.identify(cut.keys), counted(cut.keys)
    # a token of one unit is that unit
    tokens, long = of_units[cut.head], np.flatnonzero((cut.tokens & 3) == LONG_WORD)
    tokens[long] = counted(cut.tokens[long])
    chance = score_windows(weights, ids, cut.bounds).astype(float)
    other = np.flatnonzero(ids >= LISTED)
    share, kind = of_units[other], ids[other] - LISTED
    chance[other] += np.where(share > 0, np.log(np.maximum(share, 1)) - words.whole[kind], words.unseen[kind])
    new = other[share == 0]
    if len(new):
        place = (np.cumsum(cut.keys != END) - 1)[new]
        codes, bounds = quads(cut.spans, place, cut.last)
        chance[new] += sums(words.spelling.logs(codes), bounds)
    logs = np.log10(tokens + 0.1)
    return np.diff(cut.token_bounds), sums(tokens > 0, cut.token_bounds), sums(logs, cut.token_bounds), sums(chance, cut.bounds)


def score_staged(staged: DataFrame, model: Model) -> DataFrame:
    """Scores of the texts that the model was fitted with, in training or held out."""
    spark = staged.sparkSession
    shared = spark.sparkContext.broadcast((model.words, model.weights))
    told = model.rows.where("chunk >= 0").select("chunk", "key").join(model.counts, "key")

    def run(texts, counts):
        words, weights = shared.value
        keys, n = counts.column("key").to_numpy(), counts.column("n").to_numpy()
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        out = []
        for batch, part in chunks(texts.to_batches()):
            columns = score_texts(part, words, weights, keys, n)
            out.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *map(pa.array, columns)], names=[field.split()[0] for field in SCHEMA.split(", ")]))
        return pa.Table.from_batches(out)

    return staged.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, SCHEMA)


def score_documents(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    staged = staged_texts(documents)
    model = fit(staged)
    total, kinds = model.words.total, model.words.kinds
    whole = float(np.log10(total + 0.1 * (kinds + 1)))
    return score_staged(staged, model).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * whole).alias("base_score"), (F.col("score") / float(np.log(10))).alias("score"),
    )
