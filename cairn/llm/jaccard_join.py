"""N-gram Jaccard join: documents whose sets of 5-word shingles have a similarity of 0.8 or more.

1. Texts with equal sets are one *class*, named by a 64-bit hash of the set. One pass over the texts
   gives each document its class, and counts shingles by slots of their hash (a table of ``SLOTS``).
2. Shingles are ordered by the count of their slot, then by hash. Two linked sets share one of the
   first ``n - ceil(0.8 n) + 1`` shingles of each. Classes with such a shingle in common are a *tile*.
   Shingles without two classes of like size are dropped in the tasks that gather them. Shingles of
   slots that hold far more than the mean would pile up there; they skip that step and are all kept.
3. Every class of a tile is compared with the tile's leaders, at most ``LEADERS`` of its classes (4 and
   5 say how), which joins most of a group of near copies with a few pairs for each member. Connected
   components of these links are contracted.
4. What is left are pairs of one tile, without its leaders, and of different components. Tiles with the
   same smallest class are laid together, since groups of copies share many tiles. They are cut by size
   bands (a set meets its own and the next band) and into blocks of at most ``BLOCK`` rows: members of
   the largest component are met by all others, not by each other. Bit counts of hashed bitmap
   signatures bound the overlap from above; pairs that stay go on.
5. Each pair left gets its two texts; overlaps are counted on the sorted arrays of shingle hashes.

No pair inside a component is formed in step 4 and no pair is dropped but by a bound, so the
components are exact (up to equal 64-bit hashes of different shingles or sets).

Null, empty and blank texts have no set and link with nothing. Texts of fewer than five words have
the whole sequence as their one shingle. Repeated rows are copies. A document with a null id can
link others; it counts as the largest id, and its component is null if all its members have none.
Columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.components import connect
from cairn.llm.staging import stage
from cairn.llm.texts import _ODD, Texts, chunks, mix, record_batch, sums, utf8

WORDS = 5
SLOTS = 1 << 15
#: A slot is crowded when it holds so many times the mean.
CROWDED = 8
#: Shingles of one gathering task, and rows of a block in step 4.
GATHER, BLOCK = 500_000, 1024
LEADERS = 8
#: Bits of the filter that keeps unwanted texts out of a shuffle.
FILTER = 1 << 23
LAST = 2**63 - 1
_U = np.uint64


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, end to end, and their bounds."""
    words = texts.lower().words()
    hashes = words.hashes()
    starts, shingles = words.windows(hashes, WORDS)
    bounds = np.searchsorted(starts, words.first)
    counts = words.counts
    sets = []
    for i in range(len(texts)):
        if counts[i] >= WORDS:
            sets.append(np.unique(shingles[bounds[i] : bounds[i + 1]]))
        elif counts[i]:
            own = hashes[words.first[i] : words.first[i + 1]]
            sets.append(mix((own * _ODD[20 : 20 + len(own)]).sum(keepdims=True) + _U(len(own))))
        else:
            sets.append(hashes[:0])
    return np.concatenate([hashes[:0], *sets]), np.cumsum([0, *map(len, sets)])


def class_names(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, _U), np.cumsum(mix(values ^ _ODD[40]))])
    return mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(_U)).view(np.int64)


def bitmaps(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """A bitmap of each set, as wide as the power of two that is at least four times its size (512 at least)."""
    out = []
    for i, n in enumerate(np.diff(bounds)):
        flags = np.zeros(max(512, 1 << int(4 * n - 1).bit_length()), np.uint8)
        flags[values[bounds[i] : bounds[i + 1]] & _U(len(flags) - 1)] = 1
        out.append(np.packbits(flags).tobytes())
    return out


def folded(maps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words; wider ones have their halves laid over each other."""
    rows = np.empty((len(maps), width // 8), np.uint8)
    for i, own in enumerate(maps):
        part = np.frombuffer(own, np.uint8)
        while len(part) > width // 8:
            part = part[: len(part) // 2] | part[len(part) // 2 :]
        rows[i] = part
    return rows.view(_U)


def similar(overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """100 * overlap >= 80 * union"""
    return 9 * overlap >= 4 * (a + b)


def bounded(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether bit counts leave the pairs of rows a chance: bits of one that the other lacks are not shared."""
    over = np.minimum(a - np.bitwise_count(left & ~right).sum(1, dtype=np.int64), b - np.bitwise_count(right & ~left).sum(1, dtype=np.int64))
    return similar(over, a, b)


def describe(documents: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Step 1: ``doc_id``, ``version`` (of the text), ``n``, ``class``, ``bits`` of every document; counts of slots."""

    columns = ["doc_id", "version", "n", "class", "bits", "slots"]

    def run(batches):
        seen = np.zeros(SLOTS, np.int64)
        kind = pa.list_(pa.int64())
        for batch, texts in chunks(batches):
            values, bounds = shingle_sets(texts)
            seen += np.bincount((values >> _U(49)).astype(np.int64), minlength=SLOTS)
            n = np.diff(bounds)
            names = pa.array(class_names(values, bounds), mask=n == 0)
            bits = pa.array(bitmaps(values, bounds), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), names, bits, pa.nulls(len(n), kind)], names=columns)
        nothing = [*(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.binary())]
        yield pa.RecordBatch.from_arrays([*nothing, pa.array([seen], kind)], names=columns)

    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("version"), utf8())
    described = stage(rows.mapInArrow(run, "doc_id long, version long, n long, class long, bits binary, slots array<long>"), "shingle-sets")
    counts = np.zeros(SLOTS, np.int64)
    flat = described.where("slots is not null").select(F.posexplode("slots").alias("slot", "n")).groupBy("slot").agg(F.sum("n").alias("n"))
    for slot, n in flat.collect():
        counts[slot] = n
    return described.where("slots is null").drop("slots"), counts


def prefixes(documents: DataFrame, slots: np.ndarray, packs: int) -> DataFrame:
    """Step 2: ``shingle``, ``class`` and ``n`` for prefix shingles that more than one class may hold."""
    shared = documents.sparkSession.sparkContext.broadcast(slots)
    limit = CROWDED * max(1.0, slots.mean())

    def run(batches):
        order_of, held, size = shared.value, [], 0
        known: set[int] = set()

        def rows():
            shingles, names, n = (np.concatenate(x) for x in zip(*held, strict=True))
            crowded = order_of[(shingles >> _U(49)).astype(np.int64)] > limit
            pack = np.where(crowded, packs + (names.view(_U) % _U(packs)).astype(np.int64), (mix(shingles) % _U(packs)).astype(np.int64))
            order = np.argsort(pack, kind="stable")
            table = np.stack([shingles.view(np.int64), names, n], 1)[order]
            which, at = np.unique(pack[order], return_index=True)
            held.clear()
            return record_batch(pack=which.astype(np.int64), entries=pa.array([x.tobytes() for x in np.split(table, at[1:])], pa.binary()))

        for _, texts in chunks(batches):
            values, bounds = shingle_sets(texts)
            names = class_names(values, bounds)
            for i, n in enumerate(np.diff(bounds)):
                if not n or int(names[i]) in known:
                    continue
                known.add(int(names[i]))
                own = values[bounds[i] : bounds[i + 1]]
                first = own[np.argsort(order_of[(own >> _U(49)).astype(np.int64)], kind="stable")[: n - (4 * n + 4) // 5 + 1]]
                held.append((first, np.full(len(first), names[i]), np.full(len(first), n)))
                size += len(first)
            if size > 1_000_000:
                yield rows()
                size = 0
        if held:
            yield rows()

    def gather(key, packs_of_key):
        parts = [np.frombuffer(x, np.int64).reshape(-1, 3) for x in packs_of_key.column("entries").to_pylist()]
        table = np.concatenate(parts)
        table = table[np.lexsort((table[:, 1], table[:, 2], table[:, 0]))]
        fresh = np.ones(len(table), bool)
        fresh[1:] = (table[1:, :2] != table[:-1, :2]).any(1)
        table = table[fresh]
        if key[0].as_py() < packs:
            # in order of size, a set that may be similar to any other may be so to a neighbour
            same = (table[1:, 0] == table[:-1, 0]) & (5 * table[:-1, 2] >= 4 * table[1:, 2])
            keep = np.zeros(len(table), bool)
            keep[1:] |= same
            keep[:-1] |= same
            table = table[keep]
        return pa.table([pa.array(table[:, k]) for k in range(3)], names=["shingle", "class", "n"])

    packed = documents.select(utf8()).mapInArrow(run, "pack long, entries binary")
    return stage(packed.groupBy("pack").applyInArrow(gather, "shingle long, class long, n long"), "tiles")


def with_leaders(tiles: DataFrame) -> DataFrame:
    """Tiles with the leaders each class may be similar to, whether it is one itself, and the smallest.

    A tile's leaders are the smallest class of each of ``LEADERS`` remainders of the hash.
    """
    remainder = F.pmod(F.xxhash64("class"), F.lit(LEADERS))
    smallest = [F.min(F.when(remainder == k, F.struct("class", "n"))) for k in range(LEADERS)]
    leaders = tiles.groupBy("shingle").agg(F.array_compact(F.array(*smallest)).alias("leaders"))
    near = F.filter("leaders", lambda x: (x["class"] != F.col("class")) & (5 * F.least(x["n"], F.col("n")) >= 4 * F.greatest(x["n"], F.col("n"))))
    led = tiles.join(leaders, "shingle").withColumns({"near": near, "leader": F.exists("leaders", lambda x: x["class"] == F.col("class")), "home": F.array_min("leaders.class")}).drop("leaders")
    return stage(led.where("size(near) > 0 or not leader"), "leaders")


def first_pairs(led: DataFrame) -> DataFrame:
    """Step 3: each class with the leaders of its tiles."""
    pairs = led.select("class", F.explode("near.class").alias("other"))
    return stage(pairs.select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct(), "first-pairs")


def bands(led: DataFrame) -> DataFrame:
    """Tiles without their leaders, whose pairs are known, cut by size bands; a band needs two classes."""
    own = F.floor(F.log(F.col("n").cast("double")) / float(np.log(1.25))).cast("int")
    rows = led.where("not leader").select("home", "class", "n", own.alias("own")).distinct()
    rows = rows.withColumn("band", F.explode(F.array(F.col("own"), F.col("own") - 1)))
    met = rows.groupBy("home", "band").agg(F.count(F.lit(1)).alias("m"), F.min("own").alias("low")).where("m > 1 and low = band")
    return stage(rows.join(met.select("home", "band"), ["home", "band"]), "bands")


def other_pairs(banded: DataFrame, roots: DataFrame, sets: DataFrame, groups: int) -> DataFrame:
    """Step 4: pairs of one tile and different components that their bit counts leave a chance."""
    rows = banded.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    parts = rows.groupBy("home", "band", "root").agg(F.count(F.lit(1)).alias("m"), F.min("own").alias("low"))
    cut = (
        parts.groupBy("home", "band")
        .agg(F.sum("m").alias("m"), F.max(F.struct("m", "root")).alias("top"), F.count(F.lit(1)).alias("roots"), F.min("low").alias("low"))
        .where("roots > 1 and low = band")
        .select("home", "band", F.col("top.root").alias("top"), F.ceil(F.col("top.m") / BLOCK).cast("int").alias("many"), F.ceil((F.col("m") - F.col("top.m")) / BLOCK).cast("int").alias("few"))
    )
    place = F.xxhash64("class")
    cells = (
        rows.join(cut, ["home", "band"]).withColumn("large", F.col("root") == F.col("top"))
        .withColumn("block", F.pmod(place, F.when(F.col("large"), F.col("many")).otherwise(F.col("few"))).cast("int"))
        .withColumn("with_large", F.when(F.col("large"), F.transform(F.sequence(F.lit(0), F.col("few") - 1), lambda j: F.struct(F.col("block").alias("x"), j.alias("y"))))
            .otherwise(F.transform(F.sequence(F.lit(0), F.col("many") - 1), lambda i: F.struct(i.alias("x"), F.col("block").alias("y")))))
        .withColumn("with_few", F.when(~F.col("large"), F.transform(F.sequence(F.lit(0), F.col("few") - 1), lambda k: F.struct((-1 - F.least("block", k)).alias("x"), F.greatest("block", k).alias("y")))))
        .withColumn("cell", F.explode(F.concat("with_large", F.coalesce("with_few", F.array().cast("array<struct<x:int,y:int>>")))))
        .select("home", "band", F.col("cell.x").alias("x"), F.col("cell.y").alias("y"), "large", "block", "class", "root", "n")
        .join(sets.select("class", "bits"), "class")
        .withColumn("group", F.pmod(F.xxhash64("home", "band", "x", "y"), F.lit(groups)))
    )

    def compare(table):
        get = lambda name: table.column(name).to_numpy()
        columns = {name: get(name) for name in ("home", "band", "x", "y", "block", "class", "root", "n")}
        large, maps = get("large").astype(bool), table.column("bits").to_pylist()
        order = np.lexsort((columns["y"], columns["x"], columns["band"], columns["home"]))
        cell = np.stack([columns[k][order] for k in ("home", "band", "x", "y")], 1)
        bounds = np.append(np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]).any(1))), len(cell)) if len(cell) else np.zeros(1, int)
        found = []
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            at = order[low:high]
            big, x, y = large[at], cell[low, 2], cell[low, 3]
            if x >= 0:
                left, right = at[~big], at[big]
            else:
                left, right = at[columns["block"][at] == -1 - x], at[columns["block"][at] == y]
            if not len(left) or not len(right):
                continue
            width = min(len(maps[i]) for i in at) * 8
            n, root, names = columns["n"], columns["root"], columns["class"]
            theirs = folded([maps[i] for i in right], width)
            for i, own in zip(left, folded([maps[i] for i in left], width), strict=True):
                fit = (root[right] != root[i]) & (5 * np.minimum(n[right], n[i]) >= 4 * np.maximum(n[right], n[i]))
                if x < 0 and -1 - x == y:
                    fit &= names[right] > names[i]
                fit = np.flatnonzero(fit)
                fit = fit[bounded(theirs[fit], own[None, :], n[right[fit]], n[i])]
                found.append(np.stack([np.minimum(names[right[fit]], names[i]), np.maximum(names[right[fit]], names[i])], 1))
        pairs = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return cells.groupBy("group").applyInArrow(compare, "a long, b long").distinct()


def pruned(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that their bit counts leave a chance."""
    both = pairs
    for side in "ab":
        both = both.join(sets.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)

    def run(batches):
        for batch in batches:
            a, b, n_a, n_b = (batch.column(k).to_numpy() for k in range(4))
            fit = np.zeros(len(a), bool)
            for i, (left, right) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                width = 8 * min(len(left), len(right))
                fit[i] = bounded(folded([left], width), folded([right], width), n_a[i : i + 1], n_b[i : i + 1])[0]
            yield record_batch(a=a[fit], b=b[fit])

    return stage(both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long"), "pairs")


def texts_of(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """``class`` and ``text`` for the wanted ``class``, ``ident``, ``version``.

    A bitmap of ``FILTER`` bits keeps most other texts out of the shuffle; the join is exact.
    """
    slot = F.pmod(F.xxhash64("ident", "version"), F.lit(FILTER))
    words = wanted.groupBy(F.shiftright(slot, 5).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(32)).cast("int"))).alias("bits"))
    table = np.zeros(FILTER // 32, np.uint32)
    for at, bits in words.collect():
        table[at] = bits
    shared = documents.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            at = batch.column(0).to_numpy()
            yield batch.filter(pa.array((shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1))

    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ident"), F.xxhash64("text").alias("version"), utf8())
    near = rows.select(slot.alias("slot"), "ident", "version", "text").mapInArrow(run, "slot long, ident long, version long, text binary")
    return stage(near.join(wanted, ["ident", "version"]).groupBy("class").agg(F.first("text").alias("text")), "texts")


def links(pairs: DataFrame, sets: DataFrame, documents: DataFrame) -> DataFrame:
    """Step 5: the pairs that are similar, by their sorted shingles."""
    needed = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    texts = texts_of(sets.join(needed, "class").select("class", "ident", "version"), documents)
    both = pairs.join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                known: dict[int, np.ndarray] = {}
                for number, names in enumerate((a, b)):
                    _, first = np.unique(names, return_index=True)
                    for rows, texts in chunks([batch.take(pa.array(first))], ("text_a", "text_b")[number]):
                        values, bounds = shingle_sets(texts)
                        own = rows.column(number).to_pylist()
                        known.update((name, values[bounds[i] : bounds[i + 1]]) for i, name in enumerate(own))
                keep = np.zeros(len(a), bool)
                for i, (x, y) in enumerate(zip(a, b, strict=True)):
                    left, right = known[int(x)], known[int(y)]
                    shared = np.count_nonzero(right[np.minimum(np.searchsorted(right, left), len(right) - 1)] == left)
                    keep[i] = similar(shared, len(left), len(right))
                yield record_batch(a=a[keep], b=b[keep])

    return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), "links")


def jaccard_components(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest id reachable by links) of every document."""
    described, slots = describe(documents)
    entries = described.agg(F.sum(F.col("n") - F.expr("(4 * n + 4) div 5") + 1)).first()[0] or 0
    tiles = prefixes(documents, slots, max(8, int(entries) // GATHER))

    ident = F.coalesce("doc_id", F.lit(LAST)).alias("ident")
    classes = described.where("n > 0").groupBy("class").agg(F.min(F.struct(ident, "version")).alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    sets = stage(classes.select("class", "first.ident", "first.version", "n", "bits"), "sets")
    led = with_leaders(tiles)
    roots = connect(links(pruned(first_pairs(led), sets), sets, documents))
    banded = bands(led)
    others = stage(other_pairs(banded, roots, sets, max(8, banded.count() // 20_000)), "other-pairs")
    more = links(others, sets, documents)

    names = roots.withColumnRenamed("root", "top")
    outer = more.join(names.select(F.col("node").alias("a"), F.col("top").alias("top_a")), "a", "left").join(names.select(F.col("node").alias("b"), F.col("top").alias("top_b")), "b", "left")
    outer = connect(outer.select(F.coalesce("top_a", "a").alias("a"), F.coalesce("top_b", "b").alias("b")))

    # the root of each class: by the first links, then by the later ones between their components
    member = sets.select("class", "ident").join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    member = member.withColumn("root", F.coalesce("root", "class")).join(outer.select(F.col("node").alias("root"), F.col("root").alias("outer")), "root", "left")
    member = stage(member.select("class", "ident", F.coalesce("outer", "root").alias("root")), "members")
    smallest = member.groupBy("root").agg(F.min("ident").alias("component"))
    component = member.join(smallest, "root").select("class", "component")
    result = described.select("doc_id", "n", "class").join(component, "class", "left")
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.nullif("component", F.lit(LAST))).otherwise(F.col("doc_id")).alias("component_id"))
