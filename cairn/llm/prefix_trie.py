"""The trie of conversation prefixes, by union-find over the common prefixes of sorted neighbours.

Every conversation is rebuilt (``rebuilt``), equal ones are counted as one, and their turns, 128 bits each, are cut into
segments of ``width`` turns. A segment hangs below its *root*, the node at which it begins; segments below one root
are a trie of their own. All segments are sorted by root and turns over the cluster. In each range:

* the number of turns that neighbours share is an edge between them. Edges are taken in descending depth, and a
  union-find merges what they join: every merge of components at a depth makes the branching node there, and the nodes
  on the way down to a component's own depth all have its members;
* nodes on the way to the range's first and last segment may go on in its neighbours. The forest is contracted to
  these two paths (at most 2 * (width + 1) nodes, whatever the range holds), the driver merges the paths of all
  ranges in order, and the sums go back to the children that hang from them.

A longer conversation's segments are joined again by what the trie below each root adds to the node it hangs
from, summed upwards by pointer doubling over the roots.

Rows without a conv_id belong to no conversation. Turns come in the order of ``turn`` (null first), equal ones in
that of a hash of role and text; repeated rows are turns of their own. Null roles and texts are empty. No conversations make no nodes; other columns
are ignored. No task gets a whole conversation: turns are numbered over ranges of sorted rows, so one conversation, or
one turn, may hold any share of them. Only the ids of conversations that are wholly equal pass one task, as a stream,
because a SHA-256 of them all is asked for.
"""

from __future__ import annotations

import hashlib
import json
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.llm.staging import stage

#: Turns of a segment, unless stated.
BAND = 64
#: A conversation takes fewer turns than this from the first of its ``GROUP``.
HEADS, GROUP = 6, 100
#: Turns of one conversation that meet its facts in one task.
BLOCK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


NUMBERED = ["part", "conv", "local", "a", "b", "size"]


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv``, ``pos`` from 0, and the turn as ``a``, ``b`` (128 bits of role and text) and ``size`` (code points)."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, F.lit(2), role).alias("b"),
        F.length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("tie"),
    )
    # keys of a fixed size, whatever the texts; the last splits rows that are equal
    order = ["conv", F.asc_nulls_first("turn"), "a", "b", "tie"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = ranges.select(F.spark_partition_id().alias("part"), "conv", "a", "b", "size")

    def number(batches):
        """Numbers within the range; below zero come the numbers of turns its first and its last conversation have in it."""
        part, first, last, count, heads = None, None, None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(1).to_numpy()
            starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            local = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
            if part is None:
                part, first = batch.column(0)[0].as_py(), int(conv[0])
            elif conv[0] == last:
                local[: starts[1] if len(starts) > 1 else len(conv)] += count
            heads += int((conv == first).sum())
            last, count = int(conv[-1]), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 1)), pa.array(local), *(batch.column(k) for k in (2, 3, 4))], names=NUMBERED)
        if part is not None:
            edges = [(first, heads)] + [(last, count)] * (last != first)
            nothing = [0] * len(edges)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(edges), pa.int32()), pa.array([c for c, _ in edges], pa.int64()), pa.array([-n for _, n in edges], pa.int64()), *[pa.array(nothing, pa.int64())] * 3],
                names=NUMBERED,
            )

    staged = stage(turns.mapInArrow(number, "part int, conv long, local long, a long, b long, size long"), "turns")
    # a conversation that comes from the range before goes on counting: one number for each range at most
    offsets, open_conv, before = [], None, 0
    for row in staged.where("local < 0").select("part", "conv", "local").orderBy("part", "conv").toLocalIterator():
        if row["conv"] == open_conv:
            offsets.append((row["part"], row["conv"], before))
            before -= row["local"]
        else:
            open_conv, before = row["conv"], -row["local"]
    rows = staged.where("local >= 0")
    if not offsets:
        return rows.select("conv", F.col("local").alias("pos"), "a", "b", "size")
    shifts = F.broadcast(spark.createDataFrame(offsets, "part int, conv long, before long"))
    return rows.join(shifts, ["part", "conv"], "left").select("conv", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "a", "b", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (``conv``), and the turns of the rebuilt ones with their place ``d`` from 0."""
    conv = F.col("conv")
    convs = turns.where("pos = 0").select("conv", (F.crc32(conv.cast("string")) % HEADS).alias("h"), (conv - conv % GROUP).alias("base"))
    heads = turns.where((F.col("pos") < HEADS - 1) & (conv % GROUP == 0)).select(conv.alias("base"), F.col("pos").alias("d"), "a", "b", "size")
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    taken = F.least("h", F.coalesce("n", F.lit(0))).alias("taken")
    facts = stage(convs.join(lengths, "base", "left").select("conv", "base", "h", taken), "conversations")
    front = facts.where("taken > 0").join(heads, "base").where("d < taken").select("conv", "d", "a", "b", "size")
    # a long conversation's turns meet its facts block by block
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    blocks = turns.where(F.col("pos") % BLOCK == 0).select("conv", block).join(facts, "conv")
    own = turns.select("*", block).join(blocks, ["conv", "block"]).where("pos >= h")
    return facts.select("conv"), front.unionByName(own.select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("d"), "a", "b", "size"))


def wrapped(total: Column) -> Column:
    """A sum of hashes, as 62 bits; such sums can be added and wrapped again."""
    return F.pmod(F.coalesce(total, F.lit(Decimal(0))), F.lit(Decimal(1 << 62))).cast("long")


def decimal(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def cut_segments(turns: DataFrame, width: int) -> DataFrame:
    """``conv``, ``band``, ``seq`` (a and b of its turns in order), ``sizes``, ``n_turns`` and the hash sums ``sa``, ``sb``."""
    hashed = turns.withColumns({"band": F.floor(F.col("d") / width), "ha": F.xxhash64("d", "a", "b"), "hb": F.xxhash64("b", F.lit(3), "d", "a")})
    items = F.sort_array(F.collect_list(F.struct("d", "a", "b", "size")))
    found = hashed.groupBy("conv", "band").agg(
        items.alias("items"), wrapped(F.sum(decimal("ha"))).alias("sa"), wrapped(F.sum(decimal("hb"))).alias("sb"), F.count(F.lit(1)).alias("n_turns")
    )
    seq = F.flatten(F.transform("items", lambda item: F.array(item["a"], item["b"])))
    return found.select("conv", "band", seq.alias("seq"), F.col("items.size").alias("sizes"), "n_turns", "sa", "sb")


def distinct_conversations(convs: DataFrame, segments: DataFrame) -> DataFrame:
    """Rebuilt conversations that are equal, as one: the smallest ``conv``, their number ``n``, ``total`` turns, hash and ``ends``."""
    sums = segments.groupBy("conv").agg(F.sum("n_turns").alias("total"), wrapped(F.sum(decimal("sa"))).alias("wa"), wrapped(F.sum(decimal("sb"))).alias("wb"))
    whole = convs.join(sums, "conv", "left").na.fill(0, ["total", "wa", "wb"]).select("total", "wa", "wb", "conv")

    def digest(batches):
        held = None

        def closed():
            key, first, n, state = held
            return (first, n, *key, state.hexdigest())

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, conv = [batch.column(k).to_numpy() for k in range(3)], batch.column(3).to_numpy()
            new = np.append(True, np.any([x[1:] != x[:-1] for x in keys], axis=0)) if len(conv) > 1 else np.array([True])
            bounds = np.append(np.flatnonzero(new), len(conv)).tolist()
            rows = []
            for low, high in zip(bounds, bounds[1:], strict=False):
                key, ids = tuple(int(x[low]) for x in keys), conv[low:high].tolist()
                text = ",".join(map(str, ids)).encode()
                if held and held[0] == key:
                    held[3].update(b"," + text)
                    held = (key, held[1], held[2] + len(ids), held[3])
                    continue
                if held:
                    rows.append(closed())
                held = (key, ids[0], len(ids), hashlib.sha256(text))
            if rows:
                yield table_of(rows, DISTINCT)
        if held:
            yield table_of([closed()], DISTINCT)

    sorted_rows = whole.repartition("total", "wa", "wb").sortWithinPartitions("total", "wa", "wb", "conv")
    return stage(sorted_rows.mapInArrow(digest, "conv long, n long, total long, wa long, wb long, ends string"), "distinct")


DISTINCT = pa.schema([("conv", pa.int64()), ("n", pa.int64()), ("total", pa.int64()), ("wa", pa.int64()), ("wb", pa.int64()), ("ends", pa.string())])


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def ordered_segments(segments: DataFrame, distinct: DataFrame, bands: int, width: int) -> DataFrame:
    """The segments of the distinct conversations below their roots, in ranges ``part`` and sorted in each by ``row``."""
    mine = segments.join(distinct.select("conv", "n", "total", "ends"), "conv")
    if bands > 1:
        before = Window.partitionBy("conv").orderBy("band")
        sums = {f"r{x}": wrapped(F.sum(decimal(f"s{x}")).over(before.rowsBetween(Window.unboundedPreceding, -1))) for x in "ab"}
        mine = mine.withColumns(sums).withColumns({f"p{x}": F.lag(f"r{x}").over(before) for x in "ab"})
    else:
        mine = mine.withColumns({name: F.lit(0).cast("long") for name in ("ra", "rb", "pa", "pb")})
    onward = F.col("total") > (F.col("band") + 1) * width
    mine = mine.select(
        "band", "ra", "rb", "seq", "conv", "n", "sizes", "pa", "pb", onward.alias("onward"), F.when(~onward, F.col("ends")).alias("ends")
    )
    order = ["band", "ra", "rb", "seq", "conv"]
    ranges = mine.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranges.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), "*"), "segments")


# ---- one range -----------------------------------------------------------------------------------------------------


def common_prefixes(turns: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many turns each sequence shares with the one before it; -1 for the first. ``turns`` holds (a, b) rows."""
    n = len(ends) - 1
    length = np.diff(ends)
    shared = np.full(n, -1, np.int64)
    if n < 2:
        return shared
    least = np.minimum(length[1:], length[:-1])
    shared[1:] = 0
    alive = np.flatnonzero(least > 0)
    for k in range(int(least.max())):
        here, there = ends[alive + 1] + k, ends[alive] + k
        alive = alive[(turns[here] == turns[there]).all(1)]
        shared[alive + 1] += 1
        alive = alive[least[alive] > k + 1]
        if not len(alive):
            break
    return shared


class Forest:
    """Components of a range's segments. Component ``c`` is the node at depth ``top[c]`` with those above it down to, not
    including, ``bottom[c]``, the depth of its parent component ``up[c]``. All have its members; ``kids``, ``saved`` and
    ``leaves`` are those of the node at ``top`` and, for the last two, of all below it."""

    def __init__(self, shared, length, conv, low, n, sizes, first, kids, saved, leaves, ends):
        rows = len(length)
        self.first, self.rows = first, rows
        self.sizes = np.concatenate([[0], np.cumsum(sizes)])
        self.top, self.lo, self.count, self.least = length.tolist(), list(range(rows)), n.tolist(), conv.tolist()
        self.kids, self.saved, self.leaves, self.ends = kids.tolist(), saved.tolist(), leaves.tolist(), list(ends)
        self.up, self.bottom = [-1] * rows, [-1] * rows
        self.low = low.tolist()
        self._same: dict[int, int] = {}
        self._grow(shared)

    def text(self, c: int, above: int) -> int:
        """Code points of the turns of ``c`` deeper than ``above``."""
        at = self.first[self.lo[c]]
        return int(self.sizes[at + self.top[c]] - self.sizes[at + above])

    def total(self, c: int, above: int) -> int:
        return self.saved[c] + (self.count[c] - 1) * self.text(c, above)

    def leaf_count(self, c: int) -> int:
        return self.leaves[c] if self.kids[c] else 1

    def _add(self, depth: int, lo: int) -> int:
        for line, value in (
            (self.top, depth), (self.lo, lo), (self.count, 0), (self.least, None), (self.kids, 0), (self.saved, 0),
            (self.leaves, 0), (self.ends, None), (self.up, -1), (self.bottom, -1), (self.low, None),
        ):
            line.append(value)
        return len(self.top) - 1

    def _members(self, c: int, of: int) -> None:
        self.count[c] += self.count[of]
        for line in (self.least, self.low):
            line[c] = line[of] if line[c] is None else line[c] if line[of] is None else min(line[c], line[of])

    def _hang(self, c: int, below: int) -> None:
        self.up[c], self.bottom[c] = below, self.top[below]
        self.kids[below] += 1
        self.saved[below] += self.total(c, self.top[below])
        self.leaves[below] += self.leaf_count(c)
        self._members(below, c)

    def _grow(self, shared: np.ndarray) -> None:
        above = list(range(self.rows))
        node = list(range(self.rows))

        def find(i: int) -> int:
            while above[i] != i:
                above[i] = above[above[i]]
                i = above[i]
            return i

        edges = np.flatnonzero(shared >= 0)
        edges = edges[np.argsort(-shared[edges], kind="stable")]
        for i, depth in zip(edges.tolist(), shared[edges].tolist(), strict=True):
            left, right = find(i - 1), find(i)
            a, b = node[left], node[right]
            if self.top[a] == depth == self.top[b]:
                # the same node twice: segments of equal turns
                self._same[b] = a
                for line in (self.kids, self.saved, self.leaves):
                    line[a] += line[b]
                self.ends[a] = self.ends[a] or self.ends[b]
                self._members(a, b)
            else:
                if self.top[a] != depth:
                    self._hang(a, c := self._add(depth, self.lo[a]))
                    a = c
                self._hang(b, a)
            above[right], node[left] = left, a
        # what is left of each root hangs from depth 0
        for i in np.flatnonzero(shared < 0).tolist():
            top = node[find(i)]
            if self.top[top]:
                self._hang(top, self._add(0, self.lo[top]))
        self.up = [self._same.get(u, u) for u in self.up]
        self.roots = [c for c in range(len(self.top)) if self.up[c] < 0 and c not in self._same]

    def path(self, row: int) -> list[int]:
        """Components from a segment's own to its root's."""
        c, out = self._same.get(row, row), []
        while c >= 0:
            out.append(c)
            c = self.up[c]
        return out

    def spine(self, path: list[int], opened: set[int], above: int) -> list[list]:
        """What this range knows of each open node of a path deeper than ``above``, from there down: members, smallest, and
        children, savings and leaves of what hangs from it and is closed; code points of its turn, and its ends."""
        out = []
        for c in reversed(path):
            at = self.first[self.lo[c]]
            for depth in range(max(self.bottom[c], above) + 1, self.top[c] + 1):
                size = int(self.sizes[at + depth] - self.sizes[at + depth - 1]) if depth else 0
                least = self.least[c] if depth or self.low[c] is None else min(self.least[c], self.low[c])
                kids = saved = leaves = 0
                ends = None
                if depth == self.top[c]:
                    kids, saved, leaves, ends = self.kids[c], self.saved[c], self.leaves[c], self.ends[c]
                    for child in opened:
                        if self.up[child] == c:
                            kids, saved, leaves = kids - 1, saved - self.total(child, depth), leaves - self.leaf_count(child)
                out.append([self.count[c], least, kids, saved, leaves, size, ends])
        return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
GROWN = pa.schema(
    [("part", pa.int32()), *((name, pa.int64()) for name in NODE), ("ends", pa.string()), ("below", pa.string()), ("band", pa.int64()), ("ra", pa.int64()), ("rb", pa.int64()), ("spine", pa.string())]
)
GROWN_SQL = "part int, " + ", ".join(f"{name} long" for name in NODE) + ", ends string, below string, band long, ra long, rb long, spine string"


def grow(table: pa.Table, width: int) -> pa.Table:
    """One range of segments: rows of its closed nodes and roots, and one with its two open paths.

    A closed node whose parent is open names it in ``below``."""
    table = table.combine_chunks().sort_by("row")

    def column(name):
        return table.column(name).to_numpy(zero_copy_only=False)

    def flat(name):
        values = table.column(name).combine_chunks()
        values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
        offsets = values.offsets.to_numpy().astype(np.int64)
        return values.flatten().to_numpy(), offsets - offsets[0]

    rows = table.num_rows
    turns, ends = flat("seq")
    turns, ends = turns.reshape(-1, 2), ends // 2
    sizes, first = flat("sizes")
    roots = [column(name) for name in ("band", "ra", "rb")]
    shared = common_prefixes(turns, ends)
    if rows > 1:
        shared[1:][np.any([x[1:] != x[:-1] for x in roots], axis=0)] = -1
    low = np.array([None if x is None else x for x in table.column("low").to_pylist()], object)
    forest = Forest(
        shared, np.diff(first), column("conv"), low, column("n"), sizes, first, column("kids"), column("saved"), column("leaves"), table.column("ends").to_pylist()
    )
    left, right = forest.path(0), forest.path(rows - 1)
    at = {c: "L" for c in left}
    right_only = [c for c in right if c not in at]
    common = next((c for c in right if c in at), None)
    meet = forest.top[common] if common is not None else -1
    at |= {c: "R" for c in right_only}
    key = [[int(x[k]) for x in roots] + [turns[ends[k] : ends[k + 1]].ravel().tolist()] for k in (0, rows - 1)]
    spine = {"keys": key, "left": forest.spine(left, set(at), -1), "meet": meet, "right": forest.spine(right_only, set(at), meet)}

    c = np.array([c for c in range(len(forest.top)) if c not in at and c not in forest._same and forest.up[c] >= 0], np.int64)
    take = lambda line: np.array([line[x] for x in c.tolist()], np.int64)
    top, bottom, lo, count, least, up = (take(x) for x in (forest.top, forest.bottom, forest.lo, forest.count, forest.least, forest.up))
    kids, saved = take(forest.kids), take(forest.saved)
    leaves = np.where(kids > 0, take(forest.leaves), 1)
    many = top - bottom
    of = np.repeat(np.arange(len(c)), many)
    depth = bottom[of] + 1 + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    upper, deepest = depth == bottom[of] + 1, depth == top[of]
    start = first[lo[of]]
    saved = saved[of] + (count[of] - 1) * (forest.sizes[start + top[of]] - forest.sizes[start + depth - 1])
    open_up = np.array([u in at for u in up.tolist()], bool)
    root_up = bottom == 0
    parents = [forest.least[u] if not z or forest.low[u] is None else min(forest.least[u], forest.low[u]) for u, z in zip(up.tolist(), root_up.tolist(), strict=True)]
    parent = np.where(upper, np.array(parents, np.int64)[of] if len(c) else 0, least[of])
    hangs = upper & open_up[of]
    names = [f"{at[u]}{b}" if o else None for u, b, o in zip(up.tolist(), bottom.tolist(), open_up.tolist(), strict=True)]
    part, band = int(table.column("part")[0].as_py()), roots[0][lo[of]]
    nodes = {
        "part": np.full(len(of), part), "conv_id": least[of], "depth": depth + band * width,
        "parent_conv_id": pa.array(parent, pa.int64(), mask=hangs), "n_convs": count[of], "n_children": np.where(deepest, kids[of], 1),
        "n_leaves": leaves[of], "saved_tokens": saved,
        "ends": pa.array([forest.ends[x] if d else None for x, d in zip(c[of].tolist(), deepest.tolist(), strict=True)], pa.string()),
        "below": pa.array([names[x] if h else None for x, h in zip(of.tolist(), hangs.tolist(), strict=True)], pa.string()),
    }
    arrays = [nodes[f.name] if f.name in nodes else pa.nulls(len(of), f.type) for f in GROWN]
    out = [pa.table([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(arrays, GROWN, strict=True)], schema=GROWN)]
    closed = [r for r in forest.roots if r not in at]
    ended = [dict(part=part, depth=0, n_children=forest.kids[r], n_leaves=forest.leaves[r], saved_tokens=forest.saved[r], **{x: int(v[forest.lo[r]]) for x, v in zip(("band", "ra", "rb"), roots, strict=True)}) for r in closed]
    return pa.concat_tables([*out, pa.Table.from_pylist([*ended, {"part": part, "spine": json.dumps(spine)}], schema=GROWN)])


# ---- all ranges ----------------------------------------------------------------------------------------------------


def merged_spines(spines: list[tuple[int, str]]) -> tuple[list[dict], list[tuple[int, str, int]]]:
    """Rows of the open nodes and roots, whole, and the smallest member of each by range and name.

    ``spines`` come in the order of the ranges. A path goes on over a boundary as far as the segments on its sides agree."""
    nodes: list[dict] = []
    stack: list[int] = []
    names: list[tuple[int, str, int]] = []
    last = None

    def close_to(depth: int) -> None:
        while len(stack) > depth + 1:
            node = nodes[stack.pop()]
            node["n_leaves"] = node["leaves"] if node["kids"] else 1
            node["saved_tokens"] = node["saved"] + (node["count"] - 1) * node["size"]
            if stack:
                parent = nodes[stack[-1]]
                node["parent"] = stack[-1]
                parent["kids"] += 1
                parent["saved"] += node["saved_tokens"]
                parent["leaves"] += node["n_leaves"]

    def meet(part: int, name: str, key: list, depth: int, known: list) -> None:
        count, least, kids, saved, leaves, size, ends = known
        if depth == len(stack):
            nodes.append(dict(root=key[:3], depth=depth, count=0, least=least, kids=0, saved=0, leaves=0, size=size, ends=None, parent=None))
            stack.append(len(nodes) - 1)
        node = nodes[stack[depth]]
        node["count"] += count
        node["least"] = min(node["least"], least)
        for field, value in (("kids", kids), ("saved", saved), ("leaves", leaves)):
            node[field] += value
        node["ends"] = node["ends"] or ends
        names.append((part, f"{name}{depth}", stack[depth]))

    for part, text in spines:
        spine = json.loads(text)
        first, final = spine["keys"]
        agree = -1
        if last is not None and last[:3] == first[:3]:
            agree = 0
            while 2 * agree + 1 < min(len(last[3]), len(first[3])) and last[3][2 * agree : 2 * agree + 2] == first[3][2 * agree : 2 * agree + 2]:
                agree += 1
        close_to(agree)
        for depth, known in enumerate(spine["left"]):
            meet(part, "L", first, depth, known)
        if spine["right"]:
            close_to(spine["meet"])
            for depth, known in enumerate(spine["right"], spine["meet"] + 1):
                meet(part, "R", final, depth, known)
        else:
            close_to(spine["meet"])
        last = final
    close_to(-1)
    return nodes, [(part, name, nodes[k]["least"]) for part, name, k in names]


def grown(spark: SparkSession, segments: DataFrame, extras: DataFrame | None, width: int) -> tuple[DataFrame, DataFrame]:
    """Nodes and roots of the tries of all segments; ``extras`` has what hangs from a segment's end and stands at its root."""
    names = ["kids", "saved", "leaves"]
    if extras is None:
        rows = segments.select("*", *(F.lit(0).cast("long").alias(name) for name in names), F.lit(None).cast("long").alias("low"))
    else:
        rows = segments.join(extras, ["conv", "band"], "left").na.fill(0, names)
    rows = rows.select("part", "row", "band", "ra", "rb", "seq", "conv", "n", "sizes", "ends", *names, "low")
    out = stage(rows.groupBy("part").applyInArrow(lambda table: grow(table, width), GROWN_SQL), "forests")
    spines = sorted((row["part"], row["spine"]) for row in out.where("spine IS NOT NULL").select("part", "spine").collect())
    nodes, names = merged_spines(spines)
    whole, roots = [], []
    for node in nodes:
        band, ra, rb = node["root"]
        if node["depth"]:
            parent = nodes[node["parent"]]["least"]
            whole.append((node["least"], node["depth"] + band * width, parent, node["count"], node["kids"], node["n_leaves"], node["saved_tokens"], node["ends"]))
        else:
            roots.append((band, ra, rb, node["kids"], node["leaves"], node["saved"]))
    kind = ", ".join(f"{name} long" for name in NODE) + ", ends string"
    named = F.broadcast(spark.createDataFrame(names, "part int, below string, least long"))
    closed = out.where("spine IS NULL AND depth > 0").join(named, ["part", "below"], "left")
    closed = closed.select(*[F.coalesce("parent_conv_id", "least").alias(name) if name == "parent_conv_id" else F.col(name) for name in NODE], "ends")
    root_rows = out.where("spine IS NULL AND depth = 0").select("band", "ra", "rb", F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    return closed.unionByName(spark.createDataFrame(whole, kind)), root_rows.unionByName(spark.createDataFrame(roots, root_rows.schema))


ROOT = ["band", "ra", "rb"]


def hanging(segments: DataFrame, distinct: DataFrame, roots: DataFrame, bands: int, width: int) -> DataFrame:
    """For the segment that stands for a root's trie: what hangs from its end, and for the first of a root, its smallest member.

    ``roots`` has the sums of each root's own trie; those of the tries further down are added by pointer doubling."""
    places = segments.where("band > 0").groupBy(*ROOT).agg(F.min("conv").alias("owner"), F.first("pa").alias("pa"), F.first("pb").alias("pb"))
    # a conversation may end at a root; it is a member of the node, and not of the trie below
    ended = distinct.where((F.col("total") > 0) & (F.col("total") % width == 0)).select(
        F.floor(F.col("total") / width).alias("band"), F.col("wa").alias("ra"), F.col("wb").alias("rb"), F.col("conv").alias("low")
    )
    link = F.when(F.col("band") > 1, F.struct((F.col("band") - 1).alias("band"), F.col("pa").alias("ra"), F.col("pb").alias("rb")))
    table = stage(places.join(roots, ROOT).join(ended, ROOT, "left").select(*ROOT, "owner", "low", "kids", "leaves", "saved", link.alias("link")), "roots")
    for _ in range(max(0, bands - 2).bit_length()):
        below = table.where("link IS NOT NULL").groupBy(*(F.col(f"link.{x}").alias(x) for x in ROOT)).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        onward = table.select(F.struct(*ROOT).alias("link"), F.col("link").alias("next"))
        table = table.join(below, ROOT, "left").join(onward, "link", "left").select(
            *ROOT, "owner", "low", "kids", *((F.col(x) + F.coalesce(f"more_{x}", F.lit(0))).alias(x) for x in ("leaves", "saved")), F.col("next").alias("link")
        )
        table = stage(table, "roots")
    ends = table.select(F.col("owner").alias("conv"), (F.col("band") - 1).alias("band"), "kids", "saved", "leaves", F.lit(None).cast("long").alias("low"))
    starts = table.where("low IS NOT NULL").select(F.col("owner").alias("conv"), "band", *(F.lit(0).cast("long").alias(x) for x in ("kids", "saved", "leaves")), "low")
    return ends.unionByName(starts).groupBy("conv", "band").agg(*(F.sum(x).alias(x) for x in ("kids", "saved", "leaves")), F.min("low").alias("low"))


def prefix_trie(conversations: DataFrame, width: int = BAND) -> DataFrame:
    """One row a node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    spark = conversations.sparkSession
    convs, turns = rebuilt(numbered(conversations))
    segments = stage(cut_segments(turns, width), "cut")
    distinct = distinct_conversations(convs, segments)
    facts = distinct.agg(F.sum("n"), F.min("conv"), F.max("total"), F.max(F.when(F.col("total") == 0, F.col("ends")))).first()
    n_convs, least, longest, root_ends = facts
    kind = ", ".join(f"{name} long" for name in NODE) + ", ends string"
    if not n_convs:
        return spark.createDataFrame([], kind).withColumnRenamed("ends", "ends_sha256")
    bands = -(-longest // width)
    nodes, totals = spark.createDataFrame([], kind), {"kids": 0, "leaves": 0, "saved": 0}
    if bands:
        ordered = ordered_segments(segments, distinct, bands, width)
        extras = None
        if bands > 1:
            # first without what hangs from ends, then with it
            placeholder = ordered.where("band > 0").groupBy(*ROOT).agg(F.min("conv").alias("conv")).select(
                "conv", (F.col("band") - 1).alias("band"), F.lit(1).cast("long").alias("kids"), *(F.lit(0).cast("long").alias(x) for x in ("saved", "leaves")), F.lit(None).cast("long").alias("low")
            )
            extras = hanging(ordered, distinct, grown(spark, ordered, placeholder, width)[1], bands, width)
        nodes, roots = grown(spark, ordered, extras, width)
        totals = roots.where("band = 0").select("kids", "leaves", "saved").first().asDict()
    root = (least, 0, None, n_convs, totals["kids"], totals["leaves"] or 1, totals["saved"], root_ends)
    both = nodes.unionByName(spark.createDataFrame([root], kind))
    return both.select(*NODE, F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
