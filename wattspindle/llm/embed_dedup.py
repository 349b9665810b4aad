"""Exact near-duplicate vectors by a dual traversal of cover trees.

Unit vectors at cosine 0.9 or more are those within a fixed distance. A cover tree has
nested levels whose radii halve; a node knows the covering radius of what is below it.
Two nodes further apart than the threshold and both radii hold no pair and are pruned;
two that are closer than the threshold less both radii hold nothing but pairs, which are
counted at once; others are opened to the next level, down to single vectors.

A tree on a bounded sample gives the upper levels: every vector goes to one of its
leaves, leaves make up blocks of bounded size, large leaves several, and pairs of blocks
of which no two leaves can hold a pair are pruned. Each block has its own tree for the
lower levels, and the remaining pairs of blocks are small tasks, a pair of small bundles of
blocks each, which return a count per vector and links that connect what is linked, never
all pairs. They screen the nodes of a first level by products at single precision, with room
for their error, and go on from what is left at double precision.

Equal vectors are one entry with their number. In data without structure, where no
bounds prune, the number of tasks grows with the square of the number of blocks, as any
exact method's work does; every task stays small.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspindle.llm.ann import matrix, usable
from wattspindle.llm.common import NULL_ID, Table, components, deal, id_of

COSINE = 0.9
SAMPLE, SAMPLE_BYTES = 1000, 16 << 20
#: Entries of a block, at most, and bytes they may take.
BLOCK, BLOCK_BYTES = 4096, 8 << 20
#: Blocks that follow each other and travel together, at most, and bundles to have before that.
BUNDLE, BUNDLES = 4, 12
RADII = (1.0, 0.5, 0.25, 0.125)
#: Nodes on a side of a tile, and pairs or numbers that a step holds, about.
TILE, SLICE = 512, 2_000_000
#: Bounds give way by this much; single vectors are compared exactly.
SLACK = 1e-6


def _apart(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (one @ two.T), 0))


def _between(one: np.ndarray, i: np.ndarray, two: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs i, j, a slice at a time."""
    apart = np.empty(len(i))
    step = max(1, SLICE // one.shape[1])
    for begin in range(0, len(i), step):
        part = slice(begin, begin + step)
        dot = np.einsum("ij,ij->i", one[i[part]], two[j[part]])
        apart[part] = np.sqrt(np.maximum(2 - 2 * dot, 0))
    return apart


def _cover(unit: np.ndarray, members: np.ndarray, radius: float) -> list[tuple[np.ndarray, float]]:
    """Members in groups within ``radius`` of each group's first, and the radius needed."""
    groups, rest = [], members
    while len(rest):
        lead = rest[:64]
        apart = _apart(unit[lead], unit[rest])
        free = np.ones(len(rest), bool)
        for i in range(len(lead)):
            if free[i]:
                near = free & (apart[i] <= radius)
                near[i] = True
                own = np.flatnonzero(near)
                own = np.r_[i, own[own != i]]
                groups.append((rest[own], float(apart[i, own].max())))
                free[near] = False
        rest = rest[free]
    return groups


class CoverTree:
    """Vectors in tree order; per level the nodes' centre, begin, end and covering radius.

    A node's first vector is its centre, and stays the centre of its first child.
    """

    def __init__(self, unit: np.ndarray):
        nodes = [(np.arange(len(unit)), 2.0)] if len(unit) else []
        self.levels = []
        kept = []
        for radius in RADII:
            nodes = [
                child
                for members, reach in nodes
                for child in ([(members, reach)] if reach <= radius else _cover(unit, members, radius))
            ]
            kept.append([(len(m), r) for m, r in nodes])
        self.order = np.concatenate([m for m, _ in nodes]) if nodes else np.zeros(0, np.int64)
        for level in kept:
            sizes = np.array([n for n, _ in level], np.int64)
            ends = np.cumsum(sizes)
            self.levels.append((ends - sizes, ends, np.array([r for _, r in level])))
        # The last level's vectors, one by one.
        n = len(self.order)
        self.levels.append((np.arange(n), np.arange(1, n + 1), np.zeros(n)))


def _opened(level: tuple, below: tuple, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First child and number of children of nodes."""
    first = np.searchsorted(below[0], level[0][nodes])
    return first, np.searchsorted(below[0], level[1][nodes]) - first


class Pairs:
    """What a dual traversal of two blocks, or of one with itself, finds."""

    def __init__(self, one: dict, two: dict | None):
        self.one, self.two, self.same = one, two or one, two is None
        self.limit = float(np.sqrt(2 - 2 * COSINE))
        size = (len(one["ids"]), len(self.two["ids"]))
        self.added = [np.zeros(size[0] + 1), np.zeros(size[1] + 1)]
        self.itself = np.zeros(size[0] + 1)
        self.edges: list[np.ndarray] = []
        self.whole: list[set] = [set(), set()]
        self.shift = 0 if self.same else size[0]
        self._start()

    def _start(self) -> None:
        """Screen the nodes of a level pair by pair, in tiles and at single precision."""
        sizes = [len(x[0]) * len(y[0]) for x, y in zip(self.one["levels"], self.two["levels"], strict=True)]
        # Levels that hardly split their nodes are passed over: their larger radii prune less.
        depth = max(d for d in range(len(RADII)) if sizes[d] <= 2 * sizes[0])
        a, b = self.one["levels"][depth], self.two["levels"][depth]
        # In the order of their radii, so that a tile's largest ones are close to all of them.
        rows, columns = np.argsort(a[2], kind="stable"), np.argsort(b[2], kind="stable")
        left = self.one["unit"][a[0][rows]].astype(np.float32)
        right = self.two["unit"][b[0][columns]].astype(np.float32)
        rough = (left.shape[1] + 4) * float(np.finfo(np.float32).eps)
        found, held = [], 0
        for begin in range(0, len(rows), TILE):
            i = rows[begin : begin + TILE]
            for low in range(begin if self.same else 0, len(columns), TILE):
                j = columns[low : low + TILE]
                dot = left[begin : begin + TILE] @ right[low : low + TILE].T
                far = self.limit + SLACK + a[2][i[-1]] + b[2][j[-1]]
                at = np.flatnonzero(dot >= 1 - far * far / 2 - rough)
                if not len(at):
                    continue
                x, y = i[at // len(j)], j[at % len(j)]
                far = self.limit + SLACK + a[2][x] + b[2][y]
                keep = dot.ravel()[at] >= 1 - far * far / 2 - rough
                if self.same:
                    keep &= at // len(j) + begin <= at % len(j) + low
                    x, y = np.minimum(x, y), np.maximum(x, y)
                found.append((x[keep], y[keep]))
                held += len(found[-1][0])
                if held >= SLICE:
                    self._go(depth, *np.concatenate(found, axis=1))
                    found, held = [], 0
        if found:
            self._go(depth, *np.concatenate(found, axis=1))

    def _go(self, depth: int, i: np.ndarray, j: np.ndarray) -> None:
        last = len(self.one["levels"]) - 1
        while len(i):
            a, b = self.one["levels"][depth], self.two["levels"][depth]
            apart = _between(self.one["unit"], a[0][i], self.two["unit"], b[0][j])
            reach = a[2][i] + b[2][j]
            if depth == last:
                self._single(i, j, apart)
                return
            near = apart <= self.limit + SLACK + reach
            inside = apart + reach < self.limit - SLACK
            if self.same:
                inside |= (i == j) & (2 * a[2][i] < self.limit - SLACK)
            self._bulk(a, b, i[inside], j[inside])
            i, j = i[near & ~inside], j[near & ~inside]
            first, n = _opened(a, self.one["levels"][depth + 1], i)
            other, m = _opened(b, self.two["levels"][depth + 1], j)
            # All children of the one with all children of the other, in slices.
            depth += 1
            total = n * m
            cuts = np.searchsorted(np.cumsum(total), np.arange(SLICE, total.sum() + SLICE, SLICE))
            bounds = np.unique(np.r_[0, np.minimum(cuts + 1, len(i)), len(i)])
            parts = []
            for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                part = slice(begin, end)
                pair = np.repeat(np.arange(begin, end), total[part])
                at = np.arange(len(pair)) - np.repeat(np.cumsum(total[part]) - total[part], total[part])
                child, mate = first[pair] + at // m[pair], other[pair] + at % m[pair]
                if self.same:
                    keep = (i[pair] != j[pair]) | (child <= mate)
                    child, mate = child[keep], mate[keep]
                parts.append((child, mate))
            if len(parts) > 1:
                for child, mate in parts:
                    self._go(depth, child, mate)
                return
            i, j = parts[0] if parts else (i[:0], j[:0])

    def _single(self, i: np.ndarray, j: np.ndarray, apart: np.ndarray) -> None:
        keep = apart <= self.limit + SLACK
        if self.same:
            keep &= i != j
        i, j = i[keep], j[keep]
        step = max(1, SLICE // self.one["raw"].shape[1])
        for begin in range(0, len(i), step):
            a, b = i[begin : begin + step], j[begin : begin + step]
            x, y = self.one["raw"][a].astype(float), self.two["raw"][b].astype(float)
            dot = np.einsum("ij,ij->i", x, y)
            norms = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
            linked = dot / norms >= COSINE
            self._count(a[linked], a[linked] + 1, b[linked], b[linked] + 1)
            self.edges.append(np.stack([a[linked], b[linked] + self.shift]))

    def _bulk(self, a: tuple, b: tuple, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        own = self.same & (i == j)
        self._count(a[0][i[~own]], a[1][i[~own]], b[0][j[~own]], b[1][j[~own]])
        if own.any():
            begin, end = a[0][i[own]], a[1][i[own]]
            weight = self.one["sums"][end] - self.one["sums"][begin]
            np.add.at(self.added[0], begin, weight)
            np.add.at(self.added[0], end, -weight)
            np.add.at(self.itself, begin, 1)
            np.add.at(self.itself, end, -1)
        self.edges.append(np.stack([a[0][i], b[0][j] + self.shift]))
        self.whole[0].update(zip(a[0][i].tolist(), a[1][i].tolist(), strict=True))
        self.whole[1].update(zip(b[0][j].tolist(), b[1][j].tolist(), strict=True))

    def _count(self, begin, end, low, high) -> None:
        """Vectors begin..end of the one block are linked with low..high of the other."""
        weight = self.two["sums"][high] - self.two["sums"][low]
        np.add.at(self.added[0], begin, weight)
        np.add.at(self.added[0], end, -weight)
        weight = self.one["sums"][end] - self.one["sums"][begin]
        side = self.added[0] if self.same else self.added[1]
        np.add.at(side, low, weight)
        np.add.at(side, high, -weight)

    def result(self) -> tuple[np.ndarray, ...]:
        """(id, linked rows) of vectors with links, and (id, id) links that connect them."""
        counts = np.cumsum(self.added[0][:-1]) - np.cumsum(self.itself[:-1]) * self.one["weight"]
        ids, totals = [self.one["ids"]], [counts]
        if not self.same:
            ids.append(self.two["ids"])
            totals.append(np.cumsum(self.added[1][:-1]))
        ids, totals = np.concatenate(ids), np.concatenate(totals).astype(np.int64)
        for side, shift in ((0, 0), (1, self.shift)):
            for begin, end in self.whole[side]:
                if end - begin > 1:
                    at = np.arange(begin + 1, end) + shift
                    self.edges.append(np.stack([np.full(len(at), begin + shift), at]))
        x, y = np.concatenate(self.edges, axis=1) if self.edges else np.zeros((2, 0), np.int64)
        label = np.arange(len(ids))
        while True:
            low = np.minimum(label[x], label[y])
            new = label.copy()
            np.minimum.at(new, x, low)
            np.minimum.at(new, y, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        tied = np.flatnonzero(label != np.arange(len(ids)))
        some = np.flatnonzero(totals)
        return ids[some], totals[some], ids[tied], ids[label[tied]]


def _blob(ids: np.ndarray, weight: np.ndarray, raw: np.ndarray) -> bytes:
    norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
    tree = CoverTree(raw / norm[:, None])
    raw, ids, weight = raw[tree.order], ids[tree.order], weight[tree.order]
    small = raw.astype(np.float32)
    raw = small if (small.astype(float) == raw).all() else raw
    return pickle.dumps({"ids": ids, "weight": weight, "raw": raw, "levels": tree.levels}, 5)


def _block(blob: bytes) -> dict:
    block = pickle.loads(blob)
    raw = block["raw"].astype(float)
    block["unit"] = raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]
    block["sums"] = np.r_[0, np.cumsum(block["weight"])]
    return block


def bundled(pairs: list[tuple[int, int]], n_blocks: int) -> list[tuple[int, int, list[int]]]:
    """(task, block, blocks it meets as the first of a pair): what goes to each task.

    Blocks that follow each other are a bundle, and a task has the pairs of two bundles, so
    that a block travels once for every bundle it meets and not for every block.
    """
    size = min(BUNDLE, max(1, n_blocks // BUNDLES))
    tasks: dict[tuple[int, int], dict[int, list[int]]] = {}
    for a, b in pairs:
        task = tasks.setdefault((a // size, b // size), {})
        task.setdefault(a, []).append(b)
        task.setdefault(b, [])
    return [(number, block, mates) for number, task in enumerate(tasks.values()) for block, mates in task.items()]


def linked(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``table``.

    Rows are linked at cosine ``COSINE`` or more. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do those of another length
    than most have. Rows that share an identifier are separate rows, and one node of a
    component. A null identifier orders first and shows as null. An empty table gives an
    empty result.
    """
    rows = table.select(id_of(f"`{vec_id}`").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    rows = Table(rows.withColumn("ok", usable("v")).withColumn("h", F.xxhash64("v")), "vectors").df
    common = rows.where("ok").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = common["n"] if common else 0
    whole = rows.where(F.col("ok") & (F.size("v") == width))
    rest = rows.where(~(F.col("ok") & (F.size("v") == width)))
    entries = Table(whole.groupBy("h", "v").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "entries").df

    total = entries.count()
    most = min(SAMPLE, SAMPLE_BYTES // (8 * max(width, 1)))
    sample = entries.where(F.expr("pmod(h, 1000000)") < 1.2e6 * most / max(total, 1)).orderBy("h", "v").limit(most)
    points = np.array([r.v for r in sample.select("v").collect()], float).reshape(-1, max(width, 1))
    points /= np.sqrt((points * points).sum(axis=1))[:, None]
    top = CoverTree(points)
    centres = points[top.order][top.levels[1][0]] if len(points) else points

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = matrix(batch.column("v"))
            leaf, apart = np.zeros(len(raw), np.int64), np.zeros(len(raw))
            for begin in range(0, len(raw), 1000):
                part = raw[begin : begin + 1000]
                far = _apart(part / np.sqrt((part * part).sum(axis=1))[:, None], centres)
                leaf[begin : begin + 1000] = far.argmin(axis=1)
                apart[begin : begin + 1000] = far.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf), pa.array(apart)], [*batch.schema.names, "leaf", "apart"]
            )

    names = "h long, v array<double>, rep long, n long, leaf long, apart double"
    entries = Table(entries.mapInArrow(placed, names), "leaves").df
    leaves = entries.groupBy("leaf").agg(F.count("*").alias("n"), F.max("apart").alias("r")).collect()
    radius = np.full(len(centres), -1.0)
    for r in leaves:
        radius[r.leaf] = r.r
    room = max(16, min(BLOCK, BLOCK_BYTES // (8 * max(width, 1))))
    first, parts, n_blocks = deal({r.leaf: r.n for r in leaves}, len(centres), room)
    # Blocks of which some two leaves may hold a pair.
    held = [np.flatnonzero((first <= k) & (k < first + parts) & (radius >= 0)) for k in range(n_blocks)]
    limit = float(np.sqrt(2 - 2 * COSINE)) + SLACK
    near = _apart(centres, centres) <= limit + radius[:, None] + radius[None, :] if len(centres) else None
    pairs = [
        (a, b) for a in range(n_blocks) for b in range(a, n_blocks)
        if len(held[a]) and len(held[b]) and (a == b or near[np.ix_(held[a], held[b])].any())
    ]
    spark = table.sparkSession

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, h = batch.column("leaf").to_numpy(), batch.column("h").to_numpy()
            number = first[leaf] + (h >> 20) % parts[leaf]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), *[batch.column(c) for c in ("rep", "n", "v")]], ["block", "rep", "n", "v"]
            )

    def packed(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, weight = group["rep"].to_numpy(), group["n"].to_numpy()
        blob = _blob(ids, weight, matrix(group["v"].chunk(0)))
        return pa.table({"block": group["block"].slice(0, 1), "blob": pa.array([blob], pa.binary())})

    blocks = entries.mapInArrow(dealt, "block long, rep long, n long, v array<double>").groupBy("block")
    blocks = Table(blocks.applyInArrow(packed, "block long, blob binary"), "blocks").df
    wanted = spark.createDataFrame(bundled(pairs, n_blocks) or [(0, -1, [])], "task long, block long, mates array<long>")

    def compared(group: pa.Table) -> pa.Table:
        numbers = group["block"].to_pylist()
        held = {number: _block(x.as_py()) for number, x in zip(numbers, group["blob"], strict=True)}
        parts = [
            Pairs(held[a], None if a == b else held[b]).result()
            for a, mates in zip(numbers, group["mates"].to_pylist(), strict=True)
            for b in mates
        ]
        ids, totals, one, two = (np.concatenate(x) for x in zip(*parts, strict=True))
        n, m = len(ids), len(one)
        return pa.table(
            {
                "a": pa.array(np.r_[ids, one], pa.int64()),
                "b": pa.array([None] * n + two.tolist(), pa.int64()),
                "n": pa.array(totals.tolist() + [None] * m, pa.int64()),
            }
        )

    found = blocks.join(wanted, "block").groupBy("task").applyInArrow(compared, "a long, b long, n long")
    found = Table(found, "found").df
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("links"))
    labels = components(found.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    known = (
        entries.select("h", "v", "rep", "n")
        .join(counts, F.col("rep") == F.col("a"), "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("h").alias("eh"), F.col("v").alias("ev"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    result = whole.join(known, (F.col("h") == F.col("eh")) & (F.col("v") == F.col("ev")))
    result = result.select("id", "n_links", "component").union(
        rest.select("id", F.lit(0).cast("long"), F.col("id"))
    )
    return result.select(
        F.expr(f"nullif(id, {NULL_ID})").alias("vec_id"),
        "n_links",
        F.expr(f"nullif(component, {NULL_ID})").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )
