"""Approximate nearest neighbours by a hierarchical k-means tree, best bin first.

The tree is fitted on a bounded sample and every vector is put in one of its leaves. A
query opens tree nodes from a priority queue, the most promising first, and so lists the
leaves in the order it would visit them. How many leaves are visited is calibrated: exact
neighbours of a few queries are found in the whole table, and visits are widened until
the leaves visited hold the wished share of them. A query whose leaves hold fewer rows
than its list takes goes on to further ones. Leaves are dealt to groups of bounded
size, large leaves to several; each group scores its vectors against the queries that
visit its leaves, and partial lists are merged. The queries of a group are counted and
dealt to slices, each of which gets the group's vectors, so no task holds all queries.

Equal vectors are one entry that carries the smallest identifiers among them, as many as
a list can show, so a vector that a third of all rows share takes one place in its leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattspindle.llm.common import NULL_ID, Table, deal, id_of

NEIGHBOURS, EVERY = 20, 20
#: Rows, at most, that the tree is fitted on, and bytes they may take.
SAMPLE, SAMPLE_BYTES = 20_000, 32 << 20
BRANCHES, LEAF_SAMPLE = 8, 60
#: Queries that visits are calibrated on, and the recall that is wished for.
CALIBRATED, RECALL = 96, 0.97
NAMES = ["query_id", "rank", "vec_id", "score"]
KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
#: Entries of a group, at most, and queries of a slice of it, about.
GROUP, SLICE = 20_000, 4000
#: Results that a slice holds before it keeps the best of them only.
RESULTS = 1_000_000
#: Pairs of a query and a row whose exact products are taken at once, one query at least.
PAIRS = 50_000


def usable(vector: str) -> Column:
    """Neither null, empty, zero nor with components that are null or not finite."""
    finite = f"forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return F.expr(f"coalesce(size({vector}) > 0 and {finite} and exists({vector}, x -> x <> 0), false)")


def vectors(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v) of rows that take part: usable, and of the length that most of them have."""
    rows = table.select(id_of(f"`{vec_id}`").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    rows = rows.where(usable("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else 0))


def distinct(rows: DataFrame, most: int) -> DataFrame:
    """(v, ids): each vector once, with the smallest identifiers among its rows, in order.

    Every task passes on ``most`` rows of a vector at most before rows meet.
    """
    order = Window.partitionBy("h", "v").orderBy("id")
    first = rows.withColumn("h", F.xxhash64("v")).withColumn("n", F.row_number().over(order))
    return first.where(f"n <= {most}").groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def matrix(column) -> np.ndarray:
    """An Arrow list column as rows of an array."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class Tree:
    """Nodes in the order they were made; a node without children is a leaf."""

    def __init__(self, sample: np.ndarray, seed: int = 1):
        self.rng = np.random.default_rng(seed)
        self.centres = [sample.mean(axis=0)] if len(sample) else [np.zeros(1)]
        self.children: list[list[int]] = [[]]
        todo = [(0, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= LEAF_SAMPLE:
                continue
            centres, label = self._means(sample[rows])
            kinds = np.unique(label)
            if len(kinds) < 2:
                continue
            for kind in kinds.tolist():
                self.centres.append(centres[kind])
                self.children.append([])
                self.children[node].append(len(self.centres) - 1)
                todo.append((len(self.centres) - 1, rows[label == kind]))
        self.table = np.array(self.centres)
        self.leaves = [i for i, c in enumerate(self.children) if not c]
        self.leaf_number = {node: i for i, node in enumerate(self.leaves)}

    def _means(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centres = rows[self.rng.choice(len(rows), BRANCHES, replace=False)]
        label = np.zeros(len(rows), np.int64)
        for _ in range(12):
            label = self._nearest(rows, centres)
            for k in range(BRANCHES):
                if (label == k).any():
                    centres[k] = rows[label == k].mean(axis=0)
        return centres, label

    @staticmethod
    def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.argmin((centres * centres).sum(axis=1) - 2 * rows @ centres.T, axis=1)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child, level by level."""
        result = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            own = self.children[node]
            if not own:
                result[at] = self.leaf_number[node]
                continue
            label = self._nearest(rows[at], self.table[own])
            todo += [(child, at[label == k]) for k, child in enumerate(own)]
        return result

    def visits(self, query: np.ndarray, most: int, held: np.ndarray | None = None, need: int = 0) -> list[int]:
        """The first ``most`` leaves, best bin first by inner product with the centre.

        More, if these do not hold ``need`` rows, ``held`` being the rows of each leaf.
        """
        worth = -(self.table @ query)
        queue, found, rows = [(worth[0], 0)], [], 0
        while queue and (len(found) < most or rows < need):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(self.leaf_number[node])
                rows += int(held[found[-1]]) if held is not None else 0
            for child in self.children[node]:
                heapq.heappush(queue, (worth[child], child))
        return found


def fit(entries: DataFrame) -> Tree:
    """A tree on a hashed sample of at most ``SAMPLE`` distinct vectors."""
    total, width = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    most = min(SAMPLE, SAMPLE_BYTES // (8 * (width or 1)))
    chosen = entries.where(F.expr("pmod(h, 1000000)") < 1.1e6 * most / max(total, 1))
    rows = chosen.orderBy("h", "v").limit(most).select("v").toPandas()
    return Tree(np.array(rows["v"].tolist(), float).reshape(len(rows), width or 1))


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the same order."""
    return np.einsum("ij,ij->i", queries, rows)


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """The rows of the ``most`` best of each query: highest score, then smallest id."""
    order = np.lexsort((ids, -score, query))
    ordered = query[order]
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(order)])
    place = np.arange(len(order)) - np.repeat(heads, np.diff(np.r_[heads, len(order)]))
    return order[place < most]


def _listed(
    queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: list[np.ndarray], most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score, row) of the best among ``rows`` for each query but itself.

    A fast product tells which rows may be listed: those that, within its rounding, reach
    the last place. Exact scores and identifiers decide among them, however many tie.
    """
    nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    if not len(queries) or not len(rows):
        return nothing
    fast = queries @ rows.T
    keep = min(most + 1, len(rows))
    last = np.partition(fast, len(rows) - keep, axis=1)[:, len(rows) - keep]
    longest = np.linalg.norm(queries, axis=1) * np.linalg.norm(rows, axis=1).max()
    slack = 8 * rows.shape[1] * np.finfo(float).eps * longest
    with np.errstate(invalid="ignore"):
        reach = np.where(np.isfinite(slack) & np.isfinite(last), last - slack, -np.inf)
        picked = ~(fast < reach[:, None])
    upto = np.cumsum(picked.sum(axis=1))
    sizes = np.array([len(i) for i in ids])
    found, begin = [], 0
    while begin < len(queries):
        # One query at least, and few enough pairs to be scored at once.
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS, "right")))
        query, row = np.nonzero(picked[begin:end])
        query += begin
        score = _scores(queries[query], rows[row])
        near = np.concatenate([ids[i] for i in row.tolist()])
        query, score, row = (np.repeat(x, sizes[row]) for x in (query, score, row))
        other = near != own[query]
        query, near, score, row = query[other], near[other], score[other], row[other]
        at = _best(query, score, near, most)
        found.append((query[at], near[at], score[at], row[at]))
        begin = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _calibrate(tree: Tree, entries: DataFrame, queries: DataFrame, most: int) -> int:
    """Leaves to visit, from exact neighbours of a hashed few of the queries."""
    few = queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATED).toPandas()
    if not len(few):
        return 1
    own, asked = few["id"].to_numpy(np.int64), np.array(few["v"].tolist(), float)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"))
            ids = [np.array(i, np.int64) for i in batch.column("ids").to_pylist()]
            if len(rows):
                query, found, score, row = _listed(asked, own, rows, ids, most)
                leaf = batch.column("leaf").to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), pa.array(found), pa.array(score), pa.array(leaf)],
                    ["query", "id", "score", "leaf"],
                )

    partial = entries.select("v", "ids", "leaf").mapInArrow(run, "query long, id long, score double, leaf long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    exact = partial.withColumn("n", F.row_number().over(order)).where(f"n <= {most}").toPandas()
    places = np.zeros(len(tree.leaves))
    for query, group in exact.groupby("query"):
        rank = np.empty(len(tree.leaves), np.int64)
        rank[tree.visits(asked[query], len(tree.leaves))] = np.arange(len(tree.leaves))
        np.add.at(places, rank[group["leaf"].to_numpy()], 1 / len(group))
    recall = np.cumsum(places) / max(exact["query"].nunique(), 1)
    return min(int(np.searchsorted(recall, RECALL)) + 1, len(tree.leaves))


def sliced(counts: dict[int, int], groups: int) -> np.ndarray:
    """Slices of each group, from its number of queries; none where nothing visits it."""
    result = np.zeros(groups, np.int64)
    for group, n in counts.items():
        result[group] = -(-n // SLICE)
    return result


def search(
    table: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    most: int = NEIGHBOURS,
    every: int = EVERY,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every query its nearest by inner product.

    Queries are rows whose identifier is divisible by ``every``, candidates all others.
    Vectors that are null, empty, zero or hold null or non-finite components take no
    part, nor do those of another length than most have. Ties go to the smaller
    identifier. A query without candidates has no row; an empty table gives an empty
    result. Rows that share an identifier are one row if their vectors are equal; a null
    identifier is no query and orders first as a candidate.
    """
    wanted = "query_id long, rank int, vec_id long, score double"
    rows = Table(vectors(table, vec_id, embedding).distinct(), "vectors").df
    entries = Table(distinct(rows, most + 1), "entries").df
    tree = fit(entries)

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(matrix(batch.column("v"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    entries = Table(entries.mapInArrow(placed, "h long, v array<double>, ids array<long>, leaf long"), "leaves").df
    queries = rows.where((F.col("id") != NULL_ID) & (F.expr(f"id % {every}") == 0))
    visited = _calibrate(tree, entries, queries, most)
    counts = entries.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("listed")).collect()
    sizes, held = {r.leaf: r.n for r in counts}, np.zeros(len(tree.leaves), np.int64)
    for r in counts:
        held[r.leaf] = r.listed
    # Rows with the query's own identifier do not count as neighbours.
    repeated = queries.groupBy("id").agg(F.count("*").alias("own")).where("own > 1")
    queries = queries.join(repeated, "id", "left").select(
        "id", "v", F.coalesce("own", F.lit(1)).alias("own"), F.xxhash64("id", "v").alias("h")
    )
    first, parts, groups = deal(sizes, len(tree.leaves), GROUP)

    def routed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            need = (batch.column("own").to_numpy() + most).tolist()
            asked = matrix(batch.column("v"))
            leaves = [tree.visits(q, visited, held, n) for q, n in zip(asked, need, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), batch.column("h"), pa.array(leaves, pa.list_(pa.int64()))],
                ["id", "v", "h", "visits"],
            )

    routes = queries.mapInArrow(routed, "id long, v array<double>, h long, visits array<long>")
    routes = Table(routes, "routes").df

    def in_groups(leaves: list[int]) -> dict[int, list[int]]:
        mine: dict[int, list[int]] = {}
        for leaf in leaves:
            for part in range(int(parts[leaf])):
                mine.setdefault(int(first[leaf]) + part, []).append(leaf)
        return mine

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(groups, np.int64)
        for batch in batches:
            for leaves in batch.column("visits").to_pylist():
                total[list(in_groups(leaves))] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["group", "n"])

    per_group = routes.select("visits").mapInArrow(counted, "group long, n long").groupBy("group").agg(F.sum("n").alias("n"))
    slices = sliced({r.group: r.n for r in per_group.collect()}, groups)

    def grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, h = batch.column("leaf").to_numpy(), batch.column("h").to_numpy()
            group = first[leaf] + (h >> 20) % parts[leaf]
            whole = pa.RecordBatch.from_arrays(
                [pa.array(group), batch.column("leaf"), batch.column("v"), batch.column("ids")],
                ["group", "leaf", "v", "ids"],
            )
            for number in range(int(slices[group].max(initial=0))):
                part = whole.filter(pa.array(slices[group] > number))
                number = pa.array(np.full(part.num_rows, number))
                yield pa.RecordBatch.from_arrays([*part.columns, number], [*part.schema.names, "slice"])

    def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy() >> 20
            group, leaves, index = [], [], []
            for i, visits in enumerate(batch.column("visits").to_pylist()):
                for g, own_leaves in in_groups(visits).items():
                    group.append(g)
                    leaves.append(own_leaves)
                    index.append(i)
            at, number = np.array(index, np.int64), np.array(group, np.int64)
            # Runs of bounded size: a query goes to many groups.
            for begin in range(0, len(at), 10_000):
                part = slice(begin, begin + 10_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number[part]),
                        pa.array(h[at[part]] % slices[number[part]]),
                        pa.array(leaves[part], pa.list_(pa.int64())),
                        batch.column("id").take(pa.array(at[part])),
                        batch.column("v").take(pa.array(at[part])),
                    ],
                    ["group", "slice", "visits", "id", "v"],
                )

    def merged(found: list[tuple]) -> tuple:
        query, near, score = (np.concatenate(x) for x in zip(*found, strict=True))
        at = _best(query, score, near, most)
        return query[at], near[at], score[at]

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        empty = pa.table({n: pa.array([], t) for n, t in zip(NAMES, KINDS, strict=True)})
        if not left.num_rows or not right.num_rows:
            return empty
        asked, own = matrix(left["v"].chunk(0)), left["id"].to_numpy()
        rows, leaf = matrix(right["v"].chunk(0)), right["leaf"].to_numpy()
        ids = [np.array(i, np.int64) for i in right["ids"].to_pylist()]
        open_leaf = np.zeros((len(asked), int(leaf.max()) + 1), bool)
        for i, own_leaves in enumerate(left["visits"].to_pylist()):
            open_leaf[i, [x for x in own_leaves if x < open_leaf.shape[1]]] = True
        found: list[tuple] = []
        waiting = 0
        for kind in np.unique(leaf).tolist():
            here, at = np.flatnonzero(open_leaf[:, kind]), np.flatnonzero(leaf == kind)
            for begin in range(0, len(here), 512):
                part = here[begin : begin + 512]
                query, near, score, _ = _listed(asked[part], own[part], rows[at], [ids[i] for i in at], most)
                found.append((part[query], near, score))
                waiting += len(query)
                if waiting > RESULTS:
                    found, waiting = [merged(found)], 0
        if not found:
            return empty
        query, near, score = merged(found)
        arrays = [own[query], np.zeros(len(query), np.int32), near, score]
        return pa.table({n: pa.array(a, t) for n, a, t in zip(NAMES, arrays, KINDS, strict=True)})

    sides = (
        routes.mapInArrow(sent, "group long, slice long, visits array<long>, id long, v array<double>"),
        entries.mapInArrow(grouped, "group long, leaf long, v array<double>, ids array<long>, slice long"),
    )
    keyed = [side.groupBy("group", "slice") for side in sides]
    partial = keyed[0].cogroup(keyed[1]).applyInArrow(scored, wanted)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = partial.withColumn("rank", F.row_number().over(order)).where(f"rank <= {most}")
    return best.select("query_id", "rank", F.expr(f"nullif(vec_id, {NULL_ID})").alias("vec_id"), "score")

