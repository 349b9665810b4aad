"""Nearest neighbours and near-duplicate vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspindle.llm import ann, embed_dedup, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
LARGER = "/root/testdata/sf0.1"


def clustered(seed=1, n=700, width=12):
    """Copies, dense groups around the threshold, scattered vectors of varied length."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=width) * rng.choice([0.0, 0.01, 0.1, 0.3, 1.0])
        rows.append((i * 3 % n * 2, (v * rng.choice([1.0, 0.5, 3.0])).astype(np.float32).tolist()))
    return rows


ODD = [
    (9001, None), (9003, []), (9005, [0.0] * 12), (9007, [1.0] * 11 + [None]), (9009, [1.0] * 11 + [float("nan")]),
    (9011, [1.0] * 11 + [float("inf")]), (9020, [1.0, 2.0]), (9040, None),
]


def good(v):
    return v is not None and len(v) == 12 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def table(llm, rows):
    return llm.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute_links(rows):
    whole = [(i, np.array(v, float)) for i, v in rows if good(v)]
    ids, x = np.array([i for i, _ in whole]), np.stack([v for _, v in whole])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    label = ids.copy()
    while True:
        new = np.array([label[near[k]].min() for k in range(len(ids))])
        new = np.array([new[ids == i].min() for i in ids])
        if (new == label).all():
            break
        label = new
    found = [(int(i), int(near[k].sum()) - 1, int(label[k]), i == label[k]) for k, i in enumerate(ids)]
    return sorted(found + [(i, 0, i, True) for i, v in rows if not good(v)])


def links(frame):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in frame.collect())


@pytest.mark.parametrize(("block", "sample"), [(4096, 1000), (64, 30)])
@pytest.mark.parametrize("seed", [1, 2])
def test_links_match_brute_force(llm, monkeypatch, block, sample, seed):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    monkeypatch.setattr(embed_dedup, "SAMPLE", sample)
    rows = clustered(seed) + ODD
    rows += [(20_000 + i, rows[5][1]) for i in range(200)] + [rows[7], rows[7]]
    wanted = brute_links(rows)
    assert max(w[1] for w in wanted) > 200
    assert links(embed_dedup.linked(table(llm, rows))) == wanted


def test_query_matches_brute_force(llm, sf_dir):
    vectors = llm.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x = np.stack(vectors.embedding).astype(float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    counts = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in queries.QUERIES["op8_embedding_dedup"](llm, sf_dir).collect()}
    assert found == dict(zip(vectors.vec_id.tolist(), counts.tolist(), strict=True))


def test_cover_tree_covers():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(300, 6)), rng.normal(size=(1, 6)) + rng.normal(size=(200, 6)) * 0.05])
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    tree = embed_dedup.CoverTree(unit)
    assert sorted(tree.order.tolist()) == list(range(500))
    placed = unit[tree.order]
    for radius, (begins, ends, reach) in zip(embed_dedup.RADII, tree.levels, strict=False):
        assert begins[0] == 0 and ends[-1] == 500 and (begins[1:] == ends[:-1]).all()
        for begin, end, r in zip(begins, ends, reach, strict=True):
            apart = np.linalg.norm(placed[begin:end] - placed[begin], axis=1).max()
            assert apart <= r + 1e-6 and r <= radius + 1e-9


def block_of(rows, first=0):
    return embed_dedup._block(embed_dedup._blob(np.arange(first, first + len(rows)), np.ones(len(rows), np.int64), rows))


def spread(seed, n=1500, width=64):
    """Scattered directions, a few of them at most a unit apart, and some near copies."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width))
    rows[1:60:2] = rows[0:60:2] + 0.8 * rng.normal(size=(30, width))
    rows[100:130] = rows[99] + 0.05 * rng.normal(size=(30, width))
    return rows


def test_wide_nodes_do_not_meet_every_other(monkeypatch):
    """Two directions a unit apart are one wide node, near to half of all; they are met one by one instead."""
    met = []
    go = embed_dedup.Pairs._go
    monkeypatch.setattr(embed_dedup.Pairs, "_go", lambda self, depth, i, j: met.append(len(i)) or go(self, depth, i, j))
    block = block_of(spread(5))
    sizes = [len(level[0]) for level in block["levels"]]
    assert sizes[0] < sizes[-2] - 20
    embed_dedup.Pairs(block, None).result()
    embed_dedup.Pairs(block, block_of(spread(6), 2000)).result()
    assert 0 < sum(met) < 2 * sizes[0]


@pytest.mark.parametrize(("tile", "step"), [(512, 2_000_000), (7, 50)])
def test_blocks_match_brute_force(monkeypatch, tile, step):
    monkeypatch.setattr(embed_dedup, "TILE", tile, raising=False)
    monkeypatch.setattr(embed_dedup, "SLICE", step, raising=False)
    shared = spread(8, 400)
    for rows, others in ((shared, None), (shared, np.concatenate([spread(9, 300), 2 * shared[90:140]]))):
        unit, mates = (x / np.linalg.norm(x, axis=1)[:, None] for x in (rows, rows if others is None else others))
        near = unit @ mates.T >= embed_dedup.COSINE
        if others is None:
            wanted = dict(enumerate((near.sum(axis=1) - 1).tolist()))
        else:
            wanted = dict(enumerate(near.sum(axis=1).tolist())) | dict(enumerate(near.sum(axis=0).tolist(), 1000))
        two = None if others is None else block_of(others, 1000)
        ids, totals, one, tied = embed_dedup.Pairs(block_of(rows), two).result()
        assert dict(zip(ids.tolist(), totals.tolist(), strict=True)) == {k: n for k, n in wanted.items() if n}
        assert max(wanted.values()) >= 30 and set(one.tolist()) | set(tied.tolist()) == {k for k, n in wanted.items() if n}


def test_blocks_travel_in_bundles():
    every = [(a, b) for a in range(50) for b in range(a, 50) if (a + b) % 7]
    sides = embed_dedup.bundled(every, 50)
    assert sorted((block, mate) for _, block, mates in sides for mate in mates) == every
    held = {}
    for task, block, _ in sides:
        held.setdefault(task, set()).add(block)
    assert all(mate in held[task] for task, _, mates in sides for mate in mates)
    assert len(sides) < 0.35 * 2 * len(every) and max(map(len, held.values())) <= 2 * embed_dedup.BUNDLE
    assert embed_dedup.bundled([(0, 0), (0, 1)], 2) == [(0, 0, [0]), (1, 0, [1]), (1, 1, [])]


def test_bundles_match_brute_force(llm, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    monkeypatch.setattr(embed_dedup, "SAMPLE", 30)
    monkeypatch.setattr(embed_dedup, "BUNDLES", 3)
    rows = clustered(3) + ODD
    assert links(embed_dedup.linked(table(llm, rows))) == brute_links(rows)


def test_links_of_few_or_no_rows(llm):
    assert links(embed_dedup.linked(table(llm, []))) == []
    assert links(embed_dedup.linked(table(llm, ODD[:2]))) == [(9001, 0, 9001, True), (9003, 0, 9003, True)]
    null = embed_dedup.linked(table(llm, [(None, [1.0, 0.0]), (4, [2.0, 0.0])])).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in null) == [
        ("4", 1, None, False), ("None", 1, None, True),
    ]


def brute_nearest(rows, most=20):
    whole = [(i, np.array(v, float)) for i, v in rows if good(v)]
    ids = np.array([i for i, _ in whole])
    x = np.stack([v for _, v in whole])
    result = {}
    for i, v in whole:
        if i % 20 == 0:
            score = np.einsum("ij,ij->i", x, np.tile(v, (len(x), 1)))
            order = [k for k in np.lexsort((ids, -score)) if ids[k] != i][:most]
            result[i] = [(int(ids[k]), float(score[k])) for k in order]
    return result


def nearest(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


@pytest.mark.parametrize("group", [20_000, 40])
def test_all_leaves_give_the_exact_answer(llm, monkeypatch, group):
    monkeypatch.setattr(ann, "RECALL", 2.0)
    monkeypatch.setattr(ann, "GROUP", group)
    monkeypatch.setattr(ann, "LEAF_SAMPLE", 20)
    rows = clustered(3) + ODD + [(20_000 + i, clustered(3)[5][1]) for i in range(200)]
    assert nearest(ann.search(table(llm, rows))) == brute_nearest(rows)


def test_recall_of_the_query(llm):
    vectors = llm.read.parquet(f"{LARGER}/embeddings.parquet").toPandas()
    x, ids = np.stack(vectors.embedding).astype(float), vectors.vec_id.to_numpy()
    found = nearest(queries.QUERIES["op6_nearest_neighbours"](llm, LARGER))
    asked = np.flatnonzero(ids % 20 == 0)
    assert sorted(found) == sorted(ids[asked].tolist())
    hits = 0
    for k in asked:
        score = x @ x[k]
        score[k] = -np.inf
        hits += len({i for i, _ in found[ids[k]]} & set(ids[np.argsort(-score)[:20]].tolist()))
        for vec_id, s in found[ids[k]]:
            assert s == pytest.approx(score[ids == vec_id][0], rel=1e-12)
    assert hits / (20 * len(asked)) >= 0.9


def test_few_rows_and_clashes(llm):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.5, 1.0]), (7, [1.0, 0.0]), (None, [0.0, 1.0]), (40, None)]
    found = nearest(ann.search(table(llm, rows).withColumn("score", F.lit("clash"))))
    assert found == {0: [(7, 1.0), (20, 0.5), (None, 0.0)], 20: [(None, 1.0), (0, 0.5), (7, 0.5)]}
    assert ann.search(table(llm, [])).collect() == []
    assert ann.search(table(llm, [(20, [1.0])])).collect() == []


def lonely(width=24):
    """Forty tight clusters, and queries and others that are alone in their directions."""
    rng = np.random.default_rng(7)
    centres = 5 * rng.normal(size=(40, width))
    rows = [(i, (centres[i % 40] + 0.01 * rng.normal(size=width)).tolist()) for i in range(1, 2000)]
    rows += [(4000 + 10 * i, (300 * rng.normal(size=width)).tolist()) for i in range(8)]
    return rows + [(4000, [400.0] * width), (4000, [-400.0] * width), (4000, [400.0] + [0.0] * (width - 1))]


def test_queries_in_tiny_leaves_have_full_lists(llm, monkeypatch):
    monkeypatch.setattr(ann, "RECALL", 0.3)
    rows = lonely()
    found = nearest(ann.search(table(llm, rows)))
    assert {i for i, _ in rows if i % 20 == 0} == set(found)
    assert {len(x) for x in found.values()} == {20}


def test_slices_of_a_group_give_the_exact_answer(llm, monkeypatch):
    """Queries of a group go to slices by their number, and each slice meets all its entries."""
    monkeypatch.setattr(ann, "RECALL", 2.0)
    monkeypatch.setattr(ann, "SLICE", 7)
    monkeypatch.setattr(ann, "RESULTS", 50)
    assert ann.sliced({0: 7, 2: 8, 3: 700}, 5).tolist() == [1, 0, 2, 100, 0]
    rows = clustered(3) + ODD
    assert nearest(ann.search(table(llm, rows))) == brute_nearest(rows)


def test_best_bin_first_lists_every_leaf_once():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(2000, 8))
    tree = ann.Tree(points)
    order = tree.visits(points[0], len(tree.leaves))
    assert sorted(order) == list(range(len(tree.leaves)))
    assert tree.visits(points[0], 5) == order[:5]
    assert set(tree.assign(points).tolist()) <= set(order)


def test_ties_go_to_the_smallest_identifiers(llm, monkeypatch):
    rng = np.random.default_rng(4)
    binary = rng.integers(0, 2, (900, 12)).astype(float)
    binary[:300, :] = 0
    binary[:300, 0] = 1  # three hundred vectors of one product
    rows = [(i, v.tolist(), 0) for i, v in enumerate(binary) if v.any()]
    monkeypatch.setattr(ann, "RECALL", 1.0)
    monkeypatch.setattr(ann, "PAIRS", 700)
    table = llm.createDataFrame(rows[::-1], "vec_id long, embedding array<float>, label int")
    found: dict[int, list] = {}
    for r in ann.search(table).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    ids = np.array([i for i, _, _ in rows])
    vectors = np.array([v for _, v, _ in rows])
    for query in ids[ids % 20 == 0].tolist():
        scores = vectors @ binary[query]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:20]
        assert found[query] == [(int(ids[i]), float(scores[i])) for i in order]
