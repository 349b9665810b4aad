from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspindle.llm import mixing, queries


def brute_targets(sizes):
    """Share by weight, stop at twice the size, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total = 1.5 * sum(sizes.values())
    target, open_names = {}, set(names)
    while open_names:
        budget = total - sum(target.values())
        level = budget / sum(weight[s] for s in open_names)
        over = {s for s in open_names if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_names}
        for s in over:
            target[s] = 2.0 * sizes[s]
        open_names -= over
    return target


def holds(found, rows):
    """Targets as by brute force; each document 0, 1 or 2 times; sums as near as can be."""
    words = [(s, len((t or "").encode().split())) for _, t, s in rows]
    sizes = {}
    for s, n in words:
        sizes[s] = sizes.get(s, 0) + n
    target = brute_targets(sizes)
    taken = {s: 0 for s in sizes}
    source = {d: s for d, _, s in rows}
    assert len(found) == len(rows)
    for r in found:
        s = source[r.doc_id]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(target[s], rel=1e-9, abs=1e-9)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    assert sorted((r.doc_id, r["size"]) for r in found) == sorted((d, n) for (d, _, _), (_, n) in zip(rows, words, strict=True))
    return {s: taken[s] - target[s] for s in sizes}


def test_query_matches_brute_force(llm, sf_dir, documents):
    rows = list(documents[["doc_id", "text", "source"]].itertuples(index=False, name=None))
    found = queries.QUERIES["op3_mixing"](llm, sf_dir).collect()
    apart = holds(found, rows)
    target = {r.source_size: r.target for r in found}
    assert sum(abs(x) for x in apart.values()) <= 0.01 * sum(target.values()), apart
    assert sorted(found) == sorted(queries.QUERIES["op3_mixing"](llm, sf_dir).collect())


@pytest.mark.parametrize("fitted", [65_536, 40])
def test_hot_source_and_odd_texts(make, odd_texts, monkeypatch, fitted):
    monkeypatch.setattr(mixing, "FITTED", fitted)
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 50)), rng.choice(["a", "a", "b", "é", "Z", None])) for i in range(300)]
    rows += [(1000 + i, t, "odd") for i, t in enumerate(odd_texts)] + [(2000, None, "empty"), (2001, "x", "one")]
    found = mixing.mix(make(*[(d, t, None, s) for d, t, s in rows])).collect()
    apart = holds(found, rows)
    assert all(abs(x) <= 1 for s, x in apart.items() if s not in ("odd", "one"))


@pytest.mark.parametrize("seed", range(20))
def test_fit_is_nearest(seed):
    rng = random.Random(seed)
    sizes = np.array(sorted(rng.sample(range(2, 40), rng.randint(1, 5))))
    counts = np.array([rng.randint(1, 4) for _ in sizes])
    budget = rng.randint(0, int((sizes * counts).sum()))
    taken = mixing.fit(sizes, counts, budget, "s")
    assert (taken >= 0).all() and (taken <= counts).all()
    sums = {0}
    for size, count in zip(sizes.tolist(), counts.tolist(), strict=True):
        sums = {s + k * size for s in sums for k in range(count + 1)}
    assert abs(int((sizes * taken).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_mixed_repeats_rows_and_keeps_columns(make):
    rows = [(i, "w " * (1 + i % 5), "en", "ab"[i % 7 == 0]) for i in range(60)]
    docs = make(*rows).withColumn("taken", F.lit("clash"))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    wanted = {r.doc_id: r.taken // r["size"] for r in mixing.mix(docs).collect() if r.taken}
    assert times == wanted


def test_empty_tables_null_ids_and_no_words(make):
    assert mixing.mix(make()).collect() == []
    assert mixing.mixed(make()).collect() == []
    found = mixing.mix(make((None, "a b", None, None), (None, "a b", None, None), (1, None, None, "s"))).collect()
    assert sum(r.taken for r in found) in (6, 8) and len(found) == 3
    assert all(r.taken == 0 for r in mixing.mix(make((1, " ", None, "s"))).collect())


def test_rows_that_share_an_identifier_are_taken_each_for_itself(make):
    rows = [(None, f"{'w ' * (i % 5 + 1)}{i}", "en", f"s{i % 3}") for i in range(90)]
    docs = make(*rows)
    planned = sum(r.taken for r in mixing.mix(docs).collect())
    taken = [r.text for r in mixing.mixed(docs).collect()]
    assert sum(len(t.split()) for t in taken) == planned
    assert sorted(taken) == sorted(r.text for r in mixing.mixed(docs.repartition(5)).collect())
