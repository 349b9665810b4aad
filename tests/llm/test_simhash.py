from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wattspindle.llm import queries, simhash


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    prints, label = np.array(prints, np.uint64), np.array(ids)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    while True:
        new = np.array([label[near[i]].min() for i in range(len(label))])
        if (new == label).all():
            return label.tolist()
        label = new


def test_query_matches_brute_force(llm, sf_dir, documents):
    found = queries.QUERIES["op1_simhash"](llm, sf_dir).toPandas().sort_values("doc_id")
    docs = documents.sort_values("doc_id")
    prints = [brute_fingerprint(t) for t in docs.text]
    assert found.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    assert found.component_id.tolist() == brute_components(docs.doc_id.tolist(), prints)


def test_odd_texts(make, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    found = {r.doc_id: r for r in simhash.near_duplicates(make(*rows)).collect()}
    prints = [brute_fingerprint(t) for t in odd_texts]
    assert [found[i].fingerprint for i, _ in rows] == [f"{p:016x}" for p in prints]
    assert [found[i].component_id for i, _ in rows] == brute_components(range(len(rows)), prints)


def test_null_identifiers_and_repeated_rows(make):
    found = simhash.near_duplicates(make((5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, "q r s"))).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == [
        ("5", "None"), ("5", "None"), ("7", "7"), ("None", "None"),
    ]


def test_empty_table(make, llm):
    assert simhash.near_duplicates(make()).collect() == []
    assert simhash.keep_one(make()).collect() == []


def test_keep_one_keeps_columns(make):
    docs = make((3, "a b c d", "en"), (2, "a b c d", "en"), (9, "z y x w"), (9, "z y x w"))
    docs = docs.withColumn("component_id", F.lit("mine"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.component_id) for r in kept.collect()) == [(2, "mine"), (9, "mine")]


def test_keep_one_keeps_texts_that_share_an_identifier_or_have_none(make):
    rows = [
        (None, "a b c d"), (None, "q r s t u"), (None, "a b c d"), (7, "a b c d"),
        (5, "v w x y z"), (5, "k l m n o"), (5, "v w x y z"), (3, "k l m n o"), (9, "f g h i j"),
    ]
    for order in (rows, rows[::-1]):
        kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_one(make(*order).repartition(3)).collect())
        assert kept == [
            ("3", "k l m n o"), ("5", "v w x y z"), ("9", "f g h i j"), ("None", "a b c d"), ("None", "q r s t u"),
        ]


@pytest.mark.parametrize(("meeting", "small"), [(4096, 48), (8, 2), (1, 0)])
def test_dense_neighbourhoods(llm, monkeypatch, meeting, small):
    """Crowded keys go through the second cut, or the flips, with the same links."""
    monkeypatch.setattr(simhash, "MEETING", meeting)
    monkeypatch.setattr(simhash, "SMALL", small)
    rng, prints = random.Random(3), set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in set(rng.choices(range(64), k=rng.choice([0, 1, 2, 3])))))
    prints |= {0, 2**64 - 1, 2**63}
    ids = list(range(len(prints)))
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    frame = llm.createDataFrame(list(zip(signed, ids, strict=True)), "fp long, rep long")
    if meeting == 4096:
        met = simhash._meet(simhash._variants(frame), 4, first=True)
        links = met.where("key is null")
    else:
        key = F.lit(0).cast("long").alias("key")
        links = llm.createDataFrame([], "a long, b long, key long")
        rows = simhash._variants(frame).toPandas()
        parts = []
        for k, group in rows.sort_values(["key", "fp"]).groupby("key"):
            arrays = [group[c].to_numpy() for c in ("key", "fp", "rep")]
            arrays[1] = arrays[1].view(np.uint64)
            parts += list(simhash._linked(*arrays, True))
        edges = [(a, b) for p in parts for a, b, c in zip(*[p.column(i).to_pylist() for i in range(3)], strict=True) if c is None]
        crowded = [(c, a, b) for p in parts for a, b, c in zip(*[p.column(i).to_pylist() for i in range(3)], strict=True) if c is not None]
        assert crowded
        again = simhash._meet(simhash._second_cut(llm.createDataFrame(crowded, "key long, fp long, rep long")), 4, first=False)
        links = again.union(llm.createDataFrame(edges, "a long, b long").withColumn("key", key)) if edges else again
    label = {i: i for i in ids}
    pairs = [(r.a, r.b) for r in links.collect()]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert [label[i] for i in ids] == brute_components(ids, list(prints))
