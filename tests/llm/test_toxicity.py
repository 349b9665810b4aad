from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspindle.llm import queries, toxicity

LARGER = "/root/testdata/sf0.1"


def brute_kernel(one, two):
    """Common letter triples as subsequences, weighted by their stretch, by definition."""

    def features(word):
        word, found = f"{toxicity.BEGIN}{word}{toxicity.END}", {}
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i <= toxicity.STRETCH:
                key = word[i] + word[j] + word[k]
                found[key] = found.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return found

    a, b = features(one), features(two)
    norm = (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5
    k = sum(v * b.get(t, 0) for t, v in a.items()) / norm if norm else 0.0
    return np.exp((k - 1) / toxicity.WIDTH)


def test_kernel_by_definition():
    names = ["idiot", "idxiot", "idioot", "the", "clown", "closer", "loser", "aaa", "ab", "worthless"]
    machine = toxicity.Machine(names, np.zeros(len(names)), 0.0)
    found, owner = machine.kernel(names)
    assert owner.tolist() == list(range(len(names)))
    wanted = [[brute_kernel(a, b) for b in names] for a in names]
    assert np.allclose(found, wanted, atol=1e-5)


def auc(score, toxic):
    pairs = [(s > t) + (s == t) / 2 for s in score[toxic == 1] for t in score[toxic == 0]]
    return sum(pairs) / len(pairs)


def test_query_on_held_out_rows(llm):
    found = queries.QUERIES["op9_toxicity"](llm, LARGER).toPandas()
    labels = llm.read.parquet(f"{LARGER}/labels.parquet").toPandas()
    docs = llm.read.parquet(f"{LARGER}/documents.parquet").select("doc_id").toPandas()
    assert sorted(found.doc_id) == sorted(docs.doc_id)
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]).all()
    assert found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= 0.3)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert auc(held.score.to_numpy(), held.toxic.to_numpy()) >= 0.9


@pytest.fixture(scope="module")
def machine(llm):
    """Trained on clean prose, and on prose with one of three insults."""
    rng, rows, labels = random.Random(1), [], []
    syllables = ["an", "er", "the", "ou", "ing", "st", "re", "on", "ti", "ha", "lo", "se", "cl"]
    for i in range(600):
        prose = [rng.choice(syllables) + rng.choice(syllables) for _ in range(40)]
        if i % 5 == 0:
            prose[rng.randrange(40)] = rng.choice(["idiot", "worthless", "scum"])
        rows.append((i, " ".join(prose)))
        labels.append((i, int(i % 5 == 0)))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    return toxicity.learn(docs, llm.createDataFrame(labels, "doc_id long, toxic int"))


def test_gaps_and_inserted_letters(make, machine):
    base = "onre thean stre ouing anti hast "
    bad = ["idiot", "IDIOT!", "i d i o t", "i.d.i.o.t", "idioot", "worrthless", "wor-thless", "s c u m", "scuum"]
    good = ["", "onan", "anthe", "I a", "12345", "clre"]
    texts = [base + w + " reon" for w in [*bad, *good]]
    rows = toxicity.score(make(*enumerate(texts)), machine).collect()
    found = {r.doc_id: r for r in rows}
    assert [w for i, w in enumerate(bad) if not found[i].predicted] == []
    assert [w for i, w in enumerate(good, len(bad)) if found[i].predicted] == []


def test_odd_texts_nulls_and_clashes(make, machine, odd_texts):
    docs = make((None, "idiot"), (1, "idiot"), (1, "idiot"), *[(10 + i, t) for i, t in enumerate(odd_texts)])
    rows = toxicity.score(docs.withColumn("score", F.lit("clash")), machine).collect()
    assert len(rows) == 3 + len(odd_texts)
    assert all(0 <= r.score <= 1 for r in rows)
    assert [r.predicted for r in rows if r.text == "idiot"] == [1, 1, 1]
    assert {r.predicted for r in rows if not (r.text or "").strip()} == {0}
    assert toxicity.score(make(), machine).collect() == []


def test_too_little_to_learn(make, llm):
    docs = make((1, "a b c"), (3, "d e f"))
    for labels in ([], [(1, 0), (3, 0)], [(1, 1)], [(1, None), (None, 1)], [(1, 1), (1, 0), (3, 0)]):
        frame = llm.createDataFrame(labels, "doc_id long, toxic int")
        rows = toxicity.score(docs, toxicity.learn(docs, frame)).collect()
        assert all(0 <= r.score <= 1 for r in rows)


def test_long_words_are_read_whole(machine):
    value = machine.values(["x" * 400 + "idiot" + "y" * 400, "x" * 805])
    assert value[0] > value[1]


def test_values_do_not_depend_on_what_is_remembered(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 3)
    asked = []

    def values(names):
        asked.extend(names)
        return np.array([float(len(n)) for n in names])

    memory = toxicity.Memory()
    for names in ({"a", "bb", "ccc", "dddd"}, {"a", "eeeee"}, {"bb", "ff", "g", "hh"}, {"a", "x"}, {"dddd"}, set()):
        found = memory.recalled(names, values)
        assert {n: found[n] for n in names} == {n: float(len(n)) for n in names}
        assert len(memory.young) <= 3 + 4 and len(memory.old) <= 3 + 4
    # Words used again are not asked for again as long as a generation holds them.
    assert asked.count("a") == asked.count("bb") == 1
