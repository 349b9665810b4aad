from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattspindle.llm import periodic


def runs_by_hand(words: list) -> list[tuple[int, int, int]]:
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                whole = words[i : i + length]
                if not any(whole[r:] == whole[:-r] for r in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def row_by_hand(doc_id, text) -> tuple:
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        if h % 10 == 0:
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_hand(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def rows_of(df) -> list[tuple]:
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_query_matches_plain_python(llm, sf_dir, documents):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    short = [(r.doc_id, r.text) for r in documents.itertuples() if len(r.text) < 8000]
    found = {r[0]: r for r in rows_of(periodic.digests(docs))}
    assert len(found) == len(documents)
    assert [found[i] for i, _ in short] == [row_by_hand(i, t) for i, t in short]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=4))
def test_runs_of_small_alphabets(texts):
    found = [runs for _, runs in periodic.search([" ".join(t).encode() for t in texts])]
    assert found == [runs_by_hand(t) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_long_periods_among_other_words(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(25):
        words: list[str] = []
        while len(words) < rnd.randrange(1, 500):
            word = [f"w{rnd.randrange(9)}" for _ in range(rnd.randrange(1, 60))]
            words += [word[i % len(word)] for i in range(int(len(word) * rnd.uniform(0.4, 8)))]
        texts.append(words)
    found = [runs for _, runs in periodic.search([" ".join(t).encode() for t in texts])]
    assert found == [runs_by_hand(t) for t in texts] and any(q > 30 for r in found for _, _, q in r)


def test_a_very_long_period_and_a_very_long_run():
    long = [f"x{i % 30_011}" for i in range(130_000)]
    assert [r for _, r in periodic.search([" ".join(long).encode(), b"a " * 90_000])] == [
        [(0, 130_000, 30_011)], [(0, 90_000, 1)]
    ]


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_transform_counts_mismatches_exactly(size):
    rng = np.random.default_rng(size)
    x = rng.integers(0, 1 << 20, 6 * size)
    x[2 * size : 3 * size] = x[:size]  # a whole copy of the first block, 2 * size further on
    x[size : 2 * size] = x[:size]
    x[2 * size] += 1 if size > 1 else 0
    at, by = periodic.zero_mismatches(x, np.arange(0, 4 * size, size), size, int(x.max()))
    whole = [
        (p, d) for p in range(0, 4 * size, size) for d in range(size, 2 * size)
        if p + d + size <= len(x) and (x[p : p + size] == x[p + d : p + d + size]).all()
    ]
    assert sorted(zip(at.tolist(), by.tolist(), strict=True)) == whole and whole


def test_correlation_is_exact_at_the_edge_of_the_primes():
    rng = np.random.default_rng(1)
    for prime, root, _ in periodic.PRIMES:
        blocks, windows = rng.integers(0, prime, (2, 3, 16), dtype=np.uint64)
        blocks[:, 8:] = 0
        found = periodic.Transform(prime, root, 16).correlate(blocks, windows)
        for b, w, f in zip(blocks.tolist(), windows.tolist(), found.tolist(), strict=True):
            assert f[:8] == [sum(b[j] * w[i + j] for j in range(8)) % prime for i in range(8)]


def test_odd_rows_and_clashing_columns(llm, make, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "b " * 9), (7, "one"), (7, "one")]
    short = [r for r in rows if len(r[1] or "") < 8000]
    docs = make(*rows).withColumnRenamed("lang", "runs").withColumnRenamed("source", "collapsed")
    assert rows_of(periodic.digests(make(*short))) == sorted([row_by_hand(*r) for r in short], key=str)
    out = periodic.periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "n_chars", "n_words", "runs", "collapsed"]
    assert out.count() == len(rows)
    assert periodic.digests(make()).collect() == [] and periodic.periodic_runs(make()).collect() == []


def test_collapsing_keeps_one_period(make):
    docs = make((1, "go a b a b a b a b stop"), (2, None))
    rows = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert rows[1].collapsed == "go a b stop" and [tuple(x) for x in rows[1].runs] == [(1, 8, 2)]
    assert (rows[2].n_words, rows[2].runs, rows[2].collapsed) == (0, [], "")


def test_equal_exponents_go_to_the_first_then_the_shortest(make):
    text = "x x x x x x y z z z z z z"
    doc_id = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    row = periodic.digests(make((doc_id, text))).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (2, 0, 6, 1, 6000)


def test_texts_without_words_are_not_planted(make):
    chosen = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [None, "", " \n\t ", "one", "one two", "a b c d e f g h i j k l m n o p q r s t"]
    rows = [(i, texts[n % len(texts)]) for n, i in enumerate(chosen)] + [(None, "x " * 9), (-7, "y z " * 9)]
    assert len(rows) > 2 * len(texts)
    assert rows_of(periodic.digests(make(*rows))) == sorted([row_by_hand(*r) for r in rows], key=str)
