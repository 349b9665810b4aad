from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspindle.llm import packing, queries


def brute_pieces(doc, text, capacity=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    return [
        (doc, n, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes()))
        for n, at in enumerate(range(0, len(ids), capacity))
    ]


def holds(found, rows, capacity=2048):
    wanted = sorted(p for d, t in rows for p in brute_pieces(d, t, capacity))
    assert sorted(tuple(r)[:5] for r in found) == wanted
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_packs_all(llm, sf_dir, documents):
    rows = list(zip(documents.doc_id.tolist(), documents.text, strict=True))
    found = queries.QUERIES["op7_packing"](llm, sf_dir).collect()
    used = holds(found, rows)
    total = sum(r.length for r in found)
    assert used <= -(-total // 2048) * 1.02 + 1


def test_odd_texts(make, odd_texts):
    special = ["<|endoftext|> a<|startoftext|>b", "É́ é ΣΑΣ ß İI", "don't we'll I'M 3.14 ½ ٣", "a̸ ≠ ́x", " a b\x85c"]
    rows = list(enumerate([*odd_texts, *special]))
    holds(packing.pack(make(*rows)).collect(), rows)


@pytest.mark.parametrize(
    "text",
    [
        "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "x <|endoftext|> <|EndOfText|> y", "it's<|ENDOFTEXT|>",
        "<|endoftext|><|endoftext|>", "ΟΔΟΣ", "ΟΔΟΣ! ΑΣ ΟΔΟΣ", "J\u030cA H\u0331 T\u0308 j\u030c", "İSTANBUL ŸÉ É\u0301 ŉ ĲSS",
        "Größe ÉTÉ Straße", "“Quoted” Words WORDS words",
    ],
)
def test_ids_are_the_tokenizers(text):
    words = packing.Words(packing.tokenizer_path())
    for value in (text, text.lower(), text, f"Plain {text} Plain"):
        wanted = words.tokenizer.encode(value, add_special_tokens=False).ids
        assert np.frombuffer(words.ids(value), "<u4").tolist() == wanted


def test_repeated_rows_and_clashes(make):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other text"), (2, None)]
    docs = make(*rows).withColumn("offset", F.lit("clash"))
    assert holds(packing.pack(docs).collect(), rows) == 1
    assert packing.pack(make()).collect() == []
    assert len(packing.pack(make((None, "x"))).collect()) == 1


def best(lengths, capacity):
    """Fewest bins by trying every assignment."""
    fewest = len(lengths)

    def go(i, rooms):
        nonlocal fewest
        if len(rooms) >= fewest:
            return
        if i == len(lengths):
            fewest = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                go(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return fewest


@pytest.mark.parametrize("seed", range(25))
def test_completion_is_near_the_optimum(seed):
    rng = random.Random(seed)
    capacity = 20
    lengths = sorted((rng.randint(1, 19) for _ in range(9)), reverse=True)
    counts = {s: len(list(g)) for s, g in itertools.groupby(lengths)}
    patterns = packing.complete(counts, capacity)
    held = {}
    for filling, times in patterns:
        assert sum(filling) <= capacity
        for size in filling:
            held[size] = held.get(size, 0) + times
    assert held == counts
    used, fewest = sum(t for _, t in patterns), best(lengths, capacity)
    assert packing.bound(counts, capacity) <= fewest <= used <= fewest + 1


def test_first_way_down_is_whole_and_many_lengths_branch(monkeypatch):
    """A packing better than best fit is found, however few branches may follow it."""
    rng = random.Random(1)
    counts = {rng.randint(409, 1024): rng.randint(1, 4) for _ in range(200)}
    monkeypatch.setattr(packing, "BRANCHES", 1)
    asked = []
    fillings = packing._fillings
    monkeypatch.setattr(packing, "_fillings", lambda *a: asked.append(len(a[0])) or fillings(*a))
    patterns = packing.complete(counts)
    held = {}
    for filling, times in patterns:
        for size in filling:
            held[size] = held.get(size, 0) + times
    assert held == counts and max(asked) > 60
    assert sum(t for _, t in patterns) < sum(t for _, t in packing._greedy(counts, 2048))


def test_slots_give_every_rank_one_place():
    counts = {7: 10, 5: 9, 3: 31, 20: 2, 1: 4}
    slots = packing._slots(packing.complete(counts, 20))
    for size, n in counts.items():
        ranks = sorted(r for s, a, b, *_ in slots if s == size for r in range(a, b + 1))
        assert ranks == list(range(n))


def test_dominated_fillings_are_left_out():
    assert packing._dominates((9, 6), (5, 4, 6)) and packing._dominates((9, 6), (9, 5))
    assert not packing._dominates((9, 6), (8, 7)) and not packing._dominates((5, 4, 6), (9, 6))
    assert packing._dominates((7,), (7,)) and packing._dominates((7,), ())
    fillings = packing._fillings([3, 4, 5, 6, 9], {3: 1, 4: 1, 5: 1, 6: 1, 9: 1}, 15, 12)
    assert fillings[0] == (9, 6) and all(sum(f) <= 15 for f in fillings)
    assert not any(packing._dominates(a, b) for a in fillings for b in fillings if a != b)


def test_fillings_of_many_short_pieces_leave_no_room():
    left = {n: 500 for n in range(5, 21)}
    for filling in packing._fillings(sorted(left), left, 2028, 12):
        # As many as there are and fit, and none more can be added.
        assert 2028 - sum(filling) < 5 and len(filling) > 100
        assert all(filling.count(s) <= left[s] for s in left)


def test_a_word_takes_the_whole_way_only_for_itself():
    words = packing.Words(packing.tokenizer_path())
    text = "Plain WORDS and “Quoted” Plain words <|ENDOFTEXT|>"
    wanted = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words.ids(text), "<u4").tolist() == wanted
    kept = set(words.young)
    assert {b"plain", b"words", b"and", "“Quoted”".encode(), b"<|ENDOFTEXT|>"} <= kept and b"Plain" not in kept
