from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wattspindle.llm import queries, substring_dedup


def brute(rows, window=20):
    """{row number: (n_words, n_removed, kept)} for (doc_id, text) rows with distinct ids."""
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (doc, _), own in zip(rows, words, strict=True):
        for s in range(len(own) - window + 1):
            key = tuple(own[s : s + window])
            first[key] = min(first.get(key, (doc, s)), (doc, s))
    result = {}
    for n, ((doc, _), own) in enumerate(zip(rows, words, strict=True)):
        gone = set()
        for s in range(len(own) - window + 1):
            if first[tuple(own[s : s + window])] < (doc, s):
                gone.update(range(s, s + window))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        result[n] = (len(own), len(gone), hashlib.sha256(kept).hexdigest())
    return result


def agrees(frame, rows):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()}
    wanted = brute(rows)
    assert found == {rows[n][0]: w for n, w in wanted.items()}
    return wanted


def passages(seed, n=60):
    """Documents that share passages, lines within a document, and near copies."""
    rng = random.Random(seed)
    pool = [[rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(15, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(pool) if rng.random() < 0.6 else [rng.choice("xyz") + str(rng.randint(0, 9)) for _ in range(30)]
        if rows and rng.random() < 0.3:
            words = (rng.choice(rows)[1] or "").split()
            if words:
                words[rng.randrange(len(words))] = "changed"
        rows.append((i * 7 % n, rng.choice([" ", "\n", "  "]).join(words)))
    return rows


def test_query_matches_brute_force(llm, sf_dir, documents):
    rows = list(zip(documents.doc_id, documents.text, strict=True))
    found = agrees(queries.QUERIES["op10_substring_dedup"](llm, sf_dir), rows)
    assert sum(w[1] for w in found.values()) > 0


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("crowded", [2**23, 0])
def test_shared_passages(make, monkeypatch, seed, crowded):
    """Also with frequent minimisers taken as crowded, so that windows travel alone."""
    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)
    rows = passages(seed)
    agrees(substring_dedup.remove_repeats(make(*rows), digest=True), rows)


def test_odd_texts(make, odd_texts):
    rows = [(100 - i, t) for i, t in enumerate(odd_texts)]
    agrees(substring_dedup.remove_repeats(make(*rows), digest=True), rows)


def test_long_documents_are_cut_with_overlap(make, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_WORDS", 50)
    rows = passages(4)
    blocks = [b for b in rows if len((b[1] or "").split()) > 100]
    assert blocks
    agrees(substring_dedup.remove_repeats(make(*rows), digest=True), rows)


def test_text_keeps_what_is_left(make):
    line = " ".join(f"w{i}" for i in range(25))
    docs = make((1, f"start\n{line}\nend", "en", "s", 9), (2, f"other\n{line}  tail", "en", "s", 9), (3, "as\n it  is"))
    docs = docs.withColumn("n_words", F.lit("clash"))
    found = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert found[1].text == f"start\n{line}\nend"
    assert (found[2].text, found[2].n_removed, found[2].n_words) == ("other tail", 25, 27)
    assert found[3].text == "as\n it  is"


def test_null_ids_and_repeated_rows(make):
    line = " ".join(f"w{i}" for i in range(30))
    rows = [(None, line), (4, line), (4, line), (4, line + " more")]
    found = substring_dedup.remove_repeats(make(*rows)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("4", 30), ("4", 30), ("4", 30), ("None", 0)]


def test_empty_table(make):
    assert substring_dedup.remove_repeats(make()).collect() == []
