from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspindle.llm import queries, suffix_dedup
from wattspindle.llm.kmers import mix, pack, span_rows


def brute(rows, length=50):
    """{row: (bytes, removed, runs, kept)}; rows are (id, text), an id names one document."""
    raws = [(t or "").encode() for _, t in rows]
    first = {}
    for (doc, _), raw in zip(rows, raws, strict=True):
        for s in range(len(raw) - length + 1):
            key = raw[s : s + length]
            first[key] = min(first.get(key, doc), doc)
    result = []
    for (doc, _), raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < doc:
                gone[s : s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        result.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result)


def agrees(frame, rows):
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect())
    wanted = brute(rows)
    assert found == wanted
    return wanted


def passages(seed, n=60):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(30, 150))) for _ in range(8)]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            text += rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choice("xyz東 ") for _ in range(60))
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1]
            cut = rng.randrange(len(text) + 1)
            text = text[:cut] + "#" + text[cut:]
        rows.append((i * 7 % n, text))
    return rows


def test_query_matches_brute_force(llm, sf_dir, documents):
    rows = list(zip(documents.doc_id, documents.text, strict=True))
    found = agrees(queries.QUERIES["op2_suffix_dedup"](llm, sf_dir), rows)
    assert sum(r[2] for r in found) > 0


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize(("crowded", "block"), [(2**21, 2**20), (0, 2**20), (2**21, 120)])
def test_shared_passages(make, monkeypatch, seed, crowded, block):
    """Also with windows that travel alone, and with documents cut in blocks."""
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rows = passages(seed)
    agrees(suffix_dedup.remove_repeats(make(*rows), digest=True), rows)


def test_odd_texts(make, odd_texts):
    rows = [(100 - i, t) for i, t in enumerate([*odd_texts, "ab" * 200, "xab" * 100])]
    agrees(suffix_dedup.remove_repeats(make(*rows), digest=True), rows)


def test_shared_ids_null_ids_and_text(make):
    line = "".join(f"w{i} " for i in range(30))
    rows = [(4, line), (4, line), (4, line + "more"), (7, "é" + line)]
    agrees(suffix_dedup.remove_repeats(make(*rows), digest=True), rows)
    docs = make((None, line), (1, "start " + line + "end"), (2, None)).withColumn("n_spans", F.lit("clash"))
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert (found[None].text, found[None].n_removed) == (line, 0)
    assert (found[1].text, found[1].n_spans) == ("start end", 1)
    assert (found[2].text, found[2].n_bytes) == (None, 0)
    assert suffix_dedup.remove_repeats(make()).collect() == []


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("length", [3, 5, 50])
def test_expansion_gives_the_classes_of_equal_starts(seed, length):
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 120))) for _ in range(12)]
    strings += [s[3:] + b"a" for s in strings[:6]] + [b"ab" * 60, b"a" * 90]
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    order, kind = suffix_dedup.repeat_classes(text, length)
    raw = text.tobytes()
    groups = {}
    for place, k in zip(order.tolist(), kind.tolist(), strict=True):
        if b"\xff" not in raw[place : place + length] and place + length <= len(raw):
            groups.setdefault(raw[place : place + length], set()).add(k)
    assert all(len(k) == 1 for k in groups.values())
    assert len({next(iter(k)) for k in groups.values()}) == len(groups)


@pytest.mark.parametrize("seed", range(4))
def test_suffixes_are_in_order(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.integers(97, 97 + 1 + seed, rng.integers(1, 90)).astype(np.uint8).tobytes() for _ in range(60)]
    raw = bytes([suffix_dedup.SEPARATOR]).join([*parts, *parts[:20], b"a" * 300]) + bytes([suffix_dedup.SEPARATOR])
    for depth in (1, 8, 9, 51):
        order = suffix_dedup.suffix_order(np.frombuffer(raw, np.uint8), depth).tolist()
        assert sorted(order) == list(range(len(raw)))
        found = [raw[i : i + depth].ljust(depth, b"\0") for i in order]
        assert found == sorted(found)


def common_gram(rng):
    """Sixteen bytes that are the minimiser of most windows that hold them."""
    grams = ["".join(rng.choices("abcdefgh", k=16)) for _ in range(3000)]
    eight = np.array([np.frombuffer(g.encode(), "<u8") for g in grams])
    return grams[int(np.argmin(mix([eight[:, 0], eight[:, 1]])))]


def strewn(rng, n):
    return "".join(rng.choices("abcdefghijklmnop", k=n))


def test_grams_that_recur_by_chance_ship_no_text(make, monkeypatch):
    """Texts with sixteen bytes in common, and no window, are left out before strings travel."""
    rng = random.Random(11)
    gram = common_gram(rng)
    rows = [(i, strewn(rng, 80) + gram + strewn(rng, 80)) for i in range(30)]
    shared = strewn(rng, 20) + gram + strewn(rng, 20)
    rows += [(i, strewn(rng, 60) + shared + strewn(rng, 60)) for i in range(30, 33)]
    seen, strings = [], suffix_dedup._strings

    def spy(flagged, *others):
        seen.extend(r.doc_id for r in flagged.select("doc_id").collect())
        return strings(flagged, *others)

    monkeypatch.setattr(suffix_dedup, "_strings", spy)
    found = agrees(suffix_dedup.remove_repeats(make(*rows), digest=True), rows)
    assert [r[0] for r in found if r[2]] == [31, 32]
    assert sorted(seen) == [30, 31, 32]


def settled(rows, length=50):
    """The spans of strings of all rows, in one bucket."""
    found = suffix_dedup._Block([(doc, 0, 0, text.encode(), None) for doc, text in rows], length)
    sizes = found.count + length - 1
    starts = found.first + found.shift[found.owner]
    columns = [found.ids[found.owner], found.tags[found.owner], starts, sizes, found.place - found.first]
    data = b"".join(found.data[a : a + n] for a, n in zip(found.first.tolist(), sizes.tolist(), strict=True))
    kinds = zip(columns, suffix_dedup.KINDS, strict=True)
    blob = pack([c.astype(kind) for c, kind in kinds], data)
    gone = {doc: bytearray(len(text)) for doc, text in rows}
    for arrays in suffix_dedup._settle([blob], length, 1):
        batch = span_rows(*arrays)
        for doc, spans in zip(batch.column("__id").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
            for begin, end in np.frombuffer(spans, "<u4").reshape(-1, 2).tolist():
                gone[doc][begin:end] = b"\1" * (end - begin)
    return {doc: sum(g) for doc, g in gone.items()}


def test_only_strings_with_half_a_window_in_common_are_transformed(monkeypatch):
    rng = random.Random(12)
    gram = common_gram(rng)
    chance = [(i, strewn(rng, 80) + gram + strewn(rng, 80)) for i in range(40)]
    shared = strewn(rng, 30) + gram + strewn(rng, 4)
    related = [(i, strewn(rng, 60) + shared + strewn(rng, 60)) for i in range(40, 43)]
    sizes, classes = [], suffix_dedup.repeat_classes

    def spy(text, length):
        sizes.append(len(text))
        return classes(text, length)

    monkeypatch.setattr(suffix_dedup, "repeat_classes", spy)
    assert not any(settled(chance).values()) and not sizes
    wanted = {doc: removed for doc, _, removed, _, _ in brute([*chance, *related])}
    assert settled([*chance, *related]) == wanted and wanted[41] >= 50
    assert 0 < sum(sizes) < 3 * 3 * 100


@pytest.mark.parametrize("length", [16, 17, 33, 50, 51, 120])
def test_windows_alike_have_a_key_in_common(length):
    """However long a window is, and whatever stands around it."""
    rng = random.Random(length)
    shared = strewn(rng, length)
    rows = [(i, strewn(rng, rng.randint(0, 60)) + shared + strewn(rng, rng.randint(0, 60))) for i in range(40)]
    rows += [(i, text[: len(text) // 2] + "#" + text[len(text) // 2 :]) for i, (_, text) in enumerate(rows, 40)]
    assert settled(rows, length) == {doc: removed for doc, _, removed, _, _ in brute(rows, length)}
