from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspindle.llm import line_dedup
from wattspindle.llm.line_dedup import Cuckoo, LineIndex, Shards

BLANK = " \t\n\x0b\x0c\r"


def key(line: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANK))


def crowded(texts: list, bound: int) -> set[str]:
    counts = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    return {k for k, n in counts.items() if n >= bound and k}


def cleaned(text, gone: set[str]) -> tuple[int, int, str]:
    lines = (text or "").split("\n")
    stay = [x for x in lines if key(x) not in gone]
    return len(lines), len(lines) - len(stay), "\n".join(stay)


def digest_rows(rows: list, gone: set[str]) -> list[tuple]:
    out = []
    for i, t in rows:
        n, dropped, text = cleaned(t, gone)
        out.append((i, n, dropped, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df) -> list[tuple]:
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.fixture
def pairs(make):
    return lambda *rows: make(*rows).select("doc_id", "text")


@pytest.fixture(params=["filters", "joins"])
def way(request, monkeypatch):
    """Both ways of cleaning: filters in the tasks, or a join where they are too large."""
    if request.param == "joins":
        monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    return request.param


def test_query_matches_plain_python(llm, sf_dir, documents, way):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    index = LineIndex(llm)
    index.insert(docs)
    rows = [(r.doc_id, r.text) for r in documents.itertuples()]
    gone = crowded([t for _, t in rows], 10)
    assert gone and rows_of(index.clean(docs, digest=True)) == digest_rows(rows, gone)


def test_lines_come_back_when_documents_go(llm, pairs, way):
    rows = [(i, f"Head\nbody {i}\n  FOOT {i % 3} ") for i in range(24)] + [(50, None), (51, "")]
    index = LineIndex(llm, min_docs=8)
    index.insert(pairs(*rows[:10]))
    index.insert(pairs(*rows[10:]))

    def state(present):
        gone = crowded([t for _, t in present], 8)
        assert rows_of(index.clean(pairs(*present), digest=True)) == digest_rows(present, gone)
        # The filters hold the crowded keys and nothing else.
        assert sum(r.held for r in index._read(index.state["filters"], line_dedup.FILTER).collect()) == len(gone)
        counts = {(r.hi, r.lo): r.n for r in index.counts().collect()}
        expected = Counter(k for _, t in present for k in {key(x) for x in (t or "").split("\n")} if k)
        assert sorted(counts.values()) == sorted(expected.values())
        return gone

    assert state(rows) == {"head", "foot 0", "foot 1", "foot 2"}
    index.delete(pairs(rows[0], rows[3]))
    assert state([r for r in rows if r[0] not in (0, 3)]) == {"head", "foot 1", "foot 2"}
    index.delete(pairs(*[r for r in rows[1:20] if r[0] != 3]))
    assert state([r for r in rows if r[0] >= 20]) == set()
    index.insert(pairs(*rows[:20]))
    assert state(rows) == {"head", "foot 0", "foot 1", "foot 2"}


def test_an_index_is_reopened_compacted_and_vacuumed(llm, pairs, tmp_path):
    path, rows = f"file://{tmp_path}/lines", [(i, f"same\nown {i}") for i in range(30)]
    for i in range(0, 30, 3):
        LineIndex(llm, path, min_docs=30).insert(pairs(*rows[i : i + 3]))
    index = LineIndex(llm, path)
    assert index.version == 10 and len(index.state["changes"]) <= line_dedup.CHANGES
    assert rows_of(index.clean(pairs(*rows), digest=True)) == digest_rows(rows, {"same"})
    index.vacuum()
    again = LineIndex(llm, path)
    assert again.versions.numbers() == [10]
    assert len(again.versions.folders("")) <= line_dedup.CHANGES + 2
    again.delete(pairs(rows[0]))
    assert rows_of(again.clean(pairs(*rows[1:]), digest=True)) == digest_rows(rows[1:], set())


def test_a_document_that_is_not_there_cannot_go(llm, pairs):
    index = LineIndex(llm, min_docs=2)
    index.insert(pairs((1, "a\nb"), (2, "a")))
    before = rows_of(index.counts())
    with pytest.raises(ValueError, match="not inserted"):
        index.delete(pairs((3, "c")))
    assert index.version == 1 and rows_of(index.counts()) == before
    index.insert(pairs((4, "b")))
    assert rows_of(index.clean(pairs((1, "a\nb")), digest=True)) == digest_rows([(1, "a\nb")], {"a", "b"})


def test_a_shard_that_is_full_is_made_anew(llm, pairs):
    index = LineIndex(llm, min_docs=1)
    index.insert(pairs((1, "\n".join(f"first {i}" for i in range(300)))))
    more = "\n".join(f"second {i}" for i in range(9000))
    index.insert(pairs((2, more)))
    rows = rows_of(index.clean(pairs((2, more), (3, None)), digest=True))
    assert rows == digest_rows([(2, more), (3, None)], {key(x) for x in more.split("\n")})
    held = index._read(index.state["filters"], line_dedup.FILTER).collect()
    assert sum(r.held for r in held) == 9300 and not any(r.full for r in held)


def test_odd_rows_and_clashing_columns(llm, make, pairs, odd_texts, way):
    rows = [(i, t) for i, t in enumerate(odd_texts * 5)] + [(None, "one"), (3, "one")]
    index = LineIndex(llm, min_docs=5)
    docs = make(*rows).withColumnRenamed("lang", "n_dropped").withColumn("__of", F.lit(1))
    index.insert(docs)
    gone = crowded([t for _, t in rows], 5)
    out = index.clean(docs)
    assert out.columns == ["doc_id", "text", "source", "n_chars", "n_lines", "n_dropped"]
    expected = sorted([(i, None if t is None else cleaned(t, gone)[2], *cleaned(t, gone)[:2]) for i, t in rows], key=str)
    assert rows_of(out.select("doc_id", "text", "n_lines", "n_dropped")) == expected
    empty = LineIndex(llm)
    assert rows_of(empty.clean(pairs((1, "a")), digest=True)) == digest_rows([(1, "a")], set())
    empty.insert(pairs())
    assert empty.clean(pairs()).collect() == []


def test_short_keys_are_counted_by_code_points(llm, pairs):
    docs = pairs((1, "ab\nüüü\nabc"), (2, "ab\nüüü\nabc"))
    index = LineIndex(llm, min_docs=2, min_chars=3)
    index.insert(docs)
    assert [r.text for r in index.clean(docs).collect()] == ["ab", "ab"]


def test_cuckoo_filter_takes_in_and_out():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, (4000, 2)).astype(np.uint64) * np.uint64(2)
    made = Cuckoo.of(keys)

    def held(which):
        return Shards([{"shard": s, "slots": made.slots.tobytes()} for s in range(1 << line_dedup.SHARD_BITS)]).holds(which)

    assert held(keys).all() and made.held == 4000
    made.remove(keys[:1500])
    assert held(keys[1500:]).all() and not held(keys[:1500]).any()
    with pytest.raises(ValueError):
        made.remove(keys[:1])
    # Keys alike in fingerprint and buckets are one to the filter, but each counts.
    twins = np.repeat(keys[:1], 3, axis=0)
    assert made.insert(twins)
    made.remove(twins[:2])
    assert held(keys[:1]).all()
    assert not Cuckoo.sized(1).insert(np.repeat(keys[:1], 9, axis=0))


def test_listed_strangers_are_not_dropped():
    both = line_dedup.hashes([b"a", b"b"])
    shard = (both[:, 0] >> np.uint64(64 - line_dedup.SHARD_BITS)).astype(int)
    rows = [{"shard": int(s), "slots": Cuckoo.of(both[shard == s]).slots.tobytes()} for s in set(shard.tolist())]
    shards, stranger = Shards(rows), tuple(both[1].view(np.int64).tolist())
    assert line_dedup._held([b"a", b"b", b"c"], shards, set()) == {b"a", b"b"}
    assert line_dedup._held([b"a", b"b", b"c"], shards, {stranger}) == {b"a"}
