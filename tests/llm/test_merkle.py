from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wattspindle.llm import merkle

FULL = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top of a tree and the way up from each node, level by level."""
    ways = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_below = [], []
        for b in range(0, len(nodes), 16):
            run = nodes[b : b + 16]
            for j in range(len(run)):
                for leaf in below[b + j]:
                    ways[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(h(*run))
            up_below.append(sum(below[b : b + 16], []))
        nodes, below = up, up_below
    return nodes[0], ways


def by_hand(rows: list[tuple]) -> list[tuple]:
    sources: dict = {}
    for row in rows:
        leaf = h(*map(field, row))
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf, row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(sources[s], key=lambda x: x[:3]) for s in names}
    made = {s: climb([x[2] for x in ordered[s]]) for s in names}
    root, ways = climb([made[s][0] for s in names]) if names else (None, [])
    out = []
    for s, upper in zip(names, ways, strict=True):
        for (_, _, leaf, row), lower in zip(ordered[s], made[s][1], strict=True):
            way, text = lower + upper, row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if c.isascii() else c for c in text)
            node = h(*map(field, (*row[:4], text)))
            for left, right in way:
                node = h(left, node, right)
            proof = h(*[left + right for left, right in way])
            out.append((row[0], leaf, made[s][0], root, proof, node, node == root))
    return sorted(out, key=str)


def rows_of(df) -> list[tuple]:
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_query_matches_plain_python(llm, sf_dir):
    rows = [tuple(r) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").select(*merkle.FIELDS).collect()]
    found = merkle.tamper_check(llm.read.parquet(f"{sf_dir}/documents.parquet"))
    assert rows_of(found) == by_hand(rows)


@pytest.mark.parametrize("sizes", [[], [1], [2], [16], [17], [1, 1, 1], [257, 1, 33], [5] * 40])
def test_trees_of_all_shapes(llm, sizes):
    rows = [
        (1000 * s + i, f"s{s:02}" if s else None, "de", i, f"Text {i} of {s}") for s, n in enumerate(sizes) for i in range(n)
    ]
    assert rows_of(merkle.tamper_check(llm.createDataFrame(rows, FULL))) == by_hand(rows)


def test_nulls_repeats_ties_and_clashing_columns(llm, odd_texts):
    rows = [(i, "a" if i % 3 else None, None, None, t) for i, t in enumerate(odd_texts)]
    rows += [(None, "a", "x", 1, "N"), (None, "a", "x", 1, "M"), (3, "a", None, 2, "Q"), (3, "a", None, 2, "Q"), (4, "", "", 0, "")]
    docs = llm.createDataFrame(rows, FULL).withColumns({c: F.lit("x") for c in ("leaf", "path", "tree", "idx", "at", "of", "root")})
    assert rows_of(merkle.tamper_check(docs)) == by_hand(rows)


def test_a_hot_ancestor_is_dealt_to_copies(llm, monkeypatch):
    monkeypatch.setattr(merkle, "HOT", 20)
    rows = [(i, "hot" if i < 700 else f"s{i % 5}", "en", 1, f"T{i}") for i in range(900)]
    assert rows_of(merkle.tamper_check(llm.createDataFrame(rows, FULL))) == by_hand(rows)


def test_a_proof_tells_a_changed_or_moved_document(llm):
    rows = [(i, f"s{i % 3}", "en", 4, f"text {i}") for i in range(120)]
    docs = llm.createDataFrame(rows, FULL)
    later = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    proofs = merkle.manifest(docs, also={"now": merkle.leaf_of(later), "swapped": merkle.leaf_of(F.lit("text 1"))})
    checked = proofs.select(
        "doc_id",
        "place",
        (merkle.fold(F.col("path"), F.col("leaf")) == F.col("root")).alias("whole"),
        (merkle.fold(F.col("path"), F.col("now")) == F.col("root")).alias("still"),
        (merkle.fold(F.col("path"), F.col("swapped")) == F.col("root")).alias("other"),
    ).collect()
    assert all(r.whole for r in checked) and len(checked) == 120
    assert {r.doc_id for r in checked if not r.still} == {i for i in range(120) if i % 7 == 0}
    assert [r.doc_id for r in checked if r.other] == [1]
    assert sorted(r.place for r in checked if r.doc_id % 3 == 0) == list(range(40))
