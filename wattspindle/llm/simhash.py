"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits. It is cut into two halves, so that of two fingerprints
with at most two differing bits one half differs by at most one bit. Each half is
indexed under its 32 one-wildcard variants (one bit deleted): two halves at distance
one or less share a variant. Fingerprints meet by equality of (half, wildcard,
remaining bits), and each meeting is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattspindle.llm.common import MB, NULL_ID, Table, components, extended, id_of, partitions, slices

SEED = 42
SHINGLE = 3
MAX_BITS = 2
#: Larger meetings go on to a second cut, see ``_second_cut``.
MEETING = 4096
#: Meetings up to this size are compared row against following rows, all at once.
SMALL = 48


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles, repeats included; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: len(words) - shingle + 1]
    ends = ends[shingle - 1 :]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(begins), 65536):
        spans = zip(begins[i : i + 65536].tolist(), ends[i : i + 65536].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > len(begins)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The input with ``__fp``, the fingerprint as a signed long."""
    schema = extended(docs, "__fp long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 16 * MB):
            values = [fingerprint(t, shingle) for t in batch.column(text).to_pylist()]
            found = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "__fp"])

    return docs.mapInArrow(run, schema)


def _variants(distinct: DataFrame) -> DataFrame:
    """(key, fp, rep) for the 64 one-wildcard variants of each distinct fingerprint."""
    wild = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("w")
    return distinct.select("fp", "rep", wild).select(
        F.expr(
            "(cast(w as bigint) << 32) | "
            "((shiftrightunsigned(fp, if(w < 32, 0, 32)) & 4294967295L) & ~(1L << (w % 32)))"
        ).alias("key"),
        "fp",
        "rep",
    )


def _second_cut(crowded: DataFrame) -> DataFrame:
    """Longer keys for fingerprints that meet under one key in great numbers.

    They share 31 bits of one half, and linked ones differ by at most two bits in the
    other. That half is cut in two again and indexed under 32 one-wildcard variants.
    """
    wild = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("v")
    return crowded.select("key", "fp", "rep", wild).select(
        F.expr(
            "(key << 21) | (cast(v as bigint) << 16) | "
            "(shiftrightunsigned(fp, if(shiftright(key, 32) < 32, 32, 0) + if(v < 16, 0, 16))"
            " & 65535L & ~(1L << (v % 16)))"
        ).alias("key"),
        "fp",
        "rep",
    )


def _meet(rows: DataFrame, n: int, first: bool) -> DataFrame:
    """Links among fingerprints under one key: (a, b) of two representatives.

    In the first cut, rows of crowded keys come back unlinked, with their key.
    """
    dealt = rows.repartition(n, "key").sortWithinPartitions("key", "fp")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        hot = None
        for batch in batches:
            new = [batch.column(i).to_numpy() for i in range(3)]
            new[1] = new[1].view(np.uint64)
            rows = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            if hot is not None:
                cut = int(np.searchsorted(rows[0], hot, side="right"))
                yield _unlinked([x[:cut] for x in rows])
                rows = [x[cut:] for x in rows]
                hot = hot if not len(rows[0]) else None
            if not len(rows[0]):
                rest = rows
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            yield from _linked(*[x[:cut] for x in rows], first)
            rest = [x[cut:] for x in rows]
            if first and len(rest[0]) > MEETING:
                hot = int(rest[0][0])
                yield _unlinked(rest)
                rest = [x[:0] for x in rest]
        yield from _linked(*rest, first)

    return dealt.mapInArrow(run, "a long, b long, key long")


def _batch(a: np.ndarray, b: np.ndarray, key: np.ndarray | None) -> pa.RecordBatch:
    keys = pa.nulls(len(a), pa.int64()) if key is None else pa.array(key)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), keys], ["a", "b", "key"])


def _unlinked(rows: list[np.ndarray]) -> pa.RecordBatch:
    return _batch(rows[1].view(np.int64), rows[2], rows[0])


def _owned(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether this key is the lowest that two fingerprints, differing in x, share."""
    low, high = x & np.uint64(0xFFFFFFFF), x >> np.uint64(32)
    in_low = np.bitwise_count(low) <= 1
    half = np.where(in_low, low, high)
    lowest = np.where(half == 0, 0, np.log2(np.maximum(half, 1)).astype(np.int64))
    return key >> 32 == np.where(in_low, lowest, lowest + 32)


def _linked(
    key: np.ndarray, fp: np.ndarray, rep: np.ndarray, first: bool
) -> Iterator[pa.RecordBatch]:
    if not len(key):
        return
    begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[begins, len(key)])
    small = np.repeat(sizes <= SMALL, sizes)
    at = np.flatnonzero(small[:-1] & (key[1:] == key[:-1])) if len(key) > 1 else begins[:0]
    step = 1
    while len(at):
        x = fp[at] ^ fp[at + step]
        found = np.bitwise_count(x) <= MAX_BITS
        if first:
            found &= _owned(x, key[at])
        if found.any():
            one, two = rep[at[found]], rep[at[found] + step]
            yield _batch(np.minimum(one, two), np.maximum(one, two), None)
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at + step] == key[at]]
    for begin, size in zip(begins[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        part = slice(int(begin), int(begin + size))
        if size > MEETING and first:
            yield _unlinked([key[part], fp[part], rep[part]])
        elif size > MEETING:
            yield from _by_flips(fp[part], rep[part])
        else:
            yield _forest(fp[part], rep[part], int(key[begin]), first)


def _forest(fp: np.ndarray, rep: np.ndarray, key: int, first: bool) -> pa.RecordBatch:
    """Links that connect what is linked: breadth-first, one link per row at most."""
    left = np.arange(1, len(fp))
    border, edges = [0], []
    while len(left):
        if not border:
            border, left = [int(left[0])], left[1:]
            continue
        now = border.pop()
        x = fp[left] ^ fp[now]
        near = np.bitwise_count(x) <= MAX_BITS
        if first:
            near &= _owned(x, np.int64(key))
        if near.any():
            hits = left[near]
            edges.append(np.stack([np.full(len(hits), rep[now]), rep[hits]]))
            border.extend(hits.tolist())
            left = left[~near]
    pairs = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), np.int64)
    return _batch(pairs.min(axis=0), pairs.max(axis=0), None)


def _by_flips(fp: np.ndarray, rep: np.ndarray) -> Iterator[pa.RecordBatch]:
    """After the second cut at most 18 bits vary: look up each change of one or two of them."""
    order = np.argsort(fp)
    fp, rep = fp[order], rep[order]
    varying = int(np.bitwise_or.reduce(fp ^ fp[0]))
    bits = [1 << i for i in range(64) if varying >> i & 1]
    for i, one in enumerate(bits):
        for two in [0, *bits[i + 1 :]]:
            other = fp ^ np.uint64(one | two)
            at = np.minimum(np.searchsorted(fp, other), len(fp) - 1)
            found = (fp[at] == other) & (fp < other)
            if found.any():
                a, b = rep[found], rep[at[found]]
                yield _batch(np.minimum(a, b), np.maximum(a, b), None)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``fingerprint`` has 16 hex digits. Fingerprints that differ by two bits or fewer are
    linked; ``component_id`` is the smallest identifier reachable. Equal fingerprints are
    one node, whatever their number. A null or word-less text has fingerprint zero, which
    links like any other. A null identifier orders first, so its component has a null
    ``component_id``. Rows that share an identifier are one document; repeated rows come
    back as often as they came in. An empty table gives an empty result.
    """
    marked, distinct = _distinct(docs, doc_id, text, shingle)
    found = components(_links(distinct))
    labelled = distinct.join(found, distinct["rep"] == found["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component")
    )
    return marked.join(labelled, marked["__fp"] == labelled["fp"]).select(
        F.expr(f"nullif(__id, {NULL_ID})").alias("doc_id"),
        F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"),
        F.expr(f"nullif(component, {NULL_ID})").alias("component_id"),
    )


def _distinct(docs: DataFrame, doc_id: str, text: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(__id, __fp) of every row, and (fp, rep): each fingerprint with its smallest identifier."""
    slim = docs.select(id_of(doc_id).alias("__id"), F.col(f"`{text}`").alias("__text"))
    marked = Table(fingerprints(slim, "__text", shingle).drop("__text"), "fingerprints").df
    distinct = marked.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("rep"))
    return marked, Table(distinct, "distinct").df


def _links(distinct: DataFrame) -> DataFrame:
    """(a, b): the representatives of fingerprints that are linked."""
    spark = distinct.sparkSession
    n = partitions(spark, 64 * distinct.count(), 1_000_000)
    met = Table(_meet(_variants(distinct), n, first=True), "met").df
    edges = met.where("key is null").select("a", "b")
    crowded = met.where("key is not null").select("key", F.col("a").alias("fp"), F.col("b").alias("rep"))
    more = crowded.count()
    if more:
        again = _meet(_second_cut(crowded), partitions(spark, 32 * more, 1_000_000), first=False)
        edges = edges.union(again.select("a", "b"))
    return edges


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay: of each component the one with the smallest identifier.

    Components are of fingerprints here, so that rows without an identifier, or with the
    same one, stand together only if their texts do. Of rows that share identifier and
    fingerprint one stays, the first by text and then by the other columns. Columns are
    those of ``docs``.
    """
    marked, distinct = _distinct(docs, doc_id, text, SHINGLE)
    found = components(_links(distinct.select("fp", F.col("fp").alias("rep"))))
    labelled = distinct.join(found, distinct["fp"] == found["node"], "left")
    kept = (
        labelled.groupBy(F.coalesce("component", "fp"))
        .agg(F.min(F.struct("rep", "fp")).alias("first"))
        .select(F.col("first.rep").alias("__kept"), F.col("first.fp").alias("__kept_fp"))
    )
    kept = Table(kept, "kept").df
    kept_docs = docs.join(kept, id_of(doc_id) == kept["__kept"], "left_semi")
    if not marked.groupBy("__id").count().where("count > 1").limit(1).count():
        return kept_docs
    same = (id_of(doc_id) == kept["__kept"]) & (F.col("__fp") == kept["__kept_fp"])
    marked_docs = fingerprints(kept_docs, text).join(kept, same, "left_semi")
    others = [f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString() and f.name != text]
    order = Window.partitionBy(id_of(doc_id), "__fp").orderBy(f"`{text}`", *others)
    return marked_docs.withColumn("__n", F.row_number().over(order)).where("__n = 1").select(
        *[f"`{c}`" for c in docs.columns]
    )
