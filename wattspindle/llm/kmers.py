"""Pieces shared by the two operators that look for repeated passages."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspindle.llm.common import id_of

#: (id, tag) names a row: its identifier and a hash of its text.
SPANS = "__id long, __tag long, __spans binary"
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def mix(parts: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of unsigned longs side by side."""
    total = np.zeros(len(parts[0]), np.uint64)
    for part, odd in zip(parts, _ODD, strict=False):
        total = (total ^ part) * odd
        total ^= total >> np.uint64(29)
    return total * _ODD[0] ^ total >> np.uint64(32)


def least_positions(hashes: np.ndarray, length: int, bits: int) -> np.ndarray:
    """For each run of ``length`` hashes the place of the smallest, the leftmost of equals.

    Hashes are compared by their upper 64 - ``bits`` bits; the lower ones hold the place.
    """
    mask = np.uint64((1 << bits) - 1)
    low = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    step = 1
    while 2 * step <= length:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < length:
        low = np.minimum(low[: len(low) - (length - step)], low[length - step :])
    return (low & mask).astype(np.int64)


def pack(arrays: list[np.ndarray], data: bytes = b"", level: int = 1) -> bytes:
    """Arrays of one length, and bytes, in one compressed string.

    The first bytes of an array's numbers stand together, then the second ones: most upper
    bytes are alike and take no room.
    """
    head = struct.pack("<I", len(arrays[0]))
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join([head, *planes, data]), level)


def unpack(blob: bytes, kinds: list[str]) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.decompress(blob)
    (n,) = struct.unpack_from("<I", raw)
    arrays, at = [], 4
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        arrays.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * size
    return arrays, raw[at:]


def span_rows(
    ids: np.ndarray, tags: np.ndarray, begins: np.ndarray, ends: np.ndarray
) -> pa.RecordBatch:
    """One row per document, its spans joined where they touch."""
    order = np.lexsort((begins, tags, ids))
    ids, tags, begins, ends = ids[order], tags[order], begins[order], ends[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])][: len(ids)]
    # Ends so far, restarted at each document by an offset that grows with it.
    group = np.cumsum(new)
    base = group * (int(ends.max(initial=0)) + 2)
    reach = np.maximum.accumulate(ends + base) if len(ids) else base
    fresh = new | np.r_[True, begins[1:] + base[1:] > reach[:-1]][: len(ids)]
    at = np.flatnonzero(fresh)
    last = np.r_[at[1:] - 1, len(ids) - 1][: len(at)]
    pairs = np.stack([begins[at], reach[last] - base[last]], axis=1).astype("<u4")
    heads = np.flatnonzero(new[at])
    offsets = np.r_[heads, len(at)] * 8
    raw = pairs.tobytes()
    values = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[at][heads]), pa.array(tags[at][heads]), pa.array(values, pa.binary())],
        ["__id", "__tag", "__spans"],
    )


def covered(n: int, spans: list[bytes] | None) -> np.ndarray:
    """Which of ``n`` places some span covers."""
    steps = np.zeros(n + 1, np.int64)
    for blob in spans or []:
        pairs = np.frombuffer(blob, "<u4").reshape(-1, 2).astype(np.int64)
        np.add.at(steps, pairs[:, 0], 1)
        np.add.at(steps, pairs[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0


def gathered(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with ``__all``, the list of their span strings, null for rows without."""
    lists = spans.groupBy("__id", "__tag").agg(F.collect_list("__spans").alias("__all"))
    return rows.join(lists, ["__id", "__tag"], "left")


def named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Documents with ``__id`` and ``__tag``: rows that share an id but not a text stay apart."""
    return docs.withColumns({"__id": id_of(f"`{doc_id}`"), "__tag": F.xxhash64(F.col(f"`{text}`"))})


def runs(grams: np.ndarray, length: int, inside: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Super-k-mers: (first window, windows, minimiser's place) of windows that share a minimiser.

    A window starts at each place in ``inside`` and holds ``length`` grams.
    """
    least = least_positions(grams, length, bits)[inside]
    new = np.r_[True, (least[1:] != least[:-1]) | (inside[1:] != inside[:-1] + 1)][: len(inside)]
    heads = np.flatnonzero(new)
    return inside[heads], np.diff(np.r_[heads, len(inside)]), least[heads]


def binary_groups(values: np.ndarray, heads: np.ndarray) -> pa.Array:
    """The values from each head to the next, as binary strings."""
    offsets = (np.r_[heads, len(values)] * values.itemsize).astype("<i4")
    return pa.Array.from_buffers(
        pa.binary(), len(heads), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
    )


#: Blocks whose minimisers are shipped together.
TOGETHER = 16


def pairs(found) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (minimiser, document, times) of a block, by minimiser; its documents ascend."""
    order = np.argsort(found.seed, kind="stable")
    seed, owner = found.seed[order], found.owner[order]
    new = np.r_[True, (seed[1:] != seed[:-1]) | (owner[1:] != owner[:-1])][: len(seed)]
    heads = np.flatnonzero(new)
    return seed[heads], owner[heads], np.diff(np.r_[heads, len(seed)])


def short(seed: np.ndarray) -> np.ndarray:
    """What travels of a minimiser of 48 bits: its bucket holds some millions at most.

    Two alike by chance ship a string too many.
    """
    return (seed >> np.uint64(16)).astype("<u4")


def _flag_rows(seed: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> tuple[pa.Array, ...]:
    """Short minimisers by document: (id, tag, seeds) arrays of one row per document."""
    order = np.lexsort((tags, ids))
    seed, ids, tags = seed[order], ids[order], tags[order]
    heads = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])][: len(ids)])
    return pa.array(ids[heads]), pa.array(tags[heads]), binary_groups(seed, heads)


HINTS = ["bucket", "packed", "__id", "__tag", "__seeds"]


def _hints(slim: DataFrame, blocks_of, buckets: int, within: bool) -> DataFrame:
    """(bucket, packed): minimisers to compare; (__id, __tag, __seeds): those known to recur."""

    def shipped(kept: list[tuple]) -> Iterator[pa.RecordBatch]:
        base = np.cumsum([0, *[len(k[2]) for k in kept]])
        seed, ids, tags = (np.concatenate([k[i] for k in kept]) for i in (0, 2, 3))
        doc = np.concatenate([k[1] + b for k, b in zip(kept, base.tolist(), strict=False)])
        bucket = (seed % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket << 32 | doc)
        seed, doc, bucket = short(seed[order]), doc[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True][: len(bucket) + 1])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            heads = a + np.flatnonzero(np.r_[True, doc[a + 1 : b] != doc[a : b - 1]])
            number = doc[heads]
            times = np.diff(np.r_[heads, b]).astype("<u4")
            yield row(int(bucket[a]), pack([ids[number], tags[number], times], seed[a:b].tobytes()), None)

    def row(bucket: int, packed: bytes | None, flags) -> pa.RecordBatch:
        columns = [pa.array([bucket], pa.int64()), pa.array([packed], pa.binary())]
        columns += [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary())]
        return pa.RecordBatch.from_arrays(columns, HINTS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        for found in blocks_of(batches):
            seed, owner, times = pairs(found)
            if not len(seed):
                continue
            heads = np.flatnonzero(np.r_[True, seed[1:] != seed[:-1]])
            kept.append((seed[heads], owner[heads], found.ids, found.tags))
            n = np.diff(np.r_[heads, len(seed)])
            shared = np.repeat(n > 1, n) | (within & (times > 1))
            if shared.any():
                ids, tags, seeds = _flag_rows(
                    short(seed[shared]), found.ids[owner[shared]], found.tags[owner[shared]]
                )
                # Any bucket will do: these rows pass through.
                bucket = pa.array((ids.to_numpy().view(np.uint64) % np.uint64(buckets)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [bucket, pa.nulls(len(ids), pa.binary()), ids, tags, seeds], HINTS
                )
            if len(kept) == TOGETHER:
                yield from shipped(kept)
                kept = []
        if kept:
            yield from shipped(kept)

    return slim.mapInArrow(run, "bucket long, packed binary, __id long, __tag long, __seeds binary")


def recurring(slim: DataFrame, blocks_of, n: int, within: bool) -> DataFrame:
    """(__id, __tag, __all): each document's minimisers, ``short``, that occur elsewhere too.

    Elsewhere is in another document or, with ``within``, at another place of the same.
    ``blocks_of`` turns batches into blocks of super-k-mers with ``seed``, ``owner``,
    ``ids`` and ``tags``. Hashes travel, not strings. A task ships a minimiser once,
    whatever the number of its documents that hold it, and marks those itself.
    """
    hints = _hints(slim, blocks_of, n, within)
    dealt = hints.repartition(n, "bucket").sortWithinPartitions("bucket")
    names = HINTS[2:]

    def settled(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(blob, ["<i8", "<i8", "<u4"]) for blob in blobs]
        seed = np.concatenate([np.frombuffer(p[1], "<u4") for p in parts])
        ids, tags, times = (np.concatenate([p[0][i] for p in parts]) for i in range(3))
        del parts
        order = np.argsort(seed)
        ordered = seed[order]
        same = ordered[1:] == ordered[:-1]
        rows = order[np.r_[False, same] | np.r_[same, False]]
        if len(rows):
            at = np.searchsorted(np.cumsum(times, dtype=np.int64), rows, side="right")
            yield pa.RecordBatch.from_arrays([*_flag_rows(seed[rows], ids[at], tags[at])], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blobs = None, []
        for batch in batches:
            known = batch.filter(pa.compute.is_null(batch.column("packed")))
            if known.num_rows:
                yield known.select(names)
            for at, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not packed.is_valid:
                    continue
                if at != bucket and blobs:
                    yield from settled(blobs)
                    blobs = []
                bucket = at
                blobs.append(packed.as_py())
        if blobs:
            yield from settled(blobs)

    found = dealt.mapInArrow(run, "__id long, __tag long, __seeds binary")
    return found.groupBy("__id", "__tag").agg(F.collect_list("__seeds").alias("__all"))


#: Documents sampled for frequent minimisers, and how many of these are kept at most.
SAMPLE_DOCS, MOST_FREQUENT = 4000, 20_000


def frequent(slim: DataFrame, blocks_of, bytes_each: int, budget: int) -> np.ndarray:
    """Minimisers whose strings would take more than ``budget`` bytes of one bucket.

    Estimated from a bounded sample of documents. Only the way in which strings travel
    depends on the answer.
    """
    rows = slim.count()
    share = min(1.0, SAMPLE_DOCS / max(rows, 1))
    sample = slim.where(f"pmod(xxhash64(__id, __tag, 7), 1000000) < {share * 1e6:.0f}")

    def run(batches):
        for found in blocks_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(pairs(found)[0].view(np.int64))], ["seed"])

    counts = sample.mapInArrow(run, "seed long").groupBy("seed").count()
    least = max(4.0, budget / bytes_each * share)
    top = counts.where(F.col("count") >= least).orderBy(F.desc("count"), "seed").limit(MOST_FREQUENT)
    return np.array([r.seed for r in top.collect()], np.int64).view(np.uint64)
