"""Repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

In a block of text the transform gives, for the interval of suffixes that start with a
string, the intervals of that string with one more byte in front. Breadth-first backward
extension meets the ends of these intervals by increasing length, and so derives the
longest common prefixes of neighbouring suffixes in the order of their values. It stops
at the minimum length: neighbours that no interval has parted by then share a repeat.

No block holds the corpus. Windows of the minimum length that share a minimiser (the
16-byte gram of least hash in them) travel together as one string, and blocks are made
of the strings of a bucket of minimisers, so equal windows meet in one block. Sixteen
bytes recur by chance in a large corpus, so a minimiser is judged with what stands beside
it: a window holds the bytes up to half its other ones before the minimiser, or behind it.
Documents first ship the hashes of these two keys only; strings follow for those that occur
in more than one document, and only strings that share one go through the transform. Each
task ships a string once, with its smallest document, and settles its larger ones itself,
so copies and common lines add one string per task.
Minimisers that would crowd a bucket, by a bounded sample of documents, have their
windows dealt one by one by the hash of the whole window; the result is the same.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspindle.llm.common import MB, extended, partitions, slices, without
from wattspindle.llm.kmers import (
    SPANS,
    covered,
    frequent,
    gathered,
    mix,
    named,
    pack,
    recurring,
    runs,
    short,
    span_rows,
    unpack,
)

LENGTH = 50
GRAM = 16
#: Bytes handled at once, and the bits that number them.
BLOCK, BLOCK_BITS = MB, 22
#: Blocks whose strings are shipped together.
TOGETHER = 16
#: Shares of a bucket that are settled one after the other.
SHARES = 8
#: A bucket's share of a minimiser's strings beyond which its windows travel alone.
CROWDED = 2 * MB
#: Parts a separator cannot be in: this byte is in no UTF-8 text.
SEPARATOR = 0xFF
#: Of ids, tags, starts, string lengths and the minimisers' places in the strings.
KINDS = ["<i8", "<i8", "<i8", "<u4", "<u4"]


class _Halves(NamedTuple):
    """For each run of windows the hashes of what its left and its right windows hold.

    Windows that are alike have their minimiser at the same place. Left ones have more than
    half of the other bytes before it and hold all bytes of the left key, the others those of
    the right key. So runs without a key in common have no window in common.
    """

    left: np.ndarray
    right: np.ndarray
    has_left: np.ndarray
    has_right: np.ndarray


def _halves(gram, first: np.ndarray, count: np.ndarray, place: np.ndarray, length: int) -> _Halves:
    """``gram`` gives the hashes of the grams at some places."""
    half = (length - GRAM) // 2
    has_left, has_right = place - first > half, place - (first + count - 1) <= half
    middle = gram(place)
    left, right = np.zeros(len(place), np.uint64), np.zeros(len(place), np.uint64)
    left[has_left] = mix([gram(place[has_left] - half - 1), middle[has_left]])
    right[has_right] = mix([middle[has_right], gram(place[has_right] + length - GRAM - half)])
    return _Halves(left >> np.uint64(16), right >> np.uint64(16), has_left, has_right)


def _grams(data: bytes, at: np.ndarray) -> np.ndarray:
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    return mix([eight[at], eight[at + 8]])


def _blocks(
    batches: Iterable[pa.RecordBatch], length: int, text: str = "__text"
) -> Iterator[list[tuple]]:
    """Lists of (id, tag, first byte's number, bytes, flags), long documents with overlap."""
    block, size = [], 0
    for batch in slices(batches, text, 4 * MB):
        columns = [batch.column(c).to_pylist() for c in ("__id", "__tag", text)]
        flags = batch.column("__all").to_pylist() if "__all" in batch.schema.names else columns[0]
        for doc, tag, value, flag in sorted(zip(*columns, flags, strict=True), key=lambda x: x[:2]):
            raw = (value or "").encode()
            for begin in range(0, len(raw) - length + 1, BLOCK):
                part = raw[begin : begin + BLOCK + length - 1]
                block.append((doc, tag, begin, part, flag))
                size += len(part)
                if size >= BLOCK:
                    yield block
                    block, size = [], 0
    if block:
        yield block


class _Block:
    """The super-k-mers of a block of documents, by byte."""

    def __init__(self, block: list[tuple], length: int):
        self.data = b"".join(part[3] for part in block)
        sizes = np.array([len(part[3]) for part in block])
        self.ids = np.array([part[0] for part in block], np.int64)
        self.tags = np.array([part[1] for part in block], np.int64)
        starts = np.cumsum(sizes) - sizes
        self.shift = np.array([part[2] for part in block]) - starts
        n = len(self.data)
        eight = np.ascontiguousarray(np.ndarray((n - 7,), "<u8", self.data, 0, (1,)))
        self.grams = grams = mix([eight[:-8], eight[8:]])
        # The windows that end in the document they start in.
        last = np.maximum(sizes - length + 1, 0)
        inside = np.arange(last.sum()) + np.repeat(starts - (np.cumsum(last) - last), last)
        self.first, self.count, self.place = runs(grams, length - GRAM + 1, inside, BLOCK_BITS)
        self.owner = np.searchsorted(starts, self.first, side="right") - 1
        # A shorter hash travels better; equal ones by chance cost work, not correctness.
        self.seed = grams[self.place] >> np.uint64(16)

    def halves(self, length: int) -> _Halves:
        return _halves(self.grams.__getitem__, self.first, self.count, self.place, length)

    def single(self, crowded: np.ndarray, length: int) -> None:
        """Runs with a crowded minimiser become windows of their own."""
        split = np.isin(self.seed, crowded)
        if not split.any():
            return
        count = self.count[split]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        first = np.repeat(self.first[split], count) + step
        seed = [xxhash.xxh64_intdigest(self.data[i : i + length]) for i in first.tolist()]
        owner = np.r_[self.owner[~split], np.repeat(self.owner[split], count)]
        self.first = np.r_[self.first[~split], first]
        order = np.argsort(self.first, kind="stable")
        self.first, self.owner = self.first[order], owner[order]
        self.place = np.r_[self.place[~split], np.repeat(self.place[split], count)][order]
        self.count = np.r_[self.count[~split], np.ones(len(step), np.int64)][order]
        self.seed = np.r_[self.seed[~split], np.array(seed, np.uint64)][order]


class _Keys:
    """Both keys of the runs of a block, by document."""

    def __init__(self, found: _Block, length: int):
        halves = found.halves(length)
        has = np.stack([halves.has_left, halves.has_right], axis=1)
        self.seed = np.stack([halves.left, halves.right], axis=1)[has]
        self.owner = np.repeat(found.owner, 2)[has.reshape(-1)]
        self.ids, self.tags = found.ids, found.tags


def _strings(flagged: DataFrame, text: str, buckets: int, crowded: np.ndarray, length: int) -> DataFrame:
    """(bucket, strings, spans): packed strings of runs with a recurring key, and settled spans."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        sent: list[list[np.ndarray]] = []
        strings: list[bytes] = []
        blocks = 0
        for block in _blocks(batches, length, text):
            found = _Block(block, length)
            flags = np.unique(np.frombuffer(b"".join(s for p in block for s in p[4] or []), "<u4"))
            halves = found.halves(length)
            keep = np.isin(short(halves.left), flags) & halves.has_left
            keep |= np.isin(short(halves.right), flags) & halves.has_right
            found.first, found.count = found.first[keep], found.count[keep]
            found.owner, found.seed, found.place = found.owner[keep], found.seed[keep], found.place[keep]
            found.single(crowded, length)
            yield from gather(found, known, sent, strings)
            blocks += 1
            if blocks == TOGETHER:
                yield from shipped(sent, strings)
                known, sent, strings, blocks = {}, [], [], 0
        yield from shipped(sent, strings)

    def gather(found: _Block, known: dict, sent: list, strings: list) -> Iterator[pa.RecordBatch]:
        """Keep the strings that no smaller document had before; settle the others."""
        ids, tags = found.ids[found.owner], found.tags[found.owner]
        starts = found.first + found.shift[found.owner]
        data, fresh = found.data, np.ones(len(ids), bool)
        ends = (found.first + found.count + length - 1).tolist()
        for k, (doc, begin, end) in enumerate(zip(ids.tolist(), found.first.tolist(), ends, strict=True)):
            string = data[begin:end]
            if known.setdefault(string, doc) < doc:
                fresh[k] = False
            else:
                strings.append(string)
        places = found.place - found.first
        sent.append([x[fresh] for x in (found.seed, ids, tags, starts, found.count + length - 1, places)])
        if not fresh.all():
            old = ~fresh
            arrays = [ids[old], tags[old], starts[old], starts[old] + found.count[old] + length - 1]
            number = int(found.seed[0] % np.uint64(buckets))
            yield row(number, None, pack([x.astype("<i8") for x in arrays]))

    def shipped(sent: list, strings: list) -> Iterator[pa.RecordBatch]:
        if not strings:
            return
        columns = [np.concatenate(x) for x in zip(*sent, strict=True)]
        bucket = (columns[0] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = order[a:b]
            arrays = [x[part].astype(kind) for x, kind in zip(columns[1:], KINDS, strict=True)]
            blob = pack(arrays, b"".join([strings[i] for i in part.tolist()]), level=3)
            yield row(int(bucket[part[0]]), blob, None)

    def row(number: int, blob: bytes | None, spans: bytes | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([blob], pa.binary()), pa.array([spans], pa.binary())],
            ["bucket", "strings", "spans"],
        )

    return flagged.mapInArrow(run, "bucket long, strings binary, spans binary")


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``depth`` bytes, by doubling.

    A round sorts only those that are still alike in the bytes compared so far; a rank is
    the first place of a suffix's group.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).tobytes()
    key = np.ascontiguousarray(np.ndarray((n,), ">u8", padded, 0, (1,))).astype(np.uint64)
    order = np.argsort(key)
    alike, key, place, reach = order, key[order], np.arange(n), 8
    rank = np.empty(n, np.uint64)
    while True:
        new = np.r_[True, key[1:] != key[:-1]][: len(key)]
        rank[alike] = np.maximum.accumulate(np.where(new, place, 0)).astype(np.uint64)
        tied = ~new
        tied[:-1] |= ~new[1:]
        alike, place = alike[tied], place[tied]
        if reach >= depth or not len(alike):
            return order
        behind = alike + reach
        key = rank[alike] << np.uint64(32)
        inside = behind < n
        key[inside] |= rank[behind[inside]] + np.uint64(1)
        turn = np.argsort(key)
        alike, key = alike[turn], key[turn]
        order[place] = alike
        reach *= 2


def repeat_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes and, for each, the number of its class of equal ``length``-byte starts.

    Starts that reach past a separator are compared up to it only.
    """
    n = len(text)
    order = suffix_order(text, length + 1)
    before = text[order - 1]
    column = np.argsort(before, kind="stable")
    forward = np.empty(n, np.int64)
    forward[column] = np.arange(n)
    head = before[column]
    # parted[i]: neighbours i - 1 and i are known to differ within the lengths so far.
    parted = np.zeros(n + 1, bool)
    parted[0] = True
    rights = np.flatnonzero(np.r_[head[1:] != head[:-1], True])
    lefts = np.r_[0, rights[:-1] + 1]
    parted[rights + 1] = True
    for _ in range(1, length):
        if not len(lefts):
            break
        sizes = rights - lefts + 1
        alone = sizes == 1
        ends = [forward[lefts[alone]][before[lefts[alone]] != SEPARATOR]]
        begins = [ends[0]]
        if not alone.all():
            low, size = lefts[~alone], sizes[~alone]
            group = np.repeat(np.arange(len(low)), size)
            at = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size) + low[group]
            use = before[at] != SEPARATOR
            keys = np.sort(group[use] << 32 | forward[at[use]])
            place, owner = keys & 0xFFFFFFFF, keys >> 32
            new = np.r_[True, (owner[1:] != owner[:-1]) | (head[place[1:]] != head[place[:-1]])]
            first = np.flatnonzero(new[: len(keys)])
            begins.append(place[first])
            ends.append(place[np.r_[first[1:], len(keys)] - 1] if len(first) else place)
        lefts, rights = np.concatenate(begins), np.concatenate(ends)
        fresh = ~parted[rights + 1]
        lefts, rights = lefts[fresh], rights[fresh]
        parted[rights + 1] = True
    return order, np.cumsum(parted[:n]) - 1


def _rivals(data: bytes, first: np.ndarray, count: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Which of these different strings have a key in common with another."""
    halves = _halves(lambda at: _grams(data, at), first, count, place, length)
    rivals = np.zeros(len(first), bool)
    for keys, held in ((halves.left, halves.has_left), (halves.right, halves.has_right)):
        _, at, times = np.unique(keys[held], return_inverse=True, return_counts=True)
        rivals[held] |= times[at] > 1
    return rivals


def _settle(blobs: list[bytes], length: int, buckets: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Spans of one bucket, as arrays of id, tag, begin and end; settled a share at a time."""
    parts = [unpack(blob, KINDS) for blob in blobs]
    columns = [np.concatenate(x) for x in zip(*[p[0] for p in parts], strict=True)]
    data = b"".join(p[1] for p in parts)
    ends = np.cumsum(columns[3].astype(np.int64))
    seed = _grams(data, ends - columns[3] + columns[4])
    share = (seed >> np.uint64(16)) // np.uint64(buckets) % np.uint64(SHARES)
    for number in range(SHARES):
        own = share == np.uint64(number)
        if own.any():
            yield from _settled(seed[own], *[c[own] for c in columns], ends[own], data, length)


def _settled(
    seed: np.ndarray,
    ids: np.ndarray,
    tags: np.ndarray,
    starts: np.ndarray,
    sizes: np.ndarray,
    places: np.ndarray,
    ends: np.ndarray,
    data: bytes,
    length: int,
) -> Iterator[tuple[np.ndarray, ...]]:
    """Spans of strings whose minimisers are nowhere else; a string ends at ``ends`` in ``data``."""
    _, at, times = np.unique(seed, return_inverse=True, return_counts=True)
    rows = np.flatnonzero(times[at] > 1)
    cuts = zip(ids[rows].tolist(), (ends - sizes)[rows].tolist(), ends[rows].tolist(), strict=True)
    number: dict[bytes, int] = {}
    smallest: list[int] = []
    own = np.empty(len(rows), np.int64)
    for k, (doc, begin, end) in enumerate(cuts):
        string = data[begin:end]
        own[k] = at_string = number.setdefault(string, len(smallest))
        if at_string == len(smallest):
            smallest.append(doc)
        elif doc < smallest[at_string]:
            smallest[at_string] = doc
    least = np.array(smallest, np.int64)
    larger = ids[rows] > least[own] if len(rows) else np.zeros(0, bool)
    if larger.any():
        row = rows[larger]
        yield ids[row], tags[row], starts[row], starts[row] + sizes[row]
    # Strings with a key that other strings have too may share windows with them.
    holds = np.empty(len(least), np.int64)
    holds[own] = rows
    begin, size = (ends - sizes)[holds], sizes[holds].astype(np.int64)
    rivals = _rivals(data, begin, size - length + 1, begin + places[holds], length)
    if not rivals.any():
        return
    strings = [s for s, used in zip(number, rivals.tolist(), strict=True) if used]
    text = np.frombuffer(bytes([SEPARATOR]).join(strings) + bytes([SEPARATOR]), np.uint8)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    begins = np.cumsum(lengths + 1) - lengths - 1
    order, kind = repeat_classes(text, length)
    holder = np.repeat(np.arange(len(strings)), lengths + 1)
    doc = least[rivals][holder]
    whole = np.arange(len(text)) - begins[holder] <= lengths[holder] - length
    heads = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]])
    first = np.minimum.reduceat(np.where(whole[order], doc[order], np.iinfo(np.int64).max), heads)
    gone = np.zeros(len(text), bool)
    gone[order] = doc[order] > first[kind]
    window = np.flatnonzero(gone & whole)
    if not len(window):
        return
    # Each place of the string in its smallest document loses these windows.
    place_of = np.full(len(least), -1)
    place_of[np.flatnonzero(rivals)] = np.arange(len(strings))
    row = rows[~larger]
    holds = place_of[own[~larger]]
    row, holds = row[holds >= 0], holds[holds >= 0]
    low = np.searchsorted(holder[window], holds, side="left")
    high = np.searchsorted(holder[window], holds, side="right")
    n = high - low
    row, holds = np.repeat(row, n), np.repeat(holds, n)
    at = window[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
    begin = starts[row] + at - begins[holds]
    yield ids[row], tags[row], begin, begin + length


def repeated_spans(rows: DataFrame, text: str, length: int = LENGTH) -> DataFrame:
    """(__id, __tag, __spans): the byte spans to remove, several rows per document.

    ``rows`` are documents with ``__id`` and ``__tag`` that name them.
    """
    spark = rows.sparkSession
    column = F.col(f"`{text}`")
    slim = rows.select("__id", "__tag", column.alias("__text"))
    amount = slim.agg(F.coalesce(F.sum(F.octet_length("__text")), F.lit(0))).first()[0]

    def blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[_Block]:
        for block in _blocks(batches, length):
            yield _Block(block, length)

    def keys_of(batches: Iterable[pa.RecordBatch]) -> Iterator[_Keys]:
        for found in blocks_of(batches):
            yield _Keys(found, length)

    crowded = frequent(slim, blocks_of, 70, CROWDED)
    # One key in twelve bytes, and four bytes each.
    few = max(12, int(amount * 4 / 12 / (24 * MB)) + 1)
    # The same rows, dealt alike, meet their spans later on: one shuffle of the texts.
    flagged = rows.join(recurring(slim, keys_of, few, within=False), ["__id", "__tag"])
    n = partitions(spark, amount, 24 * MB)
    # A bucket is a partition: a task sends one packet to each, not many small ones.
    shipped = _strings(flagged, text, n, crowded, length)
    dealt = shipped.repartitionById(n, F.col("bucket").cast("int"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = []
        for batch in batches:
            for strings, spans in zip(batch.column(1), batch.column(2), strict=True):
                if spans.is_valid:
                    yield span_rows(*unpack(spans.as_py(), ["<i8"] * 4)[0])
                else:
                    blobs.append(strings.as_py())
        if blobs:
            for arrays in _settle(blobs, length, n):
                yield span_rows(*arrays)

    return dealt.mapInArrow(run, SPANS)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, digest: bool = False
) -> DataFrame:
    """Documents without bytes that a repeated string of ``length`` bytes covers.

    A string goes if it also starts in a document with a smaller identifier; overlaps
    count, and strings are judged on the input. Adds ``n_bytes``, ``n_removed`` and
    ``n_spans`` (maximal removed runs); with ``digest`` also ``kept_sha256`` of the bytes
    that stay, and the text column goes. Without it the text is what stays, where a
    character that lost some of its bytes becomes U+FFFD, and untouched texts stay as
    they are.

    Null and short texts lose nothing; a null identifier orders first. Rows that share
    an identifier are one document and do not remove each other's strings. Input columns
    named like a result are replaced; an empty table gives an empty result.
    """
    added = "n_bytes long, n_removed long, n_spans long" + ", kept_sha256 string" * digest
    kept = without(docs, "n_bytes", "n_removed", "n_spans", *["kept_sha256"] * digest)
    rows = named(kept, doc_id, text)
    joined = gathered(rows, repeated_spans(rows, text, length))
    names = [c for c in kept.columns if not (digest and c == text)]
    schema = extended(kept.select(*[f"`{c}`" for c in names]), added)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 * MB):
            texts, sizes, digests = [], [], []
            for value, spans in zip(
                batch.column(text).to_pylist(), batch.column("__all").to_pylist(), strict=True
            ):
                raw = (value or "").encode()
                gone = covered(len(raw), spans) if spans else np.zeros(len(raw), bool)
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes() if spans else raw
                n_spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                sizes.append((len(raw), len(raw) - len(left), n_spans))
                if digest:
                    digests.append(hashlib.sha256(left).hexdigest())
                else:
                    texts.append(value if len(left) == len(raw) else left.decode(errors="replace"))
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
            columns += [pa.array(x, pa.int64()) for x in zip(*sizes, strict=True)]
            columns += [pa.array(digests, pa.string())] * digest
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)
