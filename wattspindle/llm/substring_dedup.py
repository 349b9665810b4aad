"""Repeated word windows by super-k-mer partitioning.

A window is a number of consecutive words. Its minimiser is the word triple of least
hash in it. Consecutive windows of a document that share a minimiser travel as one
packed string to the bucket of that minimiser, where equal windows are sure to meet;
there the windows are sorted, and all but the first of equal ones are removed. Before
that, documents ship the hashes of their minimisers only: strings follow for those that
occur more than once.

Each task ships a string once, with its first place; later places of a string that the
task has seen itself are removed at once. So copies of a document, or a line that every
document holds, add one string per task to a bucket, not one per copy. Minimisers that
would crowd a bucket, by a bounded sample of documents, have varying surroundings in
great number: their windows travel one by one, dealt by the hash of the whole window.
The sample decides the way windows travel, never the result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

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

WINDOW = 20
GRAM = 3
#: Words handled at once, and the bits that number them.
BLOCK_WORDS, BLOCK_BITS = 200_000, 21
#: A bucket's share of a minimiser's strings beyond which its windows travel alone.
CROWDED = 8 * MB
KINDS = ["<u8", "<i8", "<i8", "<i8", "<u4", "<u4"]


def _blocks(
    batches: Iterable[pa.RecordBatch], window: int, text: str = "__text"
) -> Iterator[list[tuple]]:
    """Lists of (id, tag, first word's number, words, flags), long documents with overlap."""
    block, size = [], 0
    for batch in slices(batches, text, 4 * MB):
        columns = [batch.column(c).to_pylist() for c in ("__id", "__tag", text)]
        flags = batch.column("__all").to_pylist() if "__all" in batch.schema.names else columns[0]
        for doc, tag, value, flag in sorted(zip(*columns, flags, strict=True), key=lambda x: x[:2]):
            words = (value or "").encode().split()
            for begin in range(0, len(words) - window + 1, BLOCK_WORDS):
                part = words[begin : begin + BLOCK_WORDS + window - 1]
                block.append((doc, tag, begin, part, flag))
                size += len(part)
                if size >= BLOCK_WORDS:
                    yield block
                    block, size = [], 0
    if block:
        yield block


class _Runs:
    """The super-k-mers of a block: windows that share a minimiser, one after the other."""

    def __init__(self, block: list[tuple], window: int):
        words = [w for part in block for w in part[3]]
        sizes = np.array([len(part[3]) for part in block])
        self.ids = np.array([part[0] for part in block], np.int64)
        self.tags = np.array([part[1] for part in block], np.int64)
        self.owner = np.repeat(np.arange(len(block)), sizes)
        self.number = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.number += np.repeat(np.array([part[2] for part in block]), sizes)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(lengths + 1) - 1
        self.begins = self.ends - lengths
        self.joined = b" ".join(words)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        grams = mix([hashes[i : len(hashes) - GRAM + 1 + i] for i in range(GRAM)])
        inside = np.flatnonzero(self.owner[: len(words) - window + 1] == self.owner[window - 1 :])
        self.first, self.count, place = runs(grams, window - GRAM + 1, inside, BLOCK_BITS)
        # A shorter hash travels better; equal ones by chance cost work, not correctness.
        self.seed = grams[place] >> np.uint64(16)
        self.owner = self.owner[self.first]

    def keep(self, chosen: np.ndarray) -> None:
        self.first, self.count = self.first[chosen], self.count[chosen]
        self.seed, self.owner = self.seed[chosen], self.owner[chosen]

    def single(self, crowded: np.ndarray, window: int) -> None:
        """Runs with a crowded minimiser become windows of their own."""
        split = np.isin(self.seed, crowded)
        if not split.any():
            return
        count = self.count[split]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        first = np.repeat(self.first[split], count) + step
        begins, ends = self.begins[first].tolist(), self.ends[first + window - 1].tolist()
        seed = [xxhash.xxh64_intdigest(self.joined[a:b]) for a, b in zip(begins, ends, strict=True)]
        owner = np.r_[self.owner[~split], np.repeat(self.owner[split], count)]
        first = np.r_[self.first[~split], first]
        order = np.argsort(first, kind="stable")
        self.first, self.owner = first[order], owner[order]
        self.count = np.r_[self.count[~split], np.ones(len(step), np.int64)][order]
        self.seed = np.r_[self.seed[~split], np.array(seed, np.uint64)][order]


def _shipped(
    flagged: DataFrame, text: str, buckets: int, crowded: np.ndarray, window: int
) -> DataFrame:
    """(bucket, strings, spans): packed strings by bucket, and spans that are settled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, window, text):
            found = _Runs(block, window)
            flags = np.unique(np.frombuffer(b"".join(s for p in block for s in p[4] or []), "<u4"))
            found.keep(np.isin(short(found.seed), flags))
            found.single(crowded, window)
            if len(found.seed):
                yield _ship(found)

    def _ship(found: _Runs) -> pa.RecordBatch:
        known: dict[bytes, tuple[int, int]] = {}
        ids, tags = found.ids[found.owner], found.tags[found.owner]
        starts = found.number[found.first]
        begins = found.begins[found.first].tolist()
        ends = found.ends[found.first + found.count + window - 2].tolist()
        joined, strings, sent, settled = found.joined, [], [], []
        places = zip(ids.tolist(), starts.tolist(), strict=True)
        for k, (place, begin, end) in enumerate(zip(places, begins, ends, strict=True)):
            string = joined[begin:end]
            before = known.get(string)
            if before is not None and before < place:
                settled.append(k)
                continue
            known[string] = place
            sent.append(k)
            strings.append(string)
        sent, settled = np.array(sent, np.int64), np.array(settled, np.int64)
        bucket = (found.seed[sent] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True][: len(order) + 1])
        numbers, blobs, spans = [], [], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = order[a:b]
            row, own = sent[part], [strings[i] for i in part.tolist()]
            arrays = [found.seed[row], ids[row], tags[row], starts[row], found.count[row]]
            arrays.append(np.fromiter(map(len, own), np.int64, len(own)))
            arrays = [x.astype(kind) for x, kind in zip(arrays, KINDS, strict=True)]
            numbers.append(int(bucket[part[0]]))
            blobs.append(pack(arrays, b"".join(own)))
            spans.append(None)
        if len(settled):
            arrays = [ids[settled], tags[settled], starts[settled]]
            arrays.append(starts[settled] + found.count[settled] + window - 1)
            numbers.append(int(np.uint64(found.seed[0]) % np.uint64(buckets)))
            blobs.append(None)
            spans.append(pack([x.astype("<i8") for x in arrays]))
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary()), pa.array(spans, pa.binary())],
            ["bucket", "strings", "spans"],
        )

    return flagged.mapInArrow(run, "bucket long, strings binary, spans binary")


def _settle(blobs: list[bytes], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Spans of one bucket, as arrays of id, tag, begin and end."""
    parts = [unpack(blob, KINDS) for blob in blobs]
    seed, ids, tags, starts, counts, lengths = (
        np.concatenate(x) for x in zip(*[p[0] for p in parts], strict=True)
    )
    data = b"".join(p[1] for p in parts)
    ends = np.cumsum(lengths.astype(np.int64))
    begins = ends - lengths
    _, at, times = np.unique(seed, return_inverse=True, return_counts=True)
    rows = np.flatnonzero(times[at] > 1)
    spans: list[tuple[int, int, int, int]] = []
    first: dict[bytes, tuple[int, int]] = {}
    held = []
    places = zip(
        rows.tolist(), ids[rows].tolist(), starts[rows].tolist(),
        begins[rows].tolist(), ends[rows].tolist(), strict=True,
    )
    for row, doc, start, begin, end in places:
        string = data[begin:end]
        held.append((string, doc, start, row))
        if (place := first.get(string)) is None or (doc, start) < place:
            first[string] = (doc, start)
    rivals = Counter()
    once: set[bytes] = set()
    for string, _, _, row in held:
        if string not in once:
            once.add(string)
            rivals[int(at[row])] += 1
    windows = []
    for string, doc, start, row in held:
        if first[string] < (doc, start):
            spans.append((doc, int(tags[row]), start, start + int(counts[row]) + window - 1))
        elif rivals[int(at[row])] > 1:
            cuts = [-1, *[i for i, c in enumerate(string) if c == 32], len(string)]
            for j in range(int(counts[row])):
                windows.append((string[cuts[j] + 1 : cuts[j + window]], doc, start + j, row))
    windows.sort()
    lead: tuple[bytes, int, int] = (b"", 0, 0)
    for string, doc, start, row in windows:
        if string != lead[0]:
            lead = (string, doc, start)
        elif (doc, start) > lead[1:]:
            spans.append((doc, int(tags[row]), start, start + window))
    if spans:
        yield tuple(np.array(x, np.int64) for x in zip(*spans, strict=True))


def repeated_spans(rows: DataFrame, text: str, window: int = WINDOW) -> DataFrame:
    """(__id, __tag, __spans): the word spans to remove, several rows per document.

    ``rows`` are documents with ``__id`` and ``__tag`` that name them.
    """
    spark = rows.sparkSession
    slim = rows.select("__id", "__tag", F.col(f"`{text}`").alias("__text"))
    amount = slim.agg(F.coalesce(F.sum(F.octet_length("__text")), F.lit(0))).first()[0]

    def blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[_Runs]:
        for block in _blocks(batches, window):
            yield _Runs(block, window)

    crowded = frequent(slim, blocks_of, 200, CROWDED)
    # One minimiser in nine words, and eight bytes each.
    few = max(12, int(amount * 8 / 55 / (24 * MB)) + 1)
    # The same rows, dealt alike, meet their spans later on: one shuffle of the texts.
    flagged = rows.join(recurring(slim, blocks_of, few, within=True), ["__id", "__tag"])
    n = partitions(spark, 3.2 * amount, 48 * MB)
    shipped = _shipped(flagged, text, 4 * n, crowded, window)
    dealt = shipped.repartition(n, "bucket").sortWithinPartitions("bucket")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blobs = None, []
        for batch in batches:
            for at, strings, spans in zip(*[batch.column(i) for i in range(3)], strict=True):
                if spans.is_valid:
                    yield span_rows(*unpack(spans.as_py(), ["<i8"] * 4)[0])
                    continue
                if at.as_py() != bucket and blobs:
                    for arrays in _settle(blobs, window):
                        yield span_rows(*arrays)
                    blobs = []
                bucket = at.as_py()
                blobs.append(strings.as_py())
        if blobs:
            for arrays in _settle(blobs, window):
                yield span_rows(*arrays)

    return dealt.mapInArrow(run, SPANS)


RESULT = "n_words long, n_removed long, kept_sha256 string"


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    digest: bool = False,
) -> DataFrame:
    """Documents without words that a repeated window covers.

    A window of ``window`` words is removed if its words also start earlier: in a
    document with a smaller identifier, or before it in the same one. All windows are
    judged on the input. Adds ``n_words`` and ``n_removed``; with ``digest`` also
    ``kept_sha256`` of the kept words joined by one space, and the text column goes.
    Without it the text is the kept words joined by one space where words were removed,
    and stays as it is where none were.

    Null and short texts lose nothing; a null identifier orders first. Rows that share
    identifier and text are the same place and do not remove each other; rows that share
    only the identifier are compared by the place in their texts. Input columns named
    like a result are replaced; an empty table gives an empty result.
    """
    kept = without(docs, "n_words", "n_removed", *["kept_sha256"] * digest)
    rows = named(kept, doc_id, text)
    joined = gathered(rows, repeated_spans(rows, text, window))
    names = [c for c in kept.columns if not (digest and c == text)]
    wanted = "n_words long, n_removed long" + ", kept_sha256 string" * digest
    schema = extended(kept.select(*[f"`{c}`" for c in names]), wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 * MB):
            texts, n_words, n_removed, digests = [], [], [], []
            for value, spans in zip(
                batch.column(text).to_pylist(), batch.column("__all").to_pylist(), strict=True
            ):
                words = (value or "").encode().split()
                gone = covered(len(words), spans)
                left = words if not gone.any() else [words[i] for i in np.flatnonzero(~gone).tolist()]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                if digest:
                    digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
                else:
                    texts.append(value if len(left) == len(words) else b" ".join(left).decode())
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
            columns += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            columns += [pa.array(digests, pa.string())] * digest
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)
