"""Removal of lines that many documents share, reversible as documents come and go.

Every line is known by a key (stripped of white space, A-Z in lower case) and a 128-bit hash
of it. A reference-count table holds for each key the exact number of documents that have it:
an insertion or a deletion of documents adds a table of signed changes, and the sum over
these tables is the count. A key whose count reaches the bound enters the cuckoo filter of its
shard, and leaves it when deletions take the count below the bound; so the lines come back.
A cuckoo filter holds a short fingerprint of a key in one of two buckets, each found from the
fingerprint and the other bucket, which is what lets a key be taken out again.

Cleaning sends the filters to the tasks, where they stay below ``FILTER_BYTES``: lines are
looked up where they are and no text moves. A filter takes a few strangers for its own; those
among the counted keys are found by looking them all up, and listed beside the filters, so
the result is exact for every document that was inserted. Larger filters are not sent: there
keys of lines meet the counts in a join.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspindle.llm.common import MB, extended, shared_dir, slices, without
from wattspindle.sources.versions import Versions

MIN_DOCS = 10
MIN_CHARS = 1
#: Shards are told by the first bits of a key's hash.
SHARD_BITS = 8
SLOTS = 4
#: A filter is made for a load of this share, and moves so many fingerprints for a new one.
LOAD = 0.8
KICKS = 500
#: Filters beyond this, or more listed strangers than this, are not sent to tasks.
FILTER_BYTES = 64 * MB
STRANGERS = 100_000
#: Change tables beyond this number are summed into one.
CHANGES = 8
BATCH = 8 * MB
KEYS = "hi long, lo long, n long"
FILTER = "shard int, held long, slots binary, full boolean"


# Keys -------------------------------------------------------------------------


def lines_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def key_of(line: bytes) -> bytes:
    # On bytes both know ASCII only: white space 09-0D and 20, capitals A-Z.
    return line.strip().lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars < 2 or len(key.decode()) >= min_chars)


def hashes(keys: list[bytes]) -> np.ndarray:
    """Rows of two unsigned longs, a 128-bit hash of each key."""
    raw = b"".join([xxhash.xxh3_128_digest(k) for k in keys])
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)


def _signed(column: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(column).view(np.int64))


def _count_keys(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(hi, lo, n): documents that have a key, one row a key and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, BATCH):
            counts: Counter[bytes] = Counter()
            for value in batch.column(0).cast(pa.binary()).to_pylist():
                counts.update({key_of(line) for line in lines_of(value)})
            keys = [k for k in counts if _long_enough(k, min_chars)]
            both = hashes(keys)
            numbers = pa.array([counts[k] for k in keys], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [_signed(both[:, 0]), _signed(both[:, 1]), numbers], names=["hi", "lo", "n"]
            )

    return docs.select(F.col(f"`{text}`").cast("string").alias(text)).mapInArrow(run, KEYS)


# Cuckoo filters ---------------------------------------------------------------


def _prints(hi: np.ndarray) -> np.ndarray:
    """Fingerprints of 32 bits, never 0: that is an empty slot."""
    low = (hi & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return np.where(low == 0, np.uint32(1), low)


def _shift(prints: np.ndarray) -> np.ndarray:
    """What a bucket's number is combined with to find the other one."""
    return (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(17)


def _buckets(keys: float) -> int:
    """A power of two with room for ``keys``."""
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, keys / (SLOTS * LOAD))))))


class Cuckoo:
    """A filter of buckets of four fingerprints; keys are rows of two unsigned longs."""

    def __init__(self, slots: np.ndarray, held: int = 0):
        self.slots, self.held = slots, held

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        return cls(np.zeros((_buckets(keys), SLOTS), np.uint32))

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """A new filter of ``keys``, as large as they need."""
        room = len(keys)
        for _ in range(8):
            made = cls.sized(room)
            if made.insert(keys):
                return made
            room = 2 * max(room, 1)
        raise ValueError("too many keys share a fingerprint and its buckets")

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.slots) - 1)
        prints = _prints(keys[:, 0])
        first = keys[:, 1] & mask
        return prints, first.astype(np.int64), ((first ^ _shift(prints)) & mask).astype(np.int64)

    def insert(self, keys: np.ndarray) -> bool:
        """Take in all keys; False, and a filter of no use, where one finds no place."""
        prints, one, two = self._places(keys)
        slots, mask, turn = self.slots, len(self.slots) - 1, 0
        for mark, a, b in zip(prints.tolist(), one.tolist(), two.tolist(), strict=True):
            at = a if 0 in slots[a] else b
            for _ in range(KICKS):
                free = np.flatnonzero(slots[at] == 0)
                if len(free):
                    slots[at, free[0]] = mark
                    self.held += 1
                    break
                turn = (turn + 1) % SLOTS
                mark, slots[at, turn] = int(slots[at, turn]), mark
                at = (at ^ int(_shift(np.array([mark], np.uint32))[0])) & mask
            else:
                return False
        return True

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that are in."""
        for mark, a, b in zip(*[x.tolist() for x in self._places(keys)], strict=True):
            for at in (a, b):
                found = np.flatnonzero(self.slots[at] == mark)
                if len(found):
                    self.slots[at, found[0]] = 0
                    self.held -= 1
                    break
            else:
                raise ValueError("a key that is not in the filter")


class Shards:
    """Filters of all shards side by side, for look-ups."""

    def __init__(self, rows: list):
        by_shard = {r["shard"]: np.frombuffer(r["slots"], np.uint32).reshape(-1, SLOTS) for r in rows}
        none = np.zeros((1, SLOTS), np.uint32)
        tables = [by_shard.get(s, none) for s in range(1 << SHARD_BITS)]
        sizes = np.array([len(t) for t in tables])
        self.slots = np.concatenate(tables)
        self.begin, self.mask = np.cumsum(sizes) - sizes, (sizes - 1).astype(np.uint64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        shard = (keys[:, 0] >> np.uint64(64 - SHARD_BITS)).astype(np.int64)
        mask, begin, prints = self.mask[shard], self.begin[shard], _prints(keys[:, 0])
        first = keys[:, 1] & mask
        second = (first ^ _shift(prints)) & mask
        found = np.zeros(len(keys), bool)
        for bucket in (first, second):
            found |= (self.slots[begin + bucket.astype(np.int64)] == prints[:, None]).any(axis=1)
        return found


def _keys_of(rows: pd.DataFrame) -> np.ndarray:
    return rows[["hi", "lo"]].to_numpy(np.int64).view(np.uint64).reshape(-1, 2)


def _change(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter after its changes; marked full where a key found no place."""
    shard = (left if len(left) else right)["shard"].iloc[0]
    entering, leaving = _keys_of(left[left["entering"]]), _keys_of(left[~left["entering"]])
    if len(right):
        slots = np.frombuffer(right["slots"].iloc[0], np.uint32).reshape(-1, SLOTS).copy()
        made = Cuckoo(slots, int(right["held"].iloc[0]))
        made.remove(leaving)
        full = not made.insert(entering)
    else:
        made, full = Cuckoo.of(entering), False
    return pd.DataFrame({"shard": [shard], "held": [made.held], "slots": [made.slots.tobytes()], "full": [full]})


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    made = Cuckoo.of(_keys_of(rows))
    return pd.DataFrame(
        {"shard": [rows["shard"].iloc[0]], "held": [made.held], "slots": [made.slots.tobytes()], "full": [False]}
    )


# Index ------------------------------------------------------------------------


class LineIndex:
    """Reference counts and filters of the lines of a changing set of documents.

    ``path`` is its folder, one of its own in the shared folder by default; an index that
    is there already goes on from its newest version. Every ``insert`` and ``delete`` is one
    new version, put in place in one step, so a broken run changes nothing. A row is a
    document: a line counts once for each row that has it. Null and empty texts are one empty
    line. Keys shorter than ``min_chars`` code points are never dropped.
    """

    def __init__(
        self, spark: SparkSession, path: str | None = None, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
    ):
        self.spark = spark
        self.path = path or f"{shared_dir(spark)}/llm/lines-{uuid.uuid4().hex}"
        self.versions = Versions(spark, self.path)
        number = self.versions.latest()
        self.version = number
        fresh = {"changes": [], "filters": None, "min_docs": min_docs, "min_chars": min_chars}
        self.state = self.versions.read(number) if number else fresh
        self._strangers: tuple[int, list | None] | None = None

    # Counts

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def _changes(self) -> DataFrame:
        names = self.state["changes"]
        if not names:
            return self.spark.createDataFrame([], KEYS)
        return self.spark.read.schema(KEYS).parquet(*[f"{self.path}/{n}" for n in names])

    def counts(self) -> DataFrame:
        """(hi, lo, n): each key's hash and the number of documents that have it."""
        if len(self.state["changes"]) <= 1:  # a key is once in a table of changes
            return self._changes().where("n <> 0")
        return self._changes().groupBy("hi", "lo").agg(F.sum("n").alias("n")).where("n <> 0")

    def crowded(self) -> DataFrame:
        """The keys that reach the bound."""
        return self.counts().where(F.col("n") >= self.state["min_docs"])

    def _shard(self):
        return F.shiftrightunsigned("hi", 64 - SHARD_BITS).cast("int").alias("shard")

    # Changes

    def insert(self, docs: DataFrame, text: str = "text") -> None:
        self._apply(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> None:
        """Take documents out that were inserted with the same texts.

        A text that was not inserted is an error that leaves the index as it was.
        """
        self._apply(docs, text, -1)

    def _apply(self, docs: DataFrame, text: str, sign: int) -> None:
        bound = self.state["min_docs"]
        found = _count_keys(docs, text, self.state["min_chars"])
        change = found.groupBy("hi", "lo").agg((F.sum("n") * sign).cast("long").alias("n"))
        name = self._write(change, "changes")
        state = {**self.state, "changes": [*self.state["changes"], name]}
        new = self._read(name, KEYS)
        if self.state["changes"]:
            old = self.counts().withColumnRenamed("n", "before")
            both = new.join(old, ["hi", "lo"], "left").withColumn("before", F.coalesce("before", F.lit(0)))
        else:
            both = new.withColumn("before", F.lit(0).cast("long"))
        both = both.withColumn("after", F.col("before") + F.col("n"))
        if sign < 0 and both.where("after < 0").limit(1).count():
            self.versions.delete(name)
            raise ValueError("a document to delete was not inserted")
        crossing = both.where((F.col("before") >= bound) != (F.col("after") >= bound)).select(
            self._shard(), "hi", "lo", (F.col("after") >= bound).alias("entering")
        )
        if self.state["filters"] is None:
            filters = crossing.groupBy("shard").applyInPandas(_build, FILTER)
        else:
            filters = crossing.groupBy("shard").cogroup(
                self._read(self.state["filters"], FILTER).groupBy("shard")
            ).applyInPandas(_change, FILTER)
        before = self.state
        state["filters"] = self._write(filters, "filters")
        # At most one row a shard.
        full = [r["shard"] for r in self._read(state["filters"], FILTER).where("full").select("shard").collect()]
        self.state = state
        try:
            if full:
                keys = self.crowded().select(self._shard(), "hi", "lo").where(F.col("shard").isin(full))
                anew = keys.groupBy("shard").applyInPandas(_build, FILTER)
                kept = self._read(state["filters"], FILTER).where("not full")
                state["filters"] = self._write(kept.unionByName(anew), "filters")
            if len(state["changes"]) > CHANGES:
                state["changes"] = [self._write(self.counts(), "changes")]
            self.versions.commit(self.version + 1, state)
        except BaseException:
            self.state = before
            raise
        self.version += 1

    def vacuum(self) -> None:
        """Delete what no version but the newest needs."""
        needed = {*self.state["changes"], self.state["filters"], "_versions"}
        self.versions.forget(self.version)
        for name in self.versions.folders(""):
            if name not in needed:
                self.versions.delete(name)

    # Cleaning

    def _sendable(self) -> tuple[Shards, set] | None:
        """Filters and listed strangers for the tasks, or None where they are too large."""
        if self.state["filters"] is None:
            return Shards([]), set()
        filters = self._read(self.state["filters"], FILTER)
        if (filters.agg(F.sum(F.octet_length("slots"))).first()[0] or 0) > FILTER_BYTES:
            return None
        shards = Shards(filters.collect())
        if self._strangers is None or self._strangers[0] != self.version:
            sent, names = self.spark.sparkContext.broadcast(shards), ["hi", "lo"]

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    keys = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in names], axis=1)
                    yield batch.filter(pa.array(sent.value.holds(keys)))

            below = self.counts().where(F.col("n") < self.state["min_docs"]).select(*names)
            taken = below.mapInArrow(run, "hi long, lo long").limit(STRANGERS + 1).collect()
            few = len(taken) <= STRANGERS
            self._strangers = (self.version, [tuple(r) for r in taken] if few else None)
        listed = self._strangers[1]
        return None if listed is None else (shards, set(listed))

    def clean(self, docs: DataFrame, text: str = "text", digest: bool = False) -> DataFrame:
        """``docs`` without the lines whose key reaches the bound, with (n_lines, n_dropped).

        For documents that are in the index. ``n_lines`` counts before the removal; lines
        that stay are joined by a line feed. With ``digest`` the text gives way to
        ``kept_sha256``. Columns of ``docs`` named like a new one give way to it.
        """
        kept = without(docs, "n_lines", "n_dropped", "kept_sha256", "__of", "__keys")
        kept = kept.withColumn(text, F.col(f"`{text}`").cast("string"))
        sendable = self._sendable()
        if sendable is None:
            kept = self._with_dropped_keys(kept, text)
            return _dropped(kept, text, digest, None, set(), self.state["min_chars"])
        shards, strangers = sendable
        sent = self.spark.sparkContext.broadcast((shards, strangers))
        return _dropped(kept, text, digest, sent, strangers, self.state["min_chars"])

    def _with_dropped_keys(self, docs: DataFrame, text: str) -> DataFrame:
        """``docs`` with ``__keys``, the hashes of the keys to drop, by joins.

        Equal texts ask once. A key in many texts, or a text in many rows, is a hot side of an
        equality join that adaptive execution splits.
        """
        of, min_chars = F.md5(F.col(f"`{text}`").cast("binary")), self.state["min_chars"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", BATCH):
                for name, value in zip(*[c.to_pylist() for c in (batch.column(0), batch.column(1).cast(pa.binary()))], strict=True):
                    keys = [k for k in {key_of(x) for x in lines_of(value)} if _long_enough(k, min_chars)]
                    both = hashes(keys)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys), pa.string()), _signed(both[:, 0]), _signed(both[:, 1])],
                        names=["__of", "hi", "lo"],
                    )

        texts = docs.where(F.col(f"`{text}`").isNotNull()).select(of.alias("__of"), F.col(f"`{text}`").alias("text"))
        asked = texts.mapInArrow(run, "__of string, hi long, lo long").distinct()
        answers = asked.join(self.crowded().select("hi", "lo"), ["hi", "lo"])
        answers = answers.groupBy("__of").agg(F.collect_list(F.struct("hi", "lo")).alias("__keys"))
        return docs.withColumn("__of", of).join(answers, "__of", "left").drop("__of")


def _dropped(docs: DataFrame, text: str, digest: bool, sent, strangers: set, min_chars: int) -> DataFrame:
    """The removal itself: lines are judged by the filters ``sent`` or else by ``__keys``."""
    names = [c for c in docs.columns if c != "__keys" and not (digest and c == text)]
    schema = extended(docs.select(*[f"`{c}`" for c in names]), "n_lines long, n_dropped long")
    if digest:
        schema = schema.add("kept_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, listed = sent.value if sent else (None, set())
        for batch in slices(batches, text, BATCH):
            lines = [lines_of(v) for v in batch.column(text).cast(pa.binary()).to_pylist()]
            keys = [[key_of(x) for x in own] for own in lines]
            if shards is not None:
                every = [k for k in {k for own in keys for k in own} if _long_enough(k, min_chars)]
                held = _held(every, shards, listed)
                gone = [held] * len(lines)
            else:
                wanted = batch.column("__keys").to_pylist()
                gone = [_named(own, of, min_chars) for own, of in zip(keys, wanted, strict=True)]
            stay = [
                [x for x, k in zip(own, of, strict=True) if k not in out]
                for own, of, out in zip(lines, keys, gone, strict=True)
            ]
            texts = [b"\n".join(own) for own in stay]
            nulls = batch.column(text).is_null().to_pylist()
            arrays = [
                batch.column(c) if c != text else pa.array([None if n else t.decode() for t, n in zip(texts, nulls, strict=True)], pa.string())
                for c in names
            ]
            counts = [len(x) for x in lines]
            arrays.append(pa.array(counts, pa.int64()))
            arrays.append(pa.array([n - len(s) for n, s in zip(counts, stay, strict=True)], pa.int64()))
            if digest:
                arrays.append(pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)


def _held(keys: list[bytes], shards: Shards, listed: set) -> set[bytes]:
    """The keys that filters hold and that are not listed as strangers."""
    if not keys:
        return set()
    both = hashes(keys)
    at = np.flatnonzero(shards.holds(both))
    if not listed:
        return {keys[i] for i in at}
    pairs = both[at].view(np.int64).tolist()
    return {keys[i] for i, pair in zip(at.tolist(), pairs, strict=True) if tuple(pair) not in listed}


def _named(keys: list[bytes], wanted: list | None, min_chars: int) -> set[bytes]:
    """The keys whose hashes are in ``wanted``."""
    if not wanted:
        return set()
    own = [k for k in set(keys) if _long_enough(k, min_chars)]
    among = {(w["hi"], w["lo"]) for w in wanted}
    pairs = hashes(own).view(np.int64).tolist()
    return {k for k, pair in zip(own, pairs, strict=True) if tuple(pair) in among}
