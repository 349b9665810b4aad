"""Periodic runs of words, found by block convolution at dyadic scales.

A run has a smallest period q, at least four of them and six words. At the scale of blocks
of B words the periods B to 2B-1 are sought: a run of such a period holds a whole aligned
block that occurs again one period on. The number of mismatches of a block at each distance
of the window behind it is a sum of squared differences, that is, a convolution of word
numbers. It is computed exactly with number-theoretic transforms modulo enough primes to
exceed the sum: it is zero if it is zero modulo each. Every zero seeds an extension to both
sides; stretches whose smallest period is a part of the distance belong to another scale.

Texts are laid side by side, a separator between them, so one transform takes blocks of many
documents. A block is left out before the transform where no zero is possible (one of its
words does not come again within the window) or where all of them are known (the window lies
in a run of a shorter period, and shifts by multiples of that period only).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspindle.llm.common import MB, WORD, extended, slices, without

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Primes k * 2^e + 1 with a primitive root each: (prime, root, e).
PRIMES = [(2013265921, 31, 27), (469762049, 3, 26), (167772161, 3, 25)]
#: Texts of so many bytes are searched together, and so many numbers are transformed at once.
BATCH = 4 * MB
CELLS = 1 << 19
RUNS = "runs array<struct<start: long, length: long, period: long>>"
SPEC = f"n_words long, {RUNS}, collapsed string"


class Transform:
    """Number-theoretic transforms of rows of ``size`` numbers, a power of two."""

    def __init__(self, prime: int, root: int, size: int):
        self.prime, self.size = np.uint64(prime), size
        self.forward = self._factors(pow(root, (prime - 1) // size, prime))
        self.inverse = self._factors(pow(root, (prime - 1) // size * (size - 1), prime))
        self.share = np.uint64(pow(size, prime - 2, prime))

    def _factors(self, root: int) -> list[np.ndarray]:
        """For each pass the powers of its root of unity."""
        prime, out, width = int(self.prime), [], self.size
        while width > 1:
            powers = np.ones(width // 2, np.uint64)
            filled = 1
            while filled < len(powers):  # doubled, so that no loop runs over the words
                step = np.uint64(pow(root, filled, prime))
                more = min(filled, len(powers) - filled)
                powers[filled : filled + more] = powers[:more] * step % self.prime
                filled += more
            out.append(powers)
            root, width = root * root % prime, width // 2
        return out

    def _run(self, rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
        """Decimation in frequency with self-sorting passes."""
        p, n, m = self.prime, self.size, len(rows)
        at = rows.reshape(m, n, 1)
        for powers in factors:
            half = at.shape[1] // 2
            low, high = at[:, :half], at[:, half:]
            total = low + high
            total -= p * (total >= p)
            apart = (low + (p - high)) * powers[None, :, None] % p
            at = np.concatenate([total, apart], axis=2)
        return at.reshape(m, n)

    def correlate(self, blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """sum of block[j] * window[i + j] modulo the prime, for each row and i."""
        p = self.prime
        # Index 0 stays and the others are reversed: a product of spectra correlates then.
        back = np.roll(blocks[:, ::-1], 1, axis=1)
        a, b = self._run(back, self.forward), self._run(windows, self.forward)
        return self._run(a * b % p, self.inverse) * self.share % p


def zero_mismatches(x: np.ndarray, starts: np.ndarray, size: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Where blocks occur again: (block start, distance), distances ``size`` to 2 * ``size`` - 1.

    ``x`` holds numbers from 0 to ``most``; windows may go beyond its end.
    """
    found_at, found_by = [], []
    bound, product, primes = size * (most + 1) ** 2, 1, []
    for prime in PRIMES:
        if product <= bound:
            primes.append(prime)
            product *= prime[0]
    if product <= bound or 2 * size > 1 << min(e for _, _, e in primes):
        raise ValueError("a block is too long for the primes")
    transforms = [Transform(p, root, 2 * size) for p, root, _ in primes]
    step = max(1, CELLS // (2 * size))
    for begin in range(0, len(starts), step):
        at = starts[begin : begin + step]
        blocks = np.zeros((len(at), 2 * size), np.uint64)
        blocks[:, :size] = x[at[:, None] + np.arange(size)]
        behind = at[:, None] + size + np.arange(2 * size)
        windows = np.where(behind < len(x), x[np.minimum(behind, len(x) - 1)], most + 1).astype(np.uint64)
        zero = np.ones((len(at), size), bool)
        for t in transforms:
            p = t.prime
            square = windows * windows % p
            sums = np.cumsum(square, axis=1)  # at most 2^21 numbers below 2^31
            before = np.concatenate([np.zeros((len(at), 1), np.uint64), sums], axis=1)
            of_window = (before[:, size : 2 * size] - before[:, :size]) % p
            of_block = (blocks * blocks % p).sum(axis=1) % p
            cross = t.correlate(blocks % p, windows % p)[:, :size]
            zero &= (of_block[:, None] + of_window) % p == cross * np.uint64(2) % p
        rows, distance = np.nonzero(zero)
        found_at.append(at[rows])
        found_by.append(distance + size)
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_by).astype(np.int64)


def _matching(x: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` and ``b`` on agree, going by ``step``; looks ahead in growing pieces."""
    total, ahead = 0, 16
    while True:
        room = len(x) - max(a, b) if step > 0 else min(a, b) + 1
        take = min(ahead, room)
        if take <= 0:
            return total
        if step > 0:
            same = x[a : a + take] == x[b : b + take]
        else:
            same = x[a - take + 1 : a + 1][::-1] == x[b - take + 1 : b + 1][::-1]
        if not same.all():
            return total + int(same.argmin())
        total, a, b, ahead = total + take, a + step * take, b + step * take, 2 * ahead


def _primitive(x: np.ndarray, start: int, period: int) -> bool:
    """No shorter word, repeated, makes the first period."""
    word, rest, prime = x[start : start + period], period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            part = period // prime
            if (word[part:] == word[: period - part]).all():
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


def find_runs(x: np.ndarray, gaps: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``x``, numbers from 0 on.

    ``gaps`` are places of separators, which match nothing; ``longest`` is the length of
    the longest stretch between them.
    """
    n = len(x)
    if n < LEAST_WORDS:
        return []
    most = int(x.max())
    order = np.argsort(x, kind="stable")
    ahead = np.full(n, np.iinfo(np.int64).max)
    same = x[order[1:]] == x[order[:-1]]
    ahead[order[:-1][same]] = order[1:][same] - order[:-1][same]
    ahead[gaps] = np.iinfo(np.int64).max
    within, shorter = np.zeros(n, np.int64), np.ones(n, np.int64)  # end and period of a known run
    runs, size, widest = [], 1, ahead
    while LEAST_PERIODS * size <= longest:
        starts = np.flatnonzero(widest < 2 * size) * size
        starts = starts[within[starts] < starts + 3 * size]
        at, by = zero_mismatches(x, starts, size, most)
        known = (within[at] >= at + by + size) & (by % shorter[at] == 0)
        at, by = at[~known], by[~known]
        turn = np.lexsort((at, by))
        done = (0, 0)  # distance and end of the last stretch: it holds the seeds up to there
        fresh = []
        for p, d in zip(at[turn].tolist(), by[turn].tolist(), strict=True):
            if done[0] == d and p < done[1]:
                continue
            right = _matching(x, p, p + d, 1)
            left = _matching(x, p - 1, p + d - 1, -1)
            start, length = p - left, left + right + d
            done = (d, p + right)
            if length >= max(LEAST_WORDS, LEAST_PERIODS * d) and _primitive(x, start, d):
                fresh.append((start, length, d))
        for start, length, d in fresh:
            longer = within[start : start + length] < start + length
            shorter[start : start + length][longer] = d
            within[start : start + length][longer] = start + length
        runs += fresh
        half = len(widest) // 2
        widest = np.maximum(widest[: 2 * half : 2], widest[1 : 2 * half : 2])
        size *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def search(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text and its runs, the texts searched together."""
    words = [(t or b"").split() for t in texts]
    numbers: dict[bytes, int] = {}
    flat, gaps, begins = [], [], []
    for own in words:
        begins.append(len(flat))
        flat += [numbers.setdefault(w, len(numbers) + 1) for w in own]
        gaps.append(len(flat))
        flat.append(0)
    longest = max(map(len, words), default=0)
    runs = find_runs(np.array(flat, np.int64), np.array(gaps, np.int64), longest)
    at = np.searchsorted(begins, [r[0] for r in runs], "right") - 1
    by_text: list[list] = [[] for _ in words]
    for text, (start, length, period) in zip(at.tolist(), runs, strict=True):
        by_text[text].append((start - begins[text], length, period))
    yield from zip(words, by_text, strict=True)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [w for w, out in zip(words, gone.tolist(), strict=True) if not out]


def _batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in slices(batches, text, BATCH):
        column = batch.column(text).cast(pa.binary())
        yield batch, list(search(column.to_pylist()))


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with (n_words, runs, collapsed): every run of each whole text, by start, then
    period, and the text without the repetitions, its words joined by one space.

    Null and empty texts have no words and an empty ``collapsed``; repeated rows are rows of
    their own. Columns of ``docs`` named like a new one give way to it.
    """
    kept = without(docs, "n_words", "runs", "collapsed").withColumn(text, F.col(f"`{text}`").cast("string"))
    schema = extended(kept, SPEC)

    def run(batches):
        runs_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch, found in _batches(batches, text):
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([len(w) for w, _ in found], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for _, runs in found], runs_type),
                    pa.array([b" ".join(collapse(w, runs)).decode() for w, runs in found], pa.string()),
                ],
                names=[f.name for f in schema.fields],
            )

    return kept.mapInArrow(run, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """``text`` with a repeated end in every tenth document by the CRC-32 of its identifier.

    Rows without identifier or words stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n = F.size(words).cast("long")
    a = g % n
    p = F.floor((n - a) / (3 + g % 8)).cast("long") + 1

    # A row of (words, a, p): each is worked out once, not again for every word.
    def repeated(given: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0).cast("long"), F.size(given["w"]).cast("long") - 1),
            lambda i: F.get(
                given["w"],
                F.when(i < given["a"], i).otherwise(given["a"] + (i - given["a"]) % given["p"]).cast("int"),
            ),
        )

    given = F.array(F.struct(words.alias("w"), a.alias("a"), p.alias("p")))
    made = F.array_join(F.get(F.transform(given, repeated), F.lit(0)), " ")
    return F.when((h % 10 == 0) & text.rlike(WORD), made).otherwise(text)


def digests(docs: DataFrame) -> DataFrame:
    """The digest columns of documents with planted repetitions, one row for each row."""
    text = F.col("`text`").cast("string")
    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), planted(F.col("`doc_id`"), text).alias("text"))
    schema = (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )

    def run(batches):
        for batch, found in _batches(batches, "text"):
            best = [min(runs, key=_Rank) if runs else None for _, runs in found]
            lines = ["".join(f"{s},{n},{q}\n" for s, n, q in runs) for _, runs in found]
            kept = [b" ".join(collapse(w, runs)) for w, runs in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(runs) for _, runs in found], pa.int64()),
                    *[pa.array([b and b[i] for b in best], pa.int64()) for i in range(3)],
                    pa.array([b and 1000 * b[1] // b[2] for b in best], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in lines], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
                ],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            )

    return rows.mapInArrow(run, schema)


class _Rank:
    """Orders runs by length over period, the greatest first, exactly; then by start and period."""

    def __init__(self, run: tuple[int, int, int]):
        self.run = run

    def __lt__(self, other: _Rank) -> bool:
        (s, n, q), (t, m, r) = self.run, other.run
        return (-n * r, s, q) < (-m * q, t, r)
