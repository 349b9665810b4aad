"""Best-fit packing of token sequences by bin completion.

Pieces are counted by length, so the packing problem has at most as many kinds of items
as a sequence has places, whatever the number of documents. Sequences are filled around
the largest piece left: undominated fillings are enumerated best fit first, a filling is
repeated as often as its pieces last, and branch-and-bound prunes by the waste that the
best packing so far allows. The result is a short list of patterns, from which each
piece reads its place by its number among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspindle.llm.common import MB, Table, rank_in, slices

CAPACITY = 2048
#: Fillings of one sequence that are weighed, the steps in which they are looked for, and
#: branches that are followed in all: the search runs on the driver, over counts.
FILLINGS, STEPS, BRANCHES = 12, 400, 1000
#: Words of a generation whose tokens a Python worker remembers: some 80 MB.
REMEMBERED = 400_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Words of printable ASCII but apostrophes and of precomposed Latin letters have simple parts.
#: The capital I with a dot is left out: lower-cased it is two characters.
_LATIN = "a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_SIMPLE = re.compile(f"[!-&(-~{_LATIN}]+")
_PARTS = re.compile(f"[{_LATIN}]+|[0-9]|[^{_LATIN}0-9]+")
#: First bytes of all characters behind those: the only ones whose case or composition depends on neighbours.
_OTHER = bytes(range(0xC6, 0x100))


@cache
def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Words:
    """Token ids of whole texts, word by word: this vocabulary never joins across white space.

    Words are remembered in two generations; one used again moves to the young one. A
    word's parts (a run of letters, a digit, a run of other signs) go to the vocabulary's
    model at once; words with other characters, or with the text of an added token in any
    case, take the tokenizer's whole way, as they were written.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        # The vocabulary is lower-case; A-Z can go at once, unless a capital composes with a mark
        # behind it or makes the difference between an added token and plain text. That is
        # for each word to tell, as words never join.
        written = (text or "").encode()
        lower = written.lower()
        words = lower.split()
        if len(written.translate(None, _OTHER)) < len(written) or self._holds_added(lower):
            words = [self._as_met(w, low) for w, low in zip(written.split(), words, strict=True)]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        for word in set(words):
            if word not in young:
                young[word] = old.get(word) or self._word(word)
        return b"".join(map(young.__getitem__, words))

    def _as_met(self, word: bytes, lower: bytes) -> bytes:
        other = not word.isascii() and len(word.translate(None, _OTHER)) < len(word)
        return word if other or self._holds_added(lower) else lower

    def _holds_added(self, lower: bytes) -> bool:
        return any(a in lower for a in self.added)

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if not _SIMPLE.fullmatch(text) or self._holds_added(word.lower()):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        text = text.lower()
        parts = _PARTS.findall(text)
        if len(parts) == 1:
            return self._part(text.encode())
        found = []
        for part in parts:
            key = part.encode()
            ids = self.young.get(key) or self.old.get(key)
            if ids is None:
                ids = self.young[key] = self._part(key)
            found.append(ids)
        return b"".join(found)

    def _part(self, part: bytes) -> bytes:
        shown = part.decode() if part.isascii() else "".join(map(_byte_letters().__getitem__, part))
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()


@cache
def _words(path: str) -> Words:
    """One for each Python worker, so that tasks that follow each other share it."""
    return Words(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, doc_id: str, text: str, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids with id 0 behind them, cut into pieces of ``capacity``."""
    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in slices(batches, "text", 4 * MB):
            rows: list[tuple] = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = words.ids(value) + b"\0\0\0\0"
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, number, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return slim.mapInArrow(run, PIECES)


Pattern = tuple[tuple[int, ...], int]


def _dominates(one: tuple[int, ...], two: tuple[int, ...]) -> bool:
    """Whether groups of the pieces of ``two`` can be exchanged for pieces of ``one``, each at
    least as long as its group, so that ``one`` holds all that ``two`` does.

    Tried with a bounded number of steps; a dominance that takes more is not seen.
    """
    if sum(one) < sum(two):
        return False
    rooms, steps = list(one), 0

    def place(i: int) -> bool:
        nonlocal steps
        steps += 1
        if i == len(two):
            return True
        tried = set()
        for k, room in enumerate(rooms):
            if room >= two[i] and room not in tried and steps < 200:
                tried.add(room)
                rooms[k] -= two[i]
                if place(i + 1):
                    return True
                rooms[k] += two[i]
        return False

    # Short fillings only: every piece is a level of the search.
    return len(two) <= 60 and place(0)


def _fillings(sizes: list[int], left: dict[int, int], room: int, most: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room``, least waste first, then with the fewest pieces.

    Fillings to which no piece can be added are reached largest piece first, each length as
    often as it goes in, or once less. Those that another one dominates are left out:
    exchanging its pieces for the dominated ones elsewhere never takes more sequences.
    """
    found: dict[tuple[tuple[int, int], ...], int] = {}
    steps = 0

    def whole(chosen: tuple[tuple[int, int], ...], room: int) -> bool:
        used = dict(chosen)
        return all(left[s] <= used.get(s, 0) for s in sizes[: bisect_right(sizes, room)])

    def go(at: int, room: int, chosen: tuple[tuple[int, int], ...]) -> bool:
        """Distinct lengths are the levels: as many as fit in a sequence side by side."""
        nonlocal steps
        steps += 1
        at, tried, placed = min(at, bisect_right(sizes, room) - 1), 0, False
        while at >= 0 and tried < 6:
            size = sizes[at]
            at -= 1
            fits = min(left[size], room // size)
            for times in (fits, fits - 1) if fits > 1 else (fits,) if fits else ():
                placed = True
                # The first way down is gone to its end.
                if (steps < STEPS or not found) and go(at, room - times * size, (*chosen, (size, times))):
                    return True
            tried += fits > 0
        if not placed and whole(chosen, room):
            found[chosen] = room
        return len(found) >= 4 * most

    go(len(sizes) - 1, room, ())
    result: list[tuple[int, ...]] = []
    flat = [(waste, tuple(s for s, n in chosen for _ in range(n))) for chosen, waste in found.items()]
    for _, chosen in sorted(flat, key=lambda x: (x[0], len(x[1]), [-s for s in x[1]])):
        if not any(_dominates(other, chosen) for other in result):
            result.append(chosen)
        if len(result) == most:
            break
    return result


def _times(filling: tuple[int, ...], left: dict[int, int]) -> int:
    return min(left[s] // filling.count(s) for s in set(filling))


def _greedy(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counted pieces: the largest that fits goes in, again and again."""
    left, sizes, patterns = dict(counts), sorted(s for s in counts if counts[s]), []
    while sizes:
        room, chosen = capacity, []
        while (at := bisect_right(sizes, room) - 1) >= 0:
            while at >= 0 and left[sizes[at]] <= chosen.count(sizes[at]):
                at -= 1
            if at < 0:
                break
            chosen.append(sizes[at])
            room -= sizes[at]
        filling = tuple(chosen)
        times = _times(filling, left)
        patterns.append((filling, times))
        for size in filling:
            left[size] -= times
        sizes = [s for s in sizes if left[s]]
    return patterns


def bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: by total length, and by pieces that cannot share one."""
    total = sum(s * n for s, n in counts.items())
    least = -(-total // capacity)
    sizes = sorted(s for s in counts if counts[s])
    large = sum(counts[s] for s in sizes if 2 * s > capacity)
    least = max(least, large)
    for k in sizes:
        if 2 * k > capacity:
            break
        whole = sum(counts[s] for s in sizes if s > capacity - k)
        half = [s for s in sizes if capacity - k >= s > capacity / 2]
        small = sum(s * counts[s] for s in sizes if capacity / 2 >= s >= k)
        room = sum((capacity - s) * counts[s] for s in half)
        least = max(least, whole + sum(counts[s] for s in half) + max(0, -(-(small - room) // capacity)))
    return least


def complete(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns (lengths, times) that hold all counted pieces, in few sequences."""
    counts = {s: n for s, n in counts.items() if n}
    best = _greedy(counts, capacity)
    fewest, least = sum(t for _, t in best), bound(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    left, kinds = dict(counts), sorted(counts)
    done: list[Pattern] = []
    frames: list[Iterator[tuple[int, ...]]] = []
    used = waste = branches = 0
    first = True

    def move(filling: tuple[int, ...], times: int) -> None:
        """Put a filling in ``times`` sequences, or take it out again where that is negative."""
        nonlocal used, waste
        for size in filling:
            left[size] -= times
        used, waste = used + times, waste + times * (capacity - sum(filling))

    # Depth first, in place; the first way down does not count, so that a packing is complete.
    while fewest > least:
        sizes = [s for s in kinds if left[s]]
        # Waste so far and what is left give the sequences this branch needs at least.
        if not sizes or -(-(total + waste) // capacity) >= fewest:
            if used < fewest and not sizes:
                best, fewest = list(done), used
            first = False
        elif branches >= BRANCHES:
            break
        else:
            branches += not first
            top = sizes[-1]
            left[top] -= 1
            options = _fillings(sizes, left, capacity - top, FILLINGS)
            left[top] += 1
            frames.append(iter([(top, *o) for o in options]))
        filling = None
        while frames and filling is None:
            if len(done) == len(frames):
                last, times = done.pop()
                move(last, -times)
            filling = next(frames[-1], None)
            if filling is None:
                frames.pop()
        if filling is None:
            break
        done.append((filling, _times(filling, left)))
        move(*done[-1])
    return best


def _slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset) for each slot of each pattern."""
    rows, base, ranks = [], 0, {}
    for filling, times in patterns:
        offset = 0
        for size in filling:
            rank = ranks.get(size, 0)
            rows.append((size, rank, rank + times - 1, base, offset))
            ranks[size] = rank + times
            offset += size
        base += times
    return rows


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece with ``sequence_id`` and ``offset``.

    A null or empty text is one piece, of id 0 alone. Rows alike may swap places; rows
    that share an identifier are packed each. Pieces of full length have a sequence of
    their own. What comes to the driver is the count of pieces by length, at most
    ``capacity`` numbers; the slots sent back are at most one per pattern and distinct
    length and place, and a pattern ends when a length is used up, so both have a bound
    that does not depend on the documents. An empty table gives an empty result.
    """
    cut = Table(pieces(docs, doc_id, text, path or tokenizer_path(), capacity), "pieces").df
    counted = cut.groupBy("length").count().collect()
    slots = _slots(complete({r["length"]: r["count"] for r in counted}, capacity))
    ranked = rank_in(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    ordered = sorted(slots)
    starts = np.array([(s << 40) + r for s, r, *_ in ordered], np.int64)
    firsts = np.array([r for _, r, *_ in ordered], np.int64)
    bases = np.array([b for *_, b, _ in ordered], np.int64)
    offsets = np.array([o for *_, o in ordered], np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(starts, (length << 40) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(bases[at] + rank - firsts[at]), pa.array(offsets[at])],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")
