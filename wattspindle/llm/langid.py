"""Language identification by rank-order profiles.

A language's profile lists its most frequent character n-grams by rank. A document's
own list is compared with each profile by the out-of-place distance: the sum of rank
differences, where an n-gram missing from the profile counts the greatest difference.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattspindle.llm.common import MB, extended, slices, without

#: n-grams in a language's profile and in a document's list.
PROFILE, LISTED = 400, 300
LONGEST = 3
#: Labelled rows per language that the profiles are learned from, chosen by a hash.
SAMPLE_PER_LANGUAGE = 3000
CHUNK = 1_000_000
UNDETERMINED = "und"
#: Code points from here on hold no letters.
LETTERS_END = 0x32400


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(LETTERS_END)] + [False])


def _codes(text: str) -> np.ndarray:
    """Lower-case letters; one 0 for each run of anything else, and at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[np.minimum(points, LETTERS_END)], points, 0)
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    return codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the words, with a mark at word ends, and their counts."""
    codes = _codes(text)
    found = []
    for begin in range(0, len(codes), CHUNK):
        part = codes[begin : begin + CHUNK + LONGEST - 1]
        keys = []
        for n in range(1, LONGEST + 1):
            starts = min(len(part) - n + 1, CHUNK)
            if starts <= 0:
                continue
            key = np.full(starts, n, np.uint64)
            within = np.ones(starts, bool)
            for i in range(n):
                code = part[i : i + starts]
                key = key << np.uint64(20) | code
                if 0 < i < n - 1 or n == 1:
                    within &= code != 0
            if n == 2:
                within &= (part[:starts] != 0) | (part[1 : 1 + starts] != 0)
            keys.append(key[within])
        found.append(np.unique(np.concatenate(keys), return_counts=True))
    if len(found) == 1:
        return found[0]
    keys, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([f[1] for f in found])).astype(np.int64)


def _ranked(keys: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent first, ties by key."""
    return keys[np.argsort(-counts, kind="stable")[:most]]


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning. A null identifier is neither learned from nor held out."""
    return F.expr(f"coalesce(crc32(cast(`{doc_id}` as string)) % 4 = 2, false)")


class Profiles:
    """Ranks of n-grams by language: plain arrays that travel with the tasks."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.languages = sorted({r[0] for r in rows})
        self.keys = np.array(sorted({r[1] for r in rows}), np.uint64)
        self.ranks = np.full((len(self.keys), len(self.languages)), -1, np.int64)
        for language, key, rank in rows:
            row = int(np.searchsorted(self.keys, np.uint64(key)))
            self.ranks[row, self.languages.index(language)] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        keys, counts = gram_counts(text or "")
        if not len(keys) or not len(self.keys):
            return UNDETERMINED, 0.0
        listed = _ranked(keys, counts, LISTED)
        at = np.minimum(np.searchsorted(self.keys, listed), len(self.keys) - 1)
        ranks = np.where((self.keys[at] == listed)[:, None], self.ranks[at], -1)
        apart = np.abs(ranks - np.arange(len(listed))[:, None])
        distance = np.where(ranks < 0, PROFILE, np.minimum(apart, PROFILE)).sum(axis=0)
        best = int(np.argmin(distance))
        return self.languages[best], 1.0 - float(distance[best]) / (PROFILE * len(listed))


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles from at most about ``SAMPLE_PER_LANGUAGE`` labelled rows of each language.

    Rows are chosen by a hash of the identifier, so reruns agree. Only n-gram ranks,
    ``PROFILE`` a language, come to the driver.
    """
    rows = docs.where(~held_out(doc_id) & F.col(f"`{doc_id}`").isNotNull()).select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.col(f"`{text}`").alias("text"),
        F.col(f"`{lang}`").alias("lang"),
    ).where("lang is not null")
    counted = rows.groupBy("lang").count()
    drawn = (
        rows.join(F.broadcast(counted), "lang")
        .where(f"pmod(xxhash64(id, 5), 1000000) < 1e6 * {SAMPLE_PER_LANGUAGE} / count")
        .select("lang", "text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 * MB):
            texts: dict[str, list[tuple]] = {}
            for language, value in zip(*[batch.column(i).to_pylist() for i in range(2)], strict=True):
                texts.setdefault(language, []).append(gram_counts(value or ""))
            for language, parts in texts.items():
                keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([p[1] for p in parts]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([language] * len(keys), pa.string()),
                        pa.array(keys.astype(np.int64)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    ["lang", "gram", "n"],
                )

    grams = drawn.mapInArrow(run, "lang string, gram long, n long")
    totals = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(order) - 1).where(f"rank < {PROFILE}")
    return Profiles([(r.lang, r.gram, r["rank"]) for r in top.select("lang", "gram", "rank").collect()])


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the similarity to that profile (0 to 1).

    A null text, or one without letters, is ``und`` with score 0, as is every text when
    nothing was learned. Ties go to the language that sorts first. A text in a script
    that no profile knows scores 0. Columns named like a result are replaced.
    """
    kept = without(docs, "lang_pred", "score")
    schema = extended(kept, "lang_pred string, score double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t) for t in batch.column(text).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string())]
            columns.append(pa.array([f[1] for f in found], pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.names)

    return kept.mapInArrow(run, schema)
