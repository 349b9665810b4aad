"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel of two words sums over the letter triples that both hold as subsequences, in
gaps of a few letters, each weighted by its stretch: an insult with letters inserted or
changed still shares most of its triples. Words are described by their kernel with a
bounded set of landmark words, whitened (Nystroem), and a squared-hinge machine is
trained on them. Labels are those of documents: a word is an example of an insult if
documents that hold it are toxic far more often than by chance, and of a clean word if a
clean document holds it; the machine's own worst mistakes in clean documents are added
and it is trained again. A sentence is as toxic as its worst word, a document as its worst
sentence, and a logistic curve turns that value into a score.

The normalised triple kernel is sharpened by an exponential, so that a clean word close to
an insult can be told from it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspindle.llm.common import MB, Table, extended, slices, without
from wattspindle.llm.langid import held_out

#: Places between the first and last letter of a triple, at most, and the weight of a place.
STRETCH, DECAY = 5, 0.7
#: Letters fall into this many classes: a-z and both word ends have their own, others share the rest.
CLASSES = 64
BEGIN, END = "\x01", "\x02"
#: Longer words are read in overlapping parts.
PART, STEP = 20, 10
#: Labelled documents, words and landmarks that the machine is trained on.
SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 6000
INSULTS, CLEAN_WORDS, LANDMARKS = 1500, 10_000, 96
#: Words a pool of landmarks is chosen from, and insults that are varied.
LISTED, VARIED = 400, 60
#: The kernel of two words is exp((k - 1) / WIDTH), k being the normalised triple kernel.
WIDTH = 0.25
#: Words of a generation whose value a Python worker remembers: some 60 MB.
REMEMBERED = 300_000
#: Evidence that a word marks toxic documents: twice the log likelihood ratio, and share.
EVIDENCE, SHARE = 15.0, 0.7
#: What mistakes cost in all on either side, and the documents a mined clean word counts for.
COST, HARD = 3000.0, 20
THRESHOLD = 0.3

_MARKS = re.compile(r"[^\w\s]|[\d_]")
_SPELLED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
_GAPS = [(d, s) for s in range(2, STRETCH + 1) for d in range(1, s)]
_WEIGHTS = np.array([DECAY ** (s + 1) for s in range(2, STRETCH + 1)])


def words(text: str | None) -> set[str]:
    """Distinct words, lower-cased, letters only; also words spelled out letter by letter."""
    plain = _MARKS.sub("", (text or "").lower())
    found = set(plain.split())
    found.update("".join(run.split()) for run in _SPELLED.findall(plain))
    return found


def _parts(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter classes of each part of each word with its ends, -1 behind; and whose part it is."""
    cut, owner = [], []
    for i, name in enumerate(names):
        name = f"{BEGIN}{name}{END}"
        if len(name) <= PART:
            cut.append(name)
            owner.append(i)
        else:
            for at in range(0, len(name) - PART + STEP, STEP):
                cut.append(name[at : at + PART])
                owner.append(i)
    lengths = np.fromiter(map(len, cut), np.int64, len(cut))
    points = np.frombuffer("".join(cut).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    plain = (points >= 97) & (points <= 122)
    letters = np.where(plain, points - 97, 26 + points % (CLASSES - 28))
    letters = np.where(points <= ord(END), CLASSES - 3 + points, letters)
    matrix = np.full((len(cut), max(int(lengths.max(initial=0)), 1)), -1, np.int64)
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = letters
    return matrix, np.array(owner, np.int64)


def triples(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, triple, weight) of each distinct triple of each row."""
    kind = np.uint32 if len(matrix) <= 4096 else np.uint64
    letter, keys = matrix.astype(kind), []
    row = (np.arange(len(matrix), dtype=kind) << kind(20))[:, None]
    for first, stretch in _GAPS:
        wide = matrix.shape[1] - stretch
        if wide > 0:
            triple = letter[:, :wide] * kind(CLASSES) + letter[:, first : first + wide]
            triple = triple * kind(CLASSES) + letter[:, stretch:]
            key = row | triple << kind(2) | kind(stretch - 2)
            keys.append(key[matrix[:, stretch:] >= 0])
    keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, kind)
    heads = np.flatnonzero(np.r_[True, keys[1:] >> kind(2) != keys[:-1] >> kind(2)][: len(keys)])
    weight = np.add.reduceat(_WEIGHTS[keys & kind(3)], heads) if len(heads) else np.zeros(0)
    found = keys[heads].astype(np.int64)
    return found >> 20, found >> 2 & 0x3FFFF, weight


def _described(names: list[str]) -> tuple[np.ndarray, ...]:
    """(row, triple, weight) of parts of unit length, and the word each part belongs to."""
    matrix, owner = _parts(names)
    row, triple, weight = triples(matrix)
    norm = np.sqrt(np.bincount(row, weight * weight, len(matrix)))
    return row, triple, (weight / np.maximum(norm[row], 1e-12)).astype(np.float32), owner


class Memory:
    """Values of words in two generations; one used again moves to the young one."""

    def __init__(self):
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def recalled(self, names: set[str], values: Callable[[list[str]], np.ndarray]) -> dict[str, float]:
        """A table with the values of ``names`` at least, the unknown ones worked out."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        unknown = []
        for name in names.difference(self.young):
            if name in self.old:
                self.young[name] = self.old[name]
            else:
                unknown.append(name)
        self.young.update(zip(unknown, values(unknown).tolist(), strict=True))
        return self.young


class Machine:
    """Landmark words with a coefficient each, an offset, and the logistic curve."""

    def __init__(self, marks: list[str], coefficients: np.ndarray, offset: float):
        self.offset, self.slope, self.level = offset, 1.0, 0.0
        self.coefficients = coefficients.astype(np.float32)
        row, triple, weight, _ = _described(marks)
        self.kinds = np.unique(triple)
        self.table = np.zeros((len(self.kinds), len(marks)), np.float32)
        self.table[np.searchsorted(self.kinds, triple), row] = weight

    def kernel(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Kernel of each part of each word with each landmark, and whose part it is."""
        row, triple, weight, owner = _described(names)
        result = np.zeros((len(owner), self.table.shape[1]), np.float32)
        if len(self.kinds):
            at = np.minimum(np.searchsorted(self.kinds, triple), len(self.kinds) - 1)
            known = np.flatnonzero(self.kinds[at] == triple)
            row, at, weight = row[known], at[known], weight[known]
            heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)])
            if len(heads):
                result[row[heads]] = np.add.reduceat(self.table[at] * weight[:, None], heads)
        return np.exp((result - 1) / WIDTH), owner

    def values(self, names: list[str]) -> np.ndarray:
        """The machine's value of each word, that of its worst part."""
        result = np.full(len(names), self.offset)
        order = np.argsort(np.fromiter(map(len, names), np.int64, len(names)), kind="stable")
        for begin in range(0, len(order), 4000):
            at = order[begin : begin + 4000]
            near, owner = self.kernel([names[i] for i in at.tolist()])
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            result[at] = np.maximum.reduceat(near @ self.coefficients, heads) + self.offset
        return result

    def score(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.level, -40, 40)))

    def worst(self, texts: list[str | None], memory: Memory) -> tuple[np.ndarray, list[str]]:
        """The highest value among each text's words, and that word."""
        owned = [words(t) for t in texts]
        known = memory.recalled(set().union(*owned), self.values)
        best, which = np.full(len(texts), self.offset), [""] * len(texts)
        for i, own in enumerate(owned):
            if own:
                word = max(own, key=lambda w: (known[w], w))
                best[i], which[i] = max(known[word], self.offset), word
        return best, which


def _chosen(pool: list[str], most: int) -> list[str]:
    """Landmarks from a pool, in its order, none too close to those before it."""
    pool = list(dict.fromkeys(w[: PART - 2] for w in pool if len(w) >= 3))[:LISTED]
    if not pool:
        return []
    near, _ = Machine(pool, np.zeros(len(pool)), 0.0).kernel(pool)
    taken: list[int] = []
    for i in range(len(pool)):
        if len(taken) < most and near[i, taken].max(initial=0) < 0.8:
            taken.append(i)
    return [pool[i] for i in taken]


def _varied(names: list[str], seed: int = 3) -> list[str]:
    """Words with a letter inserted or doubled, as those write who evade filters."""
    rng, result = np.random.default_rng(seed), []
    for name in names:
        if len(name) >= 4:
            for letter in (chr(97 + rng.integers(26)), chr(97 + rng.integers(26)), ""):
                at = int(rng.integers(1, len(name)))
                result.append(name[:at] + (letter or name[at]) + name[at:])
    return result


def train(insults: dict[str, int], clean: dict[str, int], hard: list[str]) -> Machine:
    """A machine on example words: Nystroem features, squared hinge, balanced classes.

    Words count by the documents that hold them, an insult by toxic, a clean one by clean
    ones. Variants of the surest insults are examples too.
    """
    varied = {w: 4 for w in _varied(list(insults)[:VARIED]) if w not in clean}
    insults = {**varied, **insults}
    by_count = sorted(clean, key=lambda w: (-clean[w], w))
    marks = _chosen(sorted(insults, key=lambda w: (-insults[w], w)), LANDMARKS // 2)
    marks += _chosen(hard, LANDMARKS // 4)
    marks = list(dict.fromkeys([*marks, *_chosen(by_count, LANDMARKS - len(marks))]))
    names = [w[: PART - 2] for w in [*insults, *clean, *hard]]
    sign = np.r_[np.ones(len(insults)), -np.ones(len(clean) + len(hard))]
    machine = Machine(marks, np.zeros(len(marks)), 0.0)
    size, vectors = np.linalg.eigh(machine.kernel(marks)[0].astype(float))
    use = size > 1e-5
    white = vectors[:, use] / np.sqrt(size[use])
    near = [machine.kernel(names[i : i + 2000])[0] @ white for i in range(0, len(names), 2000)]
    features = np.c_[np.concatenate(near), np.ones(len(names))]
    cost = np.r_[list(insults.values()), list(clean.values()), np.full(len(hard), HARD)]
    cost = np.sqrt(cost.astype(float))
    cost *= np.where(sign > 0, 1 / cost[sign > 0].sum(), 1 / cost[sign < 0].sum()) * COST
    ridge = np.eye(features.shape[1])
    ridge[-1, -1] = 1e-3
    solution = np.zeros(features.shape[1])
    for _ in range(30):
        near = sign * (features @ solution) < 1
        x, c = features[near], cost[near]
        new = np.linalg.solve(ridge + (x * c[:, None]).T @ x, (x * c[:, None]).T @ sign[near])
        if np.allclose(new, solution, atol=1e-7):
            break
        solution = new
    return Machine(marks, white @ solution[:-1], float(solution[-1]))


def _curve(values: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve, by Newton steps with a small ridge."""
    x = np.c_[values, np.ones(len(values))]
    beta = np.array([1.0, 0.0])
    ridge = np.diag([1e-2, 1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (toxic - p)) - ridge @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> Machine:
    """Train on a bounded, hashed sample of labelled documents that are not held out.

    A document with several labels is toxic if one of them says so. Without toxic or
    without clean examples the machine scores every text with the toxic share.
    """
    known = (
        labels.where(F.col(toxic).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy(F.col("doc_id").alias("__of"))
        .agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    )
    total = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    n_toxic, n_clean = total.get(1, 0), total.get(0, 0)
    share = n_toxic / (n_toxic + n_clean) if n_toxic + n_clean else 0.0
    constant = Machine([], np.zeros(0), 0.0)
    constant.level = _logit(share)
    if not n_toxic or not n_clean:
        return constant
    rate = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_TOXIC / n_toxic)).otherwise(min(1.0, SAMPLE_CLEAN / n_clean))
    drawn = known.where(F.expr("pmod(xxhash64(__of, 9), 1000000)") < rate * 1e6)
    # About SAMPLE_TOXIC + SAMPLE_CLEAN identifiers, whatever the tables hold.
    sample = Table(
        docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("text"))
        .join(F.broadcast(drawn), F.col("__id") == F.col("__of"))
        .select("toxic", "text"),
        "labelled",
    ).df

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 * MB):
            rows = [
                (w, y)
                for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for w in words(t)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int32())],
                    ["word", "toxic"],
                )

    counted = (
        sample.mapInArrow(listed, "word string, toxic int")
        .groupBy("word")
        .agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("q"))
    )
    counted = Table(counted, "words").df
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        return constant
    base = n[1] / (n[0] + n[1])
    evidence = F.expr(
        f"2 * (p * ln(p / (p + q) / {base}) + if(q > 0, q * ln(q / (p + q) / {1 - base}), 0))"
    )
    marked = counted.where((F.col("p") >= 2) & (F.expr("p / (p + q)") >= SHARE)).withColumn("e", evidence)
    top = marked.where((F.col("e") >= EVIDENCE) & (F.length("word") >= 3))
    insults = {r.word: r.p for r in top.orderBy(F.desc("e"), "word").limit(INSULTS).collect()}
    if not insults:
        loose = marked.where(F.length("word") >= 3).orderBy(F.desc("e"), "word").limit(10)
        insults = {r.word: r.p for r in loose.collect()}
    plain = counted.where("q > 0").orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS)
    clean = {r.word: r.q for r in plain.collect() if r.word not in insults}
    if not insults or not clean:
        return constant

    def judged(machine: Machine) -> list:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Memory()
            for batch in slices(batches, "text", 2 * MB):
                value, word = machine.worst(batch.column(1).to_pylist(), known)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(value), pa.array(word)], ["toxic", "value", "word"]
                )

        return sample.mapInArrow(run, "toxic int, value double, word string").collect()

    hard: list[str] = []
    for _ in range(2):
        machine = train(insults, clean, hard)
        rows = judged(machine)
        worst = {r.word[:PART] for r in rows if not r.toxic and r.value > -0.5 and r.word}
        new = sorted(worst - insults.keys() - clean.keys() - set(hard))
        if not new:
            break
        hard += new
    else:
        machine = train(insults, clean, hard)
        rows = judged(machine)
    value, y = np.array([r.value for r in rows]), np.array([float(r.toxic) for r in rows])
    weight = np.where(y > 0, n_toxic / n[1], n_clean / n[0])
    machine.slope, machine.level = _curve(value, y, weight / weight.mean())
    return machine


def _logit(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


@lru_cache(maxsize=1)
def _remembered(fingerprint: str) -> Memory:
    """A Python worker's values of words, for one machine."""
    return Memory()


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on).

    The whole text counts. A null or empty text, or one without letters, has the score of
    a text with no suspicious word. Columns named like a result are replaced.
    """
    kept = without(docs, "score", "predicted")
    schema = extended(kept, "score double, predicted int")
    fingerprint = xxhash.xxh64_hexdigest(machine.coefficients.tobytes() + machine.table.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _remembered(fingerprint)
        for batch in slices(batches, text, 4 * MB):
            found = machine.score(machine.worst(batch.column(text).to_pylist(), known)[0])
            marks = pa.array((found >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), marks], schema.names)

    return kept.mapInArrow(run, schema)
