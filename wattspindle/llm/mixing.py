"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length. Of each length a mix first takes the
same share, as far as whole documents go; then single documents in a seeded order of
lengths while the budget is large; and a bounded-knapsack dynamic program over the
lengths that are left fits the rest. Which documents of a length are taken is decided
by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattspindle.llm.common import WORD, Table, rank_in, without

WEIGHTS = (3.0, 1.0, 2.0)
#: The mix has this share of all sizes, and a source at most this multiple of its own.
SHARE, MOST = 1.5, 2
SEED = 17
#: The dynamic program fits budgets of about this many words.
FITTED = 65_536


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, source: str | None) -> np.ndarray:
    """How many documents of each size to take so that their sum is nearest ``budget``.

    ``sizes`` are distinct and positive; at most ``counts`` of each are taken.
    """
    taken = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return counts.copy()
    # The same share of every length, less what the dynamic program is to fit.
    spare = max(budget - FITTED, 0)
    taken = np.array([int(c) * spare // total for c in counts], np.int64)
    left = budget - int((sizes * taken).sum())
    name = "" if source is None else source
    order = sorted(
        range(len(sizes)), key=lambda i: xxhash.xxh64_intdigest(f"{name}\0{sizes[i]}", SEED)
    )
    for i in order:
        if left <= FITTED:
            break
        if taken[i] < counts[i] and sizes[i] <= left - FITTED // 2:
            taken[i] += 1
            left -= int(sizes[i])
    return taken + _knapsack(sizes, counts - taken, left, order)


def _knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int, order: list[int]) -> np.ndarray:
    """Bounded knapsack: bit s of ``reached`` says that some choice has the sum s."""
    taken = np.zeros(len(sizes), np.int64)
    if budget <= 0:
        return taken
    # A sum beyond the budget can be the nearest, but not from twice the budget on.
    limit = budget + min(budget, int(sizes[counts > 0].max(initial=0)))
    mask = (1 << (limit + 1)) - 1
    reached, steps = 1, []
    for i in order:
        size, count, power = int(sizes[i]), int(counts[i]), 1
        count = min(count, limit // size)
        while count > 0:
            part = min(power, count)
            new = (reached | reached << (part * size)) & mask
            if new != reached:
                steps.append((i, part, reached))
                reached = new
            count -= part
            power *= 2
        if reached >> budget & 1:
            break
    below = (reached & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reached >> budget
    up = (above & -above).bit_length() - 1 if above else None
    at = budget + up if up is not None and up < budget - below else below
    for i, part, before in reversed(steps):
        if before >> at & 1:
            continue
        taken[i] += part
        at -= part * int(sizes[i])
    return taken


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Weights repeat over the sources in code-point order, null last. A target stops at
    ``MOST`` times its source's size and what exceeds it is shared again by weight: so
    each target is the smaller of that stop and weight x level, for one level.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.col("__n") % len(WEIGHTS) + 1)
    named = sources.withColumn("__n", F.row_number().over(by_name) - 1).withColumn("__w", weight)
    full = named.withColumn("__stop", F.col("source_size") * float(MOST)).withColumn(
        "__at", F.col("__stop") / F.col("__w")
    )
    # Sources stop in the order of __at. The first whose share, once all before it have
    # stopped, is below its own stop fixes the level; from there on shares only fall.
    before = everything.orderBy("__at", "__n").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * SHARE
    stopped = F.coalesce(F.sum("__stop").over(before), F.lit(0.0))
    weights = F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))
    level = full.withColumn("__level", (budget - stopped) / weights)
    level = level.withColumn(
        "__level", F.max(F.when(F.col("__level") <= F.col("__at"), F.col("__level"))).over(everything)
    )
    target = F.least(F.col("__stop"), F.coalesce(F.col("__w") * F.col("__level"), F.col("__stop")))
    return level.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    row: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row for each row of ``docs``.

    The columns ``row`` are kept besides, and tell rows apart that share an identifier.

    ``size`` counts the words of the text, 0 for null; ``taken`` the words that the mix
    takes of it: 0, or once or twice its size. Rows without words are never taken. Rows
    alike in identifier, source and size may swap places. An empty table gives an empty
    result, and a null source is a source of its own.
    """
    column = F.col(f"`{text}`")
    slim = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.coalesce(F.regexp_count(column, F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
        *row,
    )
    sized = Table(slim, "sizes").df
    lengths = Table(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths").df
    sums = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aims = Table(targets(sums), "targets").df

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size").reset_index(drop=True)
        whole, budget = divmod(round(float(rows["target"].iloc[0])), int(rows["source_size"].iloc[0]))
        more = fit(
            rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), budget, rows["source"].iloc[0]
        )
        rows["whole"], rows["more"] = whole, more
        return rows[["source", "size", "whole", "more"]]

    worded = lengths.where("size > 0").join(
        aims.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))
    )
    plan = worded.groupBy("source").applyInPandas(
        run, "source string, size long, whole long, more long"
    )
    planned = Table(plan, "plan").df
    ranked = rank_in(sized.where("size > 0"), ["source", "size"], ["doc_id"], "rank", SEED, row)
    chosen = ranked.join(
        planned.select(F.col("source").alias("__s"), F.col("size").alias("__z"), "whole", "more"),
        F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")),
    ).select(
        "doc_id",
        "source",
        "size",
        *row,
        (F.col("size") * (F.col("whole") + F.when(F.col("rank") < F.col("more"), 1).otherwise(0))).alias("taken"),
    )
    empty = sized.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (
        chosen.unionByName(empty)
        .join(aims.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
        .select("doc_id", "size", "source_size", "target", "taken", *row)
    )


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken.

    Rows that share an identifier are told apart by text and source. Only rows alike in all
    three are taken as often as the most taken of them.
    """
    kept = without(docs, "__of", "__times", "__row")
    names = [F.col(f"`{c}`").cast("string") for c in (doc_id, source, text)]
    # Null and empty differ, and neither moves a value into its neighbour.
    keyed = kept.withColumn("__row", F.xxhash64(*names, *[c.isNull() for c in names]))
    times = (
        mix(keyed, doc_id, text, source, ("__row",))
        .where("taken > 0")
        .groupBy(F.col("__row").alias("__of"))
        .agg(F.max(F.expr("cast(taken / size as int)")).alias("__times"))
    )
    return (
        keyed.join(times, F.col("__row") == F.col("__of"))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
        .select(*[f"`{c}`" for c in kept.columns])
    )
