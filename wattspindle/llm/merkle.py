"""A Merkle manifest of a dataset, with a proof for every document by pointer jumping.

Leaves of a source, in the order of their identifiers, are hashed in runs of sixteen until
one node is left, the source's subroot; subroots, in the order of their sources, are hashed
likewise until one is left, the root. Every node then holds a pointer to its parent and the
digests of its siblings. A round joins the pointers with themselves: each node takes over
the pointer of the ancestor it points to and appends that ancestor's segment to its own, so
the distance to the ancestor doubles until all nodes point to the root.

The sixteen leaves of a run share one row and one way to the root, so the rounds move a
sixteenth of the rows. Everything is a DataFrame expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattspindle.llm.common import Table

FANOUT = 16
#: An ancestor of more leaves than this is repeated, and the nodes below it are dealt to the copies.
HOT = 1 << 16
TOP = -1
NODE = ["tree", "level", "idx"]
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of strings side by side."""
    return F.sha2(F.concat(*parts), 256)


def framed(column: Column) -> Column:
    """A value that cannot be mistaken for its neighbours: byte count, colon, text; ``-`` if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column | None = None, fields: list[str] | None = None) -> Column:
    """The digest of a document's fields; ``text`` stands in for the column of that name."""
    parts = {name: F.col(f"`{name}`") for name in fields or FIELDS}
    if text is not None:
        parts["text"] = text
    return digest(*[framed(c) for c in parts.values()])


def fold(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``, an array of (left, right) digests."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def siblings(path: Column) -> Column:
    """All digests of a path side by side, level by level, left to right."""
    return F.array_join(F.flatten(F.transform(path, lambda s: F.array(s["left"], s["right"]))), "")


def _marked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows written in order, with ``__part`` and the place ``__row`` in it.

    Range partitions hold neighbours, also of a group with most of the rows.
    """
    keys = [F.asc_nulls_first(c) for c in order]
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    table = Table(spread.withColumn("__mark", F.monotonically_increasing_id()), name).df
    # The identifier is made of the partition and, in its lower 33 bits, the row.
    part, row = F.shiftright("__mark", 33), F.col("__mark").bitwiseAND((1 << 33) - 1)
    return table.withColumn("__part", part).withColumn("__row", row).drop("__mark")


def _starts(marked: DataFrame, group: list[str]) -> DataFrame:
    """For each group and part: what to add to ``__row`` for the place in the group, and its size.

    A row for each part and each group, and one more where a group begins inside a part.
    """
    pieces = marked.groupBy(*group, "__part").agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    return pieces.select(
        *group,
        "__part",
        (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias("of"),
    )


def _placed(marked: DataFrame, starts: DataFrame, group: list[str]) -> DataFrame:
    """Marked rows with ``at``, their place in the group, and the other columns of ``starts``."""
    right = starts.select(
        *[F.col(c).alias(f"__of_{c}") for c in group],
        F.col("__part").alias("__of_part"),
        *[c for c in starts.columns if c not in (*group, "__part")],
    )
    same = F.col("__part") == F.col("__of_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    helpers = ["__part", "__of_part", "__row", "__shift", *[f"__of_{c}" for c in group]]
    return marked.join(right, same).withColumn("at", F.col("__row") + F.col("__shift")).drop(*helpers)


def _run(column: str) -> Column:
    return F.expr(f"{column} div {FANOUT}")


def _above(nodes: Column) -> Column:
    return F.ceil(nodes / FANOUT).cast("long")


@dataclass
class Tree:
    """Nodes of one level after the other, and the links between them."""

    tops: DataFrame
    links: list[DataFrame]
    levels: int
    tables: list[Table]


def _climb(nodes: DataFrame, level: int, name: str) -> Tree:
    """Hash runs of nodes (tree, idx, nodes, beneath, h) until each tree has one.

    ``nodes`` is the number of nodes at this level of the tree, ``beneath`` the leaves below
    a node. Each level is a sixteenth of the one before; a run is a group of sixteen rows.
    """
    made = Tree(None, [], level, [])
    while True:
        top = nodes.where("nodes = 1").select(
            "tree", F.lit(made.levels).alias("level"), "idx", "beneath", "h"
        )
        made.tops = top if made.tops is None else made.tops.unionByName(top)
        if (nodes.agg(F.max("nodes")).first()[0] or 0) <= 1:
            return made
        runs = (
            nodes.where("nodes > 1")
            .groupBy("tree", _run("idx").alias("idx"))
            .agg(
                F.sort_array(F.collect_list(F.struct("idx", "h", "beneath"))).alias("kids"),
                _above(F.max("nodes")).alias("nodes"),
                F.sum("beneath").alias("beneath"),
            )
            .withColumn("h", F.sha2(F.array_join("kids.h", ""), 256))
        )
        table = Table(runs, f"{name}-level")
        made.tables.append(table)
        kids = table.df.select(
            "tree", F.col("idx").alias("up_idx"), F.col("beneath").alias("up_beneath"),
            F.col("kids.h").alias("all"), F.posexplode("kids").alias("i", "kid"),
        )
        made.links.append(
            kids.select(
                "tree", F.lit(made.levels).alias("level"), F.col("kid.idx").alias("idx"), F.col("kid.beneath").alias("beneath"),
                F.col("tree").alias("up_tree"), F.lit(made.levels + 1).alias("up_level"), "up_idx", "up_beneath",
                F.array(_others(F.col("all"), F.col("i"))).alias("path"),
                F.lit(None).cast("string").alias("subroot"),
            )
        )
        made.levels += 1
        nodes = table.df.drop("kids")


def _others(digests: Column, i: Column) -> Column:
    """The digests of a run before and behind the one at place ``i``, each side by side."""
    return F.struct(
        F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
        F.array_join(F.slice(digests, i + 2, F.lit(FANOUT)), "").alias("right"),
    )


def _jump(links: DataFrame, root_level: int, distance: int) -> DataFrame:
    """Pointers doubled until each node points to the root, ``distance`` steps away at most."""
    table = Table(links, "pointers")
    at_root = (F.col("up_tree") == TOP) & (F.col("up_level") == root_level)
    reached = 1
    while reached < distance:
        old = table.df
        copies = F.expr(f"beneath div {HOT} + 1")
        ancestors = old.select(
            *[F.col(c).alias(f"__{c}") for c in old.columns],
            F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("__copy"),
        )
        going = old.where(~at_root).withColumn(
            "copy", F.expr(f"pmod(xxhash64(tree, idx), up_beneath div {HOT} + 1) + 1")
        )
        met = going.join(
            ancestors,
            (F.col("up_tree") == F.col("__tree"))
            & (F.col("up_level") == F.col("__level"))
            & (F.col("up_idx") == F.col("__idx"))
            & (F.col("copy") == F.col("__copy")),
        ).select(
            *NODE, "beneath",
            *[F.col(f"__{c}").alias(c) for c in ("up_tree", "up_level", "up_idx", "up_beneath")],
            F.concat("path", "__path").alias("path"),
            F.coalesce("subroot", "__subroot").alias("subroot"),
        )
        new = Table(met.unionByName(old.where(at_root)), "pointers")
        table.drop()
        table, reached = new, 2 * reached
    return table.df


def manifest(docs: DataFrame, leaf: Column | None = None, also: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, source, place, leaf, subroot, root, path), one row for each row of ``docs``.

    ``path`` leads from the leaf to the root: an array of (left, right), the digests of the
    siblings before and behind at each level; ``fold`` gives the root again. ``leaf`` is the
    digest of a row, by default ``leaf_of()``; ``also`` names further expressions over a
    row that the result keeps. Null identifiers and sources come first, rows alike in
    identifier are ordered by their leaf. A source of one row has its leaf as subroot; an
    empty table gives no rows. Other columns of ``docs`` play no part.
    """
    also = also or {}
    rows = docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"),
        F.col("`source`").cast("string").alias("source"),
        (leaf_of() if leaf is None else leaf).alias("leaf"),
        *[c.alias(f"__also_{name}") for name, c in also.items()],
    )
    kept = [f"__also_{name}" for name in also]
    hashed = Table(rows, "leaves")
    marked = _marked(hashed.df, ["source", "doc_id", "leaf"], "leaves")
    starts = Table(_starts(marked, ["source"]), "starts").df
    named = _marked(starts.select("source").distinct(), ["source"], "sources")
    trees = _placed(named, _starts(named, []), [])
    trees = trees.select(F.col("source").alias("__source"), F.col("at").alias("tree"), F.col("of").alias("__trees"))
    starts = starts.join(trees, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    leaves = _placed(marked, starts, ["source"])

    # A run of leaves is a node of level 1; a source's only leaf is that node itself.
    runs = leaves.groupBy("tree", _run("at").alias("idx")).agg(
        F.sort_array(F.collect_list(F.struct("at", "doc_id", "leaf", *kept))).alias("kids"),
        F.min("source").alias("source"),
        F.max("of").alias("of"),
        F.max("__trees").alias("trees"),
    )
    lone = F.col("of") == 1
    runs = runs.withColumn(
        "h", F.when(lone, F.col("kids")[0]["leaf"]).otherwise(F.sha2(F.array_join("kids.leaf", ""), 256))
    )
    runs = Table(runs, "runs").df
    hashed.drop()
    low = _climb(
        runs.select(
            "tree", "idx", _above(F.col("of")).alias("nodes"), F.size("kids").cast("long").alias("beneath"), "h"
        ),
        1,
        "merkle",
    )
    subroots = Table(
        low.tops.join(runs.where("idx = 0").select("tree", "trees"), "tree"), "subroots"
    ).df
    high = _climb(
        subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("nodes"), "beneath", "h"),
        0,
        "merkle-top",
    )
    # A subroot is a leaf of the tree of sources: the same node under another name.
    same = subroots.select(
        *NODE, "beneath", F.lit(TOP).cast("long").alias("up_tree"), F.lit(0).alias("up_level"),
        F.col("tree").alias("up_idx"), F.col("beneath").alias("up_beneath"),
        F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("path"),
        F.col("h").alias("subroot"),
    )
    links = same
    for link in (*low.links, *high.links):
        links = links.unionByName(link)
    pointers = _jump(links, high.levels, low.levels + high.levels)
    found = high.tops.first()
    for table in (*low.tables, *high.tables):
        table.drop()
    way = pointers.where("level = 1 and tree >= 0").select("tree", "idx", "path", "subroot")
    every = runs.join(way, ["tree", "idx"]).select(
        "source", "of", "path", "subroot", F.col("kids.leaf").alias("all"), F.posexplode("kids").alias("i", "kid")
    )
    own = F.when(F.col("of") > 1, F.array(_others(F.col("all"), F.col("i"))))
    return every.select(
        F.col("kid.doc_id").alias("doc_id"),
        "source",
        F.col("kid.at").alias("place"),
        F.col("kid.leaf").alias("leaf"),
        "subroot",
        F.lit(found["h"] if found else None).cast("string").alias("root"),
        F.coalesce(F.concat(own, "path"), F.col("path")).alias("path"),
        *[F.col(f"kid.__also_{name}").alias(name) for name in also],
    )


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other characters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def tamper_check(docs: DataFrame) -> DataFrame:
    """The digest columns of a trial: where 5 divides the CRC-32 of the identifier, the text is
    lower-cased after the manifest was made, and the proofs must tell.

    A row without identifier is not tampered with.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.col("text").cast("string")
    changed = F.when(chosen & (lower_ascii(text) != text), leaf_of(lower_ascii(text)))
    proofs = manifest(docs, also={"changed": changed})
    folded = fold(F.col("path"), F.coalesce("changed", "leaf"))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
