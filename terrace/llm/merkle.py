"""Merkle manifest of a dataset, with a proof for every row.

Rows are leaves, in trees by group: in the order of a group's keys, every ``FANOUT`` consecutive
nodes form a run, and the digest of a run is a node of the next level, until one node is left.
These, in the order of the groups, are the leaves of the top tree, whose last node is the root.

Proofs are found by pointer jumping.  A run holds the segment of the way up that it knows, at
first itself, and a pointer to the run that follows the segment.  Repeated self-joins append to
each segment the one its pointer names and take over that one's pointer, so the distance
doubles, and after log2(height) rounds every way ends at the root.  A leaf's siblings are the
others of the runs on its way.  The runs hold each digest once, where proofs hold it once for
every sibling, so the jumps move a sixteenth of the rows, and proofs are unfolded only where
a leaf meets the run it is in.

Only runs that many jumps may still reach are joined: those at least as high as a pointer is long.  A
run is reached by at most ``FANOUT ** distance`` others, and no task holds a group, whatever its share.

Defined results: a null field is ``-``; a null group comes first and is not the empty one; a null
key comes first in its group; rows that repeat a key are ordered by their digests, and equal rows
are leaves of their own; a group of one row has its leaf as top; a single row is the root
itself; an empty table has no root and gives no rows; long texts are digested whole; other
columns are carried by ``proofs`` if they are given to ``leaves``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import materialize, positions

FANOUT = 16
#: The top tree; other trees are named by ``_tree``, which gives "" and names beginning with "=".
TOP = "top"
NODES = (
    "tree string, level int, place long, runs array<array<string>>, places array<int>, "
    "up_tree string, up_level int, up_place long, subroot string, root string"
)


def field(value: Column) -> Column:
    """UTF-8 byte count, ``:`` and the value as text; ``-`` if it is null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def digest_of(digests: Column) -> Column:
    """The digest of digests, concatenated as hexadecimal text."""
    return F.sha2(F.array_join(digests, ""), 256)


def _tree(group: Column) -> Column:
    """A name per group, in the groups' order, that null has too."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def leaves(docs: DataFrame, group: Column, key: Column, fields: Sequence[Column], **carried: Column) -> DataFrame:
    """One row per leaf: ``tree, place, leaf`` and the ``carried`` columns.  Reads the rows once."""
    narrow = materialize(
        docs.select(
            _tree(group).alias("tree"),
            key.alias("key"),
            row_digest(fields).alias("leaf"),
            F.struct(F.lit(1).alias("one"), *[c.alias(n) for n, c in carried.items()]).alias("carried"),
        )
    )
    order = [F.col("tree"), F.col("key").asc_nulls_first(), F.col("leaf")]
    return materialize(positions(narrow, order, ["tree"]).withColumnRenamed("position", "place").drop("key"))


def _forest(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of trees over ``tree, place, digest``, and per tree its last node and that one's level.

    A round builds a level of all trees.  A run at place 0 that has one member is the last node of its tree.
    """
    levels, tops, level = [], [], 0
    member = F.sort_array(F.collect_list(F.struct("place", "digest")))["digest"]
    while True:
        grouped = materialize(
            nodes.groupBy("tree", F.expr(f"place div {fanout}").alias("run"))
            .agg(member.alias("digests"))
            .select("tree", F.col("run").alias("place"), "digests", digest_of(F.col("digests")).alias("digest"))
        )
        last = (F.col("place") == 0) & (F.size("digests") == 1)
        tops.append(grouped.where(last).select("tree", F.lit(level).alias("level"), F.col("digests")[0].alias("digest")))
        level += 1
        runs = grouped.where(~last)
        if runs.isEmpty():
            return levels, materialize(reduce(DataFrame.unionByName, tops))
        levels.append(runs.withColumn("level", F.lit(level)))
        nodes = runs.select("tree", "place", "digest")


def _ways(tree_levels: list[DataFrame], top_levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """Every run with its own segment and its pointer; a tree that is one leaf has a run of no nodes."""
    alone = F.lit(not top_levels)  # a single tree: its last node is the root
    tip = tops.select(
        F.col("tree").alias("t_tree"),
        F.col("level").alias("t_level"),
        F.col("digest").alias("t_digest"),
        F.when(~alone, F.array((F.col("position") % fanout).cast("int"))).otherwise(F.array().cast("array<int>")).alias("t_places"),
        F.when(~alone, F.lit(TOP)).alias("t_up"),
        F.when(~alone, F.lit(1)).alias("t_up_level"),
        F.when(~alone, F.expr(f"position div {fanout}")).alias("t_up_place"),
        F.when(alone, F.col("digest")).alias("t_root"),
    )
    at_tip = [F.col("t_places"), F.col("t_up"), F.col("t_up_level"), F.col("t_up_place"), F.col("t_digest"), F.col("t_root")]
    names = ["places", "up_tree", "up_level", "up_place", "subroot", "root"]

    def inside(runs: DataFrame) -> list[Column]:
        none = F.lit(None).cast("string")
        at = F.array((F.col("place") % fanout).cast("int"))
        return [at, F.col("tree"), F.col("level") + 1, F.expr(f"place div {fanout}"), none, none]

    frames = [
        tip.where("t_level = 0").select(
            F.col("t_tree").alias("tree"),
            F.lit(1).alias("level"),
            F.lit(0).cast("long").alias("place"),
            F.array().cast("array<array<string>>").alias("runs"),
            *[c.alias(n) for c, n in zip(at_tip, names)],
        )
    ]
    for runs in tree_levels:
        joined = runs.join(
            tip, (F.col("tree") == F.col("t_tree")) & (F.col("level") == F.col("t_level")) & (F.col("place") == 0), "left"
        )
        ended = F.col("t_tree").isNotNull()
        frames.append(
            joined.select(
                "tree", "level", "place", F.array("digests").alias("runs"),
                *[F.when(ended, a).otherwise(b).alias(n) for a, b, n in zip(at_tip, inside(runs), names)],
            )
        )
    for i, runs in enumerate(top_levels):
        final = i + 1 == len(top_levels)
        none, nothing = F.lit(None).cast("string"), F.lit(None)
        last_run = [F.array().cast("array<int>"), none, nothing.cast("int"), nothing.cast("long"), none, F.col("digest")]
        frames.append(
            runs.select(
                "tree", "level", "place", F.array("digests").alias("runs"),
                *[c.alias(n) for c, n in zip(last_run if final else inside(runs), names)],
            )
        )
    return reduce(DataFrame.unionByName, frames)


def _jump(ways: DataFrame, reach: int) -> DataFrame:
    """Append to every way the one its pointer names.  Pointers are ``reach`` levels long."""
    pending = ways.where("up_tree IS NOT NULL")
    named = ways.where((F.col("level") > reach) | (F.col("tree") == TOP)).select(
        *[F.col(c).alias(f"n_{c}") for c in ways.columns]
    )
    same = [F.col(f"up_{c}") == F.col(f"n_{c}") for c in ("tree", "level", "place")]
    further = pending.join(named, reduce(Column.__and__, same)).select(
        "tree", "level", "place",
        F.concat("runs", "n_runs").alias("runs"),
        F.concat("places", "n_places").alias("places"),
        F.col("n_up_tree").alias("up_tree"), F.col("n_up_level").alias("up_level"), F.col("n_up_place").alias("up_place"),
        F.coalesce("subroot", "n_subroot").alias("subroot"), F.coalesce("root", "n_root").alias("root"),
    )
    return ways.where("up_tree IS NULL").unionByName(further)


@dataclass(frozen=True)
class Manifest:
    """``leaves`` as given, ``ways`` from each lowest run to the root, ``subroots`` per group."""

    leaves: DataFrame
    ways: DataFrame
    subroots: DataFrame
    root: str | None
    fanout: int = FANOUT

    def proofs(self) -> DataFrame:
        """``leaf, subroot, root, steps`` and the carried columns of every leaf.

        ``steps`` has per level the siblings to the left and to the right, each as one text.
        """
        first = self.ways.where((F.col("level") == 1) & (F.col("tree") != TOP)).select(
            F.col("tree").alias("w_tree"), F.col("place").alias("w_place"), "runs", "places", "subroot", "root"
        )
        own = F.array((F.col("place") % self.fanout).cast("int"))
        places = F.when(F.size("places") < F.size("runs"), F.concat(own, F.col("places"))).otherwise(F.col("places"))

        def others(at: Column, run: Column) -> Column:
            after = F.slice(run, at + 2, self.fanout)
            return F.struct(
                F.array_join(F.slice(run, F.lit(1), at), "").alias("left"), F.array_join(after, "").alias("right")
            )

        run = F.expr(f"place div {self.fanout}")
        met = self.leaves.join(first, (F.col("tree") == F.col("w_tree")) & (run == F.col("w_place")))
        return met.select("leaf", "subroot", "root", F.zip_with(places, F.col("runs"), others).alias("steps"), "carried.*").drop("one")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    return digest_of(F.transform(steps, lambda s: F.concat(s["left"], s["right"])))


def build(rows: DataFrame, fanout: int = FANOUT) -> Manifest:
    """The manifest of ``leaves``.  The driver sees one digest, and per level whether it has runs."""
    tree_levels, tops = _forest(rows.select("tree", "place", F.col("leaf").alias("digest")), fanout)
    tops = materialize(positions(tops, [F.col("tree")], []))
    top_nodes = tops.select(F.lit(TOP).alias("tree"), F.col("position").alias("place"), "digest")
    top_levels, last = _forest(top_nodes, fanout)
    root = last.first()
    ways, reach = materialize(_ways(tree_levels, top_levels, tops, fanout)), 1
    while not ways.where("up_tree IS NOT NULL").isEmpty():
        ways, reach = materialize(_jump(ways, reach)), reach * 2
    subroots = tops.select(
        F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("group"), F.col("digest").alias("subroot")
    )
    return Manifest(rows, ways, subroots, root and root["digest"], fanout)
