"""Prefix trie of conversations, from sorted common prefixes.

Conversations are sorted by their turns; the members of a node then stand side by side.  Each
one's LCP is the number of turns it shares with the next.  A node that ends a conversation or
branches is a candidate: every place asks for its own length and for its LCP.  Each candidate
finds the extents of its members independently, to the left and to the right, by binary search
over a sparse table of range minima of the LCPs: from the widest step to the narrowest, it
passes over a stretch if nothing in it is below its depth.  No stack walks the places in order.

The table has one level for places, in blocks of ``BLOCK``, and one for the minima of blocks, and
so on, until a level is one block.  A search leaves its block upwards, stops at the entry that
is too low, and follows it downwards, so no task holds more than a block and its searches.
What a stretch adds to a node (its smallest member, its leaves, the words its places share) is
in the table beside the minima.  Candidates of a block that reach equally far are merged first,
so that a prefix or a conversation a third of all share is searched once per block.

A node between two candidates on one way has the lower one's members; these chains are unfolded
last.  The words a subtree saves come from its extents alone: with W(d) the words of a member's
first d turns, they are the sum of W(LCP) over its places but the last, less
W(depth - 1) for each of its members but one.

Defined results: a null role or text is empty; turns with a null number come first, and
equal ones are ordered by role and text, repeated rows are turns each; turns without a
conversation id are in no conversation; a conversation without turns is a member of the root
alone; no conversations have no root and give no rows; other columns are dropped.  Texts are
digested before they are gathered: a conversation has 32 bytes and a number per turn in a row,
and its texts may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import NON_SPACE, materialize, positions, ship_library, text_or_empty

#: Places in a block.
BLOCK = 1 << 10
NO_CONV = np.iinfo(np.int64).max
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
DONE = -1

CANDIDATES = (
    "block long, candidate int, depth int, first long, last long, before int, after int, "
    "conv long, shared long, leaves long, ends string, branches array<long>"
)
SEARCHES = "block long, candidate int, side int, depth int, level int, at long, stop int, conv long, shared long, leaves long"

Table = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def turn_digest(role: Column, text: Column) -> Column:
    """Digest of a turn; the role's length keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def turn_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, path`` with a struct of ``digest`` and ``words`` per turn, from ``conv_id, turn, role, text``."""
    rows = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", text_or_empty("role").alias("role"), text_or_empty("text").alias("text")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    digest = turn_digest(F.col("role"), F.col("text")).alias("digest")
    words = F.regexp_count("text", F.lit(NON_SPACE)).cast("long").alias("words")
    placed = positions(rows, order, ["conv_id"]).select("conv_id", "position", F.struct(digest, words).alias("step"))
    path = F.sort_array(F.collect_list(F.struct("position", "step")))["step"]
    return placed.groupBy("conv_id").agg(path.alias("path"))


def sorted_links(paths: DataFrame) -> DataFrame:
    """Conversations in order, each with its LCP with the next: the last one's ``link`` is -1.

    ``position, conv_id, length, link, shared, cum``: ``cum`` has the words of the first 0, 1, ... turns.
    """

    def sums(words: pd.Series) -> pd.Series:
        return words.map(lambda w: np.concatenate([[0], np.cumsum(w)]).astype("int64"))

    rows = paths.select(
        "conv_id", F.col("path")["digest"].alias("digests"), F.pandas_udf(sums, "array<long>")(F.col("path")["words"]).alias("cum")
    )
    placed = materialize(positions(rows, [F.col("digests"), F.col("conv_id")], []))
    following = placed.select((F.col("position") - 1).alias("before"), F.col("digests").alias("next"))
    joined = placed.join(following, F.col("position") == F.col("before"), "left")
    # The shorter one is filled with nulls, which equal no digest.
    differs = F.array_position(F.zip_with("digests", "next", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    length = F.size("digests")
    link = F.when(F.col("next").isNull(), -1).when(differs == 0, length).otherwise(differs - 1).cast("int")
    return materialize(
        joined.select("position", "conv_id", length.alias("length"), link.alias("link"), "cum").withColumn(
            "shared", F.when(F.col("link") >= 0, F.element_at("cum", F.col("link") + 1)).otherwise(F.lit(0))
        )
    )


def sparse_table(link: np.ndarray, conv: np.ndarray, shared: np.ndarray, leaves: np.ndarray) -> Table:
    """Per power of two the minima and sums of all stretches of that length."""
    table, width = [(link, conv, shared, leaves)], 1
    while 2 * width <= len(link):
        a, b = slice(None, -width), slice(width, None)
        low, first, words, ends = table[-1]
        table.append((np.minimum(low[a], low[b]), np.minimum(first[a], first[b]), words[a] + words[b], ends[a] + ends[b]))
        width *= 2
    return table


def passed(table: Table, at: np.ndarray, depth: np.ndarray, side: int) -> tuple[np.ndarray, ...]:
    """How far each search gets from ``at`` to one side, and what it passes over."""
    n, at = len(table[0][0]), at.copy()
    conv = np.full(len(at), NO_CONV)
    shared, leaves = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for k in reversed(range(len(table))):
        width = 1 << k
        low, first, words, ends = table[k]
        start = at if side > 0 else at - width
        inside = (start >= 0) & (start + width <= n)
        start = np.where(inside, start, 0)
        free = inside & (low[start] >= depth)
        conv = np.where(free, np.minimum(conv, first[start]), conv)
        shared += np.where(free, words[start], 0)
        leaves += np.where(free, ends[start], 0)
        at = at + np.where(free, side * width, 0)
    return at, conv, shared, leaves


def _table(entries: pd.DataFrame) -> Table:
    return sparse_table(*(entries[c].to_numpy(np.int64) for c in ("link", "conv", "shared", "leaves")))


def _gathered(groups: np.ndarray, values: np.ndarray, n: int) -> list[np.ndarray]:
    """The values of each group from 0 to n, in order."""
    order = np.argsort(groups, kind="stable")
    return np.split(values[order], np.searchsorted(groups[order], np.arange(1, n)))


def _candidates(size: int):
    def find(entries: pd.DataFrame) -> pd.DataFrame:
        entries = entries.sort_values("entry")
        base, n = int(entries["entry"].iloc[0]), len(entries)
        table = _table(entries)
        link, convs, _, leaf = table[0]
        branching = np.flatnonzero(link >= 0)
        at = np.concatenate([np.arange(n), branching])
        depth = np.concatenate([entries["length"].to_numpy(np.int64), link[branching]])
        left, left_conv, left_shared, left_leaves = passed(table, at, depth, -1)
        right, right_conv, right_shared, right_leaves = passed(table, at, depth, 1)
        _, one, which = np.unique(np.stack([depth, left, right]), axis=1, return_index=True, return_inverse=True)
        which = which.reshape(-1)
        ends = _gathered(which[:n], convs, len(one))
        branches = _gathered(which[n:], base + branching, len(one))

        depth, left, right = depth[one], left[one], right[one]
        stopped, stop = right < n, np.minimum(right, n - 1)
        conv = np.minimum(left_conv, right_conv)[one]
        leaves = (left_leaves + right_leaves)[one]
        known_left = (left > 0) | (base == 0)
        return pd.DataFrame(
            {
                "block": base // size,
                "candidate": np.arange(len(one)),
                "depth": depth,
                "first": pd.array(base + left, dtype="Int64").copy(),
                "last": pd.array(base + right, dtype="Int64").copy(),
                "before": np.where(left > 0, link[np.maximum(left - 1, 0)], -1),
                "after": np.where(stopped, link[stop], -1),
                "conv": np.where(stopped, np.minimum(conv, convs[stop]), conv),
                "shared": (left_shared + right_shared)[one],
                "leaves": leaves + np.where(stopped, leaf[stop], 0),
                "ends": [",".join(map(str, e)) if len(e) else None for e in ends],
                "branches": list(branches),
            }
        ).assign(
            first=lambda f: f["first"].where(known_left, pd.NA), last=lambda f: f["last"].where(stopped, pd.NA)
        )

    return find


def _step(size: int, level: int):
    """Searches on one level: done, one level further up, or one further down."""

    def search(entries: pd.DataFrame, searches: pd.DataFrame) -> pd.DataFrame:
        entries = entries.sort_values("entry")
        if not len(searches):
            return searches
        base, n, table = int(entries["entry"].iloc[0]), len(entries), _table(entries)
        link, convs, _, leaf = table[0]
        moved = []
        for side, some in searches.groupby("side"):
            at, conv, shared, leaves = passed(
                table, np.clip(some["at"].to_numpy() - base, 0, n), some["depth"].to_numpy(), int(side)
            )
            conv = np.minimum(conv, some["conv"].to_numpy())
            leaves = leaves + some["leaves"].to_numpy()
            inside = at < n if side > 0 else at > 0
            stop = np.clip(at if side > 0 else at - 1, 0, n - 1)
            below = np.where(inside, level - 1, level + 1)
            going = np.where(inside, (base + at) * size, base // size + (side > 0))
            if level == 0:
                going = np.where(inside, base + at, going)
                if side > 0:
                    conv = np.where(inside, np.minimum(conv, convs[stop]), conv)
                    leaves = leaves + np.where(inside, leaf[stop], 0)
            if side < 0 and base == 0:  # nothing stands before the first place
                below, going = np.where(inside, below, DONE), np.where(inside, going, 0)
            moved.append(
                some.assign(
                    level=below, at=going, stop=np.where(inside, link[stop], -1), conv=conv,
                    shared=some["shared"].to_numpy() + shared, leaves=leaves,
                )
            )
        return pd.concat(moved)

    return search


def _levels(links: DataFrame, size: int) -> list[DataFrame]:
    """Places, blocks of places, blocks of blocks, up to a level of one block."""
    entry = links.select(
        F.col("position").alias("entry"), "link", F.col("conv_id").alias("conv"), "shared",
        (F.col("link") < F.col("length")).cast("long").alias("leaves"), "length",
    )
    levels, n = [entry], links.count()
    while n > size:
        n = -(-n // size)
        summed = levels[-1].groupBy(F.expr(f"entry div {size}").alias("entry")).agg(
            F.min("link").alias("link"), F.min("conv").alias("conv"), F.sum("shared").alias("shared"), F.sum("leaves").alias("leaves")
        )
        levels.append(materialize(summed))
    return levels


def extents(links: DataFrame, size: int = BLOCK) -> DataFrame:
    """Every candidate with the places of its members and what they add up to.

    ``block, candidate, depth, first, last, before, after, conv, shared, leaves, ends, branches``:
    ``before`` and ``after`` are the LCPs that end the extents, ``ends`` lists the block's conversations
    that end there, ``branches`` the block's places that asked for the node by their LCP.
    """
    ship_library(links.sparkSession)
    levels = _levels(links, size)
    block = F.expr(f"entry div {size}").alias("in_block")
    found = materialize(levels[0].groupBy(block).applyInPandas(_candidates(size), CANDIDATES))
    if len(levels) == 1:
        return found

    def sent(side: int, at: Column) -> DataFrame:
        ahead = [F.lit(side).alias("side"), "depth", F.lit(1).alias("level"), at.alias("at"), F.lit(-1).alias("stop")]
        none = [F.lit(int(NO_CONV)).alias("conv"), F.lit(0).cast("long").alias("shared"), F.lit(0).cast("long").alias("leaves")]
        return found.where(F.col("last" if side > 0 else "first").isNull()).select("block", "candidate", *ahead, *none)

    pending, done = sent(-1, F.col("block")).unionByName(sent(1, F.col("block") + 1)), []
    top = len(levels) - 1
    for level in [*range(1, top + 1), *range(top - 1, -1, -1)]:
        meets = F.expr(f"(at - if(side < 0, 1, 0)) div {size}").alias("in_block")
        here = pending.where(F.col("level") == level).groupBy(meets)
        entries = levels[level].select("entry", "link", "conv", "shared", "leaves").groupBy(block)
        moved = materialize(entries.cogroup(here).applyInPandas(_step(size, level), SEARCHES))
        done.append(moved.where(F.col("level") == DONE))
        pending = pending.where(F.col("level") != level).unionByName(moved.where(F.col("level") != DONE))
    answers = reduce(DataFrame.unionByName, done)

    def answer(side: int, mark: str) -> DataFrame:
        return answers.where(F.col("side") == side).select(
            F.col("block").alias(f"{mark}_block"), F.col("candidate").alias(f"{mark}_candidate"),
            *[F.col(c).alias(f"{mark}_{c}") for c in ("at", "stop", "conv", "shared", "leaves")],
        )

    def of(mark: str) -> Column:
        return (F.col("block") == F.col(f"{mark}_block")) & (F.col("candidate") == F.col(f"{mark}_candidate"))

    is_open = F.col("first").isNull() | F.col("last").isNull()
    joined = found.where(is_open).join(answer(-1, "l"), of("l"), "left").join(answer(1, "r"), of("r"), "left")
    nothing = F.lit(0).cast("long")
    closed = joined.select(
        "block", "candidate", "depth",
        F.coalesce("first", "l_at").alias("first"), F.coalesce("last", "r_at").alias("last"),
        F.coalesce("l_stop", "before").alias("before"), F.coalesce("r_stop", "after").alias("after"),
        F.least("conv", "l_conv", "r_conv").alias("conv"),
        *[(F.col(c) + F.coalesce(f"l_{c}", nothing) + F.coalesce(f"r_{c}", nothing)).alias(c) for c in ("shared", "leaves")],
        "ends", "branches",
    )
    return materialize(found.where(~is_open).unionByName(closed))


def _ends(found: DataFrame) -> DataFrame:
    """Digest of the ids that end at each node, in order; a task reads them block by block and holds one."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, running = None, hashlib.sha256()
        for batch in batches:
            closed = []
            for first, depth, ends in zip(batch["e_first"], batch["e_depth"], batch["ends"], strict=True):
                if (first, depth) != node:
                    if node is not None:
                        closed.append((*node, running.hexdigest()))
                    node, running = (first, depth), hashlib.sha256(ends.encode())
                else:
                    running.update(b"," + ends.encode())
            yield pd.DataFrame(closed, columns=["e_first", "e_depth", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, running.hexdigest())], columns=["e_first", "e_depth", "ends_sha256"])

    lists = found.where("ends IS NOT NULL").select(
        F.col("first").alias("e_first"), F.col("depth").alias("e_depth"), "block", "ends"
    )
    placed = lists.repartition("e_first", "e_depth").sortWithinPartitions("e_first", "e_depth", "block")
    return placed.mapInPandas(digests, "e_first long, e_depth int, ends_sha256 string")


def trie(paths: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per node of the conversations in ``paths`` (``conv_id, path``), the textless root too."""
    links = sorted_links(paths)
    found = extents(links, size)
    named = materialize(
        found.groupBy("first", "depth").agg(
            *[F.max(c).alias(c) for c in ("last", "before", "after", "conv", "shared", "leaves")]
        )
    ).withColumn("above", F.greatest("before", "after"))
    # The place whose LCP is the parent's depth asked for the parent.
    asked = found.select(F.explode("branches").alias("place"), F.col("first").alias("p_first"), F.col("depth").alias("p_depth"), F.col("conv").alias("p_conv"))
    beside = F.when(F.col("above") >= 0, F.when(F.col("before") == F.col("above"), F.col("first") - 1).otherwise(F.col("last")))
    nodes = materialize(named.withColumn("beside", beside).join(asked, F.col("beside") == F.col("place"), "left"))
    children = nodes.where("p_first IS NOT NULL").groupBy(F.col("p_first").alias("c_first"), F.col("p_depth").alias("c_depth")).agg(
        F.count(F.lit(1)).alias("children")
    )
    cum = links.select("position", "cum")
    whole = (
        nodes.join(children, (F.col("first") == F.col("c_first")) & (F.col("depth") == F.col("c_depth")), "left")
        .join(_ends(found), (F.col("first") == F.col("e_first")) & (F.col("depth") == F.col("e_depth")), "left")
        .join(cum, F.col("first") == F.col("position"))
    )
    unfolded = whole.withColumn("d", F.explode(F.sequence(F.col("above") + 1, F.col("depth"))))
    n, lowest = F.col("last") - F.col("first") + 1, F.col("d") == F.col("depth")
    before = F.element_at("cum", F.greatest(F.col("d"), F.lit(1)))
    return unfolded.select(
        F.col("conv").alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") > F.col("above") + 1, F.col("conv")).otherwise(F.col("p_conv")).alias("parent_conv_id"),
        n.alias("n_convs"),
        F.when(lowest, F.coalesce("children", F.lit(0).cast("long"))).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("shared") - (n - 1) * before).alias("saved_tokens"),
        F.when(lowest & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
