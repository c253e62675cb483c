"""Chat formatting.

Messages form reply trees.  Iterative self-joins enumerate the paths from the roots to the
leaves: in each round every message joins the message its pointer names and takes over
that one's pointer, so pointers double their reach and a tree of depth d takes log2(d)
rounds.  Branches are ranked by the mean score of their messages, and each chosen path is
formatted as one conversation with a loss mask over what the assistant says.  DataFrame
functions throughout.

Defined results: a null text or role is empty; a message whose parent is not in its tree is a
root; messages that only lead round in a circle are on no path; ties between branches go to
the smaller leaf; a null tree id is a tree of its own; rows that repeat a message id are
joined as one message each, so give repeated rows ids of their own; an empty table gives no
conversation; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.tables import materialize, text_or_empty

# The marks of the chat template.
START, END = "<|im_start|>", "<|im_end|>"
SPEAKER = "assistant"


def escape(text: Column) -> Column:
    """One more backslash between ``<`` and ``|``, so that no control string remains."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role stands on one line: line ends become ``\\n``, backslashes double."""
    flat = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(flat)


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def pointers(messages: DataFrame) -> list[DataFrame]:
    """Pointer tables by doubled reach: ``tree, id, up, depth, root, total``.

    In table k, ``up`` is the message 2**k steps above, or null if the root is nearer; then
    ``root`` is set, ``depth`` is the number of steps to it and ``total`` sums the scores on
    the way, the root's included.  Messages that never reach a root are in none but the first.
    """
    nodes = messages.select("tree", "id", "parent", "score")
    there = nodes.select(F.col("tree").alias("p_tree"), F.col("id").alias("p_id"))
    size = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    known = F.col("p_tree").isNotNull() | F.col("p_id").isNotNull()
    joined = nodes.join(there, _same("tree", "p_tree") & (F.col("parent") == F.col("p_id")), "left")
    tables = [
        materialize(
            joined.select(
                "tree",
                "id",
                F.when(known, F.col("parent")).alias("up"),
                F.when(known, F.lit(1)).otherwise(0).cast("long").alias("depth"),
                F.when(~known, F.col("id")).alias("root"),
                F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"),
            )
        )
    ]
    reach = 1
    while reach < size and not tables[-1].where("up is not null").isEmpty():
        above = tables[-1].toDF("a_tree", "a_id", "a_up", "a_depth", "a_root", "a_total")
        step = tables[-1].join(above, _same("tree", "a_tree") & (F.col("up") == F.col("a_id")), "left")
        tables.append(
            materialize(
                step.select(
                    "tree",
                    "id",
                    F.col("a_up").alias("up"),
                    (F.col("depth") + F.coalesce("a_depth", F.lit(0))).alias("depth"),
                    F.coalesce("root", "a_root").alias("root"),
                    (F.col("total") + F.coalesce("a_total", F.lit(0.0))).alias("total"),
                )
            )
        )
        reach *= 2
    return tables


def best_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """``tree, leaf, position, id``: the messages of the ``keep`` best branches of each tree.

    ``messages`` has ``tree, id, parent, score``.  The best leaves of a tree are found by a
    rank limit that runs inside each task before the shuffle.
    """
    tables = pointers(messages)
    nodes = tables[-1].where("root is not null")
    inner = messages.where("parent is not null").select(
        F.col("tree").alias("c_tree"), F.col("parent").alias("c_parent")
    )
    leaves = nodes.join(inner, _same("tree", "c_tree") & (F.col("id") == F.col("c_parent")), "left_anti")
    by_score = Window.partitionBy("tree").orderBy(
        (F.col("total") / (F.col("depth") + 1)).desc(), F.col("id").asc()
    )
    chosen = leaves.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= keep)
    path = chosen.select("tree", F.col("id").alias("leaf"), F.col("depth").alias("position"), "id")
    for k, table in enumerate(tables[:-1]):
        up = table.where("up is not null").select(
            F.col("tree").alias("u_tree"), F.col("id").alias("u_id"), F.col("up")
        )
        higher = path.join(up, _same("tree", "u_tree") & (F.col("id") == F.col("u_id"))).select(
            "tree", "leaf", (F.col("position") - (1 << k)).alias("position"), F.col("up").alias("id")
        )
        path = materialize(path.unionByName(higher))
    return path


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """``tree, leaf, formatted, mask``: each path as one conversation.

    A turn is ``<|im_start|>role``, a line end, the escaped text and ``<|im_end|>`` with a line
    end.  ``mask`` has a struct per turn: ``turn`` where it begins, ``start`` and ``end`` of the
    text under the loss, all in code points; the two are equal for other roles.
    """
    said = messages.select(
        F.col("tree").alias("m_tree"),
        F.col("id").alias("m_id"),
        text_or_empty("role").alias("role"),
        text_or_empty("text").alias("text"),
    )
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = (
        paths.join(said, _same("tree", "m_tree") & (F.col("id") == F.col("m_id")))
        .select("tree", "leaf", "position", "role", head.alias("head"), escape(F.col("text")).alias("body"))
        .withColumn("turn", F.concat("head", "body", F.lit(f"{END}\n")))
    )
    so_far = Window.partitionBy("tree", "leaf").orderBy("position")
    before = F.sum(F.length("turn")).over(so_far) - F.length("turn")
    start = F.col("at") + F.length("head")
    spoken = F.when(F.col("role") == SPEAKER, F.length("body")).otherwise(0)
    placed = turns.withColumn("at", before)
    return (
        placed.groupBy("tree", "leaf")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "position",
                        "turn",
                        F.struct(F.col("at").alias("turn"), start.alias("start"), (start + spoken).alias("end")).alias("mask"),
                    )
                )
            ).alias("turns")
        )
        .select(
            "tree",
            "leaf",
            F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
            F.transform("turns", lambda t: t["mask"]).alias("mask"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped: struct(role, text)."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)

    def turn(piece):
        role = F.substring_index(F.substring(piece, len(START) + 1, F.length(piece)), "\n", 1)
        text = F.substring(piece, F.length(role) + F.lit(len(START) + 2), F.length(piece))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def read_loss(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    pieces = F.split(formatted, rf"(?<=<\|im_end\|>\n)", -1)
    spoken = F.transform(
        F.arrays_zip(F.slice(pieces, 1, F.size(mask)).alias("piece"), mask.alias("mask")),
        lambda x: F.substring(
            x["piece"],
            (x["mask"]["start"] - x["mask"]["turn"] + 1).cast("int"),
            (x["mask"]["end"] - x["mask"]["start"]).cast("int"),
        ),
    )
    return F.transform(spoken, unescape)


def as_trees(conversations: DataFrame) -> DataFrame:
    """Turns in order as reply trees without branches; rows that repeat a turn follow each other."""
    in_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(in_turn).cast("long")
    return conversations.select(
        F.col("conv_id").alias("tree"), place.alias("id"), "role", "text"
    ).withColumns(
        {"parent": F.when(F.col("id") > 1, F.col("id") - 1), "score": F.lit(0.0)}
    )


def format_chats(messages: DataFrame, keep: int = 1) -> DataFrame:
    """The best branches of all trees, formatted.  The messages are written once, then joined."""
    messages = materialize(messages.select("tree", "id", "parent", "score", "role", "text"))
    return format_paths(best_paths(messages, keep), messages)
