"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node.  A first neighbour graph comes from blocks: rows that fall on the
same sides of random planes are compared with each other.  NN-descent then joins
neighbours of neighbours: each node gathers the codes of the nodes it is linked with, in
either direction, compares them pair by pair where one is new, and offers each the best it
has not got.  Queries walk the graph greedily from their entry nodes, all queries in step,
each with a beam.  What is found is scored again on the original vectors, exactly.

All steps are joins and aggregates over written tables; groups are bounded by the
parameters (a block, the links of a node, a beam).  ``nearest_exact`` gives what the walk may
miss, by comparing blocks of queries with blocks of all vectors.  Lists of reverse links are drawn by
a hash where a node has more than ``REVERSE``; that is NN-descent's own sampling, and recall
is measured against brute force in the tests.

Largest inner product becomes nearest by one more component, sqrt(M**2 - |x|**2) with M the
largest norm.  Codes hold the components as floats and that one as a double, so that neither
a row of large norm nor a group of close vectors makes codes equal; graph and walk compare
them in doubles, the graph by distance, whose size does not grow with M.  Walks also start
from the nodes of the largest norms, which few links lead to; those are expanded for the
queries that they are nearer to than their own node.

Defined results: vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without an id or of another length than most; rows that repeat an id and
vector count once; ties go to the smaller id; an empty table gives no rows; other columns
are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.tables import materialize, ship_library

#: Links kept per node, and reverse links joined.
LINKS, REVERSE = 32, 32
#: Sets of planes, rows aimed at in a block, and what a block offers each of its nodes.
PLANES, BLOCK, OFFERED = 24, 512, 12
#: Rounds of NN-descent at most; they end when fewer than this share of links is new.
ROUNDS, SETTLED = 3, 0.1
#: Best pairs offered to a node by each node it is linked with.
PAIRS = 8
#: Width of a query's beam, nodes expanded per step, and nodes scored exactly.
BEAM, EXPANDED, POOL = 192, 64, 64
#: Nodes of largest norm that all queries look at first.
HEADS = 32

LINK = "src long, dst long, near double"


def usable_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    good = rows.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).where(~bad & some)
    most = good.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size(vector) == (most["n"] if most else 0)).select("vec_id", F.col(vector).alias("vector"))


def nodes_of(vectors: DataFrame, keep: int) -> DataFrame:
    """``node, vector, members``: each distinct vector under its smallest id, with its ``keep`` smallest ids.

    The limit runs in each task before the shuffle, so many copies of one vector do not meet.
    """
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    few = vectors.distinct().withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= keep)
    return few.groupBy("vector").agg(
        F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("members")
    )


def _square(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def codes_of(nodes: DataFrame) -> DataFrame:
    """``node, code, size, leaves``: the components and the one beyond, the norm, and the side of each set of planes."""
    stats = nodes.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.max(_square(F.col("vector")))).alias("norm"),
    ).first()
    means = nodes.select(F.posexplode("vector")).groupBy("pos").agg(F.avg("col").alias("mean")).orderBy("pos").collect()
    mean = np.array([m["mean"] for m in means])
    depth = max(0, math.ceil(math.log2(max(stats["n"], 1) / BLOCK)))
    sets = PLANES if depth else 1
    planes = np.random.default_rng(7).standard_normal((len(mean), sets * depth))
    norm = stats["norm"] or 1.0

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["vector"].to_numpy()).astype(np.float64)
            code = (x / norm).astype(np.float32)
            square = (code.astype(np.float64) ** 2).sum(axis=1)
            last = np.sqrt(np.maximum(1 - square, 0))
            sides = ((x - mean) @ planes > 0).reshape(len(x), sets, depth)
            leaves = sides @ (1 << np.arange(depth, dtype=np.int64))
            yield pd.DataFrame(
                {
                    "node": batch["node"],
                    "code": [c.tobytes() + l.tobytes() for c, l in zip(code, last, strict=True)],
                    "size": np.sqrt(square),
                    "leaves": list(leaves),
                }
            )

    return nodes.select("node", "vector").mapInPandas(encode, "node long, code binary, size double, leaves array<long>")


def _fields(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """Where each row's list begins and ends, and the structs of all lists."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.concatenate([[0], np.cumsum(sizes)]), column.flatten()


def _parts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of codes, and the one beyond, as doubles."""
    x = np.ascontiguousarray(data[:, :-8]).view(np.float32).astype(np.float64)
    return x, np.ascontiguousarray(data[:, -8:]).view(np.float64).ravel()


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return _parts(data.reshape(len(column), -1))


def _nearness(x: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minus half the squared distance of each two codes: in order, their products."""
    half = (x**2).sum(axis=1) / 2
    return x @ x.T - half[:, None] - half - (last[:, None] - last) ** 2 / 2


def _links(src: list, dst: list, near: list) -> pa.RecordBatch:
    def joined(parts: list, kind: type) -> np.ndarray:
        return np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)

    return pa.RecordBatch.from_arrays(
        [pa.array(joined(src, np.int64)), pa.array(joined(dst, np.int64)), pa.array(joined(near, np.float64))],
        names=["src", "dst", "near"],
    )


def block_links(codes: DataFrame) -> DataFrame:
    """The best links inside blocks.  A leaf of more rows than a block is dealt to several by a hash."""
    leaves = codes.select("node", "code", F.posexplode("leaves").alias("planes", "leaf"))
    counts = leaves.groupBy("planes", "leaf").count().select(
        F.col("planes").alias("c_planes"), F.col("leaf").alias("c_leaf"), F.ceil(F.col("count") / (2 * BLOCK)).alias("parts")
    )
    same = (F.col("planes") == F.col("c_planes")) & (F.col("leaf") == F.col("c_leaf"))
    part = F.pmod(F.xxhash64("node", "planes"), F.col("parts"))
    blocks = leaves.join(counts, same).groupBy("planes", "leaf", part.alias("part")).agg(
        F.collect_list(F.struct("node", "code")).alias("rows")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = _fields(batch.column("rows"))
            ids, (code, last) = rows.field("node").to_numpy(), _codes(rows.field("code"))
            many = batch.column("single").to_pylist()
            src, dst, near = [], [], []
            for a, b, single in zip(at[:-1], at[1:], many, strict=True):
                best = min(LINKS if single else OFFERED, b - a - 1)
                if best < 1:
                    continue
                dots = _nearness(code[a:b], last[a:b])
                np.fill_diagonal(dots, -np.inf)
                top = np.argpartition(-dots, best - 1, axis=1)[:, :best]
                src.append(np.repeat(ids[a:b], best))
                dst.append(ids[a:b][top].ravel())
                near.append(np.take_along_axis(dots, top, axis=1).ravel())
            yield _links(src, dst, near)

    alone = F.lit(codes.select(F.size("leaves").alias("n")).where("n > 1").isEmpty())
    return blocks.select("rows", alone.alias("single")).mapInArrow(compare, LINK)


def _best_links(offers: DataFrame) -> DataFrame:
    """The ``LINKS`` nearest of each node; a link that was there stays old.  One shuffle, by node."""
    nearest = Window.partitionBy("src").orderBy(F.col("near").desc(), "dst")
    return (
        offers.repartition("src")
        .groupBy("src", "dst")
        .agg(F.max("near").alias("near"), F.min("fresh").alias("fresh"))
        .withColumn("n", F.row_number().over(nearest))
        .where(F.col("n") <= LINKS)
        .drop("n")
    )


def joined_links(links: DataFrame) -> DataFrame:
    """``src, dst, fresh``: links both ways, with at most ``REVERSE`` reverse ones per node."""
    drawn = Window.partitionBy("src").orderBy(F.xxhash64("src", "dst"), "dst")
    reverse = (
        links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "fresh")
        .withColumn("n", F.row_number().over(drawn))
        .where(F.col("n") <= REVERSE)
        .drop("n")
    )
    return links.select("src", "dst", "fresh").unionByName(reverse).groupBy("src", "dst").agg(F.max("fresh").alias("fresh"))


def descent_round(links: DataFrame, codes: DataFrame) -> DataFrame:
    """Offers among the nodes each node is linked with, where one of the two is new there."""
    bars = links.groupBy("src").agg(F.min("near").alias("least"), F.count(F.lit(1)).alias("n")).select(
        F.col("src").alias("b_node"), F.when(F.col("n") >= LINKS, F.col("least")).otherwise(F.lit(float("-inf"))).alias("bar")
    )
    known = codes.join(bars, F.col("node") == F.col("b_node"), "left").select(
        "node", "code", F.coalesce("bar", F.lit(float("-inf"))).alias("bar")
    )
    groups = (
        joined_links(links)
        .join(known, F.col("dst") == F.col("node"))
        .groupBy("src")
        .agg(F.collect_list(F.struct("node", "code", "bar", "fresh")).alias("rows"))
        .select("rows")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = _fields(batch.column("rows"))
            ids, (code, last) = rows.field("node").to_numpy(), _codes(rows.field("code"))
            bar = rows.field("bar").to_numpy()
            fresh = rows.field("fresh").to_numpy(zero_copy_only=False)
            src, dst, near = [], [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                if b - a < 2:
                    continue
                dots = _nearness(code[a:b], last[a:b])
                dots[~(fresh[a:b, None] | fresh[None, a:b])] = -np.inf
                np.fill_diagonal(dots, -np.inf)
                best = min(PAIRS, b - a - 1)
                top = np.argpartition(-dots, best - 1, axis=1)[:, :best]
                value = np.take_along_axis(dots, top, axis=1)
                row, col = np.nonzero(value > bar[a:b, None])
                src.append(ids[a:b][row])
                dst.append(ids[a:b][top[row, col]])
                near.append(value[row, col])
            yield _links(src, dst, near)

    return groups.mapInArrow(compare, LINK)


def build_graph(codes: DataFrame) -> DataFrame:
    """``src, dst, near, fresh``: the neighbour graph of the codes."""
    ship_library(codes.sparkSession)
    links = materialize(_best_links(block_links(codes).withColumn("fresh", F.lit(True))))
    for _ in range(ROUNDS):
        offers = descent_round(links, codes).withColumn("fresh", F.lit(True))
        old = links.withColumn("fresh", F.lit(False))
        links = materialize(_best_links(old.unionByName(offers)))
        total, new = links.agg(F.count(F.lit(1)), F.sum(F.col("fresh").cast("long"))).first()
        if (new or 0) <= SETTLED * total:
            break
    return links


def dot(code: Column, asked: Column) -> Column:
    """The products sought: of the components, without the one beyond."""

    def batch(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype="float64")
        x, y = (_parts(np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1))[0] for s in (left, right))
        return pd.Series(np.einsum("ij,ij->i", x, y))

    return F.pandas_udf(batch, "double")(code, asked)


def search(asked: DataFrame, codes: DataFrame, links: DataFrame) -> DataFrame:
    """``query, node, near``: each query's beam at the end of its walk from its own node and the heads.

    ``asked`` has ``query, q_code``, a query being a node.  A step expands the best nodes of each
    beam that are not yet expanded; the walk ends when there are none.
    """
    ship_library(codes.sparkSession)
    steps = materialize(joined_links(links).select(F.col("src").alias("from"), F.col("dst").alias("to")))
    known = codes.select(F.col("node").alias("c_node"), "code")

    def scored(pairs: DataFrame) -> DataFrame:
        both = pairs.join(known, F.col("node") == F.col("c_node")).join(
            asked.withColumnRenamed("query", "a_query"), F.col("query") == F.col("a_query")
        )
        return both.select("query", "node", dot(F.col("code"), F.col("q_code")).alias("near"), F.lit(False).alias("done"))

    best = Window.partitionBy("query").orderBy(F.col("near").desc(), "node")
    turn = Window.partitionBy("query", "done").orderBy(F.col("near").desc(), "node")
    first = codes.orderBy(F.desc("size"), "node").select("node", "code").limit(HEADS).collect()
    literals = [F.struct(F.lit(r["node"]).alias("node"), F.lit(bytes(r["code"])).alias("code")) for r in first]
    heads = F.array(*literals).cast("array<struct<node:bigint,code:binary>>")
    own, near = dot(F.col("q_code"), F.col("q_code")), dot(F.col("code"), F.col("q_code"))
    seen = (
        asked.select("query", "q_code", F.inline(heads))
        .where("query != node")
        .select("query", "node", near.alias("near"), own.alias("own"))
    )
    beam = materialize(
        asked.select("query", F.col("query").alias("node"), own.alias("near"), F.lit(False).alias("done")).unionByName(
            seen.select("query", "node", "near", (F.col("near") <= F.col("own")).alias("done"))
        )
    )
    while not (front := beam.where("not done")).isEmpty():
        chosen = front.withColumn("n", F.row_number().over(turn)).where(F.col("n") <= EXPANDED)
        reached = chosen.join(steps, F.col("node") == F.col("from")).select("query", F.col("to").alias("node")).distinct()
        there = beam.select(F.col("query").alias("b_query"), F.col("node").alias("b_node"))
        new = reached.join(there, (F.col("query") == F.col("b_query")) & (F.col("node") == F.col("b_node")), "left_anti")
        walked = beam.withColumn("n", F.row_number().over(turn)).select(
            "query", "node", "near", (F.col("done") | (F.col("n") <= EXPANDED)).alias("done")
        )
        beam = materialize(
            walked.unionByName(scored(new))
            .withColumn("n", F.row_number().over(best))
            .where(F.col("n") <= BEAM)
            .drop("n")
        )
    return beam.select("query", "node", "near")


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows found for each query row."""
    vectors = materialize(usable_vectors(rows, vector))
    nodes = materialize(nodes_of(vectors, k + 1))
    codes = materialize(codes_of(nodes))
    links = build_graph(codes)
    queries = materialize(
        vectors.where(is_query)
        .select(F.col("vec_id").alias("query_id"), F.col("vector").alias("q_vector"))
        .distinct()
        .join(nodes.select("vector", F.col("node").alias("query")), F.col("q_vector") == F.col("vector"))
        .select("query_id", "query")
    )
    own = codes.select(F.col("node").alias("query"), F.col("code").alias("q_code"))
    asked = materialize(queries.select("query").distinct().join(own, "query"))
    beam = search(asked, codes, links)
    pool = Window.partitionBy("query").orderBy(F.col("near").desc(), "node")
    found = beam.withColumn("n", F.row_number().over(pool)).where(F.col("n") <= POOL).select("query", "node")
    sought = nodes.select(F.col("node").alias("s_node"), F.col("vector").alias("q_vector"))
    exact = materialize(
        found.join(nodes, "node")
        .join(sought, F.col("query") == F.col("s_node"))
        .select("query", inner_product(F.col("vector"), F.col("q_vector")).alias("score"), F.explode("members").alias("vec_id"))
    )
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    best = exact.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k + 1)
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        queries.join(best.select(F.col("query").alias("f_query"), "vec_id", "score"), F.col("query") == F.col("f_query"))
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


#: Rows of a block of queries, or of vectors, in an exact search.
EXACT_BLOCK = 1024
FOUND = "query_id long, vec_id long, score double"


def _blocks(vectors: DataFrame, name: str) -> DataFrame:
    """``vectors`` in blocks of about ``EXACT_BLOCK``: a number, ids and the vectors end to end."""
    rows = materialize(vectors)
    count = max(1, math.ceil(rows.count() / EXACT_BLOCK))
    dealt = rows.withColumn(name, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).cast("int"))
    together = F.collect_list(F.struct("vec_id", F.col("vector").cast("array<double>").alias("vector")))
    return materialize(dealt.groupBy(name).agg(together.alias(f"{name}_rows")))


def nearest_exact(rows: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` as ``nearest`` gives them, with nothing left out.

    Blocks of queries meet blocks of vectors; of each pair a query keeps its ``k`` best, so what is
    shuffled afterwards grows with the queries and the blocks.  Sums run over the components in order.
    """
    ship_library(rows.sparkSession)
    vectors = materialize(usable_vectors(rows, vector).distinct())
    asked = _blocks(vectors.where(is_query), "q_block")
    given = _blocks(vectors, "v_block")
    # The blocks of queries are few; each block of vectors is sent to each of them.
    numbers = [r["q_block"] for r in asked.select("q_block").collect()]
    all_blocks = F.array(*[F.lit(n) for n in numbers]).cast("array<int>")
    met = given.select("v_block_rows", F.explode(all_blocks).alias("of")).join(asked, F.col("of") == F.col("q_block"))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = ([], []), ([], [])
                for side, name in enumerate(("q_block_rows", "v_block_rows")):
                    for row in batch.column(name)[i].as_py():
                        ids[side].append(row["vec_id"])
                        x[side].append(row["vector"])
                queries, others = np.array(ids[0], np.int64), np.array(ids[1], np.int64)
                left, right = np.array(x[0]), np.array(x[1])
                scores = np.zeros((len(left), len(right)))
                for j in range(left.shape[1]):
                    scores += left[:, j, None] * right[None, :, j]
                order = np.lexsort((np.broadcast_to(others, scores.shape), -scores), axis=1)[:, : k + 1]
                found = [np.repeat(queries, order.shape[1]), others[order].ravel(), np.take_along_axis(scores, order, 1).ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["query_id", "vec_id", "score"])

    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        met.select("q_block_rows", "v_block_rows")
        .mapInArrow(best, FOUND)
        .where("query_id != vec_id")
        .distinct()
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
