"""The Merkle manifest against plain hashlib, the digest cache and the token library."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from terrace.llm import merkle

ROWS = "doc_id long, source string, lang string, n_chars long, text string, place long, tree string, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def up(nodes, fanout):
    """The last node, and per leaf the siblings on its way as (left, right)."""
    ways, at, places = [[] for _ in nodes], nodes, list(range(len(nodes)))
    while len(at) > 1:
        runs = [at[i : i + fanout] for i in range(0, len(at), fanout)]
        for i, p in enumerate(places):
            run, k = runs[p // fanout], p % fanout
            ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            places[i] = p // fanout
        at = [h(*r) for r in runs]
    return at[0], ways


def brute(rows, fanout):
    leaf = {i: h(*[enc(v) for v in r[:5]]) for i, r in enumerate(rows)}
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[1], []).append(i)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, inner = [], {}
    for g in order:
        members = sorted(groups[g], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i]))
        subroot, ways = up([leaf[i] for i in members], fanout)
        subroots.append(subroot)
        for i, way in zip(members, ways):
            inner[i] = (subroot, way)
    root, tops = up(subroots, fanout)
    return sorted((leaf[i], inner[i][0], root, tuple(inner[i][1] + tops[order.index(rows[i][1])])) for i in leaf)


def proofs(frame, fanout):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    rows = merkle.leaves(frame, F.col("source"), F.col("doc_id"), fields, doc_id=F.col("doc_id"), tree=F.col("root"))
    return merkle.build(rows, fanout)


@pytest.mark.parametrize("fanout, shape", [(16, [1, 17, 40]), (2, [1, 2, 3, 9, 33]), (3, [1, 1, 1, 1, 10, 28]), (2, [5]), (4, [1])])
def test_proofs_equal_hashlib(spark, fanout, shape):
    rng = random.Random(fanout)
    names = [None, "", "a", "Z", "é", "=", "top", "￿", "𝄞"]
    rows = []
    for n, source in zip(shape, names):
        for _ in range(n):
            doc_id = rng.choice([None, *range(n)])
            rows.append((doc_id, source, rng.choice([None, "en"]), rng.choice([None, 3]), rng.choice([None, "", "Straße", "x" * 70_000]), 1, "t", "r"))
    rows += rows[:3] if len(rows) > 5 else []
    manifest = proofs(spark.createDataFrame(rows, ROWS), fanout)
    found = manifest.proofs().select("leaf", "subroot", "root", "steps", merkle.fold(F.col("leaf"), F.col("steps")).alias("folded"))
    got = found.collect()
    assert all(r["folded"] == r["root"] == manifest.root for r in got)
    assert sorted((r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["steps"]))) for r in got) == brute(rows, fanout)
    assert manifest.subroots.count() == len({r[1] for r in rows})


def test_a_changed_row_is_found_and_one_row_is_its_own_root(spark):
    rows = [(i, "s", None, None, "Text", 1, "t", "r") for i in range(40)]
    manifest = proofs(spark.createDataFrame(rows, ROWS), 16)
    other = merkle.row_digest([F.lit(None).cast("string")])
    changed = manifest.proofs().select(merkle.fold(other, F.col("steps")).alias("f"), "root", "tree", "doc_id")
    assert changed.where("f = root").count() == 0 and changed.columns[2:] == ["tree", "doc_id"]
    lone = proofs(spark.createDataFrame(rows[:1], ROWS), 16)
    (row,) = lone.proofs().collect()
    assert row["leaf"] == row["subroot"] == row["root"] == lone.root and row["steps"] == []


def test_an_empty_table_has_no_root(spark):
    manifest = proofs(spark.createDataFrame([], ROWS), 16)
    assert manifest.root is None and manifest.proofs().count() == 0 and manifest.subroots.count() == 0
