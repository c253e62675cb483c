"""The prefix trie against plain dictionaries."""

import hashlib
import random
import zlib

import pytest

from terrace.llm import prefix_trie
from terrace.llm.queries import QUERIES
from terrace.llm.tables import materialize

TURNS = "conv_id long, turn long, role string, text string, position long, block long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(conversations):
    """Nodes of ``{id: [(role, text), ...]}``, each prefix in a dictionary."""
    members, kids = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                kids.setdefault(tuple(turns[: d - 1]), set()).add(tuple(turns[:d]))
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(members[node]) - 1) * words
            leaves[node[:d]] += node not in kids
    rows = []
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(conversations[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.append(
            (min(ids), len(node), parent, len(ids), len(kids.get(node, ())), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=repr)


def turns_of(rows):
    ordered = {}
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        ordered.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return ordered


def found(spark, rows, size):
    turns = spark.createDataFrame([(*r, 7, 7) for r in rows], TURNS)
    paths = materialize(prefix_trie.turn_paths(turns))
    return sorted((tuple(r) for r in prefix_trie.trie(paths, size).select(*COLUMNS).collect()), key=repr)


def random_rows(seed, n):
    rng = random.Random(seed)
    rows, stock = [], [None, "", "a b", "a", "c  d\te", "é x"]
    for c in rng.sample(range(-5, 40 * n), n):
        if rng.random() < 0.3:  # a third are one conversation
            rows += [(c, t, "user", "same  words here") for t in range(4)]
        else:
            depth = rng.choice([1, 1, 2, 3, 5, 9])
            rows += [(c, t if rng.random() < 0.9 else None, rng.choice(["user", None]), rng.choice(stock)) for t in range(depth)]
    return rows + rows[:2] + [(None, 0, "user", "x")]


@pytest.mark.parametrize("seed, n, size", [(1, 60, 1024), (2, 70, 8), (3, 90, 4), (4, 60, 3), (5, 40, 2)])
def test_nodes_equal_dictionaries_at_every_number_of_levels(spark, seed, n, size):
    rows = random_rows(seed, n)
    assert found(spark, rows, size) == brute(turns_of(rows))


def test_small_and_empty_tables(spark):
    assert found(spark, [], 4) == []
    assert found(spark, [(None, 1, "user", "x")], 4) == []
    for rows in ([(5, 0, None, None)], [(5, 0, "user", "x")] * 3, [(5, t, "user", "w " * 50_000) for t in range(3)]):
        assert found(spark, rows, 4) == brute(turns_of(rows))


def test_conversations_without_turns_and_chains_of_prefixes(spark):
    step = "struct<digest: binary, words: long>"
    digests = [bytes([65 + d]) * 32 for d in range(9)]
    rows = [(c, [(digests[d], d + 1) for d in range(c % 9)]) for c in range(40)]
    paths = spark.createDataFrame(rows, f"conv_id long, path array<{step}>")
    got = prefix_trie.trie(paths, 3).select(*COLUMNS).collect()
    # The digest's letter stands for a turn of as many words.
    same = {c: [("", " ".join(["w"] * n)) for _, n in path] for c, path in rows}
    assert sorted(map(tuple, got), key=repr) == brute(same)


def test_each_search_is_a_search_of_its_own():
    import numpy as np

    rng = np.random.default_rng(3)
    link = rng.integers(0, 4, 50)
    link[-1] = -1
    table = prefix_trie.sparse_table(link, np.arange(50), np.ones(50, np.int64), np.zeros(50, np.int64))
    at, depth = np.repeat(np.arange(50), 5), np.tile(np.arange(5), 50)
    right, *_ = prefix_trie.passed(table, at, depth, 1)
    left, first, words, _ = prefix_trie.passed(table, at, depth, -1)
    for i, d, r, lo, c, w in zip(at, depth, right, left, first, words):
        assert r == next(j for j in range(i, 50) if link[j] < d)
        want = next((j + 1 for j in reversed(range(i)) if link[j] < d), 0)
        assert (lo, w) == (want, i - want) and c == (want if want < i else prefix_trie.NO_CONV)


def test_rebuilt_conversations_share_the_turns_of_their_base(spark, tmp_path):
    rng = random.Random(8)
    rows = [(c, t, "user", rng.choice("abc")) for c in [*range(0, 90, 3), 100, 121] for t in range(rng.randint(1, 5))]
    rows += [(20, None, "user", "first"), (25, 0, None, None), (25, 1, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    own = turns_of(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    got = QUERIES["op13_prefix_trie"](spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rebuilt)
    assert all(t is not None for r in got for t in r[3:])
