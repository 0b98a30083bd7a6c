"""Prefix trie against a plain dictionary of prefixes, on whole results and over many shards."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraweave.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def plain_paths(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(np.fmod(c, 5)), [])
        out[c] = tuple(base[:h]) + tuple(turns[h:])
    return out


def plain_nodes(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    leaves, saved, kids = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, own in members.items():
        bytes_ = len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(own) - 1) * bytes_
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(own), len(p), min(members[p[:-1]]) if p else None, len(own), kids[p], leaves[p], saved[p], sha([c for c in own if paths[c] == p]))
        for p, own in members.items()
    )


def nodes(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))


def conversations(seed, n=300):
    """Turns from few texts, long shared beginnings, copies of one conversation, one long conversation and its twin."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        if c % 3 == 0:
            turns = [("user", "the hot conversation"), ("assistant", "é" * 5), ("user", "bye")]
        else:
            turns = [(str(rng.choice(["user", "assistant"])), "t" * int(rng.integers(0, 3))) for _ in range(int(rng.integers(1, 45)))]
        rows += [(c if c % 2 else c - n // 2, k, r, t, "clash") for k, (r, t) in enumerate(turns)]
    rows += [(c, k, "user", f"x{k // 3}", None) for c in (5001, 5002) for k in range(700)]
    return rows


@pytest.mark.parametrize("shard_turns", [60, 700, 10**6])
def test_trie_equals_plain_prefixes(spark, shard_turns):
    rows = conversations(shard_turns)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = nodes(prefix_trie.trie(prefix_trie.rebuilt(df), shard_turns))
    assert got == plain_nodes(plain_paths(rows))


def test_identical_conversations_over_many_shards(spark):
    """One path holds all rows; its ids are split over shards and its digest is still in order."""
    rows = [(c, k, "user", "same", None) for c in range(0, 2000, 5) for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(prefix_trie.trie(prefix_trie.turns_of(df), 40)) == plain_nodes({c: (("user", "same"),) * 3 for c in range(0, 2000, 5)})


def test_shards_bound_by_matrix_bands(spark):
    """Rows that end where a band of columns ends come before those that go on."""
    paths = {c: tuple(("user", "a") for _ in range(n)) + (("user", f"b{c}"),) * extra for c, (n, extra) in enumerate([(32, 0), (16, 0), (48, 2), (16, 1), (17, 0), (32, 1), (48, 0), (15, 0), (16, 0), (64, 3)])}
    rows = [(c, k, r, t, None) for c, p in paths.items() for k, (r, t) in enumerate(p)]
    for shard_turns in (20, 10**6):
        assert nodes(prefix_trie.trie(prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA)), shard_turns)) == plain_nodes(paths)


def test_edges(spark):
    """Null ids take no part; null turns first; null roles and texts are empty; repeated rows stay; turnless conversations are members of the root."""
    # 7 has a head of base 5, which is absent; crc32 decides how many of its own turns are left
    rows = [(None, 0, "user", "lost", None), (7, None, None, None, None), (7, 3, "user", "b", None), (7, 3, "user", "b", None), (7, 3, "assistant", "é", None), (8, 1, "ab", "c", None), (9, 1, "a", "bc", None)]
    rows += [(c, 0, "user", "only", None) for c in (11, 12, 13, 14, 16)]
    paths = plain_paths(rows)
    assert any(not p for p in paths.values())
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(prefix_trie.trie(prefix_trie.rebuilt(df), 3)) == plain_nodes(paths)
    assert nodes(prefix_trie.trie(prefix_trie.rebuilt(df.where("conv_id = 7")))) == plain_nodes({7: plain_paths([r for r in rows if r[0] == 7])[7]})
    assert prefix_trie.trie(prefix_trie.rebuilt(df.limit(0))).count() == 0
    turnless = spark.createDataFrame([(3,), (1,)], "conv_id long").withColumn("turns", F.expr("array_remove(array(struct(1 as place, 'x' as digest, 1L as bytes)), struct(1 as place, 'x' as digest, 1L as bytes))"))
    assert nodes(prefix_trie.trie(turnless)) == plain_nodes({3: (), 1: ()})
