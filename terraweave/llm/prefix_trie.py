"""Prefix trie of conversations: nodes are the distinct sequences of first turns.

A conversation becomes one row with the digests of its turns. Rows are dealt to shards by
range of (path of digests, id), so the members of a node stand side by side, hot
paths are split by id, and a shard stays small. Inside a shard turns get small ids in the order of
their digests; the padded matrix of ids, some columns at a time, is sorted with lexsort; where a
column differs from the row before, or an earlier column does, a node starts (the mask is
or-ed along the columns), and ``reduceat`` adds up each depth. Only nodes on the path of
a shard's first or last row can reach into other shards. All that a node tells is a sum or
a minimum over its rows once each row knows how many turns it shares with its neighbours,
so the parts of a boundary node are simply added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraweave.llm.common import drop, materialise, table

DIGEST = 16
BAND = 16
SHARD_TURNS = 250_000
NO_IDS = hashlib.sha256(b"").hexdigest()
NODE_SCHEMA = "shard int, key binary, parent_key binary, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, n_leaves long, member_bytes long, node_bytes long, ends_sha256 string, ends binary"
NAMES = [x.split()[0] for x in NODE_SCHEMA.split(", ")]


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): one row a conversation, its turns in order as (digest in hex, bytes of the text).

    Null turn numbers come first, equal ones by role, then text; null roles and texts are empty; repeated rows stay.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    # the length of the role keeps (role, text) apart from other cuts of the same characters
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(" "), "role", "text"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")))
    turn = F.struct("place", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 5, shared: int = 9, **columns: str) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % ``every``, then c's own after its first h; h = crc32(c) % ``shared``."""
    rows = turns_of(conversations, **columns).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    heads = rows.where("conv_id = base").select(F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")
    none = F.slice("turns", 1, 0)
    head = F.when(h > 0, F.slice(F.coalesce("head", none), F.lit(1), h)).otherwise(none)
    return rows.join(heads, "base", "left").select("conv_id", F.concat(head, F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns"))


def _matrix(paths: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, lengths, shared): rows by path, then id; lengths and the number of turns shared with the row before, in that order."""
    lengths = np.fromiter(map(len, paths), np.int64, len(paths)) // DIGEST
    halves = np.frombuffer(b"".join(paths), ">u8").astype(np.uint64).reshape(-1, 2)
    by_digest = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(halves), np.int64)
    new[1:] = (halves[by_digest[1:]] != halves[by_digest[:-1]]).any(axis=1)
    code = np.empty(len(halves), np.int64)
    code[by_digest] = np.cumsum(new) - 1
    starts = np.cumsum(lengths) - lengths
    order, shared = np.lexsort((ids, lengths > 0)), np.zeros(len(paths), np.int64)
    rows = np.flatnonzero(lengths[order] > 0)  # places in the order whose rows still differ in length or turns
    same = np.zeros(len(rows), np.int64)  # equal among neighbours whose columns so far are equal
    for low in range(0, int(lengths.max(initial=0)), BAND):
        members = order[rows]
        matrix = np.full((len(rows), BAND), -1, np.int64)
        cells = np.minimum(lengths[members, None] - low, BAND)
        inside = np.arange(BAND)[None, :] < cells
        matrix[inside] = code[(starts[members, None] + low + np.arange(BAND)[None, :])[inside]]
        further = lengths[members] > low + BAND
        sort = np.lexsort((ids[members], further, *matrix.T[::-1], same))
        matrix, members, further, same = matrix[sort], members[sort], further[sort], same[sort]
        order[rows] = members
        changed = np.ones((len(rows), BAND), bool)
        changed[1:] = (matrix[1:] != matrix[:-1]) | (same[1:] != same[:-1])[:, None]
        np.logical_or.accumulate(changed, axis=1, out=changed)
        alike = (~changed).sum(axis=1)
        shared[rows] += np.minimum(alike, np.clip(lengths[members] - low, 0, BAND))
        # rows go on where they reach further and so does another with the same columns
        group = np.cumsum(changed[:, -1]) - 1
        again = further & (np.bincount(group, further) > 1)[group]
        rows, same = rows[again], group[again]
        if not len(rows):
            break
    return order, lengths[order], shared


class _Nodes:
    """Columns of nodes, in pieces."""

    def __init__(self):
        self.parts: list[dict] = []

    def add(self, n: int, **columns) -> None:
        self.parts.append({k: columns.get(k) if isinstance(columns.get(k), (list, np.ndarray)) else [columns.get(k)] * n for k in NAMES})

    def frame(self) -> pd.DataFrame:
        out = {}
        for name in NAMES:
            whole = [x for p in self.parts for x in p[name]]
            out[name] = pd.Series(whole, dtype=object if name in ("key", "parent_key", "ends_sha256", "ends") else "Int64")
        return pd.DataFrame(out)


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def shard_nodes(frame: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one shard (shard, conv_id, path, sizes, before, after).

    before, after: turns that the first (last) row shares with the neighbour shard's last
    (first) row, -1 if there is none. Nodes that reach beyond the shard have a key and
    partial sums; the others are finished, but for the parent of some.
    """
    ids, paths = frame["conv_id"].to_numpy(np.int64), frame["path"].tolist()
    before, after, shard = int(frame["before"].iloc[0]), int(frame["after"].iloc[0]), int(frame["shard"].iloc[0])
    order, length, shared = _matrix(paths, ids)
    ids, paths, n = ids[order], [paths[i] for i in order.tolist()], len(order)
    shared[0] = before
    following = np.append(shared[1:], after)
    size = np.concatenate([np.asarray(frame["sizes"].iloc[i], np.int64) for i in order.tolist()]) if length.sum() else np.zeros(0, np.int64)
    starts = np.cumsum(length) - length
    upto = np.concatenate([[0], np.cumsum(size)])
    rest = lambda rows, depth: upto[(starts + length)[rows]] - upto[starts[rows] + depth]  # noqa: E731  bytes behind so many turns
    ends_here = (following < length).astype(np.int64)  # the last of its own node, and nothing longer follows
    out = _Nodes()
    key = lambda row, depth: hashlib.md5(paths[row][: depth * DIGEST]).digest()
    # depths at which some node may have two members; below, nodes are chains of one member
    fork = np.maximum(shared, following)
    parent, is_known = np.zeros(n, np.int64), np.zeros(n, bool)  # smallest member of each row's node one level up, and whether this shard knows it
    parent_keys: list[bytes | None] = [None] * n
    for depth in range(0, int(fork.max(initial=-1)) + 1):
        rows = np.flatnonzero((length >= depth) & (fork >= depth))
        new = shared[rows] < depth
        new[0] = True
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(rows)) - 1
        add = lambda values: np.add.reduceat(values, at)  # noqa: E731, B023
        smallest, count = np.minimum.reduceat(ids[rows], at), np.diff(np.append(at, len(rows)))
        # a row opens, below this depth, the nodes it doesn't share with the row before
        opened = np.maximum(shared[rows], depth - 1)
        child = add(((length[rows] > depth) & (shared[rows] <= depth)).astype(np.int64))
        leaf = add(ends_here[rows])
        member, node = add(rest(rows, max(depth - 1, 0))), add(rest(rows, np.maximum(opened, 0)))
        first_rows, last_rows = rows[at], rows[last]
        crosses = ((first_rows == 0) & (before >= depth)) | ((last_rows == n - 1) & (after >= depth))
        whole = np.flatnonzero(~crosses)
        text = []
        for a, b in zip(at[whole].tolist(), last[whole].tolist(), strict=True):
            own = rows[a : b + 1]
            own = ids[own[length[own] == depth]]
            text.append(hashlib.sha256(_joined(own)).hexdigest() if len(own) else NO_IDS)
        firsts = first_rows[whole]
        out.add(
            len(whole), shard=shard, conv_id=smallest[whole], depth=depth, n_convs=count[whole], n_children=child[whole], n_leaves=leaf[whole], member_bytes=member[whole], node_bytes=node[whole],
            ends_sha256=text, parent_conv_id=[p if k else None for p, k in zip(parent[firsts].tolist(), is_known[firsts].tolist(), strict=True)],
            parent_key=[None if k else parent_keys[r] for r, k in zip(firsts.tolist(), is_known[firsts].tolist(), strict=True)],
        )
        for k in np.flatnonzero(crosses).tolist():
            own = rows[at[k] : last[k] + 1]
            ends = ids[own[length[own] == depth]]
            here = key(int(own[0]), depth)
            out.add(
                1, shard=shard, key=here, parent_key=key(int(own[0]), depth - 1) if depth else None, conv_id=int(smallest[k]), depth=depth, n_convs=int(count[k]), n_children=int(child[k]), n_leaves=int(leaf[k]),
                member_bytes=int(member[k]), node_bytes=int(node[k]), ends=_joined(ends) if len(ends) else None,
            )
            for r in own.tolist():
                parent_keys[r] = here
        parent[rows], is_known[rows] = np.repeat(smallest, count), np.repeat(~crosses, count)
    # chains of one member: all sums are known from the row itself
    tail = length - fork
    rows = np.repeat(np.arange(n), tail)
    depth = np.arange(len(rows)) - np.repeat(np.cumsum(tail) - tail, tail) + np.repeat(fork + 1, tail)
    top = depth == np.repeat(fork + 1, tail)
    is_end = depth == length[rows]
    digest = [hashlib.sha256(str(i).encode()).hexdigest() for i in ids.tolist()]
    own, above = ids[rows], zip(top.tolist(), rows.tolist(), parent[rows].tolist(), is_known[rows].tolist(), strict=True)
    above = [((p if k else None), (None if k else parent_keys[r])) if t else (None, None) for t, r, p, k in above]
    out.add(
        len(rows), shard=shard, conv_id=own, depth=depth, n_convs=1, n_children=(~is_end).astype(np.int64), n_leaves=1, member_bytes=0, node_bytes=0,
        ends_sha256=[digest[r] if e else NO_IDS for r, e in zip(rows.tolist(), is_end.tolist(), strict=True)],
        parent_conv_id=[p if t else i for t, i, (p, _) in zip(top.tolist(), own.tolist(), above, strict=True)], parent_key=[k for _, k in above],
    )
    return out.frame()


def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    """Turns that two paths have in common from the start."""
    out = []
    for x, y in zip(a, b, strict=True):
        n = min(len(x), len(y)) // DIGEST * DIGEST
        differ = np.flatnonzero(np.frombuffer(x[:n], np.uint8) != np.frombuffer(y[:n], np.uint8))
        out.append((int(differ[0]) if len(differ) else n) // DIGEST)
    return pd.Series(out, dtype="int64")


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a key from parts sorted by (key, shard); a part is read, added and forgotten."""
    key, sha = None, None
    done = lambda: pa.record_batch({"key": pa.array([key], pa.binary()), "ends_sha256": pa.array([sha.hexdigest()], pa.string())})
    for batch in batches:
        for k, part in zip(batch["key"], batch["ends"], strict=True):
            if k.as_py() != key:
                if sha:
                    yield done()
                key, sha = k.as_py(), hashlib.sha256(part.as_py())
            else:
                sha.update(b"," + part.as_py())
    if sha:
        yield done()


def trie(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of ``rows`` (conv_id, turns), ids being unique.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256: as stated in ``op11_prefix_trie``. A shard has about
    ``shard_turns`` turns (more only if one conversation has), so it is one task's work; a conversation is a row, without its
    texts, so the digests of its turns meet in one task. An empty table has no node.
    """
    spark = rows.sparkSession
    flat = rows.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))
    paths = materialise(flat, "trie-paths")
    turns = paths.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    n_shards = turns // shard_turns + 1
    sharded = materialise(paths.repartitionByRange(n_shards, "path", "conv_id").withColumn("part", F.spark_partition_id()), "trie-shards")
    drop(paths)
    # one row a shard: its first and last path; shards are numbered without gaps
    end = F.struct("path", "conv_id")
    edges = sharded.groupBy("part").agg(F.min(end).getField("path").alias("low"), F.max(end).getField("path").alias("high"))
    parts = sorted(r.part for r in edges.select("part").collect())
    numbered = edges.join(F.broadcast(spark.createDataFrame([(p, i) for i, p in enumerate(parts)], "part int, shard int")), "part")
    edges = materialise(numbered, "trie-edges")
    common = F.pandas_udf(_common, "long")
    left, right = edges.select("shard", "high"), edges.select((F.col("shard") - 1).alias("shard"), "low")
    meets = materialise(left.join(right, "shard").select("shard", common("high", "low").alias("common")), "trie-meets")
    none = F.lit(-1).cast("long")
    ends = edges.select("part", "shard").join(meets.withColumnRenamed("common", "after"), "shard", "left").join(meets.select((F.col("shard") + 1).alias("shard"), F.col("common").alias("before")), "shard", "left")
    ends = ends.select("part", "shard", F.coalesce("before", none).alias("before"), F.coalesce("after", none).alias("after"))
    nodes = materialise(sharded.join(ends, "part").groupBy("shard").applyInPandas(shard_nodes, NODE_SCHEMA), "trie-nodes")
    boundary = nodes.where(F.col("key").isNotNull())
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "member_bytes", "node_bytes")]
    whole = boundary.groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.first("parent_key").alias("parent_key"), *sums)
    listed = boundary.where(F.col("ends").isNotNull()).select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard").mapInArrow(_digest_ends, "key binary, ends_sha256 string")
    joined = materialise(whole.join(listed, "key", "left"), "trie-boundary")
    ids = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    # a parent in other shards is looked up by shard, so the root's children are spread
    by_shard = boundary.select("shard", F.col("key").alias("parent_key")).join(ids, "parent_key")
    inner = nodes.where(F.col("key").isNull())
    inner = inner.where(F.col("parent_key").isNull()).withColumn("_parent", F.lit(None).cast("long")).unionByName(inner.where(F.col("parent_key").isNotNull()).join(by_shard, ["shard", "parent_key"]))
    outer = joined.join(ids, "parent_key", "left").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = [
        "conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("member_bytes") - F.col("node_bytes")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    ]
    return inner.select(*columns).unionByName(outer.select(*columns))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations.

    Rows without a conversation id take no part; other columns are ignored.
    saved_tokens: over the subtree, (members - 1) times the bytes of a node's last text.
    ends_sha256: digest of the ids of the conversations that end at the node, in order.
    """
    return trie(rebuilt(table(spark, sf_dir, "conversations")))


ORACLE = r"""
WITH src AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS t FROM src GROUP BY conv_id),
h AS (
  SELECT conv_id, t, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, b:
      list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(a, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h
  FROM own
), r AS (
  SELECT a.conv_id, list_concat(coalesce(b.t[1:a.h], []), a.t[a.h + 1:]) AS t
  FROM h a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
), p AS (
  SELECT conv_id, len(t) AS len, d, md5(CAST(t[1:d] AS VARCHAR)) AS key, CASE WHEN d > 0 THEN md5(CAST(t[1:d - 1] AS VARCHAR)) END AS up,
         CASE WHEN d > 0 THEN octet_length(encode(t[d].text)) ELSE 0 END AS bytes
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM r)
), node AS (
  SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len = d), '')) AS ends_sha256
  FROM p GROUP BY d, key
), kids AS (SELECT d - 1 AS d, up AS key, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
placed AS (
  SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (d, key)
), total AS (
  SELECT p.d, p.key, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM placed n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d GROUP BY p.d, p.key
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(total.n_leaves AS BIGINT) AS n_leaves, CAST(total.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM placed n JOIN total USING (d, key) LEFT JOIN node u ON u.d = n.d - 1 AND u.key = n.up
"""
