"""Exact top-k inner-product search by Fagin's threshold algorithm.

Vectors are packed into blocks. Each candidate block holds, for every dimension, the
list of its rows sorted by that component. A query walks the lists of its non-zero
dimensions in step (from the top for a positive weight, from the bottom for a negative
one), scores every row it meets by random access inside the block, and stops when the
threshold - the score of a hypothetical row standing at the current depth of every
list - cannot beat the k-th best score known so far. The k-th score carries over between
the blocks of a task. Of the blocks that reach a task in one Arrow batch those of the
highest bounds come first, and a pair whose bound cannot beat it is passed over. Results
of all blocks are merged by a ranked window that Spark limits before its shuffle.

A task holds one Arrow batch of packed pairs, and one pair of blocks unpacked. Work is
(query blocks x candidate blocks), the whole of the stated query set against all rows.
Both sides of their join are shuffled, a copy of the query blocks to every slot; none of
it passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraweave.llm.common import table

BLOCK_SCHEMA = "block long, n int, dims int, ids binary, comps binary"
SCALE = 1024


def quantise(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id long, q array<long>) with q = floor(scale * x).

    Vectors that are null or hold a null or non-finite component take no part, nor do
    rows with a null id. An empty vector stays and scores 0 with everything.
    """
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))).alias("q")
    )


def _packer(rows_per_block: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32
        for number, pdf in enumerate(p[i : i + rows_per_block] for p in batches for i in range(0, len(p), rows_per_block)):
            dims = max((len(v) for v in pdf["q"]), default=0)
            comps = np.zeros((len(pdf), dims), dtype=np.int64)
            for row, v in enumerate(pdf["q"]):
                comps[row, : len(v)] = v
            yield pd.DataFrame({"block": [task + number], "n": [len(pdf)], "dims": [dims], "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "comps": [comps.tobytes()]})

    return pack


def threshold_search(comps: np.ndarray, ids: np.ndarray, order: np.ndarray, query: np.ndarray, own: int, k: int, floor: float, first_depth: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """One query against one block: (row numbers, scores) of its k best rows.

    ``order[d]`` lists rows by ascending component d. ``floor`` is a k-th best score
    already found elsewhere; rows below it may be left out. Depth doubles, so the number
    of rounds is logarithmic in the block. Equal scores go to the smaller id, so the
    walk goes on while the threshold equals the k-th score.
    """
    n = len(ids)
    dims = np.flatnonzero(query)
    if len(dims) == 0:
        rows = np.arange(n)
        return _best(rows, np.zeros(n, dtype=comps.dtype), ids, own, k)
    lists = np.where(query[dims, None] > 0, order[dims, ::-1], order[dims])
    seen = np.zeros(n, dtype=bool)
    rows, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=comps.dtype)
    start, depth = 0, first_depth
    while start < n:
        end = min(n, depth)
        met = np.zeros(n, dtype=bool)
        met[lists[:, start:end].ravel()] = True
        fresh = np.flatnonzero(met & ~seen)
        seen |= met
        rows, scores = np.concatenate([rows, fresh]), np.concatenate([scores, comps[fresh] @ query])
        rows, scores = _best(rows, scores, ids, own, k)
        bound = (comps[lists[:, end - 1], dims] * query[dims]).sum()
        kth = max(floor, scores[k - 1]) if len(rows) >= k else floor
        if bound < kth or seen.all():
            break
        start, depth = end, depth * 2
    return rows, scores


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    keep = ids[rows] != own
    rows, scores = rows[keep], scores[keep]
    keep_scores = 4 * k
    while len(rows) > keep_scores:
        cut = np.partition(scores, len(scores) - keep_scores)[len(scores) - keep_scores]
        near = scores >= cut
        found = _distinct(rows[near], scores[near], ids)
        if len(found[0]) >= k:
            return found[0][:k], found[1][:k]
        keep_scores *= 4  # repeated rows filled the cut
    rows, scores = _distinct(rows, scores, ids)
    return rows[:k], scores[:k]


def _distinct(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By falling score, then id; the same id with the same score counts once."""
    best = np.lexsort((ids[rows], -scores))
    rows, scores = rows[best], scores[best]
    if len(rows) > 1:
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (ids[rows[1:]] != ids[rows[:-1]]) | (scores[1:] != scores[:-1])
        rows, scores = rows[new], scores[new]
    return rows, scores


def _matrices(b) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(block, ids, components, query ids, queries) of a pair of blocks, in a type in which products are exact."""
    dims = max(b.dims, b.q_dims)
    comps = np.zeros((b.n, dims), dtype=np.int64)
    comps[:, : b.dims] = np.frombuffer(b.comps, np.int64).reshape(b.n, b.dims)
    queries = np.zeros((b.q_n, dims), dtype=np.int64)
    queries[:, : b.q_dims] = np.frombuffer(b.q_comps, np.int64).reshape(b.q_n, b.q_dims)
    widest = int(np.abs(comps).max(initial=0)) * int(np.abs(queries).max(initial=0)) * dims
    kind = np.float64 if widest < 2**53 else np.int64 if widest < 2**63 else object
    return b.block, np.frombuffer(b.ids, np.int64), comps.astype(kind), np.frombuffer(b.q_ids, np.int64), queries.astype(kind)


def _bounds(b) -> np.ndarray:
    """Of each query of a pair: what no row of the block exceeds, as at depth 0 of the lists."""
    _, _, comps, _, queries = _matrices(b)
    return np.where(queries > 0, queries * comps.max(axis=0), queries * comps.min(axis=0)).sum(axis=1)


def _searcher(k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kth: dict[int, float] = {}  # of queries that have k results from earlier blocks of this task
        last: tuple = (None,)
        for pdf in batches:
            pairs = list(pdf.itertuples(index=False))
            # one pair is unpacked at a time, here for its bounds and below for the search
            bounds = [_bounds(b) for b in pairs]
            hopes = [float(np.mean(x)) for x in bounds]
            of_block: dict[int, float] = {}
            for b, hope in zip(pairs, hopes, strict=True):
                of_block[b.block] = max(of_block.get(b.block, -np.inf), hope)
            # pairs of a block follow each other, so its lists are sorted once
            for at in sorted(range(len(pairs)), key=lambda i: (-of_block[pairs[i].block], pairs[i].block, -hopes[i], i)):
                q_ids = np.frombuffer(pairs[at].q_ids, np.int64)
                wanted = [i for i, query_id in enumerate(q_ids.tolist()) if bounds[at][i] >= kth.get(query_id, -np.inf)]
                if not wanted:
                    continue
                block, ids, comps, q_ids, queries = _matrices(pairs[at])
                if last[0] != (block, comps.shape[1]):
                    last = ((block, comps.shape[1]), np.argsort(comps, axis=0, kind="stable").T)
                found: list[tuple[int, int, int]] = []
                for i in wanted:
                    query_id = int(q_ids[i])
                    rows, scores = threshold_search(comps, ids, last[1], queries[i], query_id, k, kth.get(query_id, -np.inf))
                    if len(rows) == k:
                        kth[query_id] = max(kth.get(query_id, -np.inf), scores[-1])
                    found += zip([query_id] * len(rows), ids[rows].tolist(), (max(-(2**63), min(2**63 - 1, int(s))) for s in scores), strict=True)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, scale: int = SCALE, block_rows: int = 4096, query_rows: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every query row.

    is_query: boolean column over ``vectors`` that marks the query rows.
    Score: inner product of floor(scale * x); shorter vectors count as padded with zeros.
    Ties go to the smaller id. Rows that repeat an id are candidates each, but the same
    (query, id, score) is reported once; rows sharing the query's id are never its
    candidates. Scores beyond a long are cut to its range. Fewer candidates than k: all.
    Empty input: no rows. Other columns of ``vectors`` are ignored.
    """
    candidates = quantise(vectors, id_col, vec_col, scale).mapInPandas(_packer(block_rows), BLOCK_SCHEMA)
    queries = quantise(vectors.where(is_query), id_col, vec_col, scale)
    slots = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # one batch of rows a task makes one query block, so rows are brought together first
    blocks = queries.repartition(max(1, slots // 8), "id").mapInPandas(_packer(query_rows), BLOCK_SCHEMA)
    blocks = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), *[F.col(c).alias(f"q_{c}") for c in blocks.columns])
    # Spark's size of the query blocks doesn't count their copies, so it would broadcast them through the driver
    paired = candidates.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")).join(blocks.hint("merge"), "slot")
    found = paired.drop("slot").mapInPandas(_searcher(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
