"""A small index that holds the best n rows for any weights: the k-skyband of the scores.

Row s comes before row r under all weights >= 0 if s is at least r in every field and has
the smaller id, or if it is more than a margin above r in every field. A row with k such
rows before it is never among the best k. The rows with fewer are the k-skyband.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraweave.operators.scoring import FIELDS
from terraweave.sources.storage import drop, materialise

#: Above the rounding errors of a weighted mean of scores, below the steps of rounded scores.
MARGIN = 1e-6


def dominated(values: np.ndarray, ids: np.ndarray, k: int, chunk: int = 256) -> np.ndarray:
    """Whether each row has at least k rows before it under all weights.

    Rows are taken by falling sum, ids rising, so those before a row come first. It is enough to
    count among rows that were kept and those of the same chunk: the first k rows before a row
    are in the skyband themselves.
    """
    place = np.unique(ids, return_inverse=True)[1]
    order = np.lexsort((place, -values.sum(axis=1)))
    out = np.zeros(len(ids), dtype=bool)
    kept = np.empty(0, dtype=np.int64)
    for start in range(0, len(order), chunk):
        rows = order[start : start + chunk]
        others = np.concatenate([kept, rows])
        weak = place[others][:, None] < place[rows][None, :]
        strict = np.ones_like(weak)
        for d in range(values.shape[1]):
            theirs, mine = values[others, d][:, None], values[rows, d][None, :]
            weak &= theirs >= mine
            strict &= theirs >= mine + MARGIN
        out[rows] = (weak | strict).sum(axis=0) >= k
        kept = np.concatenate([kept, rows[~out[rows]]])
    return out


def _prune(fields: list[str], id_col: str, k: int, block: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows of a partition that are in its skyband; at most 2 * ``block`` rows are held at once, what is full is passed on."""

    def skyband(rows: pd.DataFrame) -> pd.DataFrame:
        return rows[~dominated(rows[fields].to_numpy(dtype=float), rows[id_col].to_numpy(), k)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, waiting, n = None, [], 0
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n >= block:
                held, waiting, n = skyband(pd.concat([*([] if held is None else [held]), *waiting])), [], 0
                if len(held) >= block:
                    yield held
                    held = None
        rest = [*([] if held is None else [held]), *waiting]
        if rest:
            yield skyband(pd.concat(rest))

    return run


def skyband(scores: DataFrame, k: int, fields: list[str] | None = None, id_col: str = "hex_id", block: int = 20_000) -> DataFrame:
    """(id, fields): rows among which the best k by any weights >= 0 are found, ties by id; at least the k-skyband.

    Every partition keeps its own skyband, in memory bounded by ``block`` rows; survivors are dealt
    anew, by a hash of the id and the round, to parts of a block, until one is left (the result is then the
    skyband itself) or a round takes away less than a tenth. More rows than the skyband are
    never wrong, so data of which little can be left out end as a larger index, not in a long search.
    Rows with null or non-finite scores take no part; repeated ids are all kept or counted
    one by one; an empty table gives no rows.
    """
    fields = fields or FIELDS
    usable = F.col(id_col).isNotNull()
    for f in fields:
        usable = usable & (F.abs(f) < float("inf"))
    slim = scores.where(usable).select(id_col, *[F.col(f).cast("double").alias(f) for f in fields])
    step = _prune(fields, id_col, k, block)
    left = materialise(slim.mapInPandas(step, slim.schema), "skyband")
    n, turn = left.count(), 0
    while True:
        parts, turn = max(1, -(-n // block)), turn + 1
        dealt = left.coalesce(1) if parts == 1 else left.repartition(parts, F.xxhash64(F.col(id_col), F.lit(turn)))
        after = materialise(dealt.mapInPandas(step, slim.schema), "skyband")
        drop(left)
        before, left, n = n, after, after.count()
        if parts == 1 or n > 0.9 * before:
            return left
