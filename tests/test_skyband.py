import numpy as np
import pandas as pd
import pytest

from terraweave.operators.scoring import FIELDS
from terraweave.operators.skyband import dominated, skyband

SCHEMA = "hex_id string, " + ", ".join(f"{f} double" for f in FIELDS)


def _best(frame, weights, n):
    score = frame[FIELDS[0]] * weights[0]
    for w, f in zip(weights[1:], FIELDS[1:]):
        score = score + frame[f] * w
    return list(frame.assign(score=score).sort_values(["score", "hex_id"], ascending=[False, True]).hex_id[:n])


@pytest.mark.parametrize("kind", ["rounded", "ties", "trade-off"])
def test_index_ranks_as_all_rows_for_any_weights(spark, kind):
    rng = np.random.default_rng(3)
    n = 1500
    values = rng.random((n, 5)) * 100
    if kind == "ties":
        values = np.where(rng.random((n, 1)) < 0.6, 80.0, np.floor(values / 25) * 25)
    elif kind == "trade-off":
        values = values / values.sum(axis=1, keepdims=True) * 100
    frame = pd.DataFrame(np.round(values, 3), columns=FIELDS).assign(hex_id=[f"h{i}" for i in rng.permutation(n)])[["hex_id", *FIELDS]]
    index = skyband(spark.createDataFrame(frame, SCHEMA).repartition(3), 7, block=200).toPandas()
    assert index.hex_id.is_unique and (kind == "trade-off" or len(index) < n)
    for i in range(1000):
        raw = np.where(rng.random(5) < 0.3, 0, rng.integers(0, 101, 5)).astype(float)
        weights = raw / raw.sum() if raw.sum() else np.full(5, 0.2)
        assert _best(index, weights, 7) == _best(frame, weights, 7), (i, weights)


def test_one_part_gives_the_skyband_itself(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 6, (400, 5)).astype(float)
    ids = np.array([f"h{i}" for i in rng.permutation(400)], dtype=object)
    before = [sum(ids[s] < ids[r] and (values[s] >= values[r]).all() or (values[s] > values[r]).all() for s in range(400)) for r in range(400)]
    assert list(dominated(values, ids, 3, chunk=16)) == [b >= 3 for b in before]
    rows = [(i, *map(float, v)) for i, v in zip(ids, values)]
    assert {r.hex_id for r in skyband(spark.createDataFrame(rows, SCHEMA), 3).collect()} == {i for i, b in zip(ids, before) if b < 3}


def test_unusable_rows_repeats_and_empty_tables(spark):
    assert skyband(spark.createDataFrame([], SCHEMA), 2).count() == 0
    rows = [("a", 1.0, 1.0, 1.0, 1.0, None), ("b", 1.0, 1.0, 1.0, 1.0, float("nan")), (None, 9.0, 9.0, 9.0, 9.0, 9.0), ("c", 2.0, 2.0, 2.0, 2.0, 2.0), ("c", 2.0, 2.0, 2.0, 2.0, 2.0), ("d", 1.0, 1.0, 1.0, 1.0, 1.0)]
    assert sorted(r.hex_id for r in skyband(spark.createDataFrame(rows, SCHEMA), 2).collect()) == ["c", "c"]
    assert sorted(r.hex_id for r in skyband(spark.createDataFrame(rows, SCHEMA), 3).collect()) == ["c", "c", "d"]
