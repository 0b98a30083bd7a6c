import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from terraweave.operators import neighbours
from terraweave.operators.composites import Population, composite, tail_overlaps, written_with_figures

SCHEMA = "hex_id string, a double, b double, flag boolean"
POPULATIONS = {"all": Population("true", ["a", "b"], [("a", "b")]), "flagged": Population("flag", ["a"], [("a", "b"), ("b", "a")]), "none": Population("a > 1000", ["a"], [("a", "b")])}
FIGURES = {("count", "a", "high"): "count_if(a >= 5)", ("spread", "b", "covariance"): "covar_pop(a, b)"}


def _table(n, seed):
    rng = np.random.default_rng(seed)
    a = np.where(rng.random(n) < 0.9, 7.0, rng.integers(0, 20, n))  # nine of ten rows share a value
    frame = pd.DataFrame({"hex_id": [f"h{i}" for i in range(n)], "a": a, "b": a * rng.random(n), "flag": rng.random(n) < 0.4})
    frame.loc[frame.index % 11 == 3, "b"] = np.nan
    return frame


def _rows(frame, spark):
    rows = [tuple(None if v != v else v for v in r) for r in frame.astype(object).itertuples(index=False)]
    return spark.createDataFrame(rows, SCHEMA)


def _collected(rows):
    found = [(*r[:3], r[3]) for r in rows.collect()]
    assert len({r[:3] for r in found}) == len(found)
    return {r[:3]: r[3] for r in found}


def test_figures_of_every_population_equal_pandas(spark):
    frame = _table(400, 1)
    table, rows = composite(_rows(frame, spark), POPULATIONS, FIGURES)
    assert table.count() == len(frame)
    found = _collected(rows)
    assert found["count", "a", "high"] == (frame.a >= 5).sum()
    both = frame.dropna()
    assert found["spread", "b", "covariance"] == pytest.approx(np.cov(both.a, both.b, ddof=0)[0, 1], abs=1e-6)
    for name, part in (("all", frame), ("flagged", frame[frame.flag])):
        for f in POPULATIONS[name].fields:
            v = part[f]
            expected = {"n": v.count(), "missing": v.isna().sum(), "min": v.min(), "mean": v.mean(), "std": v.std(ddof=0), "max": v.max(), "median": v.median(), "p10": v.quantile(0.1), "p99": v.quantile(0.99)}
            for metric, value in expected.items():
                assert found["distribution", f"{name}: {f}", metric] == pytest.approx(value, abs=1e-6)
        for a, b in POPULATIONS[name].pairs:
            assert found["correlation", f"{name}: {a} ~ {b}", "pearson"] == pytest.approx(part[a].corr(part[b]), abs=1e-6)
            ranks = part[[a, b]].rank()
            assert found["correlation", f"{name}: {a} ~ {b}", "spearman"] == pytest.approx(ranks[a].corr(ranks[b]), abs=1e-6)
    assert found["correlation", "none: a ~ b", "pearson"] is None and found["correlation", "none: a ~ b", "spearman"] is None
    assert not any(k[1] == "none: a" for k in found)


def test_empty_tables_constants_and_null_flags(spark):
    found = _collected(composite(spark.createDataFrame([], SCHEMA), POPULATIONS, FIGURES)[1])
    assert found["count", "a", "high"] == 0 and found["spread", "b", "covariance"] is None
    assert found["correlation", "all: a ~ b", "spearman"] is None
    rows = [("x", 3.0, 1.0, None), ("y", 3.0, None, None), ("z", 3.0, 2.0, True)]
    found = _collected(composite(spark.createDataFrame(rows, SCHEMA), POPULATIONS, FIGURES)[1])
    assert found["correlation", "all: a ~ b", "pearson"] is None and found["correlation", "all: a ~ b", "spearman"] is None
    assert found["distribution", "flagged: a", "n"] == 1 and found["distribution", "all: b", "missing"] == 1


def test_figures_are_taken_in_the_job_that_writes(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(1000, numPartitions=3).mapInPandas(count, "id long")
    table, found = written_with_figures(df, {("rows", "id", "all"): F.count("*"), ("rows", "id", "top"): F.max("id")}, "once")
    assert {r.metric: r.value for r in found.collect()} == {"all": 1000.0, "top": 999.0}
    assert table.count() == 1000 and seen.value == 1000


def test_overlap_of_best_fractions_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(f"h{i:02}", 1.0, float(-i), float(i)) for i in range(20)], "hex_id string, a double, b double, c double")
    found = {r.field: (r.rows, r.shared) for r in tail_overlaps(df, "a", ["b", "c"]).collect()}
    assert found == {"b": (2, 2), "c": (2, 0)}


def test_packed_network_equals_the_joins(spark):
    rng = np.random.default_rng(4)
    rows = [(c, r, int(rng.integers(0, 4)), int(rng.integers(0, 9)), int(rng.integers(0, 3))) for c in range(-8, 9) for r in range(-7, 8) if rng.random() < 0.8]
    names = ["candidate_pixels", "terrestrial_pixels", "habitat_context_pixels"]
    counts = spark.createDataFrame(rows, "grid_col int, grid_row int, " + ", ".join(f"{n} long" for n in names))
    units = counts.where("terrestrial_pixels > 0").withColumns({"hex_id": F.concat_ws("_", "grid_col", "grid_row"), "habitat_fraction_of_terrestrial": F.col(names[2]) * 1.0 / F.col(names[1])})
    joined = neighbours.network_indicators(units.where("candidate_pixels > 1"), units)
    packed = neighbours.packed_network(counts, F.expr("candidate_pixels > 1 and terrestrial_pixels > 0"))
    fields = [c for c in joined.columns if c != "hex_id"]
    left = {r.hex_id: r for r in joined.collect()}
    right = {f"{r.grid_col}_{r.grid_row}": r for r in packed.collect()}
    assert left.keys() == right.keys() and left
    for k, row in left.items():
        for f in fields:
            assert right[k][f] == (pytest.approx(row[f], abs=1e-12) if isinstance(row[f], float) else row[f])
