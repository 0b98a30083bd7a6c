"""Partners in score bands against a plain search over all later rows."""

import numpy as np
import pytest

from terraweave.operators import bands
from terraweave.sources import storage

SCHEMA = "hex_id string, s double, v double, high_row string"


def plain_extremes(rows, width):
    ordered = sorted((s, i, v) for i, s, v in rows if s is not None and v is not None)
    out = []
    for k, (s, i, v) in enumerate(ordered):
        band = [(j, ordered[j][2]) for j in range(k + 1, len(ordered)) if ordered[j][0] <= s + width]
        out.append((k, i, max(band, key=lambda x: (x[1], -x[0]))[0] if band else None, min(band, key=lambda x: (x[1], x[0]))[0] if band else None))
    return ordered, out


def plain_pairs(rows, width, n):
    ordered, found = plain_extremes(rows, width)
    pairs = {}
    for k, i, high, low in found:
        for kind, j in enumerate((high, low)):
            if j is not None and ordered[j][2] != ordered[k][2]:
                pairs.setdefault((k, j), (-abs(ordered[j][2] - ordered[k][2]), i, kind, j))
    best = sorted((p[0], p[1], p[2], k, j) for (k, j), p in pairs.items())[:n]
    return [(place + 1, i, ordered[j][1], ordered[k][0], ordered[j][0], ordered[k][2], ordered[j][2], -d) for place, (d, i, _, k, j) in enumerate(best)]


def table(spark, rows):
    return spark.createDataFrame([(i, s, v, "clash") for i, s, v in rows], SCHEMA).repartition(7)


@pytest.mark.parametrize("kind", ["spread", "hot", "one_score", "few_values"])
@pytest.mark.parametrize("block", [4, 128])
def test_bands_equal_plain_search(spark, kind, block):
    """Bands inside a block, over many blocks, and with 90 % of the rows at one score."""
    rng = np.random.default_rng(len(kind) + block)
    n = 700
    score = {"spread": rng.uniform(0, 100, n).round(1), "hot": np.where(rng.random(n) < 0.9, 50.0, rng.uniform(0, 100, n).round(0)), "one_score": np.full(n, 3.0), "few_values": rng.integers(0, 20, n).astype(float)}[kind]
    value = rng.integers(0, 4, n).astype(float) if kind == "few_values" else rng.normal(size=n).round(2)
    rows = [(f"h{i:04d}", float(s), float(v)) for i, (s, v) in enumerate(zip(score, value, strict=True))] + [("null", None, 1.0), ("none", 5.0, None)]
    got = sorted((r._row, r.hex_id, r.high_row, r.low_row) for r in bands.band_extremes(table(spark, rows), "s", "v", 2.0, block=block).collect())
    assert got == plain_extremes(rows, 2.0)[1]
    pairs = sorted(tuple(x for k, x in enumerate(r) if k != 5) for r in bands.contrast_pairs(table(spark, rows), "s", "v", block=block).collect())
    assert pairs == plain_pairs(rows, 2.0, 5)


def test_bands_edges(spark):
    assert bands.contrast_pairs(table(spark, [("a", 1.0, 2.0)]), "s", "v").count() == 0
    assert bands.contrast_pairs(table(spark, []), "s", "v").count() == 0
    assert bands.contrast_pairs(table(spark, [("a", 1.0, 2.0), ("b", 3.0, 2.0), ("c", 3.1, 9.0)]), "s", "v").collect()[0][1:3] == ("b", "c")  # the limit is inclusive, equal values don't count


def test_no_key_holds_a_hot_score(spark, monkeypatch):
    """With one score for all rows, no key of the spans that share an answer has more rows than a block."""
    rows = [(f"h{i:05d}", 1.0, float(i % 97)) for i in range(3000)]
    kept = {}

    def keep(df, name):
        kept[name] = storage.materialise(df, name)
        return kept[name]

    monkeypatch.setattr(bands, "materialise", keep)
    assert bands.band_extremes(table(spark, rows), "s", "v", 2.0, block=64).count() == 3000
    spans = kept["band-spans"]
    assert spans.select("_last").distinct().count() == 1  # hot
    assert spans.groupBy("_first_block", "_last").count().agg({"count": "max"}).first()[0] <= 64
    assert spans.groupBy("_first_block").count().agg({"count": "max"}).first()[0] <= 64
