"""Source mixing: weights against a plain bisection, budgets, order and edges."""

import collections
import math

import pytest
from edges import DOCS, EDGE, docs
from pyspark.sql import functions as F

from terraweave.llm import mixing


def rows(spark, n=600):
    data = [(i, " ".join([f"w{i}"] * (1 + i % 5)), "en", "big" if i % 4 else f"s{i % 3}" if i % 8 else None, 1, "x") for i in range(n)]
    return data, spark.createDataFrame(data, DOCS)


def plain_passes(tokens, entropy, repetition):
    total = sum(tokens.values())

    def measures(alpha):
        w = {s: (t / total) ** alpha for s, t in tokens.items()}
        z = sum(w.values())
        p = {s: v / z / (tokens[s] / total) for s, v in w.items()}
        return -sum(v / z * math.log(v / z) for v in w.values()) / math.log(len(w)), {s: v / min(p.values()) for s, v in p.items()}

    def smallest(good):
        low, high = 0.0, 1.0
        for _ in range(50):
            mid = (low + high) / 2
            low, high = (low, mid) if good(mid) else (mid, high)
        return high

    alpha = max(smallest(lambda a: measures(a)[0] <= entropy), smallest(lambda a: max(measures(a)[1].values()) <= repetition))
    return measures(alpha)[1]


@pytest.mark.parametrize("entropy, repetition, budget, block", [(0.9, 30.0, None, 65_536), (0.9, 1.7, None, 40), (0.8, 30.0, 700, 40), (0.97, 2.0, 9000, 7)])
def test_every_source_gets_its_budget(spark, entropy, repetition, budget, block):
    data, df = rows(spark)
    tokens = collections.Counter()
    for r in data:
        tokens[r[3]] += len(r[1].split())
    passes = plain_passes(tokens, entropy, repetition)
    scale = 1.0 if budget is None else budget / sum(tokens[s] * p for s, p in passes.items())
    out = mixing.mix(df.repartition(3), target_entropy=entropy, max_repetition=repetition, budget=budget, rows_a_block=block).collect()
    got, per_pass = collections.Counter(), collections.defaultdict(set)
    for r in out:
        assert r.mix_tokens == len(r.text.split()) and r.mix_source == r.source
        got[r.source] += r.mix_tokens
        assert r.doc_id not in per_pass[r.source, r.mix_pass]  # a pass is a permutation
        per_pass[r.source, r.mix_pass].add(r.doc_id)
    ids = collections.defaultdict(set)
    for r in data:
        ids[r[3]].add(r[0])
    for s, t in tokens.items():
        wanted = passes[s] * scale * t
        assert wanted - 1e-3 <= got[s] < wanted + 5 + 1e-3  # overrun by less than one document
        full = math.floor(passes[s] * scale + 1e-6)
        assert all(per_pass[s, k] == ids[s] for k in range(full))
        assert all(k <= full for x, k in per_pass if x == s)


def test_order_is_a_permutation_of_blocks_that_differs_by_pass(spark):
    _, df = rows(spark)
    out = mixing.mix(df, target_entropy=0.9, max_repetition=30.0, rows_a_block=40)
    order = collections.defaultdict(list)
    for r in out.orderBy("mix_pass", "mix_block", "mix_rank").collect():
        order[r.mix_pass].append((r.mix_block, r.doc_id))
    for places in order.values():
        blocks = [b for b, _ in places]
        assert len(set(blocks)) > 1 and all(a <= b for a, b in zip(blocks, blocks[1:]))
    both = {d for _, d in order[0]} & {d for _, d in order[1]}
    first, second = ([d for _, d in order[k] if d in both] for k in (0, 1))
    assert len(both) > 20 and first != second and first != sorted(first)


def test_mixing_edges(spark):
    df = docs(spark, EDGE + ["same", "same"], [*range(len(EDGE)), None, None])
    out = mixing.mix(df)
    assert out.select("doc_id").distinct().count() == len(EDGE) + 1 and out.where("doc_id is null").count() >= 2
    clash = df.withColumnRenamed("score", "mix_pass").withColumn("tokens", F.lit(1)).withColumn("source_", F.lit("x"))
    assert sorted(mixing.mix(clash).columns) == sorted([*(c for c in clash.columns if c != "mix_pass"), "mix_source", "mix_tokens", "mix_pass", "mix_block", "mix_rank"])
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mix(df.limit(0), budget=10).count() == 0
    one = mixing.mix(docs(spark, ["a b c"] * 4).withColumn("source", F.lit("only")))
    assert one.count() == 4
