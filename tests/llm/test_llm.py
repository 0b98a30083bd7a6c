"""Brute-force, round-trip and edge-case tests of the training-data operators."""

import collections
import math
import time
import zlib

import numpy as np
import pytest
import xxhash
from edges import DOCS, EDGE, docs
from pyspark.sql import functions as F

from terraweave.llm import components, mixing, packing, simhash_dedup, topk_search, toxicity

def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)], i) for i in range(300)] + [(300, None, 1), (301, [1.0, None], 1), (302, [float("nan")], 1), (303, [], 1)]
    rows += [(7, rows[7][1], 9), (None, rows[5][1], 1)]  # a repeated row, one without an id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")
    got = topk_search.top_k(df, F.col("vec_id") % 50 == 0, k=10, block_rows=64, query_rows=4).collect()
    valid = {i: [math.floor(1024 * x) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for q in [i for i in valid if i % 50 == 0]:
        scored = sorted((-sum(a * b for a, b in zip(valid[q], v)), i) for i, v in valid.items() if i != q)[:10]
        assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [(i, -s) for s, i in scored]
    assert topk_search.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_top_k_with_every_row_repeated(spark):
    rng = np.random.default_rng(12)
    vectors = {i: [float(x) for x in rng.normal(size=4).round(2)] for i in range(60)}
    rows = [(i, v) for i, v in vectors.items() for _ in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = topk_search.top_k(df, F.col("vec_id") % 20 == 0, k=10, block_rows=4096).collect()
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()}
    for q in (0, 20, 40):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [(i, -s) for s, i in scored]


def test_top_k_broadcasts_no_copies_of_query_blocks(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(200)], "vec_id long, embedding array<double>")
    got = topk_search.top_k(df, F.col("vec_id") % 10 == 0, k=3, block_rows=32, query_rows=4)
    assert len(got.collect()) == 20 * 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_threshold_search_stops_early():
    comps = np.zeros((1000, 2))
    comps[:, 0] = np.arange(1000)
    order = np.argsort(comps, axis=0, kind="stable").T
    seen = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    rows, scores = topk_search.threshold_search(comps.view(Counting), np.arange(1000), order, np.array([1.0, 0.0]), -1, 5, -np.inf)
    assert rows.tolist() == [999, 998, 997, 996, 995] and sum(seen) < 100


def test_maximal_segments_equal_definition():
    rng = np.random.default_rng(2)
    for _ in range(200):
        w = rng.integers(-5, 6, rng.integers(1, 14)).astype(float)
        w[w == 0] = -1.0

        def split(a, b):
            best = max(((w[i:j].sum(), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if best is None or best[0] <= 0:
                return []
            i, j = best[3], best[4]
            return split(a, i) + [(i, j, float(best[0]))] + split(j, b)

        assert sum(s for *_, s in toxicity.maximal_segments(w)) == pytest.approx(sum(s for *_, s in split(0, len(w))))
        w = w + rng.random(len(w)) / 100  # without ties the segments themselves are unique
        assert [x[:2] for x in toxicity.maximal_segments(w)] == [x[:2] for x in split(0, len(w))]


def test_maximal_segments_take_linear_time():
    def seconds(n):
        w = np.tile([1.0, -1.5], n)  # every run starts lower than all before it
        start = time.perf_counter()
        assert len(toxicity.maximal_segments(w)) == n
        return time.perf_counter() - start

    seconds(1000)
    assert min(seconds(160_000) for _ in range(3)) < 60 * min(seconds(10_000) for _ in range(3))


def test_toxicity_equals_plain_formulas(spark):
    rng = np.random.default_rng(21)
    texts, toxic = [], []
    for i in range(160):
        words = [f"w{'abcdefghij'[x % 10]}{'klmnopqrst'[x // 10]}" for x in rng.integers(0, 80, 30)]
        if i % 4 == 0:
            words[4:9] = ["vile", "nasty", "foul", "vile", "mean"][: 5]
        texts.append(" ".join(words))
        toxic.append(i % 4 == 0)
    lab = spark.createDataFrame([(i, int(y)) for i, y in enumerate(toxic)] + [(0, 0)], "doc_id long, toxic int")  # 0 has both labels
    model = toxicity.fit(docs(spark, texts), lab)
    c1, c0 = (collections.Counter(w for t, y in zip(texts, toxic) if y == k for w in set(t.split())) for k in (True, False))
    n1, n0 = c1.total(), c0.total()
    prior = 0.05 * (n1 + n0)
    weights = {}
    for w in c1 | c0:
        a = prior * (c1[w] + c0[w]) / (n1 + n0)
        delta = math.log((c1[w] + a) / (n1 + prior - c1[w] - a)) - math.log((c0[w] + a) / (n0 + prior - c0[w] - a))
        if abs(delta) / math.sqrt(1 / (c1[w] + a) + 1 / (c0[w] + a)) >= 3:
            weights[w] = delta - 1
    assert model.weights == pytest.approx(weights) and {"vile", "nasty"} <= set(weights)
    clean = {w: c0[w] / n0 for w in weights}
    assert sum(clean[w] * math.exp(model.lam * v) for w, v in weights.items()) + (1 - sum(clean.values())) * math.exp(-model.lam) == pytest.approx(1, abs=1e-6) or model.lam == 1.0

    def best_segments(t):
        w = [weights.get(x, -1.0) for x in t.split()]

        def split(a, b):
            best = max(((sum(w[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            return [] if best is None or best[0] <= 0 else split(a, best[3]) + [best[0]] + split(best[4], b)

        return split(0, len(w))

    null = [(len(t.split()), max(best_segments(t), default=0.0)) for t, y in zip(texts, toxic) if not y]
    assert model.k == pytest.approx(len(null) / sum(n * math.exp(-model.lam * s) for n, s in null))

    def evidence(t):
        centre = math.log(model.k * len(t.split()))
        over = [model.lam * s - centre for s in best_segments(t)]
        total = sum(max(0.0, x) for x in over)
        return total if total > 0 else min(0.0, max(over, default=-centre))

    x = np.array([math.copysign(math.log1p(abs(evidence(t))), evidence(t)) for t in texts])
    y = np.array(toxic, float)
    p = 1 / (1 + np.exp(-(model.a + model.b * x)))
    assert abs((y - p).sum() - 1e-3 * model.a) < 1e-5 and abs(((y - p) * x).sum() - 1e-3 * model.b) < 1e-5  # the likelihood's maximum
    got = {r.doc_id: r for r in toxicity.score_documents(docs(spark, texts), model).collect()}
    assert [got[i].score for i in range(len(texts))] == pytest.approx(p.tolist())
    for i, t in enumerate(texts[:20]):
        assert [s.weight for s in got[i].segments] == pytest.approx([s for s in best_segments(t) if model.lam * s > math.log(model.k * len(t.split()))])
        assert all(set(t[s.start : s.start + s.length].split()) & set(weights) for s in got[i].segments)
    nobody = spark.createDataFrame([(None, "vile nasty foul vile mean", "x")] * 2, "doc_id long, text string, segments string")
    assert [(r.doc_id, r.predicted) for r in toxicity.score_documents(nobody, model).collect()] == [(None, 1)] * 2
    assert toxicity.score_documents(nobody.limit(0), model).count() == 0 and toxicity.drop_toxic(nobody, model).count() == 0


def test_toxicity_learns_and_handles_edges(spark):
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for i in range(400):
        words = [f"w{x}" for x in rng.integers(0, 300, 60)]
        if i % 4 == 0:
            for p in rng.integers(0, 60, 4):
                words[p] = f"bad{p % 5}"
        texts.append(" ".join(words))
        labels.append((i, int(i % 4 == 0)))
    df, lab = docs(spark, texts), spark.createDataFrame([*labels, (9999, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(df.where("doc_id % 2 = 0"), lab.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in toxicity.score_documents(df, model).collect()}
    assert np.mean([got[i].predicted == y for i, y in labels if i % 2 == 1 or i % 4 == 0]) > 0.95
    edge = toxicity.score_documents(docs(spark, EDGE), model).collect()
    assert len(edge) == len(EDGE) and all(0 <= r.score <= 1 and r.predicted == 0 for r in edge)
    none = toxicity.fit(df.limit(0), lab)
    assert toxicity.score_documents(df.limit(2), none).where("predicted = 1").count() == 0


def test_toxicity_intercept_keeps_the_class_odds_of_all_labels(spark):
    rng = np.random.default_rng(13)
    texts = []
    for i in range(900):
        words = [f"w{x}" for x in rng.integers(0, 300, 40)]
        if rng.random() < (0.9 if i % 9 == 0 else 0.15):  # the marking word is no proof
            words[5:8] = ["bad1", "bad2", "bad3"]
        texts.append(" ".join(words))
    df, lab = docs(spark, texts), spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(900)], "doc_id long, toxic int")
    rates = []
    for per_class in (10000, 100):
        model = toxicity.fit(df, lab, per_class=per_class)
        rates.append(toxicity.score_documents(df, model).agg(F.avg("score")).first()[0])
    # the mean score is the share of toxic labels, 1 in 9, at every size of the sample
    assert rates == pytest.approx([1 / 9, 1 / 9], rel=0.35)


def test_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100


@pytest.mark.parametrize("small", [17, 3])
def test_simhash_links_equal_brute_force(spark, small):
    rng = np.random.default_rng(4)
    values = {int(rng.integers(0, 2**62))}
    for _ in range(120):
        x = sorted(values)[int(rng.integers(0, len(values)))]
        for b in rng.choice(62, int(rng.choice([1, 3, 4, 7])), replace=False):
            x ^= 1 << int(b)
        values.add(x)
    values = sorted(values)
    group = {v: v for v in values}
    for _ in values:
        for v in values:
            group[v] = min([group[v], *(group[u] for u in values if (u ^ v).bit_count() <= 4)])
    got = {r.fp: r.component for r in simhash_dedup.link(spark.createDataFrame([(v,) for v in values], "fp long"), 4, small).collect()}
    sets = lambda m: sorted(sorted(v for v in values if m.get(v, v) == c) for c in {m.get(v, v) for v in values})
    assert sets(got) == sets(group)


def test_simhash_edges(spark):
    got = {r.doc_id: r for r in simhash_dedup.cluster(docs(spark, EDGE)).collect()}
    assert len(got) == len(EDGE) and got[0].fp == got[1].fp == got[2].fp == 0 and got[2].component_id == 0 and got[5].component_id == 4
    h = xxhash.xxh64_intdigest(b"word", 42)
    assert got[3].fp % 2**64 == h
    kept = simhash_dedup.keep_one(docs(spark, EDGE))
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").split(", ") and {0, 3, 4} <= {r.doc_id for r in kept.collect()}


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*EDGE, "a  b   c \n d\t e ", "it's we'll  <|endoftext|> 12 3.5!", " wide   space", "tail "]
    got = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in packing.pack_documents(docs(spark, texts)).collect():
        got[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        pieces = sorted(got[i], key=lambda r: r.piece)
        assert sum(p.length for p in pieces) == len(ids) and [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert all(p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) for p in pieces)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack_documents(docs(spark, EDGE).limit(0)).count() == 0


def test_packing_nulls_repeats_and_gap(spark):
    rows = docs(spark, ["same text", "same text", None, "x y " * 3000, "same text"], [None, None, 4, 7, 9]).withColumn("length", F.lit("clash"))
    got = packing.pack_documents(rows).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece) for r in got if r.doc_id != 7) == [(False, 4, 0), (False, 9, 0), (True, 0, 0), (True, 0, 0)]
    assert len({r.row_id for r in got}) == 5 and len({r.row_id for r in got if r.doc_id == 7}) == 1
    assert {(r.n_sequences, r.lower_bound) for r in got} == {(3, 3)} and len({r.sequence_id for r in got}) == 3
    assert [r.length for r in got if r.doc_id == 4] == [1]


def test_search_that_is_cut_off_reports_its_bound():
    rng = np.random.default_rng(8)
    histogram = dict(collections.Counter(rng.integers(300, 1100, 4000).tolist()))
    some, bound = packing.complete_bins(histogram, 2048, 50)
    more, same = packing.complete_bins(histogram, 2048, 20_000)
    count = lambda patterns: sum(p.times for p in patterns)
    assert bound <= count(more) <= count(some) and same >= bound
    assert collections.Counter(x for p in more for x in p.lengths * p.times) == histogram


def test_bin_completion_is_optimal_on_small_cases():
    def optimum(items, cap):
        best = [len(items)]

        def go(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(items):
                best[0] = len(bins)
                return
            for j in range(len(bins)):
                if bins[j] + items[i] <= cap:
                    go(i + 1, bins[:j] + [bins[j] + items[i]] + bins[j + 1 :])
            go(i + 1, [*bins, items[i]])

        go(0, [])
        return best[0]

    rng = np.random.default_rng(6)
    for _ in range(40):
        items = sorted(rng.integers(1, 21, 9).tolist(), reverse=True)
        patterns, bound = packing.complete_bins(dict(collections.Counter(items)), 20)
        packed = sorted((x for p in patterns for x in p.lengths * p.times), reverse=True)
        assert packed == items and all(sum(p.lengths) <= 20 for p in patterns)
        assert sum(p.times for p in patterns) == bound == optimum(items, 20)
        assert packing.lower_bound(dict(collections.Counter(items)), 20) <= bound




def test_labels_of_absent_documents_leave_the_sample_alone(spark):
    """Many labels without a document must neither use up the sample nor change the weights of the classes."""
    rng = np.random.default_rng(2)
    words = [f"plain{k}" for k in map(chr, range(97, 117))]
    rows = [(i, " ".join(rng.choice(words, 30)) + (" awful nasty vile" if i % 4 == 0 else "")) for i in range(200)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    absent = spark.range(1000, 60000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    alone = toxicity.fit(texts, labels, per_class=50)
    assert toxicity.fit(texts, labels.unionByName(absent), per_class=50) == alone and alone.weights
    assert toxicity.fit(texts, absent, per_class=50).weights == {}
