"""The n-gram model against a plain one, on whole results."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraweave.llm import katz_lm, katz_tables

SCHEMA = "doc_id long, text string, score string, block long"
EDGE = [None, "", " \n\t", "word", "A b C d", "x " * 3000, "é ü ñ"]


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)], SCHEMA)


class Plain:
    """Katz backoff with dictionaries, as the definition has it."""

    def __init__(self, texts, order):
        self.order, self.c = order, [None] + [collections.Counter() for _ in range(order)]
        for t in texts:
            x = self.tokens(t)
            for i in range(order - 1, len(x)):
                for n in range(1, order + 1):
                    self.c[n][tuple(x[i - n + 1 : i + 1])] += 1
        self.n, self.ends = sum(self.c[1].values()), len(texts)
        of = lambda c: [0.0, *[float(sum(v == r for v in c.values())) for r in range(1, katz_lm.K_MAX + 2)]]
        self.d = [None] + [katz_lm.discounts(of(c)) for c in self.c[1:]]
        self.share = {w: self.d[1][min(v, katz_lm.K_MAX + 1)] * v / self.n for (w,), v in self.c[1].items()}
        self.unseen = 1 - sum(self.share.values())
        self.after = collections.defaultdict(list)
        for n in range(2, order + 1):
            for g in self.c[n]:
                self.after[g[:-1]].append(g[-1])

    def tokens(self, text):
        return ["<s>"] * (self.order - 1) + (text or "").lower().split() + ["</s>"]

    def p(self, h, w):
        if not h:
            return self.share.get(w, self.unseen)
        if h not in self.after:
            return self.p(h[1:], w)
        n, total = len(h) + 1, sum(self.c[len(h) + 1][(*h, x)] for x in self.after[h])
        c = self.c[n][(*h, w)]
        if c:
            return self.d[n][min(c, katz_lm.K_MAX + 1)] * c / total
        kept = sum(self.d[n][min(v, katz_lm.K_MAX + 1)] * v for x in self.after[h] for v in [self.c[n][(*h, x)]])
        return max(1 - kept / total, 1e-12) / (1 - sum(self.p(h[1:], x) for x in self.after[h])) * self.p(h[1:], w)

    def score(self, text):
        x = self.tokens(text)
        return sum(math.log10(self.p(tuple(x[i - self.order + 1 : i]), x[i])) for i in range(self.order - 1, len(x)))


def corpus():
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, 60) if x < 400) for _ in range(70)]
    return texts + texts[:9] + EDGE


@pytest.mark.parametrize("order, block, bucket", [(3, 1_000_000, 1_000_000), (3, 900, 200), (2, 1500, 100), (4, 2000, 400), (1, 1200, 100)])
def test_katz_equals_the_definition(spark, order, block, bucket):
    """Neither the size of blocks and buckets nor the splitting of frequent contexts changes a score."""
    texts = corpus()
    train = [i % 7 != 2 for i in range(len(texts))]
    plain = Plain([t for t, k in zip(texts, train, strict=True) if k], order)
    got = {r.doc_id: r for r in katz_lm.score_documents(docs(spark, texts).repartition(3), F.col("doc_id") % 7 != 2, order=order, block_bytes=block, tokens_a_bucket=bucket).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = [*(t or "").lower().split(), "</s>"]
        assert got[i].score == pytest.approx(plain.score(t), rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].train) == (len(words), sum((w,) in plain.c[1] for w in words), plain.n, train[i])
        assert got[i].base_score == pytest.approx(sum(math.log10((plain.c[1][(w,)] + 1) / (plain.n + len(plain.c[1]) + 1)) for w in words), rel=1e-12)


def test_every_context_sums_to_one():
    plain = Plain([t for t in corpus()[:40]], 3)
    for h in [(), *list(plain.after)[:200]]:
        assert sum(plain.p(h, w) for (w,) in plain.c[1]) + plain.p(h, "never seen") == pytest.approx(1)


def test_katz_edges(spark):
    rows = docs(spark, ["a b", "a b", "c", None, "a b"], [1, 1, None, None, 1])
    got = katz_lm.score_documents(rows, F.lit(None).cast("boolean")).collect()
    assert len(got) == 5 and sum(r.doc_id is None for r in got) == 2 and all(r.train for r in got)  # repeated rows and null ids stand for themselves
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert katz_lm.score_documents(rows.limit(0), F.lit(True)).count() == 0
    none = katz_lm.score_documents(rows, F.lit(False)).collect()
    assert all(r.score == 0 and r.base_score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in none)  # one type, unseen


def test_array_packing_round_trip():
    a, b = np.array([3, 9, 9, 2**40], np.int64), np.array([5, 1, 2], np.int32)
    x, y, z = katz_lm.unpack_arrays(katz_lm.pack_arrays(a, b, np.empty(0, np.int64)))
    assert (x == a).all() and (y == b).all() and len(z) == 0


@pytest.mark.parametrize("order, hot", [(3, 20_000), (3, 5), (2, 50), (1, 20_000)])
def test_stored_tables_score_another_table(spark, tmp_path, monkeypatch, order, hot):
    """Rows that were never in the training table, with frequent keys broadcast or not."""
    monkeypatch.setattr(katz_tables, "HOT_KEYS", hot)
    texts = corpus()
    known, others = texts[:40], [*texts[30:60], *EDGE, "w1 never-seen w2", "w1 never-seen w2"]
    plain = Plain(known, order)
    katz_tables.fit(docs(spark, known), f"{tmp_path}/model", order=order, parts=4)
    got = {r.doc_id: r for r in katz_tables.score(docs(spark, others), f"{tmp_path}/model").collect()}
    assert len(got) == len(others)
    for i, t in enumerate(others):
        words = [*(t or "").lower().split(), "</s>"]
        assert got[i].score == pytest.approx(plain.score(t), rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known) == (len(words), sum((w,) in plain.c[1] for w in words))


def test_stored_tables_edges(spark, tmp_path):
    rows = docs(spark, ["a b", "a b", None], [1, 1, None])
    katz_tables.fit(rows, f"{tmp_path}/model", parts=2)
    got = katz_tables.score(rows, f"{tmp_path}/model").collect()
    assert len(got) == 3 and len({r.score for r in got if r.doc_id == 1}) == 1
    stored = spark.read.parquet(f"{tmp_path}/model/ngrams")
    assert stored.groupBy("order", "context").agg(F.countDistinct("part").alias("parts")).where("parts > 1").count() == 0
    assert katz_tables.score(rows.limit(0), f"{tmp_path}/model").count() == 0
    katz_tables.fit(rows.limit(0), f"{tmp_path}/none", parts=2)
    assert {r.score for r in katz_tables.score(rows, f"{tmp_path}/none").collect()} == {0.0}
