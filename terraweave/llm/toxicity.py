"""Toxicity by maximum-scoring segments.

Token weights are log-odds of toxic against clean text under an informative Dirichlet
prior, less a drift that makes ordinary text score downwards. A linear-time scan finds
all maximal scoring segments of a document. Under the null model the best score of n
tokens follows an extreme-value law, P(S >= s) = 1 - exp(-K n exp(-lambda s)); lambda
solves sum p exp(lambda w) = 1 over clean tokens and K is fitted on clean documents. The
evidence of the segments that rise above that law adds up to the document's evidence,
and a logistic curve fitted on the training labels turns it into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.llm.common import drop, id_remainder, materialise, table

_WORD = re.compile(r"[^\W\d_]+")
SCHEMA = "doc_id long, score double, predicted int, evidence double, n_segments int, segments array<struct<start:int,length:int,weight:double>>"


def tokens_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]  # tokens whose weight differs from the default
    default: float
    lam: float
    k: float
    a: float
    b: float


def maximal_segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [start, end) by the linear-time stack algorithm.

    Runs of one sign are joined first, so the Python loop is over runs. Every segment on
    the stack knows its nearest earlier one with a smaller total before it; the search for
    a partner jumps along these links and never looks at the others again.
    """
    positive = weights > 0
    if not positive.any():
        return []
    edges = np.concatenate([[0], np.flatnonzero(positive[1:] != positive[:-1]) + 1])
    sums = np.add.reduceat(weights, edges)
    ends = np.append(edges[1:], len(weights))
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, total before, total after, link
    total = 0.0
    for start, end, s in zip(edges.tolist(), ends.tolist(), sums.tolist(), strict=True):
        before, total = total, total + s
        if s <= 0:
            continue
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= total:
                break
            start, before = stack[j][0], stack[j][2]
            link = stack[j][4]
            del stack[j:]
            j = link
        stack.append((start, end, before, total, j))
    return [(start, end, after - before) for start, end, before, after, _ in stack]


def squash(evidence):
    """Logarithmic scale, so that a few extreme documents don't flatten the curve."""
    return np.sign(evidence) * np.log1p(np.abs(evidence))


def evidence_of(tokens: list[str], model: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """Evidence of the document, and its segments that exceed the extreme-value law."""
    if not tokens:
        return 0.0, []
    get, default = model.weights.get, model.default
    weights = np.fromiter((get(t, default) for t in tokens), np.float64, len(tokens))
    centre = math.log(max(model.k * len(tokens), 1e-12))  # expected best score, times lambda
    found = [(s, e, w, model.lam * w - centre) for s, e, w in maximal_segments(weights)]
    total = sum(max(0.0, x) for *_, x in found)
    best = max((x for *_, x in found), default=-centre)
    return total if total > 0 else min(0.0, best), [(s, e, w) for s, e, w, x in found if x > 0]


def _counter():
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(pdf["text"], pdf["toxic"], strict=True):
                (toxic if label else clean).update(set(tokens_of(text or "")))  # a document counts once for a token
            words = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"token": pd.Series(words, dtype=object), "c1": [toxic[w] for w in words], "c0": [clean[w] for w in words]})

    return count


def _scorer(model: Model, threshold: float, with_segments: bool):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"], strict=True):
                text = text if isinstance(text, str) else ""
                lowered = text.lower()
                evidence, found = evidence_of(_WORD.findall(lowered), model)
                p = 1 / (1 + math.exp(-max(-700.0, min(700.0, model.a + model.b * float(squash(evidence))))))
                spans = []
                if with_segments and found and len(lowered) == len(text):  # lower case of a few letters is longer; then no offsets
                    places = [m.span() for m in _WORD.finditer(lowered)]
                    spans = [{"start": places[s][0], "length": places[e - 1][1] - places[s][0], "weight": w} for s, e, w in found]
                rows.append((doc_id, p, int(p >= threshold), evidence, len(found), spans))
            out = pd.DataFrame(rows, columns=["doc_id", "score", "predicted", "evidence", "n_segments", "segments"])
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64") if len(out) else out["doc_id"]
            yield out

    return score


def known_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One row a labelled id; where labels disagree, toxic wins."""
    return labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(F.col(label_col) != 0).alias("toxic"))


def bounded_sample(known: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each class of ``known`` (_id, toxic), those with the smallest hashes."""
    parts = [known.where(F.col("toxic") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for value in (True, False)]
    return parts[0].unionByName(parts[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_class: int = 10000, min_z: float = 3.0, drift: float = 1.0, prior_share: float = 0.05,
) -> Model:
    """Fit on a bounded sample: at most ``per_class`` labelled documents of each class that ``docs`` holds.

    The sample's ids (at most 2 * per_class longs) are broadcast, so no text is shuffled,
    and its texts are written once. All terms with \\|z\\| >= min_z get their own log-odds;
    such a term stands in several documents of the sample, which bounds their number. The
    rest weigh -drift. In the logistic curve the classes weigh as all labels of ``docs`` have them,
    however many are sampled. The prior weighs ``prior_share`` of the sample's tokens. Without documents of both classes every score is the prior 0.5 or
    below. Labels of unknown documents and null labels are ignored.
    """
    # labels of absent documents must not use up the sample, so ids are matched before it is drawn
    present = docs.select(F.col(id_col).cast("long").alias("_id"))
    known = materialise(known_labels(labels, id_col, label_col).join(present, "_id", "left_semi"), "toxicity-labels")
    sample = F.broadcast(bounded_sample(known, per_class))
    all_labels = known.groupBy("toxic").count().collect()
    # how many labelled documents a sampled one of the class stands for
    stands_for = {r["toxic"]: r["count"] / min(r["count"], per_class) for r in all_labels}
    train = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(sample, F.col("doc_id") == F.col("_id")).select("text", "toxic")
    train = materialise(train, "toxicity-sample")
    drop(known)
    counts = train.mapInPandas(_counter(), "token string, c1 long, c0 long").groupBy("token").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))
    totals = counts.agg(F.sum("c1").alias("n1"), F.sum("c0").alias("n0")).first()
    n1, n0 = totals["n1"] or 0, totals["n0"] or 0
    if not n1 or not n0:
        return Model({}, -drift, 1.0, 1.0, -5.0, 1.0)
    prior_tokens = prior_share * (n1 + n0)
    prior = F.lit(prior_tokens) * (F.col("c1") + F.col("c0")) / F.lit(float(n1 + n0))
    odds = lambda c, n: F.log((F.col(c) + prior) / (F.lit(n + prior_tokens) - F.col(c) - prior))
    delta = odds("c1", n1) - odds("c0", n0)
    z = delta / F.sqrt(1 / (F.col("c1") + prior) + 1 / (F.col("c0") + prior))
    terms = counts.withColumn("delta", delta).withColumn("z", z).where(F.abs("z") >= min_z).orderBy("token").collect()
    weights = {r["token"]: r["delta"] - drift for r in terms}
    clean = np.array([r["c0"] for r in terms], float) / n0
    lam = _solve_lambda(clean, np.array([weights[r["token"]] for r in terms]), -drift)
    model = Model(weights, -drift, lam, 1.0, 0.0, 1.0)
    # one row per sampled document, so bounded: best score and length
    best = train.mapInPandas(_best_scorer(model), "toxic boolean, n double, best double, text_order long").toPandas()
    null = best[(~best["toxic"]) & (best["n"] > 0)]
    k = len(null) / max(1e-9, float((null["n"] * np.exp(-lam * null["best"])).sum())) if len(null) else 1.0
    model = Model(weights, -drift, lam, k, 0.0, 1.0)
    seen = train.mapInPandas(_evidence_scorer(model), "toxic boolean, evidence double").toPandas()
    toxic = seen["toxic"].to_numpy(bool)
    a, b = _logistic(seen["evidence"].to_numpy(float), toxic.astype(float), np.where(toxic, stands_for.get(True, 1.0), stands_for.get(False, 1.0)))
    drop(train)
    return Model(weights, -drift, lam, k, a, b)


def _best_scorer(model: Model):
    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                tokens = tokens_of(text or "")
                weights = np.array([model.weights.get(t, model.default) for t in tokens])
                rows.append((bool(toxic), float(len(tokens)), max((w for *_, w in maximal_segments(weights)), default=0.0), 0))
            yield pd.DataFrame(rows, columns=["toxic", "n", "best", "text_order"])

    return best


def _evidence_scorer(model: Model):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"].astype(bool), "evidence": [evidence_of(tokens_of(t or ""), model)[0] for t in pdf["text"]]})

    return score


def _solve_lambda(shares: np.ndarray, weights: np.ndarray, default: float) -> float:
    rest = max(0.0, 1 - float(shares.sum()))
    excess = lambda lam: float((shares * np.exp(lam * weights)).sum()) + rest * math.exp(lam * default) - 1
    if len(weights) == 0 or weights.max() <= 0 or not (shares[weights > 0] > 0).any():
        return 1.0
    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Intercept and non-negative slope by Newton's method; rows count ``weight`` times."""
    a, b = 0.0, 0.0
    x = squash(x)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = weight * np.maximum(p * (1 - p), 1e-9)
        g = np.array([(weight * (y - p)).sum() - ridge * a, (weight * (y - p) * x).sum() - ridge * b])
        h = np.array([[w.sum() + ridge, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + ridge]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(max(b, 0.0))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, with_segments: bool = True) -> DataFrame:
    """(doc_id, score, predicted, evidence, n_segments, segments) of every whole text.

    segments: code point spans of the significant passages. Null or empty texts have no
    evidence and get the score of a text without toxic words. Null ids stay null. Repeated
    rows give repeated results; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(_scorer(model, threshold, with_segments), SCHEMA)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    model = fit(docs.where(~held_out), labels.where(~held_out))
    return score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_segments", "evidence")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; all columns are kept.

    The text is scored in place, so nothing is shuffled or joined.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        evidence = [evidence_of(tokens_of(t), model)[0] if isinstance(t, str) else 0.0 for t in texts]
        return pd.Series([1 / (1 + math.exp(-max(-700.0, min(700.0, model.a + model.b * float(squash(e)))))) for e in evidence], dtype="float64")

    return docs.where(score(F.col(text_col)) < threshold)
