"""Phrase mining against a plain count of all phrases, on whole results."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from edges import EDGE, docs

from terraweave.llm import phrase_mining

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, limit, at_least, dropped_at=80):
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            for m in range(1, 5):
                f[lang or "und"].update(zip(*[words[i:] for i in range(m)]))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= at_least}
        over = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    over[p[k : k + size]] = max(over[p[k : k + size]], a)
        rows = []
        for p, a in candidates.items():
            if 100 * over[p] >= dropped_at * a:
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n, -r[0]) for i, r in enumerate(sorted(rows)[:limit])]
    return sorted(out)


def corpus(seed, n=400):
    """Zipfian words, fixed phrases, copies, capitals and marks; languages of very different size, one of them null."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "ñandú", "日本", "x y", "E"]
    weights = 1 / np.arange(1, len(words) + 1)
    fixed = ["New York City hall", "as well as", "w1 w2 w3", "by and large", "É é e"]
    rows = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.15 else rng.choice(words, p=weights / weights.sum()) for _ in range(int(rng.integers(0, 60)))]
        text = "".join(p + rng.choice([" ", " ", " ", " ", "\t ", ", ", ".\n", "\r"]) for p in parts)
        rows.append((str(rng.choice(["en", "en", "en", "de"])) if i % 17 else None, text))
    return rows + [("en", "hot copy of all rows")] * (n // 2) + [("one", "a b a b a b"), ("none", None), ("none", " .,; ")]


@pytest.mark.parametrize("limit, at_least, ahead", [(5, 4, 1), (40, 3, 1), (100000, 3, 1), (25, 12, 2)])
def test_phrases_equal_plain_count(spark, limit, at_least, ahead):
    """Small limits leave most prefixes off the frontier; thresholds that are too high at first come down."""
    rows = corpus(limit)
    df = spark.createDataFrame([(t, g, "clash") for g, t in rows], "text string, lang string, f string").repartition(5)
    got = sorted(map(tuple, phrase_mining.mine(df, limit=limit, at_least=at_least, ahead=ahead).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))
    assert got == plain(rows, limit, at_least)


def test_rounds_that_leave_languages_open(spark):
    """All pairs stand in longer phrases, so the first threshold finds no survivor."""
    rows = [("en", f"a{i} b{i} c{i} d{i}") for i in range(60) for _ in range(5)] + [("en", f"a{i} z") for i in range(60) for _ in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(map(tuple, phrase_mining.mine(df, limit=70, at_least=5, ahead=1).collect()))
    assert got == plain(rows, 70, 5)


def test_long_text_and_slices(spark, monkeypatch):
    rows = [("en", "one two three four. " * 60000 + "tail end"), ("en", "one two"), ("de", "one two " * 50)]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = sorted(map(tuple, phrase_mining.mine(df, limit=10, at_least=30).collect()))
    assert got == plain(rows, 10, 30)


def test_edges(spark):
    df = docs(spark, EDGE * 30)
    rows = [(r.lang, r.text) for r in df.collect()]
    assert sorted(map(tuple, phrase_mining.mine(df).collect())) == plain(rows, 2000, 30)
    assert phrase_mining.mine(df.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    """Counts whose product with 2,000,000 passes 64 bits."""
    from pyspark.sql import functions as F

    big = 9_223_372_036_854
    row = spark.range(1).select(phrase_mining._exact_score(F.lit(big - 1), F.lit(big) + F.lit(big)).alias("s")).first()
    assert row.s == 2000000 * (big - 1) // (2 * big)
