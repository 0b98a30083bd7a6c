"""SimHash groups against a plain version, document by document."""

import numpy as np
import xxhash
from edges import EDGE, docs
from pyspark.sql import functions as F

from terraweave.llm import simhash_dedup


def plain_fingerprint(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    group = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            least = min(group[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 4)
            changed |= least != group[i]
            group[i] = least
    return group


def corpus():
    rng = np.random.default_rng(14)
    base = [rng.choice([f"w{k}" for k in range(400)], int(rng.integers(150, 400))).tolist() for _ in range(12)]
    out = [" ".join(rng.choice([f"v{k}" for k in range(90)], int(rng.integers(3, 60)))) for _ in range(20)]
    for words in base:
        out.append(" ".join(words))
        for _ in range(5):  # near copies, some within four bits
            copy = list(words)
            for at in rng.integers(0, len(copy), int(rng.integers(1, 4))):
                copy[at] = "changed"
            out.append(" ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
    return out + EDGE + ["Ä É a b c", "ä é a b c"]


def test_components_equal_plain_version_for_every_document(spark):
    texts = corpus()
    fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    groups = plain_groups(fps)
    got = {r.doc_id: r for r in simhash_dedup.cluster(docs(spark, texts)).collect()}
    assert {i: r.fp % 2**64 for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == groups and len(set(groups.values())) < len(groups) - 20
    kept = {r.doc_id for r in simhash_dedup.keep_one(docs(spark, texts)).collect()}
    assert kept == set(groups.values())


def test_finer_keys_meet_every_linked_pair(spark):
    rng = np.random.default_rng(15)
    rows = []
    for i in range(400):
        x = int(rng.integers(0, 2**63))
        y = x
        for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
            y ^= 1 << int(b)
        rows.append((i, x, y - 2**64 if y >= 2**63 else y))
    df = spark.createDataFrame(rows, "i long, a long, b long")
    keys = lambda c: df.select("i", F.explode(simhash_dedup.variants(F.col(c), 4)).alias("v"), c).select("i", F.explode(simhash_dedup.subkeys(F.col(c), F.col("v"), 4)).alias("k"))
    assert keys("a").join(keys("b"), ["i", "k"]).select("i").distinct().count() == 400


def test_simhash_nulls_repeats_and_empty(spark):
    same = docs(spark, ["a b c d e", "a b c d e", "a b c d e", None, "q r s t u v w"], [None, 7, 7, None, None])
    got = sorted((r.doc_id is None, r.doc_id or 0, -1 if r.component_id is None else r.component_id) for r in simhash_dedup.cluster(same).collect())
    assert got == [(False, 7, 7), (False, 7, 7), (True, 0, -1), (True, 0, -1), (True, 0, 7)]
    assert simhash_dedup.keep_one(same).count() == 3
    assert simhash_dedup.cluster(same.limit(0)).count() == 0 and simhash_dedup.keep_one(same.limit(0)).count() == 0
