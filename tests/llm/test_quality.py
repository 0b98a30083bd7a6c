"""Quality rules against plain counts and ratios, on whole results."""

import base64
import collections

import numpy as np
import pytest
import zstandard
from edges import EDGE, docs

from terraweave.llm import quality_rules

LIMITS = quality_rules.Limits()


def words_of(text):
    return [w for w in "".join(c if c not in "\x20\t\n\x0b\x0c\r" else " " for c in text or "").split(" ") if w]


def plain(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = collections.Counter(windows)
    repeat = {j for k, w in enumerate(windows) if seen[w] > 1 for j in range(k, k + 3)}
    lines = [line for line in text.split("\n") if words_of(line)]
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    data, code = text.encode(), zstandard.ZstdCompressor(level=3, write_content_size=False)
    ratio = lambda x: len(code.compress(x)) / len(x)

    def side(x, slack):
        if len(x) < 200:
            return 0
        k = max(k for k, knot in enumerate(LIMITS.knots) if knot[0] <= len(x))
        if k + 1 == len(LIMITS.knots):
            low, high = LIMITS.knots[k][1:]
        else:
            (n, l0, h0), (m, l1, h1) = LIMITS.knots[k : k + 2]
            part = np.log(len(x) / n) / np.log(m / n)
            low, high = l0 + part * (l1 - l0), h0 + part * (h1 - h0)
        return -1 if ratio(x) < low - slack else 1 if ratio(x) > high + slack else 0

    chunks = [data[k : k + 2048] for k in range(0, len(data), 2048)]
    if len(chunks) > 1 and len(chunks[-1]) < 200:
        chunks[-2:] = [chunks[-2] + chunks[-1]]
    sides = [side(c, 0.01) for c in chunks] if len(chunks) > 1 else [side(data, 0)] * len(chunks)
    share = lambda s: sum(len(c) for c, x in zip(chunks, sides) if x == s)
    whole = side(data, 0)
    verdict = "repetitive" if whole < 0 or share(-1) > 0.2 * len(data) else "incompressible" if whole > 0 or share(1) > 0.2 * len(data) else "kept"
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeat),
        "base_failed": failed, "ratio": ratio(data) if data else None, "n_chunks": len(chunks), "n_low_chunks": sides.count(-1), "n_high_chunks": sides.count(1), "verdict": verdict, "kept": not failed and verdict == "kept",
    }


def prose(rng, n):
    stems = ["ba", "ther", "ing", "lo", "mun", "tar", "ex", "ved", "or", "sil", "que", "dan"]
    return " ".join("".join(rng.choice(stems, int(rng.integers(1, 4)))) + ("\n" if rng.random() < 0.02 else "") for _ in range(n))


def texts():
    rng = np.random.default_rng(3)
    noise = lambda n: " ".join(base64.b64encode(rng.bytes(6)).decode() for _ in range(n))
    out = [prose(rng, int(n)) for n in rng.integers(40, 3000, 25)] + [noise(60), noise(400), noise(2000)]
    out += [prose(rng, 600) + noise(300), prose(rng, 60) + " §ä#*$%&|<> \x0b\x1c\x85x", "line one is here\nline one is here\n\n \nline one is here"]
    return out + ["abc def ghi jkl " * 400, prose(rng, 330)[:2048] + "z" * 150, "x y z w " * 20] + EDGE


def test_quality_equals_plain_counts_and_ratios(spark):
    rows = texts()
    got = {r.doc_id: r.asDict() for r in quality_rules.quality(docs(spark, rows)).collect()}
    for i, t in enumerate(rows):
        want = plain(t)
        assert {k: got[i][k] for k in want if k != "ratio"} == {k: v for k, v in want.items() if k != "ratio"}, i
        assert got[i]["ratio"] == pytest.approx(want["ratio"])
    assert {"repetitive", "incompressible", "kept"} == {r["verdict"] for r in got.values()}


def test_bands_reject_what_the_base_rules_keep(spark):
    rng = np.random.default_rng(4)
    noise = " ".join(base64.b64encode(rng.bytes(6)).decode() for _ in range(60))
    few = " ".join(rng.choice([f"k{i}" for i in range(9)], 400))  # nine words in any order
    got = quality_rules.quality(docs(spark, [noise, few])).orderBy("doc_id").collect()
    assert [(r.verdict, r.kept) for r in got][0] == ("incompressible", False) and got[1].verdict == "repetitive"
    assert not got[0].base_failed


def test_quality_edges(spark):
    same = docs(spark, ["a b", "a b", None], [None, None, None])
    got = quality_rules.quality(same).collect()
    assert len(got) == 3 and all(r.doc_id is None and not r.kept for r in got)
    assert quality_rules.quality(same.limit(0)).count() == 0
