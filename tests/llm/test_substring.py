"""Substring dedup against a plain version, on whole results."""

import re

import numpy as np
from edges import EDGE, docs

from terraweave.llm import substring_dedup


def plain_units(text):
    """(start, text, normal form) of paragraphs, lines and parts of lines."""
    out = []
    for p in re.finditer(r"[^\n]+(?:\n[^\n]+)*", text):
        out.append((p.start(), p.group()))
        for line in re.finditer(r"[^\n]+", p.group()):
            at = p.start() + line.start()
            out.append((at, line.group()))
            out += [(at + m.start(), m.group()) for m in re.finditer(r"[^.!?]+[.!?]*", line.group())]
    lower = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)
    normal = lambda x: "\n".join(" ".join(w for w in re.split(r"[\x20\x09\x0b-\x0d]+", line) if w) for line in lower(x).split("\n"))
    return [(at, x, normal(x)) for at, x in out if len(re.split(r"[ \n]", normal(x))) >= 4]


def plain(rows):
    first, removed = {}, {i: set() for i, _ in rows}
    for i, t in sorted(rows):
        for at, x, normal in sorted(plain_units(t or "")):
            if first.setdefault(normal, (i, at)) != (i, at):
                removed[i].update(range(at, at + len(x)))
    return {i: None if t is None else "".join(c for k, c in enumerate(t) if k not in removed[i]) for i, t in rows}


def corpus():
    rng = np.random.default_rng(9)
    parts = [" ".join(rng.choice("la mo Ti re So fa do ut".split(), int(rng.integers(2, 9)))) + str(rng.choice([".", "!", "?!", ""])) for _ in range(40)]
    lines = ["".join(f"{rng.choice(parts)}{' ' * int(rng.integers(0, 3))}" for _ in range(int(rng.integers(1, 4)))) for _ in range(25)]
    lines += ["", "", " ", "...", "ONE.!! TWO! THREE.!! FOUR! FIVE.", "  Indented la mo ti re. "]
    return ["\n".join(rng.choice(lines, int(rng.integers(1, 9)))) for _ in range(60)]


def test_substring_dedup_equals_plain_version(spark):
    rows = list(enumerate(corpus() + EDGE))
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(docs(spark, [t for _, t in rows])).collect()}
    assert {i: r.text for i, r in got.items()} == plain(rows)
    for i, t in rows:
        spans = got[i].removed
        cut = {k for s in spans for k in range(s.start, s.start + s.length)}
        assert got[i].text == (t and "".join(c for k, c in enumerate(t) if k not in cut)) or t == ""
        assert all(a.start + a.length <= b.start for a, b in zip(spans, spans[1:]))


def test_passage_of_short_pieces_is_found(spark):
    passage = " ".join(f"ER{'ABCDEFGHIJ'[i % 10]}{'KLMNO'[i // 10]}.!!" for i in range(50))
    got = substring_dedup.dedup_substrings(docs(spark, [f"Own start of one.\n{passage}\nend", f"Another start here now.\n{passage.lower()}\nOwn end."])).orderBy("doc_id").collect()
    assert passage in got[0].text and got[1].text == "Another start here now.\n\nOwn end."


def test_substring_edges(spark):
    text = "the very same text here"
    same = docs(spark, [text, text, text, None, "Too short. Too short."], [3, 3, None, None, 5])
    got = substring_dedup.dedup_substrings(same).collect()
    assert len(got) == 5 and sorted((r.text for r in got if r.doc_id == 3)) == ["", ""]  # the null id ranks first
    assert [r.text for r in got if r.doc_id == 5] == ["Too short. Too short."] and all(r.score == "clash" for r in got)
    assert {r.text for r in got if r.doc_id is None} == {text, None}
    twice = substring_dedup.dedup_substrings(docs(spark, [text, text], [1, 1])).collect()
    assert [r.text for r in twice] == [text, text]  # rows that repeat are one document
    clash = same.withColumnRenamed("score", "removed")
    assert substring_dedup.dedup_substrings(clash).columns == clash.columns
    assert substring_dedup.dedup_substrings(same.limit(0)).count() == 0


def test_many_spans_in_one_text(spark):
    """100,000 removed spans cost one pass over the text."""
    line = "the very same line is here"
    many = "\n".join(f"{line}\nown {k}" for k in range(100_000))
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(docs(spark, [line, many], [1, 2])).collect()}
    assert got[1].text == line and len(got[2].removed) == 100_000
    assert got[2].text == "\n".join(f"\nown {k}" for k in range(100_000))
