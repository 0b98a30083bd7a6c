"""Language by compression against a plain version, on whole results."""

import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from terraweave.llm import language_id

SCHEMA = "doc_id long, text string, lang string"
STEMS = {"aa": "ba be bi bo bu".split(), "bb": "xti xto xta xte kra".split(), "cc": "bai xti lom".split()}


def corpus(n=240):
    rng = np.random.default_rng(8)
    text = lambda g: " ".join("".join(rng.choice(STEMS[g], 3)) for _ in range(int(rng.integers(5, 90))))
    return [(i, text(g), g) for i in range(n) for g in [list(STEMS)[i % 3]]]


def plain_code(text):
    return " ".join(re.findall(r"[^\W\d_]+", text.lower())).encode()


def test_languages_equal_plain_version(spark):
    rows = corpus() + [(900, None, "aa"), (901, "123 !!", None), (902, "", "bb"), (903, "xtixto " * 20000, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("margin", F.lit("clash"))
    training = F.col("doc_id") % 4 != 1
    dictionaries = language_id.build_dictionaries(df.where(training), dict_bytes=3000, doc_chars=100)
    assert set(dictionaries) == set(STEMS) and all(0 < len(d) <= 3000 for d in dictionaries.values())
    learnt = {g: [plain_code(t) for i, t, lang in rows if lang == g and i % 4 != 1 and t] for g in STEMS}
    for g, content in dictionaries.items():  # passages of the language's own training texts, nothing else
        assert all(any(w in t for t in learnt[g]) for w in content.split()[1:-1])
    sizes = {}
    for g, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=3)
        code = zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_dict_id=False)
        for i, t, _ in rows:
            x = plain_code(t or "")
            sizes.setdefault(i, []).append((sum(len(code.compress(x[k : k + 1024])) for k in range(0, len(x), 1024)), g))
    got = {r.doc_id: r for r in language_id.identify(df, dictionaries).collect()}
    for i, t, _ in rows:
        best, second = sorted(sizes[i])[:2]
        if not re.search(r"[^\W\d_]", t or ""):
            assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
            continue
        margin = (second[0] - best[0]) / second[0]
        assert (got[i].lang_pred, got[i].rejected) == (best[1], margin < 0.02) and got[i].score == pytest.approx(margin / (margin + 0.02))
    assert np.mean([got[i].lang_pred == g for i, _, g in corpus() if i % 4 == 1]) > 0.9  # cc shares the stems of the others


def test_thinning_takes_the_same_passages(spark):
    """A language with many texts is thinned by a bound on the hash; the passages are those of the smallest hashes."""
    rng = np.random.default_rng(5)
    rows = [(i, "t" + "".join(rng.choice(list("abcdefgh"), 30)), "aa") for i in range(3000)] + [(i, "the hot copy of all", "aa") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = language_id.build_dictionaries(df, dict_bytes=2000, doc_chars=100)["aa"]
    place = F.shiftrightunsigned(F.xxhash64("text"), 1)
    want = [r.text for r in df.select("text", place.alias("p")).distinct().orderBy("p").limit(40).collect()]
    assert got == b" ".join(language_id.letters_only(t) for t in want)[:2000]


def test_language_edges(spark):
    rows = [(None, "ba be bi " * 30, "bb"), (None, "ba be bi " * 30, "bb"), (1, "12 34", "aa"), (2, "ba bo", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = language_id.build_dictionaries(df)
    assert list(found) == ["bb"]  # a language without a letter can't win
    got = language_id.identify(df, found).collect()
    assert len(got) == 4 and {r.lang_pred for r in got if r.doc_id is None} == {"bb"}
    assert {r.lang_pred for r in language_id.train_and_identify(df, F.lit(False)).collect()} == {"und"}
    assert language_id.train_and_identify(df.limit(0), F.lit(True)).count() == 0


def test_symbols_that_are_no_letters(spark):
    """Raised digits, fractions, numerals and circled digits are word characters, but no letters."""
    df = spark.createDataFrame([(1, "²² ½ ⅷ ①", "aa"), (2, "ba be bi bo " * 30, "aa"), (3, "xti xto xta " * 30, "bb"), (4, "ⅷ xti ② xto xta " * 20, None)], SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, language_id.build_dictionaries(df.where("doc_id > 1"))).collect()}
    assert got[1] == ("und", 0.0) and got[4][0] == "bb"
