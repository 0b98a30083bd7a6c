"""The corpus pipeline on a small corpus against a plain version of its stages."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_mixing import plain_passes
from test_simhash import plain_fingerprint, plain_groups
from test_substring import plain as plain_cut

import corpus_pipeline
from terraweave.llm import mixing, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = np.random.default_rng(31)
    rows = []
    for i in range(90):
        words = [f"w{chr(97 + x % 25)}{chr(97 + x // 25)}" for x in rng.integers(0, 500, int(rng.integers(60, 200)))]
        if i % 5 == 0:
            words[10:16] = ["vile", "nasty", "foul", "mean", "vile", "foul"]
        lines = [" ".join(words[k : k + 25]) for k in range(0, len(words), 25)]
        if i % 7 == 3:
            lines.insert(1, "this passage stands in many of the documents and only its first place is kept")
        rows.append((i, "\n".join(lines), "en", "hot" if i % 3 else f"s{i % 2}", 0))
    rows += [(100 + k, rows[k][1].upper() if k % 2 else rows[k][1], "en", "hot", 0) for k in (1, 2, 3, 4)]  # copies
    return rows + [(200, None, None, None, None), (201, "", "en", "s0", 0), (202, " \n", None, None, 0), (203, "long " * 3000 + "end", "en", "s1", 0)]


def tables(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("vile" in (t or ""))) for i, t, *_ in rows if i < 90]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_equals_plain_version(spark, tmp_path):
    rows = corpus()
    sf = tables(spark, tmp_path, rows)
    training = lambda i: zlib.crc32(str(i).encode()) % 3 != 1
    table = lambda n: spark.read.parquet(f"{sf}/{n}.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    model = toxicity.fit(table("documents"), table("labels"))
    score = lambda t: 1 / (1 + math.exp(-(model.a + model.b * float(toxicity.squash(toxicity.evidence_of(toxicity.tokens_of(t or ""), model)[0])))))
    clean = [r for r in rows if score(r[1]) < 0.7]
    kept = {r[0] for r in clean}
    assert any(not training(i) and "vile" in (t or "") and i not in kept for i, t, *_ in rows) and all("vile" in (t or "").lower() for i, t, *_ in rows if i not in kept)
    groups = plain_groups({r[0]: plain_fingerprint(r[1]) for r in clean})
    single = [r for r in clean if groups[r[0]] == r[0]]
    cut = plain_cut([(r[0], r[1]) for r in single])
    source = {r[0]: r[3] for r in single}
    tokens = collections.Counter()
    for i, t in cut.items():
        tokens[source[i]] += max(1, len((t or "").split()))
    passes = plain_passes(tokens, 0.97, 2.0)

    got = corpus_pipeline.run(spark, sf).collect()
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[r.row_id].append(r)
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reads = collections.Counter()
    for own in pieces.values():
        own.sort(key=lambda r: r.piece)
        doc = own[0].doc_id
        ids = np.array([*tokenizer.encode(cut[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids) and {r.doc_id for r in own} == {doc}
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
        reads[doc] += 1
    assert set(reads) == set(cut)  # clean documents stay
    read = collections.Counter()
    for doc, n in reads.items():
        read[source[doc]] += n * max(1, len((cut[doc] or "").split()))
    longest = {s: max(len((cut[i] or "").split()) for i in cut if source[i] == s) for s in tokens}
    for s, t in tokens.items():
        assert passes[s] * t - 1e-3 <= read[s] < passes[s] * t + max(1, longest[s]) + 1e-3
    filled = collections.defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(filled) == got[0].n_sequences and -(-sum(r.length for r in got) // 2048) <= got[0].lower_bound <= len(filled)


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    sf = tables(spark, tmp_path, corpus()[:40])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


@pytest.mark.parametrize("repeat", [2])
def test_repeated_rows(spark, repeat):
    one = spark.createDataFrame([(None, "same words in every row here", "en", None, 0)] * repeat, SCHEMA)
    assert mixing.mix(one).count() == repeat
    assert corpus_pipeline.drop_near_copies(spark, one, "").count() == 1
