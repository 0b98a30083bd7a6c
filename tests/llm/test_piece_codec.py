"""Prefix tables against the library itself: same ids and same texts, whole tables and awkward texts."""

import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
from edges import EDGE, docs
from sentencepiece import SentencePieceProcessor

from terraweave.llm import piece_codec

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def encoded(library, text):
    return [library.bos_id(), *library.encode(text), library.eos_id()]


def test_prefix_table_equals_library_on_random_texts(library):
    """Random joins of pieces, runs of spaces (equal scores, left to right), bytes outside the vocabulary."""
    codec, rng = piece_codec.PieceCodec(MODEL, limit=500), random.Random(3)  # a small cache is forgotten often
    pieces = list(codec.id_of)
    alphabets = ["ab ", "aeinst  ", "▁ a\n\t", "éñ日本語 \U0001f600aa", " ", "0123456789.,", "=-_/ ", "ⅷ\x00\r\n <s>unk|", "".join(chr(c) for c in range(32, 0x500))]
    for k in range(12000):
        if k % 3 == 0:
            text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))).replace("▁", " ")
        else:
            text = "".join(rng.choices(rng.choice(alphabets), k=rng.randint(0, 60)))
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == encoded(library, text), text
        assert codec.decode(ids) == library.decode(encoded(library, text))


def test_every_prefix_has_the_last_token_of_its_own_encoding(library):
    codec = piece_codec.PieceCodec(MODEL)
    text = "▁internationalisation▁▁▁▁of▁prefixes"
    for end in range(1, len(text) + 1):
        assert np.frombuffer(codec.encode_stretch(text[:end]), "<u4").tolist() == library.encode(text[1:end].replace("▁", " ")) or end == 1


def test_long_stretch_without_spaces_is_linear(library):
    text = "abcdefghijé" * 40000
    assert np.frombuffer(piece_codec.PieceCodec(MODEL).encode(text), "<u4").tolist() == encoded(library, text)


def test_query_digests_equal_library(spark, library):
    from terraweave.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    sha = lambda data: hashlib.sha256(data).hexdigest()
    got = sorted(map(tuple, QUERIES["op13_piece_codec"](spark, "/root/testdata/sf0.001").collect()))
    want = []
    for doc_id, text in rows:
        ids = encoded(library, text or "")
        want.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids).encode())))
    assert got == sorted(want) and len(got) == len(rows)


def test_edges_and_round_trip(spark, library):
    df = docs(spark, [*EDGE, "tail"], [None, *range(len(EDGE))])
    ids = piece_codec.encode(df, MODEL)
    rows = ids.collect()
    assert len(rows) == df.count() and rows[0].doc_id is None and rows[0].ids == [1, 2]
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    assert all(r.ids == encoded(library, texts[r.doc_id]) for r in rows)
    assert {r.doc_id: r.text for r in piece_codec.decode(ids, MODEL).collect()} == {i: library.decode(encoded(library, t)) for i, t in texts.items()}
    assert piece_codec.digests(df.limit(0), MODEL).count() == 0
    assert piece_codec.digests(df, MODEL).count() == df.count()
