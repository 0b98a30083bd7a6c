"""SentencePiece encoding and decoding of whole texts by a table of prefixes.

Every prefix of a text has one encoding by merges, and that encoding has one last token.
The table stores it for each prefix: an automaton finds the pieces that end there, and
the one that belongs to the encoding is the one that may follow the last token of the
prefix before it. Two tokens may follow each other if, while both grow by their merges, no merge
across their border is ever due first. The ids are then read off backwards. Time and
memory are linear in the text; no merge queue is kept.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.llm.common import table

SPACE = "▁"
NEVER = float("inf")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    """Encoder and decoder of one merge-type model with identity normalisation and byte fallback."""

    def __init__(self, model: str, limit: int = 400_000):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        spec = ModelProto()
        with open(model, "rb") as file:
            spec.ParseFromString(file.read())
        plain, byte, user = 1, 6, 4  # fixed values: kinds of pieces in the model's format
        normal = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback or normal.precompiled_charsmap or normal.remove_extra_whitespaces or any(p.type == user for p in spec.pieces):
            raise ValueError(f"{model} isn't a merge-type model with identity normalisation and byte fallback")
        self.prefixed = normal.add_dummy_prefix
        self.processor = SentencePieceProcessor(model_file=model)
        self.begin, self.end = self.processor.bos_id(), self.processor.eos_id()
        self.id_of = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == plain}
        word = lambda i: int(i).to_bytes(4, "little")
        self.word_of = {piece: word(i) for piece, i in self.id_of.items()}
        self.bytes_of = [word(self.processor.piece_to_id(f"<0x{b:02X}>")) for b in range(256)]
        assert sum(p.type == byte for p in spec.pieces) == 256
        #: when a piece is made by merging: the higher its score the sooner, equal scores from left to right
        self.due = {piece: -spec.pieces[i].score for piece, i in self.id_of.items() if len(piece) > 1}
        self.automaton = ahocorasick.Automaton()
        for piece in self.id_of:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        # where no piece reaches across, a text falls into stretches that are encoded alone
        cut_spaces = all(SPACE not in piece.lstrip(SPACE) for piece in self.id_of)
        cut_lines = all("\n" not in piece for piece in self.due)
        marks = (SPACE if cut_spaces else "") + ("\n" if cut_lines else "")
        self.stretches = re.compile((f"{SPACE}+[^{marks}]*|" if cut_spaces else "") + ("\n+|" if cut_lines else "") + (f"[^{marks}]+" if marks else ".+"), re.DOTALL).findall
        self.edges = functools.cache(self._edges)  # at most the vocabulary
        self.may_follow = functools.lru_cache(limit)(lambda left, right: bool(self.edges(right)) and (left is None or self._border(left, right) is None))
        self.cached = _Cache(self.encode_stretch, limit)

    def _border(self, left: str, right: str) -> tuple[str, str] | None:
        """What is merged across the border of two growing tokens; None if they stay apart."""
        a, b = iter(self.edges(left)[1]), iter(self.edges(right)[0])
        (x, x_ends), (y, y_ends) = next(a), next(b)
        while True:
            due = self.due.get(x + y, NEVER)
            if due < x_ends and due <= y_ends and due < NEVER:
                return x, y
            if x_ends == y_ends == NEVER:
                return None
            if x_ends <= y_ends:  # of equal scores the left one is merged first
                x, x_ends = next(a)
            else:
                y, y_ends = next(b)

    def _edges(self, piece: str) -> tuple[list, list] | None:
        """(token, when it is merged on) at the left and the right edge of a growing piece; None if merges never make it."""
        if len(piece) == 1:
            return [(piece, NEVER)], [(piece, NEVER)]
        for k in range(1, len(piece)):
            left, right = piece[:k], piece[k:]
            if all(x in self.id_of and self.edges(x) for x in (left, right)) and self._border(left, right) == (left, right):
                due, whole = self.due[piece], (piece, NEVER)
                return [*self.edges(left)[0][:-1], (left, due), whole], [*self.edges(right)[1][:-1], (right, due), whole]
        return None

    def encode_stretch(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian 32-bit words, nothing added before it."""
        last: list[str | None] = [None] * len(text)
        may_follow = self.may_follow
        for end, piece in self.automaton.iter(text):
            if last[end] is None:
                before = end - len(piece)
                # a character outside the vocabulary has no entry and is never merged
                if may_follow(last[before] if before >= 0 else None, piece):
                    last[end] = piece
        words, end = [], len(text) - 1
        while end >= 0:
            piece = last[end]
            if piece is None:
                words.extend(self.bytes_of[b] for b in reversed(text[end].encode()))
                end -= 1
            else:
                words.append(self.word_of[piece])
                end -= len(piece)
        return b"".join(reversed(words))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text with begin and end ids, as little-endian 32-bit words."""
        spaced = text.replace(" ", SPACE)
        if self.prefixed and text:
            spaced = SPACE + spaced
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        return b"".join([begin, *map(self.cached.__getitem__, self.stretches(spaced)), end])

    def decode(self, ids: bytes) -> str:
        return self.processor.decode(np.frombuffer(ids, "<u4").tolist())


class _Cache(dict):
    """Values of ``function``, forgotten when there are ``limit``; long keys aren't kept."""

    def __init__(self, function, limit: int):
        self.function, self.limit = function, limit

    def __missing__(self, key: str) -> bytes:
        value = self.function(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


@functools.cache
def codec(model: str) -> PieceCodec:
    """One codec a Python worker."""
    return PieceCodec(model)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids of every whole text with begin and end ids, as an array.

    One row a row of ``docs``, in tasks that share nothing. Null and empty texts have the
    begin and end id only; null ids stay null, repeated rows repeat. A very long text is
    cut where no piece reaches across, so only a long stretch without a space holds a table of its own. Other
    columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.frombuffer(codec(model).encode(text.as_py() or ""), "<i4")
                yield pa.record_batch({"doc_id": pa.array([doc_id.as_py()], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int32()))})

    return _slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"], batch["ids"], strict=True):
                text = codec(model).processor.decode(ids.as_py() or [])
                yield pa.record_batch({"doc_id": pa.array([doc_id.as_py()], pa.int64()), "text": pa.array([text], pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; cases as in ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch["text"]:  # one text at a time is held with its ids
                ids = codec(model).encode(text.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(sha(ids))
                text_sha.append(sha(codec(model).decode(ids).encode()))
            yield pa.record_batch({"doc_id": batch["doc_id"], "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())})

    return _slim(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def op13_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
