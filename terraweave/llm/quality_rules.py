"""Quality rules with compression bands.

A document passes when its zstandard ratio (compressed bytes / bytes) stays inside a band
that depends on the length: below the band the text is repetitive, above it the text is
incompressible noise. The whole text is measured, and each of its fixed chunks, the last,
shorter one included.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession

from terraweave.llm.common import table

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Bands by length in bytes, linear in its logarithm between the knots (bytes, low, high).

    The default limits lie just outside the ratios of the documents that the labels of the
    sf0.1 tables call good (3,243 documents that pass the base rules; none is rejected).
    Texts and chunks shorter than the first knot have no band; a last chunk that short is
    joined to the one before it. Chunks may leave the band by ``chunk_slack``. A document
    fails when more than ``bad_share`` of its bytes are in chunks that leave it.
    """

    knots: tuple[tuple[int, float, float], ...] = (
        (200, 0.550, 0.880), (300, 0.545, 0.800), (400, 0.536, 0.760), (600, 0.528, 0.720), (850, 0.508, 0.660), (1200, 0.488, 0.600), (2048, 0.460, 0.545),
        (3000, 0.448, 0.525), (4096, 0.440, 0.500), (8192, 0.420, 0.470), (16384, 0.400, 0.455), (32768, 0.390, 0.445), (131072, 0.370, 0.435),
    )
    chunk_bytes: int = 2048
    chunk_slack: float = 0.01
    bad_share: float = 0.2
    level: int = 3

    def band(self, size: int) -> tuple[float, float] | None:
        if size < self.knots[0][0]:
            return None
        sizes, lows, highs = zip(*self.knots, strict=True)
        at = np.log(sizes)
        return float(np.interp(math.log(size), at, lows)), float(np.interp(math.log(size), at, highs))

    def chunks(self, size: int) -> list[tuple[int, int]]:
        edges = [*range(0, size, self.chunk_bytes), size]
        if len(edges) > 2 and size - edges[-2] < self.knots[0][0]:
            del edges[-2]
        return list(zip(edges[:-1], edges[1:], strict=True)) if size else []


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, n_chunks int, n_low_chunks int, n_high_chunks int, verdict string, kept boolean"
)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, width):
        # renumbered at every step, so that keys of any number of words fit
        key = np.unique(key * len(code) + ids[k : n + k], return_inverse=True)[1] if k < width - 1 else key * len(code) + ids[k : n + k]
    found, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return int((np.cumsum(marks) > 0).sum())


def duplicate_lines(data: bytes) -> int:
    lines = [line for line in data.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def compression_verdict(data: bytes, compressor: zstandard.ZstdCompressor, limits: Limits) -> tuple[float | None, int, int, int, str]:
    """(whole ratio, chunks, repetitive chunks, incompressible chunks, verdict)."""

    def side(ratio: float, size: int, slack: float) -> int:
        band = limits.band(size)
        return 0 if band is None else -1 if ratio < band[0] - slack else 1 if ratio > band[1] + slack else 0

    ratio = len(compressor.compress(data)) / len(data) if data else None
    whole = side(ratio, len(data), 0.0) if data else 0
    chunks = limits.chunks(len(data))
    sides = [(side(len(compressor.compress(data[a:b])) / (b - a), b - a, limits.chunk_slack), b - a) for a, b in chunks] if len(chunks) > 1 else [(whole, len(data))] * len(chunks)
    low, high = sum(n for x, n in sides if x < 0), sum(n for x, n in sides if x > 0)
    verdict = "kept"
    if whole < 0 or low > limits.bad_share * len(data):
        verdict = "repetitive"
    elif whole > 0 or high > limits.bad_share * len(data):
        verdict = "incompressible"
    return ratio, len(chunks), sum(x < 0 for x, _ in sides), sum(x > 0 for x, _ in sides), verdict


def _scorer(limits: Limits, min_words: int, max_repeat_share: float):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressor = zstandard.ZstdCompressor(level=limits.level, write_content_size=False)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"], strict=True):
                data = text.encode() if isinstance(text, str) else b""
                words = data.split()  # bytes split at exactly 0x20 and 0x09-0x0D
                joined = b"".join(words)
                # code points: all bytes but the continuation bytes
                chars = len(joined.decode())
                symbols = len(data) - len(data.translate(None, SYMBOLS))
                repeats = repeated_words(words)
                failed = len(words) < min_words or 100 * repeats > 100 * max_repeat_share * len(words)
                ratio, chunks, low, high, verdict = compression_verdict(data, compressor, limits)
                rows.append((doc_id, len(words), chars, symbols, duplicate_lines(data), repeats, failed, ratio, chunks, low, high, verdict, not failed and verdict == "kept"))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64") if len(out) else out["doc_id"]
            yield out

    return score


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(), min_words: int = 50, max_repeat_share: float = 0.5) -> DataFrame:
    """One row per document with base counts, ratios, verdict and ``kept``.

    Null or empty text: zero counts, null ratio, no band (base rules fail it). Null ids
    stay null. Repeated rows give repeated results. Other columns are ignored. An empty
    table gives no rows.
    No shuffle: a document is judged on its own.
    """
    rows = docs.selectExpr(f"cast({id_col} as long) as doc_id", f"{text_col} as text")
    return rows.mapInPandas(_scorer(limits, min_words, max_repeat_share), SCHEMA)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
