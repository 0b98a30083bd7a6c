"""Substring dedup by hashing units of text.

Texts are cut into paragraphs (no blank line inside), lines, and the sentence-like parts
of lines. Units are normalised (ASCII lower case, white space collapsed) and digested to
128 bits. Digests are grouped globally; the occurrence that ranks first (smallest id,
then position) stays, all others are removed from their documents, with their original
offsets kept. The first occurrence of a unit never goes with a larger one, for then that
larger one had an earlier occurrence too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.llm.common import ASCII_LOWER, ASCII_UPPER, materialise, table

#: Parts of a line: a run without sentence marks, with the marks that close it.
PART = re.compile(r"[^.!?]+[.!?]*")
_BLANK = re.compile(r"\n\n+")
_SPACE = re.compile(r"[\x20\x09\x0B-\x0D]+")
_BREAK = re.compile(r" ?\n ?")
_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)
UNIT_SCHEMA = "doc_id long, text_hash long, start int, length int, d1 long, d2 long"


def units_of(text: str, min_words: int) -> Iterator[tuple[int, int, str]]:
    """(start, length, normalised text) of the units with at least ``min_words`` words.

    A line that is its whole paragraph, and a part that is its whole line, are given once.
    """
    text = text.translate(_LOWER)
    at = 0
    for paragraph in _paragraphs(text):
        at = text.index(paragraph, at) if paragraph else at
        lines = paragraph.split("\n")
        if len(lines) > 1:
            normal = _BREAK.sub("\n", _SPACE.sub(" ", paragraph)).strip(" ")
            if normal.count(" ") + normal.count("\n") + 1 >= min_words:
                yield at, len(paragraph), normal
        for line in lines:
            normal = _SPACE.sub(" ", line).strip(" ")
            if normal.count(" ") + 1 >= min_words:  # else no part has so many words
                yield at, len(line), normal
                for m in PART.finditer(line):
                    if m.end() - m.start() < len(line):
                        normal = _SPACE.sub(" ", m.group()).strip(" ")
                        if normal.count(" ") + 1 >= min_words:
                            yield at + m.start(), m.end() - m.start(), normal
            at += len(line) + 1
        at -= 1


def _paragraphs(text: str) -> list[str]:
    return [p for p in _BLANK.split(text.strip("\n"))] if text.strip("\n") else []


def _digester(min_words: int):
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at, starts, lengths, digests = [], [], [], []
            for row, text in enumerate(pdf["text"]):
                if not isinstance(text, str):
                    continue
                for start, length, normal in units_of(text, min_words):
                    at.append(row)
                    starts.append(start)
                    lengths.append(length)
                    digests.append(xxhash.xxh128_digest(normal.encode()))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            rows = pdf.iloc[at]
            yield pd.DataFrame(
                {"doc_id": pd.array(rows["doc_id"].array, dtype="Int64"), "text_hash": rows["text_hash"].to_numpy(), "start": np.array(starts, np.int32), "length": np.array(lengths, np.int32), "d1": halves[:, 0], "d2": halves[:, 1]}
            )

    return digest


def cut_spans(text: str, starts: np.ndarray, lengths: np.ndarray) -> tuple[str, list[dict]]:
    """``text`` without the spans, and the outermost of them; spans are sorted by start, the longest first. One pass."""
    kept, removed, at = [], [], 0
    for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
        if start >= at or not removed:  # else it lies inside the one that went before
            kept.append(text[at:start])
            removed.append({"start": start, "length": length})
            at = start + length
    return "".join([*kept, text[at:]]), removed


def _cutter():
    @F.pandas_udf("text string, removed array<struct<start:int,length:int>>")
    def cut(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
        rows = [cut_spans(t, s, n) if isinstance(t, str) else (None, None) for t, s, n in zip(texts, starts, lengths, strict=True)]
        return pd.DataFrame(rows, columns=["text", "removed"])

    return cut


def find_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 4) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInPandas(_digester(min_words), UNIT_SCHEMA)


def repeated_units(units: DataFrame) -> DataFrame:
    """The occurrences to remove: all but the first of every digest.

    Digests are counted with map-side combination, so a unit that a third of all rows
    share costs one row a task; the join back is on the digest, where skewed partitions
    can be split. Rows that repeat (doc_id, text) are one document.
    """
    place = F.struct("doc_id", "text_hash", "start")
    first = units.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    return units.join(first, ["d1", "d2"]).where(~place.eqNullSafe(F.col("first"))).select("doc_id", "text_hash", "start", "length")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 4) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``, and column ``removed``.

    removed: array of structs (start, length), offsets in code points of the original
    text, in order and apart from each other; empty where nothing went. Units of fewer than ``min_words`` words stay.
    Null text stays null. Null ids rank first. Rows repeating (id, text) are one document
    and all get the same result. Other columns are kept as they are, but for ``removed``,
    which is replaced. An empty table gives no rows.
    """
    units = materialise(find_units(docs, id_col, text_col, min_words), "units")
    # larger units first; what lies inside one that went is passed over
    spans = repeated_units(units).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", (-F.col("length")).alias("size")))).alias("_spans"))
    keyed = docs.withColumn("_key", F.col(id_col).cast("long")).withColumn("_hash", F.xxhash64(text_col))
    joined = keyed.join(spans.select(F.col("doc_id").alias("_sid"), F.col("text_hash").alias("_shash"), "_spans"), F.col("_key").eqNullSafe(F.col("_sid")) & (F.col("_hash") == F.col("_shash")), "left")
    text, has = F.col(text_col), F.col("_spans").isNotNull()
    # only texts that lose something go to Python
    done = joined.withColumn("_cut", _cutter()(F.when(has, text), F.transform("_spans", lambda s: s["start"]), F.transform("_spans", lambda s: -s["size"])))
    removed = F.coalesce("_cut.removed", F.expr("cast(array() as array<struct<start:int,length:int>>)"))
    cut = F.when(has, F.col("_cut.text")).otherwise(text)
    columns = [cut.alias(c) if c == text_col else F.col(c) for c in docs.columns if c != "removed"]
    return done.select(*columns, removed.alias("removed"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.size("removed").cast("bigint").alias("n_removed"), F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["length"])), ",").alias("removed"))


ORACLE = r"""
WITH piece AS (
  SELECT doc_id, i, piece, piece = chr(10) AS nl, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) - length(piece) AS start
  FROM (SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS piece
        FROM (SELECT doc_id, regexp_extract_all(text, '[^\n.!?]+[.!?]*|[.!?]+|\n') AS p FROM documents))
), placed AS (
  SELECT *, nl AND NOT coalesce(lag(nl) OVER d, true) AND NOT coalesce(lead(nl) OVER d, true) AS inner_nl, sum(CAST(nl AS INT)) OVER d AS line
  FROM piece WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), b AS (
  SELECT *, sum(CAST(nl AND NOT inner_nl AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS para FROM placed
), unit AS (
  SELECT doc_id, 1 AS level, para AS number, min(start) AS start, string_agg(piece, '' ORDER BY i) AS body FROM b WHERE inner_nl OR NOT nl GROUP BY doc_id, para
  UNION ALL SELECT doc_id, 2, line, min(start), string_agg(piece, '' ORDER BY i) FROM b WHERE NOT nl GROUP BY doc_id, line
  UNION ALL SELECT doc_id, 3, i, start, piece FROM b WHERE regexp_matches(piece, '^[^\n.!?]')
), n AS (
  SELECT *, trim(regexp_replace(regexp_replace(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), ' ') AS normal FROM unit
), r AS (
  SELECT *, rank() OVER (PARTITION BY normal ORDER BY doc_id, start) > 1 AND length(normal) - length(replace(replace(normal, ' ', ''), chr(10), '')) >= 3 AS gone FROM n
), m AS (
  SELECT b.*, coalesce(p.gone, false) AS p_gone, coalesce(l.gone, false) AS l_gone, coalesce(s.gone, false) AS s_gone,
         p.start AS p_start, length(p.body) AS p_length, l.start AS l_start, length(l.body) AS l_length
  FROM b LEFT JOIN r p ON p.level = 1 AND p.doc_id = b.doc_id AND p.number = b.para AND (b.inner_nl OR NOT b.nl)
         LEFT JOIN r l ON l.level = 2 AND l.doc_id = b.doc_id AND l.number = b.line AND NOT b.nl
         LEFT JOIN r s ON s.level = 3 AND s.doc_id = b.doc_id AND s.number = b.i
), spans AS (
  SELECT DISTINCT doc_id, CASE WHEN p_gone THEN p_start WHEN l_gone THEN l_start ELSE start END AS start,
         CASE WHEN p_gone THEN p_length WHEN l_gone THEN l_length ELSE length(piece) END AS length
  FROM m WHERE p_gone OR l_gone OR s_gone
), s AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(start AS VARCHAR) || ':' || CAST(length AS VARCHAR), ',' ORDER BY start) AS removed FROM spans GROUP BY doc_id
), t AS (
  SELECT doc_id, string_agg(piece, '' ORDER BY i) FILTER (WHERE NOT (p_gone OR l_gone OR s_gone)) AS text FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(t.text, CASE WHEN d.text IS NOT NULL THEN '' END) AS text, coalesce(s.n, 0) AS n_removed, coalesce(s.removed, '') AS removed
FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id
"""
