"""Language identification by compression.

For each language a raw-content zstandard dictionary is built from labelled text. A text
is encoded with every dictionary, in fixed chunks so that the dictionary matters
throughout long texts, and the language of the smallest total wins. A narrow margin over
the second best rejects the verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraweave.llm.common import id_remainder, table

UNDETERMINED = "und"
SCHEMA = "doc_id long, lang_pred string, score double, margin double, rejected boolean"
_LETTER = regex.compile(r"\p{L}")  # of Unicode's letter classes; digits in circles or raised, fractions and numerals are none
_OTHER = regex.compile(r"\P{L}+")


def letters_only(text: str) -> bytes:
    """Lower case, every run of other characters than letters as one space."""
    return _OTHER.sub(" ", text.lower()).strip().encode()


def build_dictionaries(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", dict_bytes: int = 131072, doc_chars: int = 1024, max_languages: int = 512) -> dict[str, bytes]:
    """Raw-content dictionaries, at most ``dict_bytes`` for each language.

    The labelled sample is bounded: per language enough passages of ``doc_chars``
    characters, one for each of the texts with the smallest hashes and at a place in the
    text that the hash gives, so the choice does not depend on order or partitioning and
    repeated texts count once. Passages are cut, and those of a language with many texts
    thinned to a few times the number wanted by a bound on the hash, before they are
    ranked, so what reaches one task does not grow with the input. ``max_languages``
    bounds what reaches the driver (more raises an error). Rows with a null text or
    language are not used, nor is a language without a letter in its passages. No rows: no
    dictionaries.
    """
    wanted = max(1, 2 * dict_bytes // doc_chars)  # short texts fill less
    rows = labelled.where(F.col(lang_col).isNotNull() & (F.length(F.trim(F.col(text_col))) > 0)).select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    kinds = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(max_languages + 1).collect()
    if len(kinds) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    # four times as many as wanted are expected below the bound; small languages have none
    bounds = labelled.sparkSession.createDataFrame([(r["lang"], (1 << 63) - 1 if r["n"] <= 8 * wanted else int(4 * wanted / r["n"] * 2**63)) for r in kinds], "lang string, bound long")
    place = F.shiftrightunsigned("h", 1)
    start = F.pmod("h", F.greatest(F.lit(1), F.length("text") - doc_chars + 1)).cast("int") + 1
    passages = rows.join(F.broadcast(bounds), "lang").where(place <= F.col("bound")).select("lang", "h", F.substring("text", start, F.lit(doc_chars)).alias("piece")).dropDuplicates(["lang", "h"])
    ranked = passages.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(place, "h"))).where(F.col("n") <= wanted)
    chosen = ranked.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("pieces")).collect()
    found = {r["lang"]: b" ".join(filter(None, dict.fromkeys(letters_only(p["piece"]) for p in r["pieces"])))[:dict_bytes] for r in sorted(chosen, key=lambda r: r["lang"])}
    return {lang: content for lang, content in found.items() if content}


def _predictor(dictionaries: dict[str, bytes], chunk_bytes: int, level: int, min_margin: float):
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coders = {}
        for lang, content in dictionaries.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            coders[lang] = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"], strict=True):
                if not coders or not isinstance(text, str) or not _LETTER.search(text):
                    rows.append((doc_id, UNDETERMINED, 0.0, None, True))
                    continue
                data = letters_only(text)
                chunks = [data[i : i + chunk_bytes] for i in range(0, len(data), chunk_bytes)]
                sizes = sorted((sum(len(c.compress(x)) for x in chunks), lang) for lang, c in coders.items())
                best = sizes[0]
                margin = 1.0 if len(sizes) == 1 else (sizes[1][0] - best[0]) / sizes[1][0]
                rows.append((doc_id, best[1], margin / (margin + min_margin), margin, margin < min_margin))
            out = pd.DataFrame(rows, columns=["doc_id", "lang_pred", "score", "margin", "rejected"])
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64") if len(out) else out["doc_id"]
            yield out

    return predict


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 1024, level: int = 3, min_margin: float = 0.02) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) for every document, whole texts.

    margin: how much larger the second smallest encoding is, as a share; score rises with
    it from 0 to 1 and is 0.5 at ``min_margin``; rejected: margin below that. Equal sizes
    go to the first language by name. Null text, a text without a letter, or no
    dictionary at all: ``und``, score 0, rejected. Null ids stay null, repeated rows give
    repeated results, an empty table none.
    The dictionaries (bounded when built) travel with the task.
    """
    rows = docs.selectExpr(f"cast({id_col} as long) as doc_id", f"{text_col} as text")
    return rows.mapInPandas(_predictor(dictionaries, chunk_bytes, level, min_margin), SCHEMA)


def train_and_identify(docs: DataFrame, is_training: Column, **options) -> DataFrame:
    return identify(docs, build_dictionaries(docs.where(is_training)), **options)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    found = train_and_identify(docs, ~held_out)
    return found.withColumn("held_out", held_out)
