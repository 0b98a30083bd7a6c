"""Corpus pipeline: toxicity, near-dedup, substring dedup, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before
it kept. All but the last return the columns of ``documents``; other columns of the input,
whatever their names, are left out. An empty table gives an empty one in every stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.llm import mixing, packing, simhash_dedup, substring_dedup, toxicity
from terraweave.llm.common import id_remainder, materialise, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is predicted go; the model is fitted as in op5.

    Null, empty and wordless texts have no evidence and stay, null ids are scored like any
    other, repeated rows all stay or all go. Without labels of both classes nothing goes.
    """
    training = ~F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs.where(training), table(spark, sf_dir, "labels").where(training))
    return toxicity.drop_toxic(docs, model).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group stays: that of the smallest (id, text hash), null ids last.

    Repeated rows are one group, and so are all null and wordless texts.
    """
    return simhash_dedup.keep_one(docs).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut from all but the first document that has them; no row goes.

    Null texts stay null and n_chars is null with them; null ids rank first; repeated rows
    get the same result.
    """
    cut = substring_dedup.dedup_substrings(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated to their target weights; no document is left out.

    A null source is one of its own; a null or empty text counts as one token. Rows that
    are read several times differ in nothing here; the packed pieces tell them apart.
    """
    return mixing.mix(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences; a null or empty text is one end token.

    row_id tells the readings of a repeated document apart.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("bin_completion", pack_sequences),
]

#: No stage but substring dedup can be written in SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""

    def step(docs: DataFrame, stage: tuple) -> DataFrame:
        name, function = stage
        out = function(spark, docs, sf_dir)
        return out if name == STAGES[-1][0] else materialise(out, f"stage-{name}")

    return functools.reduce(step, STAGES, table(spark, sf_dir, "documents"))
