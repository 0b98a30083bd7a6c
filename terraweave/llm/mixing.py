"""Mixing sources to target weights, in DataFrame functions only.

Temperature mixing: the weight of a source is share**alpha / sum share**alpha, where
share is its part of all tokens. Alpha is bisected in [0, 1] to meet a target entropy and
a repetition limit. The weights are then realised under a token budget: every source is
read in whole passes and a part of a last pass, and each pass is its own permutation of
hash blocks and of the documents inside the blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraweave.llm.common import materialise, table


def word_count(text: Column) -> Column:
    """Tokens of a text, counted as words; at least one, so that every row has a cost."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")), " ")
    return F.greatest(F.lit(1), F.size(words)).cast("long")


def _bisect(measure, wanted: float, steps: int, levels: int = 1) -> float:
    """Smallest alpha in [0, 1] where ``measure`` (falling in alpha) is at most ``wanted``.

    ``measure`` takes a list of alphas, so that ``levels`` halvings cost one evaluation.
    """
    low, high = 0.0, 1.0
    for _ in range(-(-steps // levels)):
        points = [low + (high - low) * i / 2**levels for i in range(1, 2**levels)]
        values = measure(points)
        below = [p for p, v in zip(points, values, strict=True) if v is not None and v <= wanted]
        above = [p for p, v in zip(points, values, strict=True) if v is None or v > wanted]
        low, high = max([low, *above]), min([high, *below])
    return high


def source_weights(totals: DataFrame, target_entropy: float | None = 0.97, max_repetition: float | None = 2.0, steps: int = 32) -> tuple[DataFrame, float]:
    """(source, tokens, share, weight, passes) and alpha, from (source, tokens).

    target_entropy: wanted entropy of the weights as a part of its maximum ln(sources);
    alpha is the smallest that brings it down to that (0 where even equal weights don't
    exceed it). max_repetition: limit on the passes over any source when the source with
    the fewest passes is read once; it can only raise alpha. passes: weight / share,
    scaled so that the smallest is one pass, so no source is cut. ``totals`` is read
    several times. No sources: no rows.
    """
    whole = totals.agg(F.sum("tokens").alias("all"), F.count("*").alias("n"), F.min("tokens").alias("least"), F.max("tokens").alias("most")).first()
    if not whole["n"]:
        return totals.select("source", "tokens", *[F.lit(None).cast("double").alias(c) for c in ("share", "weight", "passes")]), 1.0
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(whole["all"])))
    log_share = F.log("share")

    def entropies(alphas: list[float]) -> list[float]:
        """Of the weights at every alpha, as parts of the maximum: one aggregate over the sources."""
        sums = [f(a) for a in alphas for f in (lambda a: F.sum(F.exp(a * log_share)), lambda a: F.sum(F.exp(a * log_share) * log_share))]
        row = shares.agg(*[x.alias(f"x{i}") for i, x in enumerate(sums)]).first()
        return [(math.log(row[2 * i]) - a * row[2 * i + 1] / row[2 * i]) / math.log(whole["n"]) for i, a in enumerate(alphas)]

    alpha = 0.0
    if target_entropy is not None and whole["n"] > 1:
        alpha = _bisect(entropies, target_entropy, steps, 6)
    if max_repetition is not None:
        # passes of a source are proportional to share ** (alpha - 1)
        widest = whole["most"] / whole["least"]
        alpha = max(alpha, _bisect(lambda alphas: [widest ** (1 - a) for a in alphas], max_repetition, steps))
    z = shares.agg(F.sum(F.exp(alpha * log_share)).alias("z")).first()["z"]
    most = float(whole["most"]) / float(whole["all"])
    return shares.withColumn("weight", F.exp(alpha * log_share) / F.lit(z)).withColumn("passes", F.exp((alpha - 1) * (log_share - F.log(F.lit(most))))), alpha


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", target_entropy: float | None = 0.97, max_repetition: float | None = 2.0, budget: float | None = None, seed: int = 17, rows_a_block: int = 65_536) -> DataFrame:
    """``docs`` repeated to the mixture, with mix_source, mix_tokens, mix_pass, mix_block, mix_rank.

    budget: tokens of the mixture; null: as many as give the most plentiful source one
    whole pass. A source is read floor(passes) times, then the documents of a last pass
    in permuted order while their tokens before them are within the remaining budget, so
    a source overruns its budget by less than one document (of any length), and the
    mixture by less than the longest document of every source together.
    mix_block and mix_rank give the order: passes, then permuted blocks, then documents
    inside the block. Blocks are hash buckets, one for every ``rows_a_block`` rows of the
    table, so a source that holds a third of all rows is spread over a third as many.
    A null source is a source of its own. Null ids and texts are fine. Repeated rows stay
    repeated: rows alike in id and text are read the same number of times, but in the pass
    that the budget cuts, which takes all of them or none. Clashing mix_* columns are
    replaced. Empty table: no rows.
    """
    columns = [c for c in docs.columns if c not in ("mix_source", "mix_tokens", "mix_pass", "mix_block", "mix_rank")]
    rows = docs.select(*columns).withColumn("mix_source", F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))).withColumn("mix_tokens", word_count(F.col(text_col)))
    slim = rows.select(F.col("mix_source").alias("source"), F.col("mix_tokens").alias("tokens"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"))
    # the last pass is settled on (source, key) alone, without texts
    slim = materialise(slim, "mix-keys")
    blocks = max(1, -(-slim.count() // rows_a_block))
    slim = slim.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(blocks)))
    by_bucket = materialise(slim.groupBy("source", "bucket").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    weights, _ = source_weights(materialise(by_bucket.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-totals"), target_entropy, max_repetition)
    scale = 1.0
    if budget is not None:
        whole = weights.agg(F.sum(F.col("tokens") * F.col("passes")).alias("all")).first()["all"]
        scale = budget / whole if whole else 1.0
    plan = weights.select("source", (F.col("passes") * F.lit(scale)).alias("passes"), "tokens").withColumn("full", F.floor(F.col("passes") + 1e-9)).withColumn("rest", (F.col("passes") - F.col("full")) * F.col("tokens"))
    plan = materialise(plan.select("source", "full", F.greatest("rest", F.lit(0.0)).alias("rest")), "mix-plan")
    order = lambda *c: F.xxhash64(F.lit(seed), *c)
    # one row a block of the source
    before = Window.partitionBy("source").orderBy("block_order", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = by_bucket.join(plan, "source").withColumn("block_order", order("full", "bucket")).withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    last = placed.where("rest > before").select("source", "bucket", F.col("full").alias("last_pass"), F.col("before").alias("start"), "rest", (F.col("before") + F.col("tokens") <= F.col("rest")).alias("whole_block"))
    # documents of the one block of each source that the budget cuts
    inside = Window.partitionBy("source", "bucket").orderBy(order("last_pass", "key"), "key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    cut = slim.join(last.where(~F.col("whole_block")), ["source", "bucket"]).withColumn("used", F.col("start") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    cut = cut.where("used < rest").groupBy("source", "key").agg(F.count("*").alias("copies"))
    ready = rows.withColumn("_key", F.xxhash64(F.col(id_col), F.col(text_col))).withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("_key")), F.lit(blocks)))
    blocks_plan = by_bucket.select("source", "bucket").join(plan, "source").join(last.select("source", "bucket", "whole_block"), ["source", "bucket"], "left")
    blocks_plan = blocks_plan.select(F.col("source").alias("mix_source"), F.col("bucket").alias("_bucket"), "full", "whole_block")
    joined = ready.join(blocks_plan, ["mix_source", "_bucket"])
    # only documents of cut blocks need a look at the cut list
    whole = joined.where(F.coalesce(F.col("whole_block"), F.lit(True))).withColumn("n", F.col("full") + F.col("whole_block").isNotNull().cast("int"))
    partial = joined.where(~F.col("whole_block")).join(cut.select(F.col("source").alias("mix_source"), F.col("key").alias("_key"), "copies"), ["mix_source", "_key"], "left").withColumn("n", F.col("full") + F.col("copies").isNotNull().cast("int"))
    every = whole.select(*rows.columns, "_key", "_bucket", "n").unionByName(partial.select(*rows.columns, "_key", "_bucket", "n"))
    passes = every.where("n > 0").withColumn("mix_pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return passes.select(*columns, "mix_source", "mix_tokens", "mix_pass", order("mix_pass", "_bucket").alias("mix_block"), order("mix_pass", "_key").alias("mix_rank")).withColumn("mix_source", F.when(F.col("mix_source") != "", F.substring("mix_source", 2, 2**31 - 1)))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("mix_source").alias("source"), F.col("mix_tokens").alias("n_tokens"), F.col("mix_pass").alias("pass"), F.col("mix_block").alias("block"), F.col("mix_rank").alias("rank"))
