"""Katz backoff weights as tables that outlive a query, and scores of any other table from them.

The model is that of ``katz_lm``. A fitted model is a folder of three Parquet tables:

* ``ngrams`` (context, word, n, logp), n: occurrences, logp: log10 of the discounted probability,
* ``contexts`` (context, n, log_alpha), log_alpha: log10 of the exact backoff weight,
* ``totals``: one row with the order, the training tokens, distinct ones, and log10 of the unseen type's probability.

``ngrams`` and ``contexts`` are partitioned by order and by a hash of the context, so all that is known of a
context stands in one part. Contexts are words joined by spaces; no word holds white space,
so a tab (before a document) and a line feed (its end) mark the tokens that are no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.llm.common import ASCII_LOWER, ASCII_UPPER, drop, materialise
from terraweave.llm.katz_lm import K_MAX, discounts

START, END = "\t", "\n"
#: Most keys that are looked up in a broadcast: those that hold at least this share of the rows each.
HOT_KEYS = 20_000
NGRAMS = "context string, word string, n long, logp double, order int, part int"
CONTEXTS = "context string, n long, log_alpha double, order int, part int"


def _tokens(text: str, order: int) -> Column:
    """Tokens of a text behind order - 1 start marks."""
    words = F.filter(F.split(F.translate(F.coalesce(F.col(text), F.lit("")), ASCII_UPPER, ASCII_LOWER), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.concat(F.array_repeat(F.lit(START), order - 1), words, F.array(F.lit(END)))


def _gram(x: Column, i: Column, order: int, n: int) -> list[Column]:
    """Context of n - 1 words and the word at place ``i``, counted from 1 behind the start marks."""
    context = F.array_join(F.slice(x, i + F.lit(order - n), F.lit(n - 1)), " ") if n > 1 else F.lit("")
    return [context.alias("context"), F.element_at(x, i + F.lit(order - 1)).alias("word")]


def _places(order: int) -> Column:
    return F.sequence(F.lit(1), F.size("_x") - F.lit(order - 1))


def _shorter() -> Column:
    """The column ``context`` less its first word."""
    return F.when(F.instr("context", " ") > 0, F.expr("substring(context, instr(context, ' ') + 1)")).otherwise("")


def look_up(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to rows that are unique by ``keys`` (never null).

    Keys with at least one in ``HOT_KEYS`` of the rows of ``left`` are at most so many; their
    rows of ``right`` are broadcast, so no task gets all rows of a frequent key.
    ``left`` should be a written table, since it is read for the keys as well.
    """
    counts = left.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = left.agg(F.count("*").alias("_all"))
    hot = counts.join(F.broadcast(total)).where((F.col("_n") >= 2) & (F.col("_n") * HOT_KEYS >= F.col("_all"))).select(*keys, F.lit(True).alias("_hot"))
    hot = materialise(hot, "hot-keys")
    known = right.join(F.broadcast(hot.drop("_hot")), keys, "left_semi")
    marked = left.join(F.broadcast(hot), keys, "left")
    few = marked.where(F.col("_hot")).drop("_hot").join(F.broadcast(known), keys, "left")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot").join(right, keys, "left")
    return few.unionByName(rest)


def fit(docs: DataFrame, path: str, order: int = 3, text_col: str = "text", parts: int = 64) -> None:
    """Learns from all rows of ``docs`` and writes the tables below ``path``, which must be new.

    Null texts are empty (one end token); repeated rows train each; other columns are
    ignored. An empty table gives empty tables, where every word is unseen. ``parts``
    grows with the corpus: it is the number of folders an order has, and changes no score.
    """
    spark = docs.sparkSession
    slim = docs.select(_tokens(text_col, order).alias("_x"))
    grams = F.flatten(F.transform(_places(order), lambda i: F.array(*[F.struct(F.lit(n).alias("order"), *_gram(F.col("_x"), i, order, n)) for n in range(1, order + 1)])))
    counted = slim.select(F.explode(grams).alias("g")).select("g.*").groupBy("order", "context", "word").agg(F.count("*").alias("n"))
    counted = materialise(counted, "ngram-counts")
    of = {n: [0.0] * (K_MAX + 2) for n in range(1, order + 1)}
    for row in counted.where(F.col("n") <= K_MAX + 1).groupBy("order", "n").count().collect():  # at most K_MAX + 1 rows an order
        of[row["order"]][row["n"]] = float(row["count"])
    by_count = F.lit(1.0)
    for n, c in of.items():
        for r, d in enumerate(discounts(c)[: K_MAX + 1]):
            by_count = F.when((F.col("order") == n) & (F.col("n") == r), F.lit(float(d))).otherwise(by_count)
    sums = counted.groupBy("order", "context").agg(F.sum("n").alias("total"), F.sum(F.col("n") * (1 - by_count)).alias("lost"))
    sums = materialise(sums, "context-sums")
    weighed = materialise(look_up(counted.withColumn("_kept", by_count * F.col("n")), sums, ["order", "context"]).select("order", "context", "word", "n", (F.col("_kept") / F.col("total")).alias("p")), "weighed")
    # the words seen after a context were all seen after the shorter one
    lower = weighed.select((F.col("order") + 1).alias("order"), F.col("context").alias("_short"), "word", F.col("p").alias("_lower"))
    longer = materialise(weighed.where("order > 1").select("order", "context", _shorter().alias("_short"), "word"), "longer")
    gone = look_up(longer, lower, ["order", "_short", "word"]).groupBy("order", "context").agg(F.sum("_lower").alias("gone"))
    alpha = F.greatest(F.col("lost") / F.col("total"), F.lit(1e-12)) / F.greatest(1 - F.col("gone"), F.lit(1e-12))
    contexts = sums.where("order > 1").join(gone, ["order", "context"]).select("order", "context", F.col("total").alias("n"), F.log10(alpha).alias("log_alpha"))
    _write(weighed.select("order", "context", "word", "n", F.log10("p").alias("logp")), f"{path}/ngrams", parts)
    _write(contexts, f"{path}/contexts", parts)
    first = weighed.where("order = 1")
    whole = first.agg(F.lit(order).alias("max_order"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds"), F.log10(F.greatest(1 - F.coalesce(F.sum("p"), F.lit(0.0)), F.lit(1e-12))).alias("log_unseen"))
    whole.write.parquet(f"{path}/totals")
    for t in (counted, sums, weighed, longer):
        drop(t)


def _write(df: DataFrame, path: str, parts: int) -> None:
    """By order and part of the context; each part is dealt over some tasks, that of the empty context over as many as there are parts."""
    placed = df.withColumn("part", F.pmod(F.xxhash64("context"), F.lit(parts)).cast("int"))
    deal = F.when(F.col("order") == 1, F.lit(parts)).otherwise(4)
    placed.repartition("order", "part", F.pmod(F.xxhash64(*df.columns[1:3]), deal)).write.partitionBy("order", "part").parquet(path)


def _read(spark: SparkSession, path: str, schema: str, order: int) -> DataFrame:
    return spark.read.schema(schema).parquet(path).where(F.col("order") == order).drop("order", "part")


def score(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, score), one row a row of ``docs``, by the tables below ``path``.

    The distinct n-grams of ``docs`` are looked up from the longest context down: a seen one has
    its probability, an unseen one its context's weight, if that was seen, and the next shorter
    n-gram. Null texts are the end token alone; repeated rows and null ids are scored each on its
    own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    whole = spark.read.parquet(f"{path}/totals").first()
    order = whole["max_order"]
    rows = materialise(docs.select(F.col(id_col).cast("long").alias("doc_id"), _tokens(text_col, order).alias("_x")).withColumn("_row", F.monotonically_increasing_id()), "rows")
    tokens = rows.select("_row", F.explode(F.transform(_places(order), lambda i: F.struct(*_gram(F.col("_x"), i, order, order)))).alias("g")).select("_row", "g.*")
    tokens = materialise(tokens.groupBy("_row", "context", "word").agg(F.count("*").alias("times")), "doc-ngrams")
    distinct = tokens.select("context", "word").distinct()
    state = distinct.select(F.col("context").alias("_full"), "context", "word", F.lit(None).cast("double").alias("_logp"), F.lit(0.0).alias("_weight"))
    state, spent = materialise(state, "state"), []
    for n in range(order, 0, -1):
        spent.append(state)
        found = look_up(state.where("_logp is null"), _read(spark, f"{path}/ngrams", NGRAMS, n).drop("n"), ["context", "word"])
        missed = F.col("logp").isNull()
        if n > 1:
            weights = _read(spark, f"{path}/contexts", CONTEXTS, n).drop("n")
            found = look_up(materialise(found, "found"), weights, ["context"]).select(
                "_full", _shorter().alias("context"), "word", (F.col("_weight") + F.col("logp")).alias("_logp"), F.when(missed, F.col("_weight") + F.coalesce("log_alpha", F.lit(0.0))).otherwise(F.col("_weight")).alias("_weight"),
            )
        else:
            found = found.select("_full", "context", "word", (F.col("_weight") + F.coalesce("logp", F.lit(whole["log_unseen"]))).alias("_logp"), "_weight")
        state = materialise(found.unionByName(state.where("_logp is not null")), "state")
    known = _read(spark, f"{path}/ngrams", NGRAMS, 1).select("word", F.lit(1).alias("_known"))
    answers = materialise(look_up(state.select(F.col("_full").alias("context"), "word", F.col("_logp")), known, ["word"]), "answers")
    scored = look_up(tokens, answers, ["context", "word"]).groupBy("_row").agg(F.sum("times").alias("n_tokens"), F.coalesce(F.sum(F.col("times") * F.col("_known")), F.lit(0)).alias("n_known"), F.sum(F.col("times") * F.col("_logp")).alias("score"))
    out = materialise(rows.select("doc_id", "_row").join(scored, "_row").drop("_row"), "scores")
    for t in (rows, tokens, answers, state, *spent):
        drop(t)
    return out
