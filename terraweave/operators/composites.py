"""Composite audits: all figures of a table as rows (section, subject, metric, value)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terraweave.operators import ranks, stats
from terraweave.sources.storage import drop, materialise

SCHEMA = "section string, subject string, metric string, value double"
SUMMARY = ["n", "missing", "min", "mean", "std", "max"]


@dataclass
class Population:
    """Rows that meet ``condition`` (SQL), fields whose distribution is asked for, and pairs whose correlations are."""

    condition: str
    fields: list[str] = field(default_factory=list)
    pairs: list[tuple[str, str]] = field(default_factory=list)


def metric_rows(df: DataFrame, section: str, subject: Column, metrics: list[str]) -> DataFrame:
    """The columns ``metrics`` of a small table as metric rows, rounded to 6 digits."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.round(F.col(m).cast("double"), 6).alias("value")) for m in metrics])
    return df.select(F.lit(section).alias("section"), subject.alias("subject"), F.explode(cells).alias("c")).select("section", "subject", "c.*")


def written_with_figures(df: DataFrame, figures: dict[tuple[str, str, str], Column], name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` written to the shared folder, and metric rows of aggregates taken in the job that writes it.

    figures: (section, subject, metric): aggregate. They are one row of numbers, whatever
    the size of ``df``; the table isn't read for them. Of a task that runs twice Spark
    counts one. Empty table: counts are 0, all else null.
    """
    seen = Observation()
    observed = df.observe(seen, *[c.cast("double").alias(f"f{i}") for i, c in enumerate(figures.values())]) if figures else df
    table = materialise(observed, name)
    found = seen.get if figures else {}
    rows = [(*key, None if found[f"f{i}"] is None else found[f"f{i}"]) for i, key in enumerate(figures)]
    return table, df.sparkSession.createDataFrame(rows, SCHEMA).withColumn("value", F.round("value", 6))


def composite(df: DataFrame, populations: dict[str, Population], figures: dict[tuple[str, str, str], str], key: str = "hex_id", name: str = "audit") -> tuple[DataFrame, DataFrame]:
    """(table, rows): ``df`` written once, and its figures, distributions and correlations as metric rows.

    ``figures`` (aggregates in SQL) and Pearson correlations are taken while the table is
    written. Distributions of all fields in all populations, and the ranks behind Spearman
    correlations, come from one sort of distinct values, so equal values never gather in a
    task. Ranks are those among the non-null values of a field in its population; rows
    with a null on either side take no part in a correlation, and one of a constant is null.
    A population without rows has no distributions; its Pearson correlations are null,
    as are Spearman's. ``key`` is unique; null conditions are false.
    """
    wide = {k: F.expr(sql) for k, sql in figures.items()}
    for population, of in populations.items():
        for a, b in of.pairs:
            inside = [F.when(F.expr(of.condition), F.col(c).cast("double")) for c in (a, b)]
            wide["correlation", f"{population}: {a} ~ {b}", "pearson"] = stats.guarded_corr(*inside)
    table, found = written_with_figures(df, wide, name)
    keys = ["population", "field"]
    placed = lambda p, f: F.struct(F.lit(p).alias("population"), F.lit(f).alias("field"), F.col(f).cast("double").alias("value"))
    needed = {p: dict.fromkeys([*of.fields, *[c for pair in of.pairs for c in pair]]) for p, of in populations.items()}
    cells = [F.when(F.expr(of.condition), placed(p, f)) for p, of in populations.items() for f in needed[p]]
    rows = table.select(key, F.explode(F.array_compact(F.array(*cells))).alias("c")).select(key, "c.*")
    asked = F.concat_ws("\n", *keys).isin([f"{p}\n{f}" for p, of in populations.items() for f in of.fields])
    counts = rows.where("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("_ties"))
    places = materialise(ranks.cumulative(counts, keys, "value"), "places")
    value = F.col("value")
    summary = rows.where(asked).groupBy(*keys).agg(F.count(value).alias("n"), F.count_if(value.isNull()).alias("missing"), F.min(value).alias("min"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.max(value).alias("max"))
    points = stats.at_points(places.where(asked), keys, "value", stats.POINTS)
    subject = F.concat_ws(": ", *keys)
    out = [found, metric_rows(summary.join(points, keys, "left"), "distribution", subject, [*SUMMARY, *stats.POINTS])]
    if any(of.pairs for of in populations.values()):
        out.append(_rank_correlations(rows, places, populations, key))
    result = materialise(_all(out), f"{name}-figures")
    drop(places)
    return table, result


def _rank_correlations(rows: DataFrame, places: DataFrame, populations: dict[str, Population], key: str) -> DataFrame:
    keys = ["population", "field"]
    sides = {p: list(dict.fromkeys(c for pair in of.pairs for c in pair)) for p, of in populations.items()}
    names = {f: f"r{i}" for i, f in enumerate(dict.fromkeys(f for fields in sides.values() for f in fields))}
    used = F.concat_ws("\n", *keys).isin([f"{p}\n{f}" for p, fields in sides.items() for f in fields])
    rank = places.where(used).select(*keys, "value", (F.col("_below") + (F.col("_ties") + 1) / F.lit(2.0)).alias("_rank"))
    ranked = rows.where(used & F.col("value").isNotNull()).join(rank, [*keys, "value"])
    wide = ranked.groupBy(key, "population").agg(*[F.max(F.when(F.col("field") == f, F.col("_rank"))).alias(r) for f, r in names.items()])
    pairs = {pair: f"c{i}" for i, pair in enumerate(dict.fromkeys(pair for of in populations.values() for pair in of.pairs))}
    found = wide.groupBy("population").agg(*[stats.guarded_corr(F.col(names[a]), F.col(names[b])).alias(c) for (a, b), c in pairs.items()])
    every = rows.sparkSession.createDataFrame([(p, a, b) for p, of in populations.items() for a, b in of.pairs], "population string, a string, b string")
    value = F.coalesce(*[F.when((F.col("a") == a) & (F.col("b") == b), F.col(c)) for (a, b), c in pairs.items()])
    joined = every.join(found, "population", "left").withColumn("spearman", value)
    return metric_rows(joined, "correlation", F.concat("population", F.lit(": "), "a", F.lit(" ~ "), "b"), ["spearman"])


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def tail_overlaps(df: DataFrame, reference: str, names: list[str], fraction: float = 0.1, key: str = "hex_id") -> DataFrame:
    """(field, rows, shared): the best fraction by every field, and how many of it are among the best by ``reference``; all ranked in one sort."""
    every = ranks.stacked(df, [reference, *names], "field", "score", [key])
    tails = ranks.top_fraction(every, "score", fraction, key, within=["field"])
    top = tails.where(F.col("field") == reference).select(key, F.lit(1).alias("_in"))
    return tails.where(F.col("field") != reference).join(top, key, "left").groupBy("field").agg(F.count("*").alias("rows"), F.count("_in").alias("shared"))
