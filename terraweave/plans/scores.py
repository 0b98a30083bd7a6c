"""Queries over component scores: ranks, presets, audits and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.operators import cells, checks, delivery, ranks, scoring, skyband, stats
from terraweave.operators.scoring import FIELDS, PRESETS, SCHEMES
from terraweave.plans import cells as c
from terraweave.sources import projection as p

VECTORS = {"first_only": (100.0, 0.0, 0.0, 0.0, 0.0), "mixed": (10.0, 20.0, 30.0, 40.0, 0.0), "none": (0.0, 0.0, 0.0, 0.0, 0.0)}
#: Thirty-two weightings: every choice of components that count at all.
MANY = {f"w{i}": tuple(float((i * k) % 101) if i >> j & 1 else 0.0 for j, k in enumerate((37, 53, 11, 71, 29))) for i in range(32)}


def _presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.with_schemes(p.part_scores(spark, sf_dir), PRESETS)


def s2_flag_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = F.expr("CASE l_linenumber % 5 WHEN 0 THEN ' TRUE' WHEN 1 THEN '0' WHEN 2 THEN 'yes' WHEN 3 THEN 'False ' ELSE '1' END")
    return lines.groupBy(checks.boolean_flag(text).alias("flag")).agg(F.count("*").alias("rows"))


def s2_numeric_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select((F.col("o_orderkey") / 8.0).alias("v"))
    return checks.numeric_violations(orders, "v", low=10.0, high=1000.0, integer=True)


def s4_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.key_check(p.part_scores(spark, sf_dir), score="ecological_network_score")


def s4_reconcile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = spark.read.parquet(f"{sf_dir}/lineitem.parquet"), spark.read.parquet(f"{sf_dir}/orders.parquet")
    return checks.reconcile_ids(orders.select(F.col("o_orderkey").alias("k")), lines.select(F.col("l_orderkey").alias("k")), "k")


def s4_flag_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = p.part_scores(spark, sf_dir).select("hex_id", "boundary_edge_flag", "raw")
    b = a.select("hex_id", (F.col("boundary_edge_flag") | (F.col("raw") == 3)).alias("boundary_edge_flag"))
    return checks.flag_agreement([a, b], "boundary_edge_flag")


def s4_one_to_one_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = p.part_scores(spark, sf_dir)
    return checks.one_to_one_join(scores.select("hex_id", "raw"), scores, ["steps"])


def s4_reconcile_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land pixels of every cell, as the composition and as the protection table count them."""
    grid = cells.protection(p.marked_pixels(spark, sf_dir))
    return checks.reconcile_positions(p.counts(spark, sf_dir), grid, "terrestrial_pixels")


def s4_same_context_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of equal habitat score whose availability is lowest and highest, gaps of 5 or more."""
    v = F.col("restoration_land_availability_score")
    groups = p.part_scores(spark, sf_dir).groupBy(F.round("habitat_context_score", 1).alias("habitat")).agg(F.min(F.struct(v.alias("v"), "hex_id")).alias("low"), F.min(F.struct((-v).alias("v"), "hex_id")).alias("high"))
    gap = -F.col("high.v") - F.col("low.v")
    return groups.select("habitat", F.col("low.hex_id").alias("low_id"), F.col("high.hex_id").alias("high_id"), gap.alias("gap")).where("gap >= 5").orderBy(F.col("gap").desc(), "habitat").limit(6)


def s5_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.distribution(p.part_scores(spark, sf_dir), FIELDS)


def s5_group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.distribution(p.part_scores(spark, sf_dir), FIELDS[:2], ["boundary_edge_flag"])


def s5_binned_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.binned_counts(p.part_scores(spark, sf_dir), "habitat_context_score", [0.0, 10.0, 25.0, 50.0, 100.0])


def s5_integer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.integer_counts(p.part_scores(spark, sf_dir), "steps", 8)


def s5_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.correlation_matrix(p.part_scores(spark, sf_dir), FIELDS)


def s5_rank_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = p.part_scores(spark, sf_dir).select("hex_id", *FIELDS[:3])
    for f in FIELDS[:3]:
        df = ranks.average_ranks(df, f).withColumn(f"rank_{f}", F.col("rank_avg")).drop("rank_avg", "n")
    return stats.correlation_matrix(df, [f"rank_{f}" for f in FIELDS[:3]], "spearman")


def s5_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.tie_diagnostics(p.part_scores(spark, sf_dir), "raw")


def s5_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.score_anchors(p.part_scores(spark, sf_dir), "raw", "ecological_network_score")


def s5_joint_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.joint_bands(p.part_scores(spark, sf_dir), FIELDS[0], FIELDS[2])


def s5_step_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ranks.reverse_score(p.part_scores(spark, sf_dir).select("hex_id", "steps"), "steps")
    return scored.groupBy("steps").agg(F.count("*").alias("rows"), F.round(F.min("score"), 9).alias("score"), F.count_distinct("score").alias("scores"))


def s6_percentile_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.percentile_score(p.part_scores(spark, sf_dir).select("hex_id", "raw"), "raw")


def s6_positive_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.positive_percentile_score(p.part_scores(spark, sf_dir).select("hex_id", "riparian_opportunity_score"), "riparian_opportunity_score")


def s6_reverse_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.reverse_score(p.part_scores(spark, sf_dir).select("hex_id", "steps"), "steps")


def s6_ordinal_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.ordinal_ranks(_presets(spark, sf_dir).select("hex_id", "balanced"), "balanced")


def s6_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.quartiles(p.part_scores(spark, sf_dir).select("hex_id", "raw"), "raw")


def s6_leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranks.average_ranks(ranks.leave_one_out(p.part_scores(spark, sf_dir), FIELDS).withColumn("score", F.round("score", 9)), "score", within=["omitted"])
    return ranked.select("hex_id", "omitted", "score", "rank_avg")


def s6_rank_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _presets(spark, sf_dir).select("hex_id", *[F.round(c, 9).alias(c) for c in ("balanced", "riparian_restoration")])
    a = ranks.percentile_score(df, "balanced", "a").select("hex_id", "a", "riparian_restoration")
    moved = F.abs(F.col("b") - F.col("a"))
    moves = ranks.percentile_score(a, "riparian_restoration", "b").select(moved.alias("moved"))
    middle = stats.percentiles(moves, [], "moved", {"median": 0.5}).select(F.round("median", 6).alias("median"))
    return moves.agg(F.round(F.max("moved"), 6).alias("max"), *[F.count_if(F.col("moved") >= t).alias(f"at_least_{t}") for t in (10, 25, 40)]).join(F.broadcast(middle))


def s7_top_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.top_fraction(p.part_scores(spark, sf_dir).select("hex_id", "raw"), "raw", 0.1)


def s7_shortlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.shortlists(_presets(spark, sf_dir).select("hex_id", *[F.round(c, 9).alias(c) for c in PRESETS]), list(PRESETS))


def s7_custom_weight_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.custom_rank(p.part_scores(spark, sf_dir), VECTORS, 5).withColumn("score", F.round("score", 9))


def s7_skyband_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best ten for many weightings, from an index that is made once for all of them."""
    index = skyband.skyband(p.part_scores(spark, sf_dir), 10)
    return scoring.custom_rank(index, MANY, 10).withColumn("score", F.round("score", 9))


def s7_tail_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _presets(spark, sf_dir).select("hex_id", *[F.round(c, 9).alias(c) for c in PRESETS])
    a, b = ranks.top_fraction(df, "balanced", 0.1).select("hex_id"), ranks.top_fraction(df, "riparian_restoration", 0.1).select("hex_id")
    return a.join(b.withColumn("both", F.lit(1)), "hex_id", "left").agg(F.count("*").alias("tail"), F.count("both").alias("shared"))


def s7_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _presets(spark, sf_dir).select("hex_id", *[F.round(c, 9).alias(c) for c in PRESETS])
    tails = [ranks.top_fraction(df, c, 0.1).select("hex_id") for c in PRESETS]
    return tails[0].unionByName(tails[1]).unionByName(tails[2]).groupBy("hex_id").count().where("count = 3").select("hex_id")


def s7_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _presets(spark, sf_dir).select("hex_id", *[F.round(c, 9).alias(c) for c in PRESETS])
    now, before = ranks.top_n(df, "riparian_restoration", 100).select("hex_id"), ranks.top_n(df, "balanced", 100).select("hex_id")
    return now.exceptAll(before).withColumn("change", F.lit("entered")).unionByName(before.exceptAll(now).withColumn("change", F.lit("left")))


def s8_presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _presets(spark, sf_dir)


def s8_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.baseline(p.part_scores(spark, sf_dir))


def s8_sensitivity_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.with_schemes(p.part_scores(spark, sf_dir), {"reference": PRESETS["balanced"]} | SCHEMES)


def s8_compensability(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = p.part_scores(spark, sf_dir).withColumn("balanced", F.round(scoring.weighted_mean(PRESETS["balanced"]), 9))
    return scoring.compensability(ranks.top_fraction(scores, "balanced", 0.1))


def s8_consistent_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.consistent_strength(p.part_scores(spark, sf_dir), (20, 40, 50))


def s8_component_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.component_winners(p.part_scores(spark, sf_dir))


def s8_preset_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.preset_winners(_presets(spark, sf_dir).select("hex_id", *[F.round(c, 9).alias(c) for c in PRESETS]))


def s8_contribution_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.contribution_spread(p.part_scores(spark, sf_dir), PRESETS)


def s8_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.explain(p.part_scores(spark, sf_dir))


W = "WITH " + p.PARTS_SQL
_D = lambda w: f"{w!r}::DOUBLE"


def _mean(weights: tuple[float, ...]) -> str:
    return " + ".join(f"{_D(w)} * {f}" for w, f in zip(weights, FIELDS, strict=True))


def _schemes(schemes: dict) -> str:
    return ", ".join(f"{_mean(w)} AS {n}" for n, w in schemes.items())


_PRE = W + ", pre AS (SELECT hex_id, " + ", ".join(f"round({_mean(w)}, 9) AS {n}" for n, w in PRESETS.items()) + " FROM scores)"
_AVG = "rank() OVER ({part} ORDER BY {v}) + (count(*) OVER (PARTITION BY {keys}{v}) - 1) / 2.0::DOUBLE"


def _avg(v: str) -> str:
    return _AVG.format(part="", keys="", v=v)


def _dist(by: str, fields: list[str]) -> str:
    src = " UNION ALL ".join(f"SELECT {by + ', ' if by else ''}'{f}' AS metric, {f} AS v FROM scores" for f in fields)
    points = ", ".join(f"round(quantile_cont(v, {q}), 6) AS {n}" for n, q in stats.POINTS.items())
    return f" SELECT {by + ', ' if by else ''}metric, count(v) AS n, count(*) FILTER (WHERE v IS NULL) AS missing, round(min(v), 6) AS min, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(max(v), 6) AS max, {points} FROM ({src}) GROUP BY {by + ', ' if by else ''}metric"


def _corr(fields: list[str], source: str, method: str) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, '{method}' AS method, round(corr({a}, {b}), 6) AS value FROM {source}" for i, a in enumerate(fields) for b in fields[i + 1 :])


def _custom(vectors: dict[str, tuple[float, ...]] = VECTORS, n: int = 5) -> str:
    parts = []
    for name, raw in vectors.items():
        total = sum(raw)
        w = [x / total for x in raw] if total else [0.2] * 5
        parts.append(f"SELECT '{name}' AS vector, hex_id, " + " + ".join(f"{f} * {_D(x)}" for f, x in zip(FIELDS, w, strict=True)) + " AS score FROM scores")
    return W + " SELECT vector, CAST(rank AS INTEGER) AS rank, hex_id, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY vector ORDER BY score DESC, hex_id) AS rank FROM (" + " UNION ALL ".join(parts) + f")) WHERE rank <= {n}"


def _top(v: str, source: str = "pre") -> str:
    return f"(SELECT hex_id FROM (SELECT hex_id, row_number() OVER (ORDER BY {v} DESC, hex_id) AS k, count(*) OVER () AS n FROM {source}) WHERE k <= greatest(1, ceil(n * 0.1::DOUBLE)))"


def _phrases() -> str:
    items = ", ".join(f"{{'k': -{f}, 'i': {i}, 's': CASE WHEN {f} >= 75 THEN '{s}' WHEN {f} >= 50 THEN '{m}' ELSE '{w}' END}}" for i, (f, (s, m, w)) in enumerate(scoring.PHRASES.items()))
    a, r = FIELDS[4], FIELDS[2]
    return W + f""", e AS (SELECT hex_id, list_sort([{items}]) AS l, CASE WHEN {a} < 50 THEN '{scoring.PHRASES[a][2]}' WHEN {r} < 50 THEN '{scoring.PHRASES[r][2]}' END AS c FROM scores)
      SELECT hex_id, l[1].s || ' ' || l[2].s || CASE WHEN c IS NULL OR c = l[1].s OR c = l[2].s THEN '' ELSE ' ' || c END AS explanation FROM e"""


_BIN = "CASE WHEN habitat_context_score < 0 THEN 'below' WHEN habitat_context_score < 10 THEN '[0,10)' WHEN habitat_context_score < 25 THEN '[10,25)' WHEN habitat_context_score < 50 THEN '[25,50)' WHEN habitat_context_score < 100 THEN '[50,100)' ELSE 'above' END"
_BAND = "CASE WHEN {c} < 25 THEN '0-25' WHEN {c} < 50 THEN '25-50' WHEN {c} < 75 THEN '50-75' ELSE '75-100' END"
_WEAK = " + ".join(f"CAST({f} <= 25 AS INTEGER)" for f in FIELDS)
_LEAST, _MOST = f"least({', '.join(FIELDS)})", f"greatest({', '.join(FIELDS)})"
_PB = f"greatest({', '.join(PRESETS)})"

ORACLES = {
    "s2_flag_coercion": "SELECT CASE l_linenumber % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 3 THEN false WHEN 4 THEN true END AS flag, count(*) AS rows FROM lineitem GROUP BY 1",
    "s2_numeric_checks": "SELECT count(*) AS rows, 0::BIGINT AS not_finite, count(*) FILTER (WHERE o_orderkey / 8.0::DOUBLE < 10 OR o_orderkey / 8.0::DOUBLE > 1000) AS out_of_range, count(*) FILTER (WHERE o_orderkey % 8 <> 0) AS not_whole FROM orders",
    "s4_key_check": W + " SELECT count(*) AS rows, 0::BIGINT AS empty_keys, 0::BIGINT AS repeated_keys, count(*) FILTER (WHERE ecological_network_score > 100) AS bad_scores FROM scores",
    "s4_reconcile_ids": "WITH a AS (SELECT o_orderkey AS k, count(*) AS a FROM orders GROUP BY 1), b AS (SELECT l_orderkey AS k, count(*) AS b FROM lineitem GROUP BY 1), j AS (SELECT * FROM a FULL JOIN b USING (k)) SELECT CAST(sum(a) AS BIGINT) AS expected_rows, CAST(sum(b) AS BIGINT) AS found_rows, count(*) FILTER (WHERE b IS NULL) AS missing, count(*) FILTER (WHERE a IS NULL) AS extra, count(*) FILTER (WHERE a > 1 OR b > 1) AS repeated, count(*) FILTER (WHERE b IS NULL OR a IS NULL OR a > 1 OR b > 1) = 0 AS exact FROM j",
    "s4_flag_agreement": W + " SELECT count(*) AS keys, count(*) FILTER (WHERE raw = 3 AND NOT boundary_edge_flag) AS disagreeing FROM scores",
    "s4_one_to_one_join": W + " SELECT hex_id, raw, steps FROM scores",
    "s4_reconcile_positions": c.CELLS + "," + p.PROTECTED_SQL + c._PGRID + ", a AS (SELECT grid_col, grid_row, terrestrial_pixels AS a FROM cnt), b AS (SELECT grid_col, grid_row, terrestrial_pixels AS b FROM pg) SELECT CASE WHEN b IS NULL THEN 'left_only' WHEN a IS NULL THEN 'right_only' WHEN a = b THEN 'equal' ELSE 'different' END AS side, count(*) AS positions, CAST(sum(coalesce(a, 0) - coalesce(b, 0)) AS BIGINT) AS difference FROM a FULL JOIN b USING (grid_col, grid_row) GROUP BY 1",
    "s4_same_context_extremes": W + " SELECT habitat_context_score AS habitat, low_id, high_id, gap FROM (SELECT habitat_context_score, arg_min(hex_id, {'v': restoration_land_availability_score, 'h': hex_id}) AS low_id, arg_min(hex_id, {'v': -restoration_land_availability_score, 'h': hex_id}) AS high_id, max(restoration_land_availability_score) - min(restoration_land_availability_score) AS gap FROM scores GROUP BY 1) WHERE gap >= 5 ORDER BY gap DESC, habitat LIMIT 6",
    "s5_distribution": W + _dist("", FIELDS),
    "s5_group_split": W + _dist("boundary_edge_flag", FIELDS[:2]),
    "s5_binned_counts": W + f", b AS (SELECT unnest(['below', '[0,10)', '[10,25)', '[25,50)', '[50,100)', 'above', 'missing']) AS bin) SELECT b.bin, count(s.hex_id) AS rows FROM b LEFT JOIN scores s ON b.bin = {_BIN} GROUP BY 1",
    "s5_integer_counts": W + " SELECT v AS value, count(hex_id) AS rows FROM (SELECT unnest(range(9)) AS v) LEFT JOIN scores ON steps = v GROUP BY 1",
    "s5_correlations": W + " " + _corr(FIELDS, "scores", "pearson"),
    "s5_rank_correlations": W + ", k AS (SELECT " + ", ".join(f"{_avg(f)} AS rank_{f}" for f in FIELDS[:3]) + " FROM scores) " + _corr([f"rank_{f}" for f in FIELDS[:3]], "k", "spearman"),
    "s5_ties": W + " SELECT count(*) AS distinct_values, count(*) FILTER (WHERE n > 1) AS tied_groups, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_ties, max(n) AS largest_group FROM (SELECT raw, count(*) AS n FROM scores GROUP BY 1)",
    "s5_anchors": W + " SELECT CAST(t AS INTEGER) AS score_limit, count(hex_id) AS rows, min(raw) AS least_raw FROM (SELECT unnest([25, 50, 75, 90, 95]) AS t) LEFT JOIN scores ON ecological_network_score >= t GROUP BY 1",
    "s5_joint_bands": W + f" SELECT {_BAND.format(c=FIELDS[0])} AS band_a, {_BAND.format(c=FIELDS[2])} AS band_b, count(*) AS rows FROM scores GROUP BY 1, 2",
    "s5_step_lookup": W + f", k AS (SELECT hex_id, {_avg('steps')} AS r, count(*) OVER () AS n FROM scores WHERE steps > 0) SELECT steps, count(*) AS rows, round(min(CASE WHEN steps = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE * (n - r + 1) / (n + 1) END), 9) AS score, 1::BIGINT AS scores FROM scores LEFT JOIN k USING (hex_id) GROUP BY 1",
    "s6_percentile_score": W + f" SELECT hex_id, raw, 100.0::DOUBLE * (r - 1) / (n - 1) AS score FROM (SELECT *, {_avg('raw')} AS r, count(*) OVER () AS n FROM scores)",
    "s6_positive_percentile": W + f", k AS (SELECT hex_id, {_avg(FIELDS[2])} AS r, count(*) OVER () AS n FROM scores WHERE {FIELDS[2]} > 0) SELECT hex_id, {FIELDS[2]}, CASE WHEN {FIELDS[2]} = 0 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * r / n END AS score FROM scores LEFT JOIN k USING (hex_id)",
    "s6_reverse_score": W + f", k AS (SELECT hex_id, {_avg('steps')} AS r, count(*) OVER () AS n FROM scores WHERE steps > 0) SELECT hex_id, steps, CASE WHEN steps = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE * (n - r + 1) / (n + 1) END AS score FROM scores LEFT JOIN k USING (hex_id)",
    "s6_ordinal_rank": W + f" SELECT hex_id, {_mean(PRESETS['balanced'])} AS balanced, row_number() OVER (ORDER BY {_mean(PRESETS['balanced'])} DESC, hex_id) AS rank FROM scores",
    "s6_quartiles": W + " SELECT hex_id, raw, CAST(ceil(4.0::DOUBLE * k / n) AS INTEGER) AS quartile FROM (SELECT *, row_number() OVER (ORDER BY raw, hex_id) AS k, count(*) OVER () AS n FROM scores)",
    "s6_leave_one_out": W + ", o AS (" + " UNION ALL ".join(f"SELECT hex_id, '{x}' AS omitted, round(({' + '.join(f for f in FIELDS if f != x)}) / 4.0::DOUBLE, 9) AS score FROM scores" for x in FIELDS) + ") SELECT hex_id, omitted, score, " + _AVG.format(part="PARTITION BY omitted", keys="omitted, ", v="score") + " AS rank_avg FROM o",
    "s6_rank_movement": _PRE + f", k AS (SELECT {_avg('balanced')} AS a, {_avg('riparian_restoration')} AS b, count(*) OVER () AS n FROM pre), m AS (SELECT abs(100.0::DOUBLE * (b - 1) / (n - 1) - 100.0::DOUBLE * (a - 1) / (n - 1)) AS d FROM k) SELECT round(quantile_cont(d, 0.5), 6) AS median, round(max(d), 6) AS max, count(*) FILTER (WHERE d >= 10) AS at_least_10, count(*) FILTER (WHERE d >= 25) AS at_least_25, count(*) FILTER (WHERE d >= 40) AS at_least_40 FROM m",
    "s7_top_fraction": W + " SELECT hex_id, raw FROM scores JOIN " + _top("raw", "scores") + " USING (hex_id)",
    "s7_shortlists": _PRE + " SELECT preset, hex_id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY preset ORDER BY score DESC, hex_id) AS rank FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS preset, hex_id, {n} AS score FROM pre" for n in PRESETS) + ")) WHERE rank <= 50",
    "s7_custom_weight_rank": _custom(),
    "s7_skyband_rank": _custom(MANY, 10),
    "s7_tail_overlap": _PRE + f" SELECT count(*) AS tail, count(b.hex_id) AS shared FROM {_top('balanced')} a LEFT JOIN {_top('riparian_restoration')} b USING (hex_id)",
    "s7_consistent": _PRE + " " + " INTERSECT ".join(f"SELECT hex_id FROM {_top(n)}" for n in PRESETS),
    "s7_churn": _PRE + ", a AS (SELECT hex_id FROM pre ORDER BY riparian_restoration DESC, hex_id LIMIT 100), b AS (SELECT hex_id FROM pre ORDER BY balanced DESC, hex_id LIMIT 100) SELECT hex_id, 'entered' AS change FROM a ANTI JOIN b USING (hex_id) UNION ALL SELECT hex_id, 'left' FROM b ANTI JOIN a USING (hex_id)",
    "s8_presets": W + f" SELECT hex_id, {_schemes(PRESETS)} FROM scores",
    "s8_baseline": W + " SELECT hex_id, " + ", ".join(f"0.2::DOUBLE * {f} AS contribution_{f.removesuffix('_score')}" for f in FIELDS) + f", {_mean(PRESETS['balanced'])} AS balanced FROM scores",
    "s8_sensitivity_schemes": W + f" SELECT hex_id, {_schemes({'reference': PRESETS['balanced']} | SCHEMES)} FROM scores",
    "s8_compensability": _PRE + f" SELECT count(*) AS rows, count(*) FILTER (WHERE {_WEAK} >= 1) AS any_at_most_25, count(*) FILTER (WHERE {_LEAST} = 0) AS any_zero, count(*) FILTER (WHERE {_WEAK} >= 2) AS two_at_most_25, min({_LEAST}) AS least_component FROM scores JOIN {_top('balanced')} USING (hex_id)",
    "s8_consistent_strength": W + " SELECT " + ", ".join(f"count(*) FILTER (WHERE {_LEAST} >= {t}) AS all_at_least_{t}" for t in (20, 40, 50)) + " FROM scores",
    "s8_component_winners": W + " SELECT CASE " + " ".join(f"WHEN {f} = {_MOST} THEN '{f}'" for f in FIELDS) + " END AS winner, count(*) AS rows, count(*) FILTER (WHERE " + " + ".join(f"CAST({f} = {_MOST} AS INTEGER)" for f in FIELDS) + " > 1) AS tied_rows FROM scores GROUP BY 1",
    "s8_preset_winners": _PRE + " SELECT concat_ws('+', " + ", ".join(f"CASE WHEN {n} = {_PB} THEN '{n}' END" for n in PRESETS) + ") AS pattern, count(*) AS rows FROM pre GROUP BY 1",
    "s8_contribution_spread": W + " " + " UNION ALL ".join(f"SELECT '{s}' AS scheme, '{f}' AS field, round({_D(w)} * stddev_pop({f}), 6) AS spread FROM scores" for s, ws in PRESETS.items() for f, w in zip(FIELDS, ws, strict=True)),
    "s8_explanations": _phrases(),
}
QUERIES = {name: f for name, f in globals().items() if name[:1] == "s" and name[1:2].isdigit() and callable(f)}
