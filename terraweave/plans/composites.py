"""Queries of the composite audits: every figure of a model in one table, with the SQL made from the same lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.operators import cells, geometry, neighbours, profiles, ranks, scoring, stats
from terraweave.operators.composites import SUMMARY, Population, composite, metric_rows, tail_overlaps
from terraweave.operators.scoring import FIELDS, PRESETS
from terraweave.plans import cells as c
from terraweave.plans import chain
from terraweave.plans import relations as r
from terraweave.plans import scores as s
from terraweave.sources import projection as p

PARTS = {f: f"contribution_{f.removesuffix('_score')}" for f in FIELDS}
LEFT_OUT = {f: f"without_{f.removesuffix('_score')}" for f in FIELDS}
_BINS = {"0-10": "balanced <= 10", "10-25": "balanced > 10 and balanced <= 25", "25-50": "balanced > 25 and balanced <= 50", "50-75": "balanced > 50 and balanced <= 75", "75-90": "balanced > 75 and balanced <= 90", "90-100": "balanced > 90"}
_MATRIX = [*FIELDS, "balanced"]

BASELINE_POPULATIONS = {
    "all": Population("true", [*FIELDS, "balanced", *PARTS.values()], [(a, b) for i, a in enumerate(_MATRIX) for b in _MATRIX[i + 1 :]] + [("balanced", x) for x in LEFT_OUT.values()]),
    "boundary": Population("boundary_edge_flag", [*FIELDS, "balanced"]),
    "inner": Population("not boundary_edge_flag", [*FIELDS, "balanced"]),
}
BASELINE_FIGURES = (
    {("bins", "balanced", name): f"count_if({where})" for name, where in _BINS.items()}
    | {
        ("formula", "balanced", "mean_mismatches"): f"count_if(abs(balanced - ({' + '.join(FIELDS)}) / 5.0) > 1e-8)",
        ("formula", "balanced", "sum_mismatches"): f"count_if(abs(balanced - ({' + '.join(PARTS.values())})) > 1e-8)",
        ("formula", "balanced", "out_of_range"): "count_if(balanced < 0 or balanced > 100 or balanced is null)",
        ("population", "boundary", "rows"): "count_if(boundary_edge_flag)",
        ("population", "all", "rows"): "count(*)",
    }
    | {("influence", f, "spread"): f"stddev_pop({part})" for f, part in PARTS.items()}
    | {("influence", f, "covariance"): f"covar_pop({part}, balanced)" for f, part in PARTS.items()}
)

AXES = [f"bridge_axis_{k}_strength" for k in "abc"]
SHAPE = ["opposing_balance_ratio", "dominant_opposing_pair_share"]
AMOUNT = ["bridge_strength_max", "bridge_strength_mean", "neighbor_habitat_mean"]
HABITAT = ["habitat_local_fraction", "habitat_context_score", "habitat_adjacent_fraction"]
COMPOSITION = ["candidate_fraction_of_terrestrial", "habitat_fraction_of_terrestrial"]
_QUARTILES = {f"quartile {k}": Population(f"quartile = {k}", ["habitat_context_score"], [(a, b) for a in SHAPE for b in HABITAT[:2]]) for k in (1, 2, 3, 4)}
_SPLITS = {"whole ring": "adjacent_cells_missing = 0", "ring with gaps": "adjacent_cells_missing >= 1", "boundary": "boundary_edge_flag", "inner": "not boundary_edge_flag"}
NETWORK_POPULATIONS = (
    {"all": Population("true", [*AXES, *AMOUNT, *SHAPE], [("bridge_strength_max", "bridge_strength_mean"), tuple(SHAPE), *[(a, b) for a in SHAPE for b in AMOUNT], *[(a, b) for a in [*AMOUNT, *SHAPE] for b in HABITAT + COMPOSITION]])}
    | {name: Population(where, ["bridge_strength_max", "bridge_strength_mean", *SHAPE]) for name, where in _SPLITS.items()}
    | _QUARTILES
)
NETWORK_FIGURES = (
    {("strength", "bridge_strength_max", f"at_least_{t}"): f"count_if(bridge_strength_max >= {t})" for t in (0.25, 0.5, 0.75)}
    | {
        ("strength", "bridge_strength_max", "above_zero"): "count_if(bridge_strength_max > 0)",
        ("strength", "axes", "all_zero"): f"count_if({' and '.join(f'{a} = 0' for a in AXES)})",
        ("strongest axis", "tied", "rows"): "count_if(strongest_axis_tie_count >= 2)",
        ("check", "neighbor_habitat_mean", "out_of_range"): "count_if(neighbor_habitat_mean < 0 or neighbor_habitat_mean > 1)",
        ("check", "dominant_opposing_pair_share", "above_balance"): "count_if(dominant_opposing_pair_share > opposing_balance_ratio + 1e-8)",
        ("check", "shape", "not_zero_without_habitat"): f"count_if(neighbor_habitat_mean = 0 and ({' or '.join(f'{x} <> 0' for x in SHAPE)}))",
        ("check", "bridge_strength_max", "mismatches"): f"count_if(bridge_strength_max <> greatest({', '.join(AXES)}))",
        ("check", "bridge_strength_mean", "mismatches"): f"count_if(abs(bridge_strength_mean - ({' + '.join(AXES)}) / 3.0) > 1e-8)",
        ("check", "all", "missing_values"): f"count_if({' or '.join(f'{x} is null' for x in [*AMOUNT, *SHAPE, *HABITAT])})",
        ("population", "all", "rows"): "count(*)",
        ("population", "boundary", "rows"): "count_if(boundary_edge_flag)",
    }
    | {("check", x, "out_of_range"): f"count_if({x} < 0 or {x} > 1)" for x in SHAPE}
    | {("strongest axis", x, "rows"): f"count_if(strongest_axis = '{x}')" for x in ("axis_a", "axis_b", "axis_c")}
    | {("missing neighbours", str(k), "rows"): f"count_if(adjacent_cells_missing = {k})" for k in range(7)}
)


def s8_full_baseline_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of the equal-weight score: distributions, bins, formula checks, influence, correlations, omissions, tails, weak components and winners."""
    df = p.part_scores(spark, sf_dir)
    columns = {part: F.lit(0.2) * F.col(f) for f, part in PARTS.items()} | {x: F.round(sum((F.col(o) for o in FIELDS if o != f), F.lit(0.0)) / 4.0, 9) for f, x in LEFT_OUT.items()}
    wide = df.select("hex_id", *FIELDS, "boundary_edge_flag", F.round(scoring.weighted_mean(PRESETS["balanced"]), 9).alias("balanced")).withColumns(columns)
    table, rows = composite(wide, BASELINE_POPULATIONS, BASELINE_FIGURES)
    tails = profiles.tail_profiles(table, "balanced", FIELDS)
    weak = scoring.compensability(ranks.top_fraction(table, "balanced", 0.1))
    more = [
        metric_rows(tails, "tails", F.concat_ws(": ", "tail", "field"), ["rows", *profiles.PROFILE]), metric_rows(tail_overlaps(table, "balanced", list(LEFT_OUT.values())), "tenth", F.col("field"), ["rows", "shared"]),
        metric_rows(weak, "compensability", F.lit("balanced"), weak.columns), metric_rows(scoring.component_winners(table), "winners", F.col("winner"), ["rows", "tied_rows"]),
    ]
    for table in more:
        rows = rows.unionByName(table)
    return rows


def s5_full_network_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of the network indicators, read from the pixels: strengths, shapes, checks, correlations also by quartile of habitat, and the best shapes' tails."""
    counts = p.full_counts(spark, sf_dir)
    cand = cells.eligible(cells.analysis_units(counts)).select("hex_id", "grid_col", "grid_row", *COMPOSITION)
    near = neighbours.packed_network(counts, cells.is_eligible())
    rounded = {x: F.round(x, 9) for x in ("bridge_strength_mean", "neighbor_habitat_mean", *SHAPE)}
    joined = cand.join(near, ["grid_col", "grid_row"]).withColumns(rounded)
    flags = geometry.near_boundary(r._centres(cand), p.study_edges(spark, sf_dir), 1000.0)
    scored = ranks.percentile_score(joined, "habitat_local_fraction", "habitat_context_score").withColumn("habitat_context_score", F.round("habitat_context_score", 9))
    wide = ranks.quartiles(scored.join(flags, "hex_id"), "habitat_context_score").drop("grid_col", "grid_row")
    table, rows = composite(wide, NETWORK_POPULATIONS, NETWORK_FIGURES)
    edge = table.withColumn("edge", F.col("boundary_edge_flag").cast("double"))
    for x in SHAPE:
        tails = profiles.tail_profiles(edge, x, ["edge", "neighbor_habitat_mean", "bridge_strength_max", "habitat_context_score"])
        rows = rows.unionByName(metric_rows(tails, f"tails of {x}", F.concat_ws(": ", "tail", "field"), ["rows", *profiles.PROFILE]))
    return rows


def _row(section: str, subject: str, metric: str, value: str) -> str:
    return f"SELECT {section} AS section, {subject} AS subject, '{metric}' AS metric, round(CAST({value} AS DOUBLE), 6) AS value"


def _composite_sql(populations: dict[str, Population], figures: dict, tails: dict[str, list[str]]) -> str:
    """Parts of a composite over the table ``t``, after a WITH that ends in it."""
    named = {p: list(dict.fromkeys([*of.fields, *[x for pair in of.pairs for x in pair]])) for p, of in populations.items()}
    rows = " UNION ALL ".join(f"SELECT hex_id, '{p}' AS population, '{f}' AS field, CAST({f} AS DOUBLE) AS v FROM t WHERE {populations[p].condition}" for p, fields in named.items() for f in fields)
    points = ", ".join(f"quantile_cont(v, {q}) AS {n}" for n, q in stats.POINTS.items())
    asked = ", ".join(f"('{p}', '{f}')" for p, of in populations.items() for f in of.fields)
    sql = f""", long AS MATERIALIZED ({rows}), placed AS (SELECT *, rank() OVER (PARTITION BY population, field ORDER BY v) + (count(*) OVER (PARTITION BY population, field, v) - 1) / 2.0::DOUBLE AS k FROM long WHERE v IS NOT NULL),
      sm AS MATERIALIZED (SELECT population, field, count(v) AS n, count(*) FILTER (WHERE v IS NULL) AS missing, min(v) AS min, avg(v) AS mean, stddev_pop(v) AS std, max(v) AS max, {points} FROM long WHERE (population, field) IN ({asked}) GROUP BY 1, 2),
      wide AS MATERIALIZED (SELECT hex_id, population, """
    every = list(dict.fromkeys(f for fields in named.values() for f in fields))
    sql += ", ".join(f"max(k) FILTER (WHERE field = '{f}') AS {f}" for f in every) + " FROM placed GROUP BY 1, 2)"
    parts = [_row(f"'{a}'", f"'{b}'", m, e) + " FROM t" for (a, b, m), e in figures.items()]
    parts += [_row("'distribution'", "population || ': ' || field", m, m) + " FROM sm" for m in [*SUMMARY, *stats.POINTS]]
    for population, of in populations.items():
        for a, b in of.pairs:
            value = f"CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN corr({a}, {b}) END"
            for method, source, where in (("pearson", "t", of.condition), ("spearman", "wide", f"population = '{population}'")):
                parts.append(_row("'correlation'", f"'{population}: {a} ~ {b}'", method, value) + f" FROM {source} WHERE {where}")
    for i, (score, fields) in enumerate(tails.items()):
        sql += f", tails{i} AS MATERIALIZED ({chain.tails_sql('t', score, fields)})"
        section = "tails" if score == "balanced" else f"tails of {score}"
        parts += [_row(f"'{section}'", "tail || ': ' || field", m, m) + f" FROM tails{i}" for m in ("rows", *profiles.PROFILE)]
    return sql + " " + " UNION ALL ".join(parts)


def _baseline() -> str:
    left_out = ", ".join(f"round(({' + '.join(x for x in FIELDS if x != f)}) / 4.0::DOUBLE, 9) AS {n}" for f, n in LEFT_OUT.items())
    parts = ", ".join(f"0.2::DOUBLE * {f} AS {n}" for f, n in PARTS.items())
    out = s.W + f", t AS MATERIALIZED (SELECT hex_id, {', '.join(FIELDS)}, boundary_edge_flag, round({s._mean(PRESETS['balanced'])}, 9) AS balanced, {parts}, {left_out} FROM scores)" + _composite_sql(BASELINE_POPULATIONS, BASELINE_FIGURES, {"balanced": FIELDS})
    for n in LEFT_OUT.values():
        for metric, join in (("rows", ""), ("shared", f" JOIN {s._top('balanced', 't')} y USING (hex_id)")):
            out += " UNION ALL " + _row("'tenth'", f"'{n}'", metric, "count(*)") + f" FROM {s._top(n, 't')} x{join}"
    weak, least, most = s._WEAK, s._LEAST, s._MOST
    for metric, value in {"rows": "count(*)", "any_at_most_25": f"count(*) FILTER (WHERE {weak} >= 1)", "any_zero": f"count(*) FILTER (WHERE {least} = 0)", "two_at_most_25": f"count(*) FILTER (WHERE {weak} >= 2)", "least_component": f"min({least})"}.items():
        out += " UNION ALL " + _row("'compensability'", "'balanced'", metric, value) + f" FROM t JOIN {s._top('balanced', 't')} y USING (hex_id)"
    winner = "CASE " + " ".join(f"WHEN {f} = {most} THEN '{f}'" for f in FIELDS) + " END"
    tied = " + ".join(f"CAST({f} = {most} AS INTEGER)" for f in FIELDS)
    for metric, value in {"rows": "count(*)", "tied_rows": f"count(*) FILTER (WHERE {tied} > 1)"}.items():
        out += " UNION ALL " + _row("'winners'", winner, metric, value) + f" FROM t GROUP BY {winner}"
    return out


def _network() -> str:
    fields = c.ORACLES["s5_network_indicators"].removeprefix(c.CELLS).removeprefix(chain._NETWORK)
    quartile = "CAST(ceil(4.0::DOUBLE * row_number() OVER (ORDER BY habitat_context_score, hex_id) / count(*) OVER ()) AS INTEGER) AS quartile"
    table = f"""{chain.MODEL_SQL}, net AS ({fields}), t AS MATERIALIZED (SELECT hex_id, {', '.join([*AXES, *AMOUNT, *SHAPE])}, strongest_axis, strongest_axis_tie_count, adjacent_cells_missing,
      {', '.join(f'h.{x}' for x in HABITAT if x != 'habitat_context_score')}, habitat_context_score, model.candidate_fraction_of_terrestrial, cand.habitat_fraction_of_terrestrial, boundary_edge_flag, CAST(boundary_edge_flag AS DOUBLE) AS edge, {quartile}
      FROM (SELECT hex_id, habitat_context_score, candidate_fraction_of_terrestrial, boundary_edge_flag FROM model) model JOIN net USING (hex_id) JOIN sh_habitat h USING (hex_id) JOIN cand USING (hex_id))"""
    return table + _composite_sql(NETWORK_POPULATIONS, NETWORK_FIGURES, {x: ["edge", "neighbor_habitat_mean", "bridge_strength_max", "habitat_context_score"] for x in SHAPE})


ORACLES = {"s8_full_baseline_audit": _baseline(), "s5_full_network_audit": _network()}
QUERIES = {name: f for name, f in globals().items() if name[:1] == "s" and name[1:2].isdigit() and callable(f)}
