"""The whole chain from pixels over five component scores to presets, lists and the delivered frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import cells, components, delivery, geometry, neighbours, profiles, scoring
from terraweave.operators.components import EVIDENCE, FLAG
from terraweave.operators.scoring import FIELDS, PRESETS
from terraweave.plans import cells as c
from terraweave.plans import relations as r
from terraweave.plans import scores as s
from terraweave.sources import projection as p
from terraweave.sources import publish
from terraweave.sources.storage import materialise, new_path


def indicators(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Candidates with the raw fields of all components, and their boundary flags; pixels are read once, neighbours are looked up in one pass."""
    counts = p.full_counts(spark, sf_dir)
    cand = cells.eligible(cells.analysis_units(counts))
    share = lambda part, whole: F.try_divide(part * F.lit(1.0), whole)
    water, land = F.col("inland_water_pixels"), F.col("terrestrial_pixels")
    own = cand.select(
        "hex_id", "grid_col", "grid_row", "candidate_fraction_of_terrestrial", (F.col("candidate_area_m2") / 10000.0).alias("candidate_land_area_ha"), share(F.col("artificial_pixels"), land).alias("artificial_focal_fraction"),
        share(F.col("wetland_context_pixels") + water, land + water).alias("riparian_focal_fraction"), share(F.col("protected_pixels"), land).alias("protected_focal_fraction"),
    )
    near = neighbours.packed_indicators(counts, cells.is_eligible()).select("grid_col", "grid_row", F.col("habitat_local_fraction"), F.round("opposing_balance_ratio", 9).alias("opposing_balance_ratio"))
    steps = neighbours.nearest_steps(own, counts.where("protected_pixels > 0")).withColumnRenamed("steps", "nearest_protected_hex_steps")
    out = own.join(near, ["grid_col", "grid_row"], "left").join(steps, "hex_id", "left")
    flags = geometry.near_boundary(r._centres(own), p.study_edges(spark, sf_dir), 1000.0)
    return materialise(out, "indicators"), materialise(flags, "flags")


def _table(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    raw, flags = indicators(spark, sf_dir)
    return components.component(raw, flags, field).withColumn(field, F.round(field, 9))


def model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with five reconciled component scores, written once."""
    raw, flags = indicators(spark, sf_dir)
    tables = {f: components.component(raw, flags, f).withColumn(f, F.round(f, 9)) for f in FIELDS}
    return materialise(components.reconcile(raw.select("hex_id", "grid_col", "grid_row"), tables), "model")


def s5_packed_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbourhood fields of every component for all candidates, from one packed pass."""
    found = neighbours.packed_indicators(p.full_counts(spark, sf_dir), cells.is_eligible())
    rounded = {"opposing_balance_ratio": F.round("opposing_balance_ratio", 9)}
    return found.select(hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")).alias("hex_id"), *found.columns[2:]).withColumns(rounded)


def s6_network_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, FIELDS[1])


def s6_protected_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, FIELDS[3])


def s6_land_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, FIELDS[4])


def s8_reconciled_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model(spark, sf_dir).drop("grid_col", "grid_row")


def s8_delivery_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.delivery_frame(model(spark, sf_dir))


def s8_published_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered frame, published as a version in the order of its ids and read back with its digest checked."""
    path = new_path(spark, "published")
    publish.publish(components.delivery_frame(model(spark, sf_dir)), path, ["hex_id"])
    return publish.read_published(spark, path, verify=True)


def s7_weight_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.weight_index(model(spark, sf_dir)).withColumns({k: F.round(k, 5) for k in ("longitude", "latitude")})


def s8_bounds_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components.bounds_check(components.weight_index(model(spark, sf_dir)))
    return found.select(*[F.round(k, 5).alias(k) for k in found.columns if k != "outside"], "outside")


def s7_model_shortlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 50 of every preset, scored from pixels."""
    presets = scoring.with_schemes(model(spark, sf_dir), PRESETS)
    return delivery.shortlists(presets.select("hex_id", *[F.round(n, 9).alias(n) for n in PRESETS]), list(PRESETS))


def s7_model_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = model(spark, sf_dir)
    return profiles.tail_profiles(frame.withColumn("balanced", F.round(scoring.weighted_mean(PRESETS["balanced"]), 9)), "balanced", FIELDS)


def s5_zero_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Habitat and network scores of the candidates without riparian opportunity."""
    return profiles.population_profile(model(spark, sf_dir), F.col(FIELDS[2]) == 0, FIELDS[:2])


def s5_overlap_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protected share and component scores of the candidates that hold protected land themselves."""
    return profiles.population_profile(model(spark, sf_dir), F.col("nearest_protected_hex_steps") == 0, ["protected_focal_fraction", *FIELDS[:3]])


def s5_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by which of wetland and inland water they hold more of."""
    counts = p.counts(spark, sf_dir)
    own = cells.eligible(cells.analysis_units(counts)).select("grid_col", "grid_row").join(cells.hydrology(counts), ["grid_col", "grid_row"])
    return profiles.characters(own, "wetland_pixels", "water_pixels", "nonmarine_pixels")


def s5_subtype_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of building, other and transport pixels in artificial land."""
    from terraweave.operators import semantics

    names = {51: "artificial_building_pixels", 52: "artificial_other_pixels", 53: "artificial_transport_pixels"}
    of = p.pixels(spark, sf_dir).groupBy("grid_col", "grid_row").agg(F.count_if(cells.has_role("terrestrial_land")).alias("terrestrial_pixels"), *[F.count_if(F.col("code") == code).alias(n) for code, n in names.items()])
    assert set(names) <= {x for codes in semantics.GROUP_CODES.values() for x in codes}
    return profiles.subtype_shares(of, list(names.values()), "terrestrial_pixels")


def s5_water_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Riparian shares on the full grid against those without cells of water alone."""
    hydro, keep = c._hydrology(spark, sf_dir)
    full = materialise(neighbours.packed_riparian(hydro, keep), "full")
    land = materialise(neighbours.packed_riparian(hydro.where("terrestrial_pixels > 0"), keep), "land")
    return profiles.differences(full, land, ["riparian_adjacent_fraction", "riparian_local_fraction"])


def s6_rank_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How candidate area and candidate share rank the candidates differently."""
    cand = cells.eligible(p.units(spark, sf_dir)).select("hex_id", "candidate_area_m2", "candidate_fraction_of_terrestrial")
    return profiles.rank_differences(cand, "candidate_area_m2", "candidate_fraction_of_terrestrial")


def _share(part: str, whole: str, grid: str, prefix: str) -> str:
    text = c._near(part, whole, grid, prefix)
    return text.replace(", near AS (", f", near_{prefix} AS (").replace("FROM near\n", f"FROM near_{prefix}\n").replace(", sh AS (", f", sh_{prefix} AS (")


_WINDOW = "CASE WHEN {v} IS NOT NULL THEN rank() OVER (ORDER BY {v}) + (count(*) OVER (PARTITION BY {v}) - 1) / 2.0::DOUBLE END"
_NETWORK = c.ORACLES["s5_network_indicators"].removeprefix(c.CELLS).split("SELECT hex_id, a AS bridge_axis_a_strength", 1)[0]
MODEL_SQL = (
    c.CELLS + "," + p.PROTECTED_SQL + c._PGRID + ", " + r._STUDY_EDGES + f", {r._CENTRES}"
    + _share("habitat_context_pixels", "terrestrial_pixels", "units", "habitat")
    + _NETWORK
    + f""", nr AS (SELECT hex_id, round(coalesce(2 * (a + b + c) / nullif(t, 0), 0), 9) AS opposing_balance_ratio FROM m),
st AS (SELECT c.hex_id, CAST(min(greatest(abs(c.grid_col - s.grid_col), abs(c.grid_row - s.grid_row), abs(c.grid_col - s.grid_col + c.grid_row - s.grid_row))) AS INTEGER) AS nearest_protected_hex_steps FROM cand c, (SELECT * FROM pg WHERE protected_pixels > 0) s GROUP BY 1),
fl AS (SELECT hex_id, min({r._PS('c.x', 'c.y', *r._B1, *r._B2)}) <= 1000 AS boundary_edge_flag FROM cen c, study t GROUP BY 1),
raw AS (
  SELECT cand.hex_id, cand.grid_col, cand.grid_row, habitat_local_fraction, opposing_balance_ratio, h.hydrologic_pixels * 1.0::DOUBLE / nullif(h.nonmarine_pixels, 0) AS riparian_focal_fraction,
    nearest_protected_hex_steps, protected_fraction AS protected_focal_fraction, candidate_area_m2 / 10000.0::DOUBLE AS candidate_land_area_ha, artificial_pixels * 1.0::DOUBLE / cand.terrestrial_pixels AS artificial_focal_fraction, boundary_edge_flag,
    candidate_area_m2, candidate_fraction_of_terrestrial, h.wetland_pixels, h.water_pixels, h.nonmarine_pixels
  FROM cand LEFT JOIN sh_habitat USING (hex_id) LEFT JOIN nr USING (hex_id) LEFT JOIN hyd h USING (grid_col, grid_row) LEFT JOIN st USING (hex_id) LEFT JOIN pg USING (grid_col, grid_row) LEFT JOIN fl USING (hex_id)
), rk AS (
  SELECT *, {_WINDOW.format(v='habitat_local_fraction')} AS r0, count(habitat_local_fraction) OVER () AS n0, {_WINDOW.format(v='candidate_land_area_ha')} AS r4, count(*) OVER () AS n4 FROM raw
), rp AS (
  SELECT hex_id, {_WINDOW.format(v='riparian_focal_fraction')} AS r2, count(*) OVER () AS n2 FROM raw WHERE riparian_focal_fraction > 0
), rs AS (
  SELECT hex_id, {_WINDOW.format(v='nearest_protected_hex_steps')} AS r3, count(*) OVER () AS n3 FROM raw WHERE nearest_protected_hex_steps > 0
), model AS (
  SELECT rk.*, round(CASE WHEN n0 > 1 THEN 100.0::DOUBLE * (r0 - 1) / (n0 - 1) WHEN r0 IS NOT NULL THEN 0 END, 9) AS {FIELDS[0]}, round(100.0::DOUBLE * opposing_balance_ratio, 9) AS {FIELDS[1]},
    round(CASE WHEN riparian_focal_fraction = 0 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * r2 / n2 END, 9) AS {FIELDS[2]},
    round(CASE WHEN nearest_protected_hex_steps = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE * (n3 - r3 + 1) / (n3 + 1) END, 9) AS {FIELDS[3]},
    round(CASE WHEN n4 > 1 THEN 100.0::DOUBLE * (r4 - 1) / (n4 - 1) ELSE 0 END, 9) AS {FIELDS[4]}
  FROM rk LEFT JOIN rp USING (hex_id) LEFT JOIN rs USING (hex_id)
)"""
)
_FIXED = lambda v, d: f"CAST(format('{{:.{d}f}}', {v}) AS DOUBLE) + 0.0::DOUBLE"


def _round_sql(value: str, digits: int) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN {_FIXED(value, digits)} END"


def _delivered() -> str:
    columns = [f"{_round_sql(s._mean(w), 3)} AS {n}" for n, w in PRESETS.items()] + [f"{_round_sql(f, 3)} AS {f}" for f in FIELDS]
    for raw, more in EVIDENCE.values():
        columns += [f"nearest_protected_hex_steps" if x.endswith("_steps") else f"{_round_sql(x, 2 if x.endswith('_ha') else 5)} AS {x}" for x in (raw, *more)]
    return MODEL_SQL + f" SELECT hex_id, {', '.join(columns)}, {FLAG} FROM model"


#: Inverse transverse Mercator as a flattened series of latitude and longitude in powers of the meridian's footpoint.
_N = (1 / 298.257222101) / (2 - 1 / 298.257222101)
_A = 0.9996 * 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_D = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_G = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_HYP = lambda f, v: f"((exp({v}) {'+' if f == 'cosh' else '-'} exp(-({v}))) / 2)"
_LONLAT = (
    f""", g0 AS (SELECT *, y / {_A!r}::DOUBLE AS xi, (x - 500000.0) / {_A!r}::DOUBLE AS eta FROM model JOIN cen USING (hex_id)),
g1 AS (SELECT *, xi"""
    + "".join(f" - {_D[j]!r}::DOUBLE * sin({2 * (j + 1)} * xi) * {_HYP('cosh', f'{2 * (j + 1)} * eta')}" for j in range(3)) + " AS x1, eta"
    + "".join(f" - {_D[j]!r}::DOUBLE * cos({2 * (j + 1)} * xi) * {_HYP('sinh', f'{2 * (j + 1)} * eta')}" for j in range(3)) + f""" AS e1 FROM g0),
g2 AS (SELECT *, asin(sin(x1) / {_HYP('cosh', 'e1')}) AS chi, degrees(atan2({_HYP('sinh', 'e1')}, cos(x1))) + 15 AS longitude FROM g1),
place AS (SELECT *, degrees(chi"""
    + "".join(f" + {_G[j]!r}::DOUBLE * sin({2 * (j + 1)} * chi)" for j in range(3)) + ") AS latitude FROM g2)"
)
_POINTS = "round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.9), 6) AS p90"


def _population(where: str, fields: list[str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{f}' AS field, CAST({f} AS DOUBLE) AS v FROM model WHERE {where}" for f in fields)
    return MODEL_SQL + f" SELECT field, count(*) AS rows, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM model), 6) AS percent, {_POINTS} FROM ({rows}) GROUP BY field"


def tails_sql(source: str, score: str, fields: list[str]) -> str:
    ranked = f"(SELECT *, row_number() OVER (ORDER BY {score} DESC NULLS LAST, hex_id) AS k, count(*) OVER () AS n FROM {source})"
    rows = " UNION ALL ".join(f"SELECT '{t}' AS tail, '{f}' AS field, {f} AS v FROM {ranked} WHERE k <= greatest(1, ceil(n * {x}::DOUBLE))" for t, x in profiles.TAILS.items() for f in fields)
    return f"SELECT tail, field, count(*) AS rows, {_POINTS} FROM ({rows}) GROUP BY tail, field"


_WATER = c._RIPARIAN.removesuffix("") + _share("hydrologic_pixels", "nonmarine_pixels", "(SELECT * FROM hyd WHERE terrestrial_pixels > 0)", "land") + """, d AS (
  SELECT 'riparian_adjacent_fraction' AS field, riparian_adjacent_fraction AS a, land_adjacent_fraction AS b FROM rip JOIN sh_land USING (hex_id)
  UNION ALL SELECT 'riparian_local_fraction', riparian_local_fraction, land_local_fraction FROM rip JOIN sh_land USING (hex_id))
SELECT field, count(*) AS rows, count(*) FILTER (WHERE abs(a - b) > 1e-12) AS affected, round(coalesce(quantile_cont(CASE WHEN abs(a - b) > 1e-12 THEN abs(a - b) END, 0.5), 0), 9) AS median,
  round(coalesce(max(CASE WHEN abs(a - b) > 1e-12 THEN abs(a - b) END), 0), 9) AS largest, count(*) FILTER (WHERE a IS NULL) AS first_missing, count(*) FILTER (WHERE b IS NULL) AS second_missing FROM d GROUP BY field"""
_KINDS = "CASE WHEN wetland_pixels > water_pixels THEN 'wetland_pixels' WHEN water_pixels > wetland_pixels THEN 'water_pixels' ELSE 'tie' END"
_SUB = {51: "artificial_building_pixels", 52: "artificial_other_pixels", 53: "artificial_transport_pixels"}

_PACKED = {"h": "s5_habitat_indicators", "a": "s5_land_indicators", "w": "s5_riparian_indicators", "o": "s5_protected_indicators", "n": "s5_network_indicators"}
_PACKED_SQL = (
    "WITH " + ", ".join(f"{k} AS ({c.ORACLES[q]})" for k, q in _PACKED.items())
    + " SELECT hex_id, riparian_adjacent_cells AS adjacent_cells, riparian_local_cells AS local_cells, "
    + ", ".join(f"{n}_{w}_fraction" for n in ("habitat", "artificial", "riparian", "protected") for w in ("adjacent", "local"))
    + ", bridge_strength_max, opposing_balance_ratio FROM h JOIN a USING (hex_id) JOIN w USING (hex_id) JOIN o USING (hex_id) JOIN n USING (hex_id)"
)

ORACLES = {
    "s5_packed_indicators": _PACKED_SQL,
    "s6_network_score": MODEL_SQL + f" SELECT hex_id, opposing_balance_ratio, {FIELDS[1]}, boundary_edge_flag FROM model",
    "s6_protected_score": MODEL_SQL + f" SELECT hex_id, nearest_protected_hex_steps, {FIELDS[3]}, protected_focal_fraction, boundary_edge_flag FROM model",
    "s6_land_score": MODEL_SQL + f" SELECT hex_id, candidate_land_area_ha, {FIELDS[4]}, artificial_focal_fraction, boundary_edge_flag FROM model",
    "s8_reconciled_components": MODEL_SQL + " SELECT hex_id, " + ", ".join(f"{raw}, {f}{''.join(', ' + m for m in more)}" for f, (raw, more) in EVIDENCE.items()) + ", boundary_edge_flag FROM model",
    "s8_delivery_frame": _delivered(),
    "s7_weight_index": MODEL_SQL + _LONLAT + f" SELECT hex_id, round(round(longitude, 6), 5) AS longitude, round(round(latitude, 6), 5) AS latitude, {', '.join(f'{_round_sql(f, 3)} AS {f}' for f in FIELDS)} FROM place",
    "s8_bounds_check": MODEL_SQL + _LONLAT + " SELECT round(min(longitude), 5) AS min_longitude, round(max(longitude), 5) AS max_longitude, round(min(latitude), 5) AS min_latitude, round(max(latitude), 5) AS max_latitude, count(*) FILTER (WHERE NOT (longitude BETWEEN 11 AND 15.5 AND latitude BETWEEN 54.5 AND 57.5)) AS outside FROM place",
    "s7_model_shortlists": MODEL_SQL + ", pre AS (SELECT hex_id, " + ", ".join(f"round({s._mean(w)}, 9) AS {n}" for n, w in PRESETS.items()) + " FROM model)" + s.ORACLES["s7_shortlists"].removeprefix(s._PRE),
    "s7_model_tails": MODEL_SQL + f", b AS (SELECT *, round({s._mean(PRESETS['balanced'])}, 9) AS balanced FROM model) " + tails_sql("b", "balanced", FIELDS),
    "s5_zero_profile": _population(f"{FIELDS[2]} = 0", FIELDS[:2]),
    "s5_overlap_profile": _population("nearest_protected_hex_steps = 0", ["protected_focal_fraction", *FIELDS[:3]]),
    "s5_characters": MODEL_SQL + f" SELECT {_KINDS} AS character, count(*) AS rows, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM model), 6) AS percent, CAST(sum(wetland_pixels) AS BIGINT) AS first_sum, CAST(sum(water_pixels) AS BIGINT) AS second_sum, round(avg(wetland_pixels * 1.0::DOUBLE / nullif(nonmarine_pixels, 0)), 9) AS first_share, round(avg(water_pixels * 1.0::DOUBLE / nullif(nonmarine_pixels, 0)), 9) AS second_share FROM model GROUP BY 1",
    "s5_subtype_shares": c.PIX + ", g AS (SELECT grid_col, grid_row, count(*) FILTER (WHERE code NOT IN (61, 62)) AS w, " + ", ".join(f"count(*) FILTER (WHERE code = {k}) AS {n}" for k, n in _SUB.items()) + " FROM px GROUP BY 1, 2), u AS (" + " UNION ALL ".join(f"SELECT '{n}' AS subtype, {n} AS v, w FROM g" for n in _SUB.values()) + "), t AS (SELECT subtype, CAST(sum(v) AS BIGINT) AS pixels, round(avg(v * 1.0::DOUBLE / nullif(w, 0)), 9) AS mean_fraction FROM u GROUP BY 1) SELECT subtype, pixels, pixels * 1.0::DOUBLE / (SELECT sum(pixels) FROM t) AS share, mean_fraction FROM t",
    "s5_water_only": _WATER,
    "s6_rank_fraction": c.CELLS + f", k AS (SELECT {s._avg('candidate_area_m2')} AS a, {s._avg('candidate_fraction_of_terrestrial')} AS b, count(*) OVER () AS n FROM cand), g AS (SELECT a, b, abs(b / n - a / n) AS gap FROM k) SELECT count(*) AS rows, round(max(gap), 9) AS largest, count(*) FILTER (WHERE gap >= 0.10) AS at_least_10, count(*) FILTER (WHERE gap >= 0.25) AS at_least_25, round(corr(a, b), 6) AS spearman, round(quantile_cont(gap, 0.5), 9) AS median, round(quantile_cont(gap, 0.9), 9) AS p90 FROM g",
    "s8_features": c.CELLS + f", {r._CENTRES}" + _LONLAT.replace("FROM model JOIN cen", "FROM cand JOIN cen") + " SELECT hex_id, round(longitude, 4) AS lon, round(latitude, 4) AS lat, hex_id AS feature_id, CAST(7 AS INTEGER) AS ring_points FROM place",
}
ORACLES["s8_published_frame"] = ORACLES["s8_delivery_frame"]
QUERIES = {name: f for name, f in globals().items() if name[:1] == "s" and name[1:2].isdigit() and callable(f)}
