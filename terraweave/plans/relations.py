"""Queries of distances, patches, coverage, pairs, movers and audits."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import audits, bands, cells, delivery, geometry, patches
from terraweave.operators.scoring import FIELDS, PRESETS, SCHEMES, with_schemes
from terraweave.plans import scores as s
from terraweave.sources import projection as p
from terraweave.sources import sinks
from terraweave.sources.storage import materialise, new_path

DIGITS = {"habitat_context_score": 3, "share": 5, "hectares": 2}


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds on and around the study area, one a customer."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("feature_id"), F.expr("385000 + (c_custkey * 3701 % 42000) + 0.3D").alias("cx"), F.expr("6190000 + (c_custkey * 977 % 320000) + 0.3D").alias("cy"), F.expr("CAST(150 + (c_custkey % 5) * 60 AS DOUBLE)").alias("r")
    )


def _centres(units: DataFrame) -> DataFrame:
    x, y = hexgrid.centre(F.col("grid_col"), F.col("grid_row"))
    return units.select("hex_id", x.alias("x"), y.alias("y"))


def _layer_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strips with a version, one a nation, of 12 km or a multiple that covers the study area."""
    height = 12000.0 * (1 + math.ceil((p.study(spark, sf_dir)[2][1] - p.NORTH) / 300000.0))
    y = F.lit(6199000.0) + F.col("n_nationkey") * F.lit(height)
    version = F.expr("CASE WHEN n_nationkey % 5 = 4 THEN 'v1.9' ELSE concat('NMD v2.', n_nationkey % 3) END")
    strips = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("feature_id"), version.alias("version"), y.alias("y"))
    west, east = F.lit(400000.0), F.lit(413000.0)
    side = lambda x, up: F.struct(x.alias("x1"), F.col("y").alias("y1"), x.alias("x2"), up.alias("y2"))
    up = F.col("y") + F.lit(height)
    return strips.select("feature_id", "version", F.explode(F.array(side(west, up), side(east, up))).alias("e")).select("feature_id", "version", "e.*")


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.part_scores(spark, sf_dir).select("hex_id", F.col("habitat_context_score"), (F.col("raw") / 7.0).alias("share"), (F.col("raw") / 3.0).alias("hectares"))
    rounded = {f"{f}_delivered": delivery.exact_round(d)(F.col(f)) for f, d in DIGITS.items()}
    rounded["share_delivered"] = F.when(F.col("share") == 1.0, 1.5).otherwise(rounded["share_delivered"])
    return rows.withColumns(rounded)


def _preset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = {"reference": PRESETS["balanced"]} | SCHEMES
    scored = p.part_scores(spark, sf_dir)
    schemes = with_schemes(scored, every)
    return schemes.select("hex_id", *[F.round(c, 9).alias(c) for c in every]).join(scored.select("hex_id", *FIELDS), "hex_id")


def s2_coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.coverage(p.pixels(spark, sf_dir), _layer_edges(spark, sf_dir))


def s3_context_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = geometry.within(p.diamond_edges(_customers(spark, sf_dir)), p.study_edges(spark, sf_dir), 5000.0)
    return found.select("feature_id", F.round("distance", 6).alias("distance"))


def s3_boundary_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.near_boundary(_centres(cells.eligible(p.units(spark, sf_dir))), p.study_edges(spark, sf_dir), 1000.0)


def s3_footprint_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every candidate's centre to the footprint, and whether it lies inside."""
    edges = materialise(p.footprint_edges(spark, sf_dir), "footprint-edges")
    points = materialise(_centres(cells.eligible(p.units(spark, sf_dir))).select("hex_id", F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2")), "centres")
    found = geometry.nearest(points, edges)
    return found.select("hex_id", F.round("distance", 6).alias("distance"), (F.col("distance") == 0).alias("centre_within"))


def s3_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patches.sizes(patches.label(p.pixels(spark, sf_dir).where(cells.has_role("primary_candidate"))))


def s3_patch_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patches.accounting(s3_patches(spark, sf_dir))


def s3_patch_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perimeter of every protected patch from its outline."""
    sides = patches.sides(patches.label(p.footprint_runs(spark, sf_dir)))
    length = F.col("x2") - F.col("x1") + F.col("y2") - F.col("y1")
    return sides.groupBy("patch").agg((F.sum(length) * 10.0).alias("perimeter_m"), F.min("x1").alias("min_x"), F.max("y2").alias("max_y"))


def s4_adjacent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.adjacent_pairs(p.part_scores(spark, sf_dir), FIELDS[0], [FIELDS[2], "raw"])


def s4_contrast_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest contrasts of two indicators among rows of nearly one score."""
    scored = p.part_scores(spark, sf_dir)
    parts = [bands.contrast_pairs(scored, FIELDS[0], v).select(F.lit(v).alias("field"), "*") for v in (FIELDS[2], "raw")]
    return parts[0].unionByName(parts[1])


def s6_extreme_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.extreme_movers(_preset_rows(spark, sf_dir), "reference", list(SCHEMES))


def s7_thematic_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.thematic_effect(_preset_rows(spark, sf_dir), "reference", list(SCHEMES), FIELDS[2], 75.0)


def s8_rounding_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.rounding_audit(_delivered(spark, sf_dir), DIGITS)


def s8_payload_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.payload(delivery.features(cells.eligible(p.units(spark, sf_dir)), ["hex_id", "candidate_pixels"]))


def s1_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-precision CSV, written to the shared folder and read back as text."""
    path = new_path(spark, "csv")
    sinks.write_csv(p.part_scores(spark, sf_dir).select("hex_id", (F.col("raw") / 8.0).alias("value"), F.expr("nullif(raw, 7.0D)").alias("gap")), path)
    return spark.read.csv(path, header=True, schema="hex_id string, value string, gap string")


def s1_audit_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON audit rows; division by zero comes back as null."""
    path = new_path(spark, "json")
    sinks.write_audit(p.part_scores(spark, sf_dir).groupBy("steps").agg(F.count("*").alias("rows"), F.try_divide(F.sum("raw"), F.max("steps")).alias("ratio")), path)
    return spark.read.schema("steps int, rows long, ratio double").json(path)


_CELLS = "WITH " + p.CELL_SQL
#: The study area; its corners in the north are in the table of that name.
_CORNERS = [("400150.3::DOUBLE", "6199000.7::DOUBLE"), ("412700.3::DOUBLE", "6199500.7::DOUBLE"), ("412300.3::DOUBLE", "(SELECT n FROM north)"), ("400450.3::DOUBLE", "(SELECT n FROM north)")]
_SIDES = list(zip(_CORNERS, [*_CORNERS[1:], _CORNERS[0]], strict=True))
_STUDY_EDGES = "study(x1, y1, x2, y2) AS (" + " UNION ALL ".join(f"SELECT {a[0]}, {a[1]}, {b[0]}, {b[1]}" for a, b in _SIDES) + ")"
_NORTH = p.PIXEL_SQL.split("sel AS", 1)[0].strip().rstrip(",")
#: Macros can't be made in one statement, so the distance of a point and a segment is a text.
_PS = lambda x, y, x1, y1, x2, y2: (
    f"sqrt(pow({x} - ({x1} + least(1, greatest(0, (({x} - {x1}) * ({x2} - {x1}) + ({y} - {y1}) * ({y2} - {y1})) / (pow({x2} - {x1}, 2) + pow({y2} - {y1}, 2)))) * ({x2} - {x1})), 2)"
    f" + pow({y} - ({y1} + least(1, greatest(0, (({x} - {x1}) * ({x2} - {x1}) + ({y} - {y1}) * ({y2} - {y1})) / (pow({x2} - {x1}, 2) + pow({y2} - {y1}, 2)))) * ({y2} - {y1})), 2))"
)
_INSIDE_STUDY = " AND ".join(f"({b[0]} - {a[0]}) * ({{y}} - {a[1]}) - ({b[1]} - {a[1]}) * ({{x}} - {a[0]}) > 0" for a, b in _SIDES)
_DIAMOND = "SELECT feature_id, cx, cy, r, cx + dx * r AS x1, cy + dy * r AS y1, cx + ex * r AS x2, cy + ey * r AS y2 FROM {src}, (VALUES (1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1), (0, -1, 1, 0)) v(dx, dy, ex, ey)"
_CENTRES = f"cen AS (SELECT hex_id, (grid_col + grid_row / 2.0::DOUBLE) * 500.0::DOUBLE AS x, grid_row * {1.5 * hexgrid.SIDE!r}::DOUBLE AS y FROM cand)"
_SIDE = lambda a, b, c: f"sign(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))"
_A1, _A2, _B1, _B2 = ("d.x1", "d.y1"), ("d.x2", "d.y2"), ("t.x1", "t.y1"), ("t.x2", "t.y2")
_GAP = f"CASE WHEN {_SIDE(_A1, _A2, _B1)} * {_SIDE(_A1, _A2, _B2)} < 0 AND {_SIDE(_B1, _B2, _A1)} * {_SIDE(_B1, _B2, _A2)} < 0 THEN 0 ELSE least({_PS(*_A1, *_B1, *_B2)}, {_PS(*_A2, *_B1, *_B2)}, {_PS(*_B1, *_A1, *_A2)}, {_PS(*_B2, *_A1, *_A2)}) END"
_SCHEMES = s.W + ", pre AS (SELECT hex_id, " + ", ".join(f"round({s._mean(w)}, 9) AS {n}" for n, w in ({"reference": PRESETS["balanced"]} | SCHEMES).items()) + ", " + ", ".join(FIELDS) + " FROM scores)"


def _movers() -> str:
    parts = []
    for scheme in SCHEMES:
        moved = f"SELECT hex_id, round(100.0::DOUBLE * (b - 1) / (n - 1) - 100.0::DOUBLE * (a - 1) / (n - 1), 9) AS movement, ra AS reference_rank, rb AS scheme_rank FROM (SELECT hex_id, {s._avg('reference')} AS a, {s._avg(scheme)} AS b, count(*) OVER () AS n, row_number() OVER (ORDER BY reference DESC, hex_id) AS ra, row_number() OVER (ORDER BY {scheme} DESC, hex_id) AS rb FROM pre)"
        for direction, order in (("upward", "DESC"), ("downward", "ASC")):
            parts.append(f"SELECT '{scheme}' AS scheme, '{direction}' AS direction, *, CAST(row_number() OVER (ORDER BY movement {order}, hex_id) AS INTEGER) AS place FROM ({moved}) QUALIFY place <= 10")
    return _SCHEMES + " " + " UNION ALL ".join(parts)


def _effect() -> str:
    tails = " UNION ALL ".join(f"SELECT '{n}' AS scheme, {FIELDS[2]} AS v FROM pre JOIN {s._top(n)} USING (hex_id)" for n in ["reference", *SCHEMES])
    return _SCHEMES + f", t AS ({tails}), m AS (SELECT scheme, count(*) AS rows, median(v) AS median, count(*) FILTER (WHERE v >= 75) AS at_threshold FROM t GROUP BY 1) SELECT *, median - (SELECT median FROM m WHERE scheme = 'reference') AS change FROM m"


def _pairs() -> str:
    parts = []
    for v in (FIELDS[2], "raw"):
        parts.append(f"SELECT '{v}' AS field, CAST(row_number() OVER (ORDER BY difference DESC, k) AS INTEGER) AS place, first_id, second_id, gap, difference FROM (SELECT hex_id AS first_id, lead(hex_id) OVER w AS second_id, lead({FIELDS[0]}) OVER w - {FIELDS[0]} AS gap, abs(lead({v}) OVER w - {v}) AS difference, row_number() OVER w AS k FROM scores WINDOW w AS (ORDER BY {FIELDS[0]}, hex_id)) WHERE gap <= 0.5 QUALIFY place <= 3")
    return s.W + " " + " UNION ALL ".join(parts)


def _contrasts() -> str:
    parts = []
    for v in (FIELDS[2], "raw"):
        band = f"FROM scores a JOIN scores b ON b.{FIELDS[0]} <= a.{FIELDS[0]} + 2.0 AND (b.{FIELDS[0]} > a.{FIELDS[0]} OR b.{FIELDS[0]} = a.{FIELDS[0]} AND b.hex_id > a.hex_id)"
        each = f"SELECT a.hex_id AS first_id, b.hex_id AS second_id, a.{FIELDS[0]} AS first_score, b.{FIELDS[0]} AS second_score, a.{v} AS first_value, b.{v} AS second_value, {{kind}} AS kind {band} QUALIFY row_number() OVER (PARTITION BY a.hex_id ORDER BY b.{v} {{order}}, b.{FIELDS[0]}, b.hex_id) = 1"
        both = each.format(kind=0, order="DESC") + " UNION ALL " + each.format(kind=1, order="ASC")
        once = f"SELECT *, abs(second_value - first_value) AS difference FROM ({both}) WHERE second_value <> first_value QUALIFY row_number() OVER (PARTITION BY first_id, second_id ORDER BY kind) = 1"
        parts.append(f"SELECT '{v}' AS field, CAST(row_number() OVER (ORDER BY difference DESC, first_id, kind) AS INTEGER) AS place, first_id, second_id, first_score, second_score, second_score - first_score AS score_gap, first_value, second_value, difference FROM ({once}) QUALIFY place <= 5")
    return s.W + " " + " UNION ALL ".join(parts)


def _rounding() -> str:
    rows = []
    for f, (d, v) in {"habitat_context_score": (3, "habitat_context_score"), "share": (5, "raw / 7.0::DOUBLE"), "hectares": (2, "raw / 3.0::DOUBLE")}.items():
        wrong = f"count(*) FILTER (WHERE {v} = 1.0)" if f == "share" else "0::BIGINT"
        rows.append(f"SELECT '{f}' AS field, {d}::INTEGER AS decimals, max(abs({v} - CAST(format('{{:.{d}f}}', {v}) AS DOUBLE))) AS max_difference, {wrong} AS mismatches FROM scores")
    return s.W + " " + " UNION ALL ".join(rows)


def _patches(before: str, mask: str) -> str:
    """Patches of a mask of pixels: least labels spread over touching runs until nothing changes."""
    return f"""WITH RECURSIVE {before},
mk AS (SELECT DISTINCT px_col, px_row FROM ({mask})), isl AS (SELECT px_row, px_col, px_col - row_number() OVER (PARTITION BY px_row ORDER BY px_col) AS i FROM mk),
run AS (SELECT CAST(px_row AS BIGINT) * 2147483648 + min(px_col) AS run, px_row, min(px_col) AS l, max(px_col) AS r FROM isl GROUP BY px_row, i),
half AS (SELECT a.run AS a, b.run AS b, least(a.r, b.r) - greatest(a.l, b.l) + 1 AS shared FROM run a JOIN run b ON b.px_row = a.px_row + 1 AND b.l <= a.r AND b.r >= a.l),
link AS (SELECT a, b, shared FROM half UNION ALL SELECT b, a, shared FROM half),
lab(run, patch) USING KEY (run) AS (
  SELECT run, run FROM run
  UNION
  SELECT k.b, min(n.patch) FROM lab n JOIN link k ON n.run = k.a JOIN recurring.lab o ON o.run = k.b WHERE n.patch < o.patch GROUP BY k.b
),
pt AS (SELECT patch, CAST(sum(r - l + 1) AS BIGINT) AS pixels, sum(r - l + 1) * 100.0::DOUBLE AS area_m2, CAST(min(l) AS INTEGER) AS min_col, CAST(max(r) AS INTEGER) AS max_col, CAST(min(px_row) AS INTEGER) AS min_row, CAST(max(px_row) AS INTEGER) AS max_row FROM run JOIN lab USING (run) GROUP BY patch)"""


_CANDIDATE_PATCHES = _patches(p.PIXEL_SQL, "SELECT px_col, px_row FROM px WHERE code = 3")

ORACLES = {
    "s3_patches": _CANDIDATE_PATCHES + " SELECT * FROM pt",
    "s3_patch_accounting": _CANDIDATE_PATCHES + " SELECT count(*) AS patches, coalesce(sum(area_m2), 0) AS mask_m2, count(*) FILTER (WHERE area_m2 >= 10000) AS kept, coalesce(sum(area_m2) FILTER (WHERE area_m2 >= 10000), 0) AS kept_m2, sum(area_m2) FILTER (WHERE area_m2 >= 10000) * 100.0::DOUBLE / sum(area_m2) AS kept_percent FROM pt",
    "s3_patch_outlines": _patches(p.PROTECTED_SQL, "SELECT px_col, px_row FROM foot") + ", ov AS (SELECT a AS run, sum(shared) AS shared FROM link GROUP BY 1) SELECT patch, CAST(sum(2 + 2 * (r - l + 1) - coalesce(shared, 0)) AS DOUBLE) * 10.0::DOUBLE AS perimeter_m, CAST(min(l) AS INTEGER) AS min_x, CAST(max(px_row) + 1 AS INTEGER) AS max_y FROM run JOIN lab USING (run) LEFT JOIN ov USING (run) GROUP BY patch",
    "s2_coverage_gate": "WITH " + p.PIXEL_SQL + """, h AS (SELECT 12000.0::DOUBLE * (1 + ceil((n - 6500000.7::DOUBLE) / 300000.0::DOUBLE)) AS h FROM north), strip AS (SELECT n_nationkey, 6199000 + n_nationkey * h AS low, 6199000 + n_nationkey * h + h AS high FROM nation, h WHERE n_nationkey % 5 <> 4),
      c AS (SELECT code IN (61, 62) AS sea, n_nationkey IS NULL AS gone FROM px LEFT JOIN strip ON y >= low AND y < high AND x BETWEEN 400000 AND 413000)
      SELECT count(*) AS valid_pixels, count(*) FILTER (WHERE sea) AS marine_pixels, count(*) FILTER (WHERE NOT sea) AS land_pixels, count(*) FILTER (WHERE sea AND gone) AS uncovered_marine, count(*) FILTER (WHERE NOT sea AND gone) AS uncovered_land,
        count(*) FILTER (WHERE NOT sea AND gone) * 100.0::DOUBLE AS uncovered_land_m2, count(*) FILTER (WHERE NOT sea AND gone) = 0 AS complete FROM c""",
    "s3_context_filter": "WITH " + _NORTH + ", " + _STUDY_EDGES + ", cust AS (SELECT c_custkey AS feature_id, 385000 + (c_custkey * 3701 % 42000) + 0.3::DOUBLE AS cx, 6190000 + (c_custkey * 977 % 320000) + 0.3::DOUBLE AS cy, CAST(150 + (c_custkey % 5) * 60 AS DOUBLE) AS r FROM customer), dia AS (" + _DIAMOND.format(src="cust") + f"), g AS (SELECT feature_id, min(CASE WHEN {_INSIDE_STUDY.format(x='d.x1', y='d.y1')} THEN 0 ELSE {_GAP} END) AS gap FROM dia d, study t GROUP BY 1) SELECT feature_id, round(gap, 6) AS distance FROM g WHERE gap <= 5000",
    "s3_boundary_flags": _CELLS + ", " + _STUDY_EDGES + f", {_CENTRES} SELECT hex_id, min({_PS('c.x', 'c.y', *_B1, *_B2)}) <= 1000 AS boundary_edge_flag FROM cen c, study t GROUP BY 1",
    "s3_footprint_distance": _CELLS + "," + p.PROTECTED_SQL + f", {_CENTRES}, dia AS (" + _DIAMOND.format(src="(SELECT DISTINCT feature_id, cx, cy, r FROM box)") + f"), g AS (SELECT hex_id, min(CASE WHEN abs(c.x - t.cx) + abs(c.y - t.cy) < t.r THEN 0 ELSE {_PS('c.x', 'c.y', *_B1, *_B2)} END) AS gap FROM cen c, dia t GROUP BY 1) SELECT hex_id, round(gap, 6) AS distance, gap = 0 AS centre_within FROM g",
    "s4_adjacent_pairs": _pairs(),
    "s4_contrast_pairs": _contrasts(),
    "s6_extreme_movers": _movers(),
    "s7_thematic_effect": _effect(),
    "s8_rounding_audit": _rounding(),
    "s1_csv_sink": s.W + " SELECT hex_id, printf('%.10f', raw / 8.0::DOUBLE) AS value, CASE WHEN raw = 7 THEN 'NaN' ELSE printf('%.10f', raw) END AS gap FROM scores",
    "s1_audit_sink": s.W + " SELECT steps, count(*) AS rows, CASE WHEN steps > 0 THEN sum(raw) / steps END AS ratio FROM scores GROUP BY 1",
}
QUERIES = {name: f for name, f in globals().items() if name[:1] == "s" and name[1:2].isdigit() and callable(f)}
