"""Neighbourhood joins on the hex grid and the five indicator tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import geometry
from terraweave.sources.storage import materialise


def neighbours(candidates: DataFrame, grid: DataFrame, radius: int = 2, how: str = "inner") -> DataFrame:
    """(hex_id, ring, dc, dr, and the grid's columns prefixed n_) around every candidate.

    Candidates are exploded with the constant offsets (18 for radius 2) and joined by an
    equality on coordinates. how='left' keeps missing neighbours with null columns.
    """
    offsets = [(c, r, k) for k in range(1, radius + 1) for c, r in hexgrid.ring(k)]
    steps = F.array(*[F.struct(F.lit(c).alias("dc"), F.lit(r).alias("dr"), F.lit(k).alias("ring")) for c, r, k in offsets])
    around = candidates.select("hex_id", "grid_col", "grid_row", F.explode(steps).alias("o")).select(
        "hex_id", F.col("o.ring").alias("ring"), F.col("o.dc").alias("dc"), F.col("o.dr").alias("dr"), (F.col("grid_col") + F.col("o.dc")).alias("n_grid_col"), (F.col("grid_row") + F.col("o.dr")).alias("n_grid_row")
    )
    renamed = grid.select(*[F.col(c).alias(f"n_{c}") for c in grid.columns])
    return around.join(renamed, ["n_grid_col", "n_grid_row"], how)


def _ratio(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part) * F.lit(1.0), F.col(whole))


def _sums(near: DataFrame, columns: dict[str, str]) -> DataFrame:
    """adjacent_* and local_* sums of neighbour columns, and how many cells are present."""
    one = F.col("ring") == 1
    aggregates = [F.count_if(one).alias("adjacent_cells"), F.count("*").alias("local_cells")]
    for name, source in columns.items():
        aggregates += [F.sum(F.when(one, F.col(f"n_{source}")).otherwise(0)).alias(f"adjacent_{name}"), F.sum(f"n_{source}").alias(f"local_{name}")]
    return near.groupBy("hex_id").agg(*aggregates)


def share_indicators(candidates: DataFrame, grid: DataFrame, part: str, whole: str, prefix: str) -> DataFrame:
    """Adjacent and local fraction of ``part`` in ``whole``: pixels are summed first.

    The focal cell is left out; missing neighbours add nothing; a zero whole gives null.
    """
    sums = _sums(neighbours(candidates, grid.select("grid_col", "grid_row", part, whole)), {"part": part, "whole": whole})
    out = candidates.select("hex_id").join(sums, "hex_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select("hex_id", *[zero(c) for c in sums.columns[1:]]).select(
        "hex_id", F.col("adjacent_cells").alias(f"{prefix}_adjacent_cells"), F.col("local_cells").alias(f"{prefix}_local_cells"), _ratio("adjacent_part", "adjacent_whole").alias(f"{prefix}_adjacent_fraction"), _ratio("local_part", "local_whole").alias(f"{prefix}_local_fraction")
    )


def focal_share(candidates: DataFrame, grid: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    """The cell's own fraction; a candidate without a grid row gets null."""
    own = grid.select("grid_col", "grid_row", _ratio(part, whole).alias(name))
    return candidates.select("hex_id", "grid_col", "grid_row").join(own, ["grid_col", "grid_row"], "left").select("hex_id", name)


def riparian_indicators(candidates: DataFrame, hydrology: DataFrame) -> DataFrame:
    """Focal, adjacent and local hydrologic fraction of the non-marine pixels, and the nearer maximum.

    The grid is the full one, cells of water alone included.
    """
    near = share_indicators(candidates, hydrology, "hydrologic_pixels", "nonmarine_pixels", "riparian")
    focal = focal_share(candidates, hydrology, "hydrologic_pixels", "nonmarine_pixels", "riparian_focal_fraction")
    return near.join(focal, "hex_id").withColumn("riparian_near_fraction", F.greatest("riparian_focal_fraction", "riparian_adjacent_fraction"))


def _stencil(tile: int, radius: int, sums: list[str], values: list[str], carry: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        width = tile + 2 * radius
        tc, tr = int(pdf["tc"].iloc[0]), int(pdf["tr"].iloc[0])
        at = (pdf["grid_row"].to_numpy() - tr * tile + radius, pdf["grid_col"].to_numpy() - tc * tile + radius)
        present = np.zeros((width, width), np.int64)
        present[at] = 1
        planes = {"cells": present}
        for name in sums:
            planes[name] = np.zeros((width, width), np.int64)
            planes[name][at] = pdf[name].fillna(0).to_numpy(np.int64)
        own = pdf["own"].to_numpy(bool)
        mine = (at[0][own], at[1][own])
        out = {"grid_col": pdf["grid_col"].to_numpy()[own], "grid_row": pdf["grid_row"].to_numpy()[own]}
        around = lambda plane, rings: sum(plane[mine[0] + r, mine[1] + c] for k in rings for c, r in hexgrid.ring(k))
        for name, plane in planes.items():
            out[f"adjacent_{name}"] = around(plane, [1])
            out[f"local_{name}"] = out[f"adjacent_{name}"] + around(plane, range(2, radius + 1))
        for name in values:
            plane = np.full((width, width), np.nan)
            plane[at] = pdf[name].astype(float).to_numpy()
            for c, r in hexgrid.ring(1):
                out[f"{name}_{_name((c, r))}"] = plane[mine[0] + r, mine[1] + c]
        return pd.DataFrame(out | {name: pdf[name].to_numpy()[own] for name in carry})

    return run


def stencil(grid: DataFrame, keep: Column, sums: list[str], values: list[str] | None = None, radius: int = 2, tile: int = 64, carry: list[str] | None = None) -> DataFrame:
    """One row for every cell of ``grid`` that meets ``keep``: what its neighbours hold, for all columns at once.

    adjacent_<c>, local_<c>: sums of the whole numbers ``c`` over ring 1 and over all rings
    up to ``radius``; adjacent_cells, local_cells: neighbours that are in the grid; <v>_<offset>: a
    value of each of the six neighbours, null where it or the neighbour is missing; ``carry``: numbers of the cell itself that
    come along, so that nothing need be joined to it again. Cells are packed in
    square tiles with a halo of ``radius`` cells, in one shuffle that each cell passes once, or a few times near
    a border; neighbours are then looked up in a tile's arrays, whose size is fixed.
    Cells without a place are dropped; places should be unique. An empty grid gives no rows.
    """
    values, carry = values or [], carry or []
    tiles = lambda c: F.sequence(F.floor((F.col(c) - radius) / tile).cast("int"), F.floor((F.col(c) + radius) / tile).cast("int"))
    slim = grid.where("grid_col is not null and grid_row is not null").select("grid_col", "grid_row", *dict.fromkeys([*sums, *values, *carry]), F.coalesce(keep, F.lit(False)).alias("own"))
    dealt = slim.withColumn("tc", F.explode(tiles("grid_col"))).withColumn("tr", F.explode(tiles("grid_row")))
    home = (F.floor(F.col("grid_col") / tile) == F.col("tc")) & (F.floor(F.col("grid_row") / tile) == F.col("tr"))
    names = [f"{where}_{c} long" for c in ["cells", *sums] for where in ("adjacent", "local")] + [f"{v}_{_name(o)} double" for v in values for o in hexgrid.ring(1)]
    kept = [f"{c} {grid.schema[c].dataType.simpleString()}" for c in carry]
    found = dealt.withColumn("own", F.col("own") & home).groupBy("tc", "tr").applyInPandas(_stencil(tile, radius, sums, values, carry), "grid_col int, grid_row int, " + ", ".join([*names, *kept]))
    known = [F.when(~F.isnan(f"{v}_{_name(o)}"), F.col(f"{v}_{_name(o)}")).alias(f"{v}_{_name(o)}") for v in values for o in hexgrid.ring(1)]
    return found.select("grid_col", "grid_row", *[n.split()[0] for n in names if n.endswith("long")], *known, *carry)


def packed_shares(grid: DataFrame, keep: Column, shares: dict[str, tuple[str, str]], carry: list[str] | None = None) -> DataFrame:
    """hex_id, the fields of ``share_indicators`` for every (part, whole) by prefix, and the cell's own ``carry``, for the cells of ``grid`` that meet ``keep``.

    One pass of ``stencil`` and no join: neither the driver nor a task holds more than a tile.
    """
    near = stencil(grid, keep, sorted({c for pair in shares.values() for c in pair}), carry=carry)
    out = [hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")).alias("hex_id")]
    for prefix, (part, whole) in shares.items():
        out += [F.col(f"{w}_cells").alias(f"{prefix}_{w}_cells") for w in ("adjacent", "local")] + [_ratio(f"{w}_{part}", f"{w}_{whole}").alias(f"{prefix}_{w}_fraction") for w in ("adjacent", "local")]
    return near.select(*out, *(carry or []))


def packed_riparian(hydrology: DataFrame, keep: Column) -> DataFrame:
    """``riparian_indicators`` for the cells of ``hydrology`` that meet ``keep``, from one pass of ``stencil``."""
    pair = ("hydrologic_pixels", "nonmarine_pixels")
    near = packed_shares(hydrology, keep, {"riparian": pair}, list(pair)).withColumn("riparian_focal_fraction", _ratio(*pair)).drop(*pair)
    return near.withColumn("riparian_near_fraction", F.greatest("riparian_focal_fraction", "riparian_adjacent_fraction"))


def packed_indicators(counts: DataFrame, keep: Column) -> DataFrame:
    """Neighbourhood fields of all components for the cells that meet ``keep``, from one pass of ``stencil``.

    counts: cell counts with protected_pixels. The fields are those of ``share_indicators``
    (habitat, artificial, riparian, protected) and ``network_indicators``.
    """
    wet, water = F.col("wetland_context_pixels"), F.col("inland_water_pixels")
    full = counts.withColumns({"hydrologic_pixels": wet + water, "nonmarine_pixels": F.col("terrestrial_pixels") + water, "habitat": F.coalesce(_ratio("habitat_context_pixels", "terrestrial_pixels"), F.lit(0.0))})
    shares = {"habitat": ("habitat_context_pixels", "terrestrial_pixels"), "artificial": ("artificial_pixels", "terrestrial_pixels"), "riparian": ("hydrologic_pixels", "nonmarine_pixels"), "protected": ("protected_pixels", "terrestrial_pixels")}
    near = stencil(full, keep, sorted({c for pair in shares.values() for c in pair}), ["habitat"])
    at = {o: F.coalesce(F.col(f"habitat_{_name(o)}"), F.lit(0.0)) for pair in AXES.values() for o in pair}
    axes = [F.least(at[p], at[q]) for p, q in AXES.values()]
    strengths, total = axes[0] + axes[1] + axes[2], sum(list(at.values())[1:], next(iter(at.values())))
    fractions = [_ratio(f"{where}_{part}", f"{where}_{whole}").alias(f"{name}_{where}_fraction") for name, (part, whole) in shares.items() for where in ("adjacent", "local")]
    return near.select(
        "grid_col", "grid_row", "adjacent_cells", "local_cells", *fractions, F.greatest(*axes).alias("bridge_strength_max"), F.coalesce(F.try_divide(2.0 * strengths, total), F.lit(0.0)).alias("opposing_balance_ratio")
    )


AXES = {"a": ((1, 0), (-1, 0)), "b": ((0, 1), (0, -1)), "c": ((1, -1), (-1, 1))}


def network_indicators(candidates: DataFrame, units: DataFrame, fraction: str = "habitat_fraction_of_terrestrial") -> DataFrame:
    """Opposing-axis habitat strengths; a missing neighbour counts as zero and is counted."""
    near = neighbours(candidates, units.select("grid_col", "grid_row", fraction), radius=1, how="left")
    value = F.coalesce(F.col(f"n_{fraction}"), F.lit(0.0))
    at = lambda o: F.max(F.when((F.col("dc") == o[0]) & (F.col("dr") == o[1]), value)).alias(_name(o))
    six = [o for pair in AXES.values() for o in pair]
    wide = near.groupBy("hex_id").agg(*[at(o) for o in six], F.count_if(F.col(f"n_{fraction}").isNull()).alias("adjacent_cells_missing"))
    return _network_fields(wide, ["hex_id"])


def _network_fields(wide: DataFrame, keep: list[str]) -> DataFrame:
    """Network fields from the values of the six neighbours, in columns named by ``_name``."""
    six = [o for pair in AXES.values() for o in pair]
    wide = wide.withColumns({f"axis_{k}": F.least(F.col(_name(p)), F.col(_name(q))) for k, (p, q) in AXES.items()})
    axes = [F.col(f"axis_{k}") for k in AXES]
    total = sum((F.col(_name(o)) for o in six[1:]), F.col(_name(six[0])))
    wide = wide.withColumns({"total": total, "bridge_strength_max": F.greatest(*axes), "axis_sum": axes[0] + axes[1] + axes[2]})
    tied = [(F.col("bridge_strength_max") - a <= 1e-12) for a in axes]
    return wide.select(
        *keep, *[F.col(f"axis_{k}").alias(f"bridge_axis_{k}_strength") for k in AXES], "bridge_strength_max", (F.col("axis_sum") / 3.0).alias("bridge_strength_mean"), (F.col("total") / 6.0).alias("neighbor_habitat_mean"),
        F.coalesce(F.try_divide(2.0 * F.col("axis_sum"), F.col("total")), F.lit(0.0)).alias("opposing_balance_ratio"), F.coalesce(F.try_divide(2.0 * F.col("bridge_strength_max"), F.col("total")), F.lit(0.0)).alias("dominant_opposing_pair_share"),
        F.when(tied[0], "axis_a").when(tied[1], "axis_b").otherwise("axis_c").alias("strongest_axis"), sum((t.cast("int") for t in tied[1:]), tied[0].cast("int")).alias("strongest_axis_tie_count"), "adjacent_cells_missing",
    )


def packed_network(counts: DataFrame, keep: Column) -> DataFrame:
    """Fields of ``network_indicators`` and the habitat shares around it, by place, for the cells that meet ``keep``: one pass of ``stencil``."""
    full = counts.withColumn("habitat", _ratio("habitat_context_pixels", "terrestrial_pixels"))
    near = stencil(full, keep, ["habitat_context_pixels", "terrestrial_pixels"], ["habitat"])
    at = [_name(o) for pair in AXES.values() for o in pair]
    gaps = [F.col(f"habitat_{n}").isNull().cast("long") for n in at]
    wide = near.withColumn("adjacent_cells_missing", sum(gaps[1:], gaps[0])).withColumns({n: F.coalesce(f"habitat_{n}", F.lit(0.0)) for n in at})
    wide = wide.withColumns({f"habitat_{w}_fraction": _ratio(f"{w}_habitat_context_pixels", f"{w}_terrestrial_pixels") for w in ("adjacent", "local")})
    return _network_fields(wide, ["grid_col", "grid_row", "habitat_adjacent_fraction", "habitat_local_fraction"])


def _name(offset: tuple[int, int]) -> str:
    return f"n{offset[0]}_{offset[1]}".replace("-", "m")


def _axial(c: tuple[Column, Column], r: tuple[Column, Column]) -> tuple[Column, Column]:
    """The least and the greatest axial distance, from ranges of the differences in column and in row."""
    ranges = [c, r, (c[0] + r[0], c[1] + r[1])]
    return F.greatest(*[geometry.gap_of(*x) for x in ranges]), F.greatest(*[geometry.reach_of(*x) for x in ranges])


def _far_steps(open_: DataFrame, edge: DataFrame, tile: int) -> DataFrame:
    """(hex_id, steps): to the nearest source, however far, by the hierarchy of tiles of ``geometry.near_tiles``."""
    index = lambda c: F.floor(F.col(c) / tile)
    a = open_.withColumns({"tx": index("grid_col"), "ty": index("grid_row")})
    b = edge.withColumns({"_tx": index("s_col"), "_ty": index("s_row")})

    def boxes(rows: DataFrame, tiles: list[str], places: list[str], name: str) -> DataFrame:
        ends = {f"{n}_{c}": f(p).cast("double") for c, p in zip("xy", places, strict=True) for n, f in (("low", F.min), ("high", F.max))}
        return materialise(rows.groupBy(*[F.col(t).alias(t.lstrip("_")) for t in tiles]).agg(*[v.alias(n) for n, v in ends.items()]), name)

    pairs = geometry.near_tiles(boxes(a, ["tx", "ty"], ["grid_col", "grid_row"], "open-tiles"), boxes(b, ["_tx", "_ty"], ["s_col", "s_row"], "source-tiles"), _axial)
    steps = hexgrid.distance(F.col("grid_col"), F.col("grid_row"), F.col("s_col"), F.col("s_row"))
    return pairs.join(a.hint("merge"), ["tx", "ty"]).join(b.hint("merge"), ["_tx", "_ty"]).groupBy("hex_id").agg(F.min(steps).cast("int").alias("steps"))


def nearest_steps(candidates: DataFrame, sources: DataFrame, first_radius: int = 4, max_rounds: int = 5) -> DataFrame:
    """(hex_id, steps): exact axial distance to the nearest source cell, null without sources or without a place.

    Candidates that are sources have distance 0. For all others only sources at the edge of
    a group of sources can be nearest, so cells with six source neighbours are left out.
    Then tiles with a doubling radius: tiles are as wide as the radius, a candidate meets
    the sources of its 3x3 tiles, and a distance within the radius is final. What is left
    goes on, and every round is written to the shared folder. After ``max_rounds`` what is
    still open goes down a hierarchy of tiles, since wider tiles would hold all there is.
    """
    # the filter stands behind the written table, or it would be pushed to whatever the cells are made of
    places = materialise(sources.select(F.col("grid_col").alias("s_col"), F.col("grid_row").alias("s_row")).distinct(), "sources").where("s_col IS NOT NULL AND s_row IS NOT NULL")
    every = candidates.select("hex_id", "grid_col", "grid_row")
    if places.isEmpty():
        return every.select("hex_id", F.lit(None).cast("int").alias("steps"))
    own = every.join(places, (F.col("grid_col") == F.col("s_col")) & (F.col("grid_row") == F.col("s_row")), "left")
    done = materialise(own.where("s_col IS NOT NULL").select("hex_id", F.lit(0).alias("steps")), "nearest")
    open_ = materialise(own.where("s_col IS NULL AND grid_col IS NOT NULL AND grid_row IS NOT NULL").select("hex_id", "grid_col", "grid_row"), "open")
    six = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(r).alias("r")) for c, r in hexgrid.ring(1)])
    around = places.select(F.explode(six).alias("o"), "*").select((F.col("s_col") + F.col("o.c")).alias("s_col"), (F.col("s_row") + F.col("o.r")).alias("s_row"))
    inner = around.join(places, ["s_col", "s_row"]).groupBy("s_col", "s_row").count().where("count = 6")
    edge = materialise(places.join(inner.select("s_col", "s_row"), ["s_col", "s_row"], "left_anti"), "source-edge")
    radius = first_radius
    for _ in range(max_rounds):
        if open_.isEmpty():
            break
        tiled = edge.select("*", F.floor(F.col("s_col") / radius).alias("tc"), F.floor(F.col("s_row") / radius).alias("tr"))
        nine = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
        looking = open_.withColumn("o", F.explode(nine)).select("hex_id", "grid_col", "grid_row", (F.floor(F.col("grid_col") / radius) + F.col("o.a")).alias("tc"), (F.floor(F.col("grid_row") / radius) + F.col("o.b")).alias("tr"))
        steps = hexgrid.distance(F.col("grid_col"), F.col("grid_row"), F.col("s_col"), F.col("s_row"))
        found = looking.join(tiled, ["tc", "tr"]).groupBy("hex_id").agg(F.min(steps).cast("int").alias("steps")).where(F.col("steps") <= radius)
        found = materialise(found, "nearest")
        done = done.unionByName(found)
        open_ = materialise(open_.join(found, "hex_id", "left_anti"), "open")
        radius *= 2
    if not open_.isEmpty():
        done = done.unionByName(materialise(_far_steps(open_, edge, 4 * first_radius), "nearest"))
    return every.select("hex_id").join(done, "hex_id", "left")
