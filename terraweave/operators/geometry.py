"""Exact relations of polygons and points, over edge tables dealt to square tiles.

Edges are (key, x1, y1, x2, y2) of closed rings, holes included; a point is an edge of no
length. Null coordinates are dropped. Joins are equalities on tiles, so a task holds what
lies near one tile. Both sides are shuffled (``_apart``): Spark's size of a table doesn't count the tiles its
rows are spread out to, and would send millions of them through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraweave.sources.storage import materialise

ENDS = ["x1", "y1", "x2", "y2"]
STEP = 4  # widths of a tile in the one above


def _point_gaps(pairs: DataFrame, points: dict[str, tuple[str, str]], segment: list[str], name: str) -> DataFrame:
    """``pairs`` with the square of the distance of every point to the segment (x1, y1, x2, y2), as columns name + point."""
    x1, y1, x2, y2 = (F.col(c) for c in segment)
    dx, dy, length = (f"{name}{c}" for c in ("dx", "dy", "l"))
    pairs = pairs.withColumns({dx: x2 - x1, dy: y2 - y1}).withColumn(length, F.col(dx) * F.col(dx) + F.col(dy) * F.col(dy))
    along = lambda x, y: F.coalesce(F.try_divide((F.col(x) - x1) * F.col(dx) + (F.col(y) - y1) * F.col(dy), F.col(length)), F.lit(0.0))
    pairs = pairs.withColumns({f"{name}t{k}": F.least(F.lit(1.0), F.greatest(F.lit(0.0), along(*p))) for k, p in points.items()})
    gaps = {f"{name}{c}{k}": F.col(v) - (start + F.col(f"{name}t{k}") * F.col(d)) for k, p in points.items() for c, v, start, d in (("gx", p[0], x1, dx), ("gy", p[1], y1, dy))}
    return pairs.withColumns(gaps).withColumns({f"{name}{k}": F.col(f"{name}gx{k}") * F.col(f"{name}gx{k}") + F.col(f"{name}gy{k}") * F.col(f"{name}gy{k}") for k in points})


def point_gaps(pairs: DataFrame, x: str, y: str, segment: list[str], key: str) -> DataFrame:
    """(key, distance): the smallest distance of each key's pairs of a point and a segment."""
    return _point_gaps(pairs, {"p": (x, y)}, segment, "_q").groupBy(key).agg(F.sqrt(F.min("_qp")).alias("distance"))


def segment_gaps(pairs: DataFrame, a: list[str], b: list[str], key: str) -> DataFrame:
    """(key, distance): the smallest distance of each key's pairs of segments, 0 where they cross, else from an end.

    Every quantity is a column of its own, taken once a pair. As one nested expression they were
    repeated dozens of times, in a method too long for the JVM to compile, and again in the
    filter that Spark pushed into the join; a limit therefore belongs behind the minimum. The root is taken of the minimum.
    """
    x = lambda s, i: F.col(s[2 * i])
    y = lambda s, i: F.col(s[2 * i + 1])
    side = lambda s, o, i: F.signum((x(s, 1) - x(s, 0)) * (y(o, i) - y(s, 0)) - (y(s, 1) - y(s, 0)) * (x(o, i) - x(s, 0)))
    rows = pairs.withColumns({"_cross_b": side(a, b, 0) * side(a, b, 1), "_cross_a": side(b, a, 0) * side(b, a, 1)})
    rows = rows.select(key, *a, *b, ((F.col("_cross_b") < 0) & (F.col("_cross_a") < 0)).alias("_crossing"))
    rows = _point_gaps(rows, {"0": (a[0], a[1]), "1": (a[2], a[3])}, b, "_a").select(key, *a, *b, "_crossing", F.least("_a0", "_a1").alias("_near_b"))
    rows = _point_gaps(rows, {"0": (b[0], b[1]), "1": (b[2], b[3])}, a, "_b").select(key, F.when(F.col("_crossing"), 0.0).otherwise(F.least("_near_b", "_b0", "_b1")).alias("_square"))
    return rows.groupBy(key).agg(F.sqrt(F.min("_square")).alias("distance"))


def _boxes_within(a: list[str], b: list[str], limit: float) -> Column:
    """Whether the boxes of two segments come within ``limit`` of each other in x and in y; no pair that near is left out."""
    apart = lambda i: F.greatest(F.least(a[i], a[i + 2]) - F.greatest(b[i], b[i + 2]), F.least(b[i], b[i + 2]) - F.greatest(a[i], a[i + 2]))
    return (apart(0) <= limit + 1e-6) & (apart(1) <= limit + 1e-6)


def _apart(df: DataFrame) -> DataFrame:
    return df.hint("merge")


def _tiled(edges: DataFrame, tile: float, pad: float = 0.0) -> DataFrame:
    """``edges`` once for every tile (tx, ty) that comes within ``pad`` of them.

    The edge is clipped to each column of tiles, so a long slanted edge meets a band of
    tiles and not its whole bounding box.
    """
    pad += 1e-6
    index = lambda v: F.floor(v / F.lit(tile))
    rows = edges.where(" and ".join(f"{c} is not null" for c in ENDS))
    left, right = F.least("x1", "x2"), F.greatest("x1", "x2")
    rows = rows.withColumn("tx", F.explode(F.sequence(index(left - pad), index(right + pad))))
    from_x, to_x = F.greatest(left, F.col("tx") * tile - pad), F.least(right, (F.col("tx") + 1) * tile + pad)
    at = lambda x: F.col("y1") + (x - F.col("x1")) * (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    steep = F.abs(F.col("x1") - F.col("x2")) < 1e-9
    ya, yb = F.when(steep, F.col("y1")).otherwise(at(from_x)), F.when(steep, F.col("y2")).otherwise(at(to_x))
    return rows.withColumn("ty", F.explode(F.sequence(index(F.least(ya, yb) - pad), index(F.greatest(ya, yb) + pad))))


def contains(points: DataFrame, edges: DataFrame, point_key: str, key: str, tile: float) -> DataFrame:
    """(point_key, key), distinct: rings of ``key`` that have the point (x, y) inside (even-odd rule).

    A ray runs to the right. Edges are dealt to the tiles of their rows from the ring's
    leftmost tile to their own, so that a point meets all edges its ray can cross, once.
    """
    index = lambda v: F.floor(v / F.lit(tile))
    rows = edges.where(" and ".join(f"{c} is not null" for c in ENDS) + f" and y1 <> y2 and {key} is not null")
    rows = rows.withColumn("_left", F.min(index(F.least("x1", "x2"))).over(Window.partitionBy(key))).withColumn("tx", F.explode(F.sequence(F.col("_left"), index(F.greatest("x1", "x2")))))
    rows = rows.withColumn("ty", F.explode(F.sequence(index(F.least("y1", "y2")), index(F.greatest("y1", "y2")))))
    placed = points.where("x is not null and y is not null").select(point_key, F.col("x").alias("_x"), F.col("y").alias("_y"), index(F.col("x")).alias("tx"), index(F.col("y")).alias("ty"))
    met = placed.join(_apart(rows.select(key, *ENDS, "tx", "ty")), ["tx", "ty"])
    spans = (F.col("_y") >= F.least("y1", "y2")) & (F.col("_y") < F.greatest("y1", "y2"))
    ahead = F.col("x1") + (F.col("_y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")) > F.col("_x")
    crossings = met.where(spans & ahead).groupBy(point_key, key, "_x", "_y").agg(F.count("*").alias("_n"))
    return crossings.where("_n % 2 = 1").select(point_key, key).distinct()


def _corners(edges: DataFrame, key: str) -> DataFrame:
    """One corner of every ring: its smallest by (x, y)."""
    return edges.groupBy(key).agg(F.min(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))).alias("_p")).select(key, "_p.x", "_p.y")


def distances(shapes: DataFrame, others: DataFrame, limit: float, key: str = "hex_id", other_key: str = "feature_id") -> DataFrame:
    """(key, distance): to the nearest of ``others``, for shapes within ``limit`` (inclusive).

    Shapes that touch, hold or lie in another have distance 0. One ring a key is taken for
    the holding tests; an empty side gives no rows.
    """
    a = _tiled(shapes.select(key, *ENDS), limit)
    b = _tiled(others.select(*[F.col(c).alias(f"_{c}") for c in ENDS], *ENDS), limit, limit).drop(*ENDS)
    theirs = [f"_{c}" for c in ENDS]
    near = segment_gaps(a.join(_apart(b), ["tx", "ty"]).where(_boxes_within(ENDS, theirs, limit)), ENDS, theirs, key).where(F.col("distance") <= limit)
    inside = contains(_corners(shapes, key), others, key, other_key, limit).select(key, F.lit(0.0).alias("distance"))
    holding = contains(_corners(others, other_key), shapes, other_key, key, limit).select(key, F.lit(0.0).alias("distance"))
    return near.unionByName(inside).unionByName(holding).groupBy(key).agg(F.min("distance").alias("distance"))


def within(shapes: DataFrame, others: DataFrame, limit: float, key: str = "feature_id", other_key: str = "feature_id") -> DataFrame:
    """Keys of ``shapes`` that intersect ``others`` buffered by ``limit``, with their distance."""
    return distances(shapes, others.withColumnRenamed(other_key, "_other"), limit, key, "_other")


def near_boundary(points: DataFrame, edges: DataFrame, limit: float = 1000.0, key: str = "hex_id") -> DataFrame:
    """(key, boundary_edge_flag) for all ``points`` (key, x, y): a line of ``edges`` within ``limit``, inclusive."""
    line = _tiled(edges.select(*ENDS), limit, limit)
    placed = points.select(key, "x", "y", F.floor(F.col("x") / limit).alias("tx"), F.floor(F.col("y") / limit).alias("ty"))
    met = placed.join(_apart(line), ["tx", "ty"]).where(_boxes_within(["x", "y", "x", "y"], ENDS, limit))
    hit = point_gaps(met, "x", "y", ENDS, key).where(F.col("distance") <= limit).select(key)
    return points.select(key).join(_apart(hit.withColumn("_hit", F.lit(True))), key, "left").select(key, F.coalesce("_hit", F.lit(False)).alias("boundary_edge_flag"))


def _tile_boxes(tiles: DataFrame, shrink: int) -> DataFrame:
    """(tx, ty, up_x, up_y, low_x, low_y, high_x, high_y): boxes of what lies in every tile, tiles ``shrink`` times as wide as those of ``tiles``, with the tile above."""
    up = lambda c, n: F.floor(F.col(c) / F.lit(n))
    boxes = [F.min("low_x").alias("low_x"), F.min("low_y").alias("low_y"), F.max("high_x").alias("high_x"), F.max("high_y").alias("high_y")]
    return tiles.groupBy(up("tx", shrink).alias("tx"), up("ty", shrink).alias("ty")).agg(*boxes).withColumns({"up_x": up("tx", STEP), "up_y": up("ty", STEP)})


def gap_of(low: Column, high: Column) -> Column:
    """The least size of a difference that lies in [low, high]."""
    return F.greatest(F.lit(0.0), low, -high)


def reach_of(low: Column, high: Column) -> Column:
    """The greatest size of a difference that lies in [low, high]."""
    return F.greatest(high, -low)


def _straight(x: tuple[Column, Column], y: tuple[Column, Column]) -> tuple[Column, Column]:
    """The least and the greatest straight distance, from ranges of the differences in x and in y."""
    return F.hypot(gap_of(*x), gap_of(*y)), F.hypot(reach_of(*x), reach_of(*y))


def near_tiles(shapes: DataFrame, others: DataFrame, bounds: Callable = _straight) -> DataFrame:
    """(tx, ty, _tx, _ty): pairs of tiles of both sides, among them for every shape the tile of its nearest other.

    From one pair of tiles that hold everything down to the tiles given, STEP times narrower at a time. A tile keeps the
    tiles whose box is no farther than the least distance within which some other is sure to lie; that is a
    few, however far they are, so the pairs grow with the tiles and not with their product.
    Both sides: (tx, ty, low_x, low_y, high_x, high_y), one row a tile; bounds: as ``_straight``, of the distance in use.
    """
    reach = shapes.select("tx", "ty").unionByName(others.select("tx", "ty")).agg(F.max(F.greatest(F.abs("tx"), F.abs("ty")))).first()[0] or 0
    shrink = 1
    while shrink <= reach:
        shrink *= STEP
    above = ["up_x", "up_y", "_up_x", "_up_y"]
    pairs = None
    while shrink:
        a, b = _tile_boxes(shapes, shrink), _tile_boxes(others, shrink)
        b = b.select(*[F.col(c).alias(f"_{c}") for c in b.columns])
        if pairs is None:  # at most four tiles a side
            met = a.crossJoin(b)
        else:
            met = pairs.join(_apart(a), ["up_x", "up_y"]).join(_apart(b), ["_up_x", "_up_y"])
        met = met.withColumns({f"_{n}_d{c}": F.col(f"{n}_{c}") - F.col(f"_{o}_{c}") for c in "xy" for n, o in (("low", "high"), ("high", "low"))})
        least, most = bounds(*[(F.col(f"_low_d{c}"), F.col(f"_high_d{c}")) for c in "xy"])
        met = met.select("tx", "ty", "_tx", "_ty", least.alias("_least"), most.alias("_most"))
        kept = met.withColumn("_sure", F.min("_most").over(Window.partitionBy("tx", "ty"))).where(F.col("_least") <= F.col("_sure") * (1 + 1e-9) + 1e-6)
        pairs = materialise(kept.select("tx", "ty", "_tx", "_ty"), "near-tiles")
        pairs = pairs if shrink == 1 else pairs.toDF(*above)
        shrink //= STEP
    return pairs


def _far(shapes: DataFrame, others: DataFrame, tile: float, key: str) -> DataFrame:
    """(key, distance): to the nearest of ``others``, for shapes that neither touch, hold nor lie in one, however far it is."""

    def placed(edges: DataFrame) -> DataFrame:
        middle = lambda c: F.floor((F.col(f"{c}1") + F.col(f"{c}2")) / F.lit(2.0 * tile))
        return edges.withColumns({"tx": middle("x"), "ty": middle("y")})

    def boxes(edges: DataFrame, name: str) -> DataFrame:
        ends = {f"{n}_{c}": f(f"{c}1", f"{c}2") for c in "xy" for n, f in (("low", F.least), ("high", F.greatest))}
        return materialise(_tile_boxes(edges.withColumns(ends), 1).drop("up_x", "up_y"), name)

    a, b = placed(shapes.select(key, *ENDS)), placed(others.select(*ENDS).where(" and ".join(f"{c} is not null" for c in ENDS)))
    pairs = near_tiles(boxes(a, "shape-tiles"), boxes(b, "other-tiles"))
    theirs = [f"_{c}" for c in ENDS]
    met = pairs.join(_apart(a), ["tx", "ty"]).join(_apart(b.select(*[F.col(c).alias(f"_{c}") for c in b.columns])), ["_tx", "_ty"])
    return segment_gaps(met, ENDS, theirs, key)


def nearest(shapes: DataFrame, others: DataFrame, start: float = 2000.0, key: str = "hex_id") -> DataFrame:
    """(key, distance): the exact nearest distance for every shape, however far; null with no others or without a place.

    Two rounds by tiles as wide as the radius, the second for the shapes still open. A wider radius would put
    all shapes and others in a few tiles, so what is left after that goes down a hierarchy of tiles (``near_tiles``).
    """
    left, done = shapes.where(" and ".join(f"{c} is not null" for c in ENDS)), None
    for radius in (start, 4 * start):
        found = materialise(distances(left, others, radius, key), "distances")
        done = found if done is None else done.unionByName(found)
        left = materialise(left.join(_apart(found.select(key)), key, "left_anti"), "open")
        if left.isEmpty():
            break
    else:
        done = done.unionByName(materialise(_far(left, others, start, key), "distances"))
    return shapes.select(key).distinct().join(_apart(done), key, "left")
