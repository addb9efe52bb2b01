"""Plane geometry on columns: rings are arrays of (x, y) structs, first point not repeated.

Spatial joins are equal joins on grid cells and an exact predicate; nothing is compared
outside its cell, so that they scale with the data and the polygons' sizes. Where many
shapes lie over each other, what lies in a cell is compared in blocks (see blocks); everything
else is an expression of Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import let
from hustings.operators import blocks

RING = "array<struct<x:double,y:double>>"


def _edges(ring: Column) -> Column:
    """(a, b) of each side."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.arrays_zip(ring.alias("a"), following.alias("b"))


def signed_area(ring: Column) -> Column:
    return let(ring, lambda r: F.aggregate(_edges(r), F.lit(0.0), lambda s, e: s + (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2)


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside, by counting the sides that a ray to the right crosses."""

    def crossed(n: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        over = (a["y"] > y) != (b["y"] > y)
        return n + F.when(over & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]), 1).otherwise(0)

    return F.aggregate(_edges(ring), F.lit(0), crossed) % 2 == 1


def clip_convex(ring: Column, window: Column) -> Column:
    """The part of a ring inside a convex counter-clockwise window, side by side of the window."""

    def by_side(rest: Column, side: Column) -> Column:
        p, q = side["a"], side["b"]
        left = lambda v: (q["x"] - p["x"]) * (v["y"] - p["y"]) - (q["y"] - p["y"]) * (v["x"] - p["x"])

        def cut(e: Column) -> Column:
            da, db = left(e["a"]), left(e["b"])
            t = da / (da - db)
            meet = F.struct((e["a"]["x"] + t * (e["b"]["x"] - e["a"]["x"])).alias("x"), (e["a"]["y"] + t * (e["b"]["y"] - e["a"]["y"])).alias("y"))
            none = F.lit(None).cast("struct<x:double,y:double>")
            return F.filter(F.array(F.when(da >= 0, e["a"]).otherwise(none), F.when((da >= 0) != (db >= 0), meet).otherwise(none)), lambda v: v.isNotNull())

        return F.flatten(F.transform(_edges(rest), cut)).cast(RING)

    return let(window, lambda w: F.aggregate(_edges(w), ring.cast(RING), by_side))


def bounds(ring: Column) -> dict[str, Column]:
    of = lambda c: F.transform(ring, lambda p: p[c])
    return {"x0": F.array_min(of("x")), "x1": F.array_max(of("x")), "y0": F.array_min(of("y")), "y1": F.array_max(of("y"))}


def _cells(df: DataFrame, x0: Column, x1: Column, y0: Column, y1: Column, cell: float) -> DataFrame:
    """A row for each grid cell that the box touches."""
    of = lambda v: F.floor(v / cell)
    return df.withColumn("gx", F.explode(F.sequence(of(x0), of(x1)))).withColumn("gy", F.explode(F.sequence(of(y0), of(y1))))


def _met(points: DataFrame, polygons: DataFrame, cell: float, ring: str, payload: list[str], key: str | None = None, grouped: bool = False) -> DataFrame:
    of = lambda c: F.floor(F.col(c) / cell)
    shapes = polygons.select(*dict.fromkeys([*payload, *([key] if key else [])]), F.col(ring).alias("ring"))
    placed = _cells(shapes, *(bounds(F.col("ring"))[c] for c in ("x0", "x1", "y0", "y1")), cell)
    return blocks.points_in_rings(points.withColumns({"gx": of("x"), "gy": of("y")}), placed, points.columns, payload, key, grouped)


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float, ring: str = "ring") -> DataFrame:
    """points (x, y) with the columns of each polygon that holds them, but for its ring; a point in two polygons is two rows."""
    payload = [c for c in polygons.columns if c != ring]
    found = _met(points, polygons, cell, ring, payload).select(*points.columns, F.explode("found").alias("__f"))
    return found.select(*points.columns, F.col("__f").alias(payload[0]) if len(payload) == 1 else "__f.*")


def held_by(points: DataFrame, polygons: DataFrame, cell: float, by: list[str], key: str | None = None, ring: str = "ring") -> DataFrame:
    """points (x, y) with found, an array of structs: payload (by), n and, where key is given, key: how many polygons of equal `by` hold the point, and the least key of them.

    A point may have several rows, each for other polygons. Use it instead of points_in_polygons where polygons lie over each other many times and
    what they have in common is asked.
    """
    return _met(points, polygons, cell, ring, by, key, True)


def each_held(found: DataFrame) -> DataFrame:
    """What held_by found, a row per entry: the points' columns, by, n and key."""
    own = [c for c in found.columns if c != "found"]
    kind = found.schema["found"].dataType.elementType.names
    return found.select(*own, F.explode("found").alias("__f")).select(*own, *(f"__f.{c}" for c in kind if c != "payload"), "__f.payload.*")


def overlaps(polygons: DataFrame, key: str, cell: float, least: float = 1.0, ring: str = "ring", by: list[str] | None = None) -> DataFrame:
    """a, b, overlap: pairs of convex polygons (a < b) that share over `least` area; overlay.overlaps takes any shapes. by: only those with equal ones are compared."""
    by = by or []
    b = bounds(F.col(ring))
    boxed = polygons.select(*by, F.col(key).alias("key"), F.array(F.col(ring).cast(RING)).alias("pieces"), *(c.alias(n) for n, c in b.items()))
    return pairs_of(boxed, by, cell, least)


def pairs_of(boxed: DataFrame, by: list[str], cell: float, least: float) -> DataFrame:
    """a, b, overlap of shapes (by, key, pieces, x0, x1, y0, y1), a < b."""
    placed = _cells(boxed, F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"), cell)
    found = blocks.shapes_over_each_other(placed, by, cell, least).where("one <> two")
    return found.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"), "overlap")


def points_of_pairs(points: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """a, b, na, nb: for pairs of polygons (key, home, ring; a < b) the points (home, x, y) that both hold and whose home is that of a, or of b. A pair may have several rows, or none."""
    of = lambda c: F.floor(F.col(c) / cell)
    drawn = polygons.withColumn("ring", F.col("ring").cast(RING))
    placed = _cells(drawn, *(bounds(F.col("ring"))[c] for c in ("x0", "x1", "y0", "y1")), cell)
    found = blocks.points_of_pairs(points.withColumns({"gx": of("x"), "gy": of("y")}), placed).where("one <> two")
    first = F.col("one") < F.col("two")
    return found.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"), F.when(first, F.col("n1")).otherwise(F.col("n2")).alias("na"), F.when(first, F.col("n2")).otherwise(F.col("n1")).alias("nb"))


def _near(points: DataFrame, sites: DataFrame, by: list[str], cell: float) -> DataFrame:
    """Points joined with the sites of their own and the eight cells around, with d."""
    of = lambda c: F.floor(F.col(c) / cell)
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    spread = sites.withColumn("o", around).select("*", (of("sx") + F.col("o.i")).alias("gx"), (of("sy") + F.col("o.j")).alias("gy")).drop("o")
    found = points.withColumns({"gx": of("x"), "gy": of("y")}).join(spread, [*by, "gx", "gy"]).drop("gx", "gy")
    return found.withColumn("d", F.sqrt((F.col("x") - F.col("sx")) ** 2 + (F.col("y") - F.col("sy")) ** 2))


def within_distance(points: DataFrame, sites: DataFrame, by: list[str], point: str, reach: float) -> DataFrame:
    """by, point: points with a site of their group at most reach away."""
    return _near(points, sites, by, reach).where(F.col("d") <= reach).select(*by, point).distinct()


def nearest_other(seeds: DataFrame, by: list[str], seed: str, cell: float) -> DataFrame:
    """by, seed, d: distance to the nearest other seed of the same group within cell; null where none is that near."""
    sites = seeds.select(*by, F.col(seed).alias("site"), F.col("x").alias("sx"), F.col("y").alias("sy"))
    near = _near(seeds, sites, by, cell).where((F.col("d") <= cell) & (F.col(seed) != F.col("site"))).groupBy(*by, seed).agg(F.min("d").alias("d"))
    return seeds.select(*by, seed).join(near, [*by, seed], "left")


def unique_points(seeds: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """One seed of each place of a group, the first by order."""
    first = F.min(F.struct(*order, F.struct(*(F.col(c) for c in seeds.columns)).alias("row"))).alias("m")
    return seeds.groupBy(*by, "x", "y").agg(first).select("m.row.*")


def hausdorff(one: DataFrame, two: DataFrame, key: str) -> DataFrame:
    """key, d: the larger of the largest distances from a vertex of either shape to the nearest of the other. A key's vertices are those of one shape."""
    pairs = one.select(key, F.col("v").alias("av"), F.col("x").alias("ax"), F.col("y").alias("ay")).join(two.select(key, F.col("v").alias("bv"), F.col("x").alias("bx"), F.col("y").alias("by")), key)
    pairs = pairs.withColumn("d", F.sqrt((F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2))
    sides = [pairs.groupBy(key, v).agg(F.min("d").alias("d")).select(key, "d") for v in ("av", "bv")]
    return sides[0].unionByName(sides[1]).groupBy(key).agg(F.max("d").alias("d"))


def degree_two(ways: DataFrame) -> DataFrame:
    """node, neighbours: nodes with exactly two distinct neighbours over all ways. ways: way_id, pos, node; a closed way repeats its first node."""
    from pyspark.sql.window import Window

    along = Window.partitionBy("way_id").orderBy("pos")
    steps = ways.withColumn("next", F.lead("node").over(along)).where("next is not null and next <> node")
    sides = steps.select("node", F.col("next").alias("other")).unionByName(steps.select(F.col("next").alias("node"), F.col("node").alias("other")))
    counted = sides.distinct().groupBy("node").agg(F.count("*").alias("neighbours"))
    return counted.where("neighbours = 2")


def close_lines(features: DataFrame, points: str = "coordinates") -> DataFrame:
    """features with geom_type Polygon for closed lines of four points or more."""
    shut = (F.col("geom_type") == "LineString") & (F.size(points) >= 4) & (F.element_at(points, 1) == F.element_at(points, -1))
    return features.withColumn("geom_type", F.when(shut, "Polygon").otherwise(F.col("geom_type")))


def snap(v: Column, size: float) -> Column:
    return F.round(v / size) * size
