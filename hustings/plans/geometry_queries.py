"""Queries of the geometry: suppliers as diamond-shaped precincts, customers as address points, orders' lines as ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.functions import grid
from hustings.operators import derive, geometry, overlay, voronoi
from hustings.plans.adapters import ADDRESSES, addresses, duck, sql, table

#: Suppliers as sites: a centre off the grid of the addresses, and a reach.
SITES = """
SELECT s_suppkey AS site, concat('mc', cast(s_nationkey AS varchar(4))) AS mcnorm, cast(s_suppkey * 3571 % 10007 AS double) + cast(0.25 AS double) AS sx,
  cast(s_suppkey * 6229 % 10009 AS double) + cast(0.5 AS double) AS sy, cast(s_suppkey % 7 * 100 + 400 AS double) AS r FROM {supplier}
"""
CELL = 1000.0
#: A box around all addresses.
BOX = (-500.0, -500.0, 10510.0, 10510.0)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, SITES, "supplier")


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A diamond around each site, counter-clockwise."""
    corner = lambda dx, dy: F.struct((F.col("sx") + dx * F.col("r")).alias("x"), (F.col("sy") + dy * F.col("r")).alias("y"))
    return sites(spark, sf_dir).withColumn("ring", F.array(corner(1, 0), corner(0, 1), corner(-1, 0), corner(0, -1)))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).select("ra_id", F.col("mcnorm").alias("home"), "x", "y")


def pip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.points_in_polygons(_points(spark, sf_dir), polygons(spark, sf_dir).select("site", "ring"), CELL).select("ra_id", "site")


def wrong_side_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points inside a precinct of another area and of none of their own."""
    found = geometry.each_held(geometry.held_by(_points(spark, sf_dir), polygons(spark, sf_dir), CELL, ["mcnorm"], "site"))
    sides = found.groupBy("ra_id").agg(F.bool_or(F.col("home") == F.col("mcnorm")).alias("own"), F.min(F.when(F.col("home") != F.col("mcnorm"), F.col("key"))).alias("site"))
    return sides.where("not own and site is not null").select("ra_id", "site")


def outside_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    held = geometry.held_by(points.select("ra_id", "x", "y"), polygons(spark, sf_dir).withColumn("any", F.lit(True)), CELL, ["any"])
    return points.join(held.select("ra_id"), "ra_id", "left_anti").select("ra_id")


def voronoi_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = addresses(spark, sf_dir).select("mcnorm", "ra_id", "x", "y")
    found = voronoi.nearest(points, sites(spark, sf_dir).select("mcnorm", "site", "sx", "sy"), ["mcnorm"], "ra_id", CELL)
    return found.select("ra_id", "site", F.round("d", 6).alias("d"))


def clip_cap_300(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = addresses(spark, sf_dir).select("mcnorm", "ra_id", "x", "y")
    return geometry.within_distance(points, sites(spark, sf_dir), ["mcnorm"], "ra_id", 300.0).select("ra_id")


def neighbour_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points at most 400 from some precinct of an even site, and more than 5 outside all precincts of odd ones."""
    shapes = polygons(spark, sf_dir).withColumn("rings", F.array("ring"))
    return overlay.neighbours(_points(spark, sf_dir), shapes.where("site % 2 = 0"), shapes.where("site % 2 = 1"), "ra_id").select("ra_id")


def label_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each bent or pierced shape has its label."""
    found = _notched(spark, sf_dir).select("site", overlay.label_point(F.col("rings")).alias("p"))
    return found.select("site", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


def national_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses as degrees on the national grid, and back from it through the datum's shift."""
    places = addresses(spark, sf_dir).select("ra_id", (F.lit(16.8) + F.col("x") / 10007 * 5.75).alias("lon"), (F.lit(47.7) + F.col("y") / 10009 * 1.95).alias("lat"))
    found = places.withColumns({"g": grid.project(F.col("lon"), F.col("lat")), "m": grid.to_grid(F.col("lon"), F.col("lat"))}).withColumn("b", grid.from_grid(F.col("m.x"), F.col("m.y")))
    return found.select("ra_id", F.round("g.x", 2).alias("x"), F.round("g.y", 2).alias("y"), F.round("b.x", 6).alias("lon"), F.round("b.y", 6).alias("lat"))


def isolated_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points whose nearest other point of their area is 400 away or more."""
    seeds = addresses(spark, sf_dir).select("mcnorm", "ra_id", "x", "y")
    return geometry.nearest_other(seeds, ["mcnorm"], "ra_id", 400.0).where("d is null or d >= 400").select("ra_id")


def overlap_selfjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.overlaps(polygons(spark, sf_dir), "site", CELL).select("a", "b", F.round("overlap", 3).alias("overlap"))


def shoelace_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons(spark, sf_dir).select("site", F.round(geometry.area(F.col("ring")), 3).alias("area"))


def dissolve_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the precincts of each city part, however many lie over each other."""
    shapes = polygons(spark, sf_dir)
    parts = shapes.select("mcnorm", F.col("site").alias("part"), F.lit("own").alias("label"), F.array("ring").alias("rings"))
    areas = overlay.region_areas(overlay.regions(overlay.arrangement(parts, ["mcnorm"], CELL), ["mcnorm"], lambda labels: F.get(labels, F.lit(0))), ["mcnorm"])
    return shapes.groupBy("mcnorm").agg(F.count("*").alias("n")).join(areas, "mcnorm").select("mcnorm", "n", _whole("area"))


def _whole(area: str) -> Column:
    """Square metres; areas here are multiples of 1/32, so that rounding errors don't show."""
    return F.floor(F.col(area) + 0.01).alias(area)


def dissolve_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area and length of the rings around the precincts of each city part."""
    parts = polygons(spark, sf_dir).select("mcnorm", F.col("site").alias("part"), F.lit("own").alias("label"), F.array("ring").alias("rings"))
    found = overlay.dissolve(parts, ["mcnorm"], CELL)
    length = F.aggregate(F.flatten(F.transform("rings", geometry._edges)), F.lit(0.0), lambda n, e: n + F.sqrt((e["b"]["x"] - e["a"]["x"]) ** 2 + (e["b"]["y"] - e["a"]["y"]) ** 2))
    return found.groupBy("mcnorm").agg(F.sum("area").alias("area"), F.sum(length).alias("length")).select("mcnorm", _whole("area"), F.round("length", 1).alias("length"))


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = addresses(spark, sf_dir).select("mcnorm", F.col("ra_id").cast("long").alias("ra_id"), "x", "y")
    return geometry.unique_points(seeds, ["mcnorm"], ["ra_id"])


def voronoi_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' cells in a box around their city part."""
    seeds = _seeds(spark, sf_dir)
    limits = seeds.select("mcnorm").distinct().select("mcnorm", *(F.lit(v).alias(c) for c, v in zip(("x0", "y0", "x1", "y1"), BOX, strict=True)))
    cells = voronoi.cells(seeds, limits, ["mcnorm"], "ra_id", CELL / 4)
    return cells.select("mcnorm", "ra_id", F.round(geometry.signed_area(F.col("ring")), 1).alias("area"))


def derive_precincts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five precincts of each city part from customers as seeds, up to a square boundary."""
    seeds = addresses(spark, sf_dir).select("mcnorm", F.col("ra_id").cast("long").alias("ra_id"), (F.col("ra_id").cast("long") % 5 + 1).cast("int").alias("okrsok"), "x", "y")
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    edge = F.array(F.array(corner(-1.0, -1.0), corner(10010.0, -1.0), corner(10010.0, 10010.0), corner(-1.0, 10010.0)))
    found = derive.derive(seeds, seeds.select("mcnorm").distinct().withColumn("rings", edge), clip=0, cell=CELL / 4)
    return found.groupBy("mcnorm", "okrsok").agg(F.round(F.sum("area") / 10_000, 0).alias("hectares"))


def _uv(u: Column, v: Column) -> Column:
    """The place of sum u and difference v of its coordinates."""
    return F.struct(((u + v) / 2).alias("x"), ((u - v) / 2).alias("y"))


def _notched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds around sites: every third without a quarter, every third with a hole."""
    u, v, r = F.col("sx") + F.col("sy"), F.col("sx") - F.col("sy"), F.col("r")
    square = lambda h: [_uv(u + h, v + h), _uv(u - h, v + h), _uv(u - h, v - h), _uv(u + h, v - h)]
    full, bent = F.array(*square(r)), F.array(_uv(u, v), _uv(u, v + r), _uv(u - r, v + r), _uv(u - r, v - r), _uv(u + r, v - r), _uv(u + r, v))
    rings = F.when(F.col("site") % 3 == 0, F.array(bent)).when(F.col("site") % 3 == 1, F.array(full, F.array(*square(r / 2)))).otherwise(F.array(full))
    return sites(spark, sf_dir).withColumn("rings", rings)


def overlay_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bent and pierced shapes of even sites over those of odd ones, by city part."""
    shapes = _notched(spark, sf_dir).withColumn("part", F.col("site"))
    found = overlay.overlay_areas(shapes.where("site % 2 = 0"), shapes.where("site % 2 = 1"), ["mcnorm"], CELL)
    return found.select("mcnorm", *(_whole(c) for c in ("only_one", "both", "only_two")))


def overlap_concave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlay.overlaps(_notched(spark, sf_dir), "site", CELL).select("a", "b", _whole("overlap"))


def shape_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds drawn well, crossed, with a hole outside, with holes in each other, and with a corner on a side."""
    u, v, r, k = F.col("sx") + F.col("sy"), F.col("sx") - F.col("sy"), F.col("r"), F.col("site") % 5
    square = lambda h, off=0.0: [_uv(u + off + h, v + h), _uv(u + off - h, v + h), _uv(u + off - h, v - h), _uv(u + off + h, v - h)]
    a, b, c, d = square(r)
    rings = (
        F.when(k == 0, F.array(F.array(a, c, b, d))).when(k == 1, F.array(F.array(a, b, c, d), F.array(*square(F.lit(50.0), r * 3))))
        .when(k == 2, F.array(F.array(a, b, c, d), F.array(*square(r / 2)), F.array(*square(r / 4)))).when(k == 3, F.array(F.array(a, b, _uv(u, v - r), c, d)))
        .otherwise(F.array(F.array(a, b, c, d), F.array(*square(r / 2))))
    )
    drawn = F.when(k == 3, F.array(F.array(a, b, c, d, _uv(u, v + r)))).otherwise(rings)
    found = overlay.faults(sites(spark, sf_dir).withColumn("rings", drawn), "site", CELL)
    return found.select("site", "fault", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


def border_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as bricks, every second row moved by half a brick: how far neighbours run along each other."""
    n = F.col("p_partkey")
    row = F.floor(n / 40)
    bricks = table(spark, sf_dir, "part").select(n.cast("long").alias("part"), (n % 40 * 100.0 + row % 2 * 50.0).alias("x"), (row * 100.0).alias("y"))
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    rings = F.array(F.array(corner(0, 0), corner(100, 0), corner(100, 100), corner(0, 100)))
    shapes = bricks.select(F.lit("wall").alias("mcnorm"), "part", F.col("part").cast("string").alias("label"), rings.alias("rings"))
    return overlay.shared_borders(shapes, ["mcnorm"], 250.0).select("a", "b", F.round("length", 3).alias("length"))


def hausdorff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds against themselves moved and grown."""
    corners = polygons(spark, sf_dir).select("site", "r", F.posexplode("ring").alias("v", "p")).select("site", "v", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "r")
    moved = corners.select("site", "v", (F.col("x") + F.col("site") % 5).alias("x"), F.col("y"))
    return geometry.hausdorff(corners, moved, "site").select("site", F.round("d", 6).alias("d"))


WAYS = "SELECT l_orderkey AS way_id, cast(l_linenumber AS bigint) * 10000000 + l_partkey AS pos, l_partkey * 10 + l_linenumber AS node FROM {lineitem}"


def degree2_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.degree_two(sql(spark, sf_dir, WAYS, "lineitem")).select("node")


def distinct_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = addresses(spark, sf_dir).select("mcnorm", "ra_id", (F.floor(F.col("x") / 500)).alias("x"), (F.floor(F.col("y") / 500)).alias("y"))
    return geometry.unique_points(seeds, ["mcnorm"], ["ra_id"]).select("mcnorm", "ra_id")


QUERIES = {f.__name__: f for f in (
    pip_join, wrong_side_anti, outside_anti, voronoi_nearest, clip_cap_300, neighbour_semi, isolated_knn, overlap_selfjoin, shoelace_area, dissolve_area, dissolve_rings, voronoi_cells, derive_precincts,
    overlay_areas, overlap_concave, shape_faults, border_lengths, label_places, national_grid, hausdorff, degree2_vertices, distinct_on,
)}

_BASE = f"WITH a AS ({duck(ADDRESSES, 'customer')}), s AS ({duck(SITES, 'supplier')})"
_IN = "abs(x - sx) + abs(y - sy) < r"
_DIST = "sqrt((x - sx) * (x - sx) + (y - sy) * (y - sy))"
#: Diamonds are squares in x + y and x - y.
_SHARED = """p AS (SELECT a.site AS a, b.site AS b, a.mcnorm AS ma, b.mcnorm AS mb, greatest(0, least(a.sx + a.sy + a.r, b.sx + b.sy + b.r) - greatest(a.sx + a.sy - a.r, b.sx + b.sy - b.r))
  * greatest(0, least(a.sx - a.sy + a.r, b.sx - b.sy + b.r) - greatest(a.sx - a.sy - a.r, b.sx - b.sy - b.r)) / 2 AS overlap FROM s a JOIN s b ON a.site < b.site)"""
#: The cells between all corners' sums u and differences v, and whether a diamond holds them.
_GRID = f"""{_BASE}, us AS (SELECT DISTINCT mcnorm, unnest([sx + sy - r, sx + sy + r]) AS u FROM s), vs AS (SELECT DISTINCT mcnorm, unnest([sx - sy - r, sx - sy + r]) AS v FROM s),
  ui AS (SELECT mcnorm, u AS u0, lead(u) OVER (PARTITION BY mcnorm ORDER BY u) AS u1 FROM us), vi AS (SELECT mcnorm, v AS v0, lead(v) OVER (PARTITION BY mcnorm ORDER BY v) AS v1 FROM vs),
  c AS (SELECT ui.*, v0, v1, EXISTS (SELECT 1 FROM s WHERE s.mcnorm = ui.mcnorm AND (u0 + u1) / 2 BETWEEN sx + sy - r AND sx + sy + r AND (v0 + v1) / 2 BETWEEN sx - sy - r AND sx - sy + r) AS held
    FROM ui JOIN vi ON vi.mcnorm = ui.mcnorm AND u1 IS NOT NULL AND v1 IS NOT NULL)"""
#: Each diamond in sums and differences, and the rectangle that is cut out of it.
_NOTCHED = f"""{_BASE}, p AS (SELECT *, sx + sy AS u, sx - sy AS v, CASE site % 3 WHEN 0 THEN sx + sy WHEN 1 THEN sx + sy - r / 2 ELSE sx + sy END AS ru0, CASE site % 3 WHEN 0 THEN sx + sy + r WHEN 1 THEN sx + sy + r / 2 ELSE sx + sy END AS ru1,
  CASE site % 3 WHEN 0 THEN sx - sy WHEN 1 THEN sx - sy - r / 2 ELSE sx - sy END AS rv0, CASE site % 3 WHEN 0 THEN sx - sy + r WHEN 1 THEN sx - sy + r / 2 ELSE sx - sy END AS rv1 FROM s)"""
_RECT = "greatest(0, least({a1}, {b1}) - greatest({a0}, {b0})) * greatest(0, least({c1}, {d1}) - greatest({c0}, {d0})) / 2"
#: Cells by brute force: of all meetings of two borders those that no other border cuts off, in order around the seed.
_CELLS = f"""{_BASE}, k AS (SELECT mcnorm, min(cast(ra_id AS bigint)) AS n, x, y FROM a GROUP BY mcnorm, x, y),
  h AS (SELECT s.n, s.x, s.y, row_number() OVER (PARTITION BY s.n ORDER BY t.n) AS i, t.x - s.x AS p, t.y - s.y AS q, (t.x * t.x + t.y * t.y - s.x * s.x - s.y * s.y) / 2 AS m FROM k s JOIN k t ON t.mcnorm = s.mcnorm AND t.n <> s.n
    UNION ALL SELECT n, x, y, -i, p, q, m FROM k, (VALUES (1, 1.0::double, 0.0::double, {{x1}}::double), (2, -1.0, 0.0, -({{x0}}::double)), (3, 0.0, 1.0, {{y1}}::double), (4, 0.0, -1.0, -({{y0}}::double))) w(i, p, q, m)),
  c AS (SELECT f.n, f.x AS sx, f.y AS sy, (f.m * g.q - g.m * f.q) / (f.p * g.q - g.p * f.q) AS x, (f.p * g.m - g.p * f.m) / (f.p * g.q - g.p * f.q) AS y FROM h f JOIN h g ON g.n = f.n AND f.i < g.i WHERE abs(f.p * g.q - g.p * f.q) > 1e-9),
  v AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.n = c.n AND h.p * c.x + h.q * c.y > h.m + 1e-6 * (abs(h.p) + abs(h.q)))),
  o AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy FROM v WINDOW w AS (PARTITION BY n ORDER BY atan2(y - sy, x - sx))),
  cell AS (SELECT mcnorm, n, sum(o.x * coalesce(ny, fy) - o.y * coalesce(nx, fx)) / 2 AS area FROM o JOIN k USING (n) GROUP BY ALL)"""
ORACLES = {
    "pip_join": f"{_BASE} SELECT ra_id, site FROM a JOIN s ON {_IN}",
    "wrong_side_anti": f"{_BASE} SELECT ra_id, min(site) AS site FROM a JOIN s ON {_IN} WHERE a.mcnorm <> s.mcnorm AND NOT EXISTS (SELECT 1 FROM s o WHERE o.mcnorm = a.mcnorm AND abs(x - o.sx) + abs(y - o.sy) < o.r) GROUP BY ra_id",
    "outside_anti": f"{_BASE} SELECT ra_id FROM a WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_IN})",
    "voronoi_nearest": f"{_BASE} SELECT ra_id, site, round(d, 6) AS d FROM (SELECT ra_id, site, {_DIST} AS d, row_number() OVER (PARTITION BY ra_id ORDER BY d, site) AS k FROM a JOIN s USING (mcnorm)) WHERE k = 1",
    "clip_cap_300": f"{_BASE} SELECT ra_id FROM a WHERE EXISTS (SELECT 1 FROM s WHERE s.mcnorm = a.mcnorm AND {_DIST} <= 300)",
    "neighbour_semi": f"""{_BASE}, n AS (SELECT ra_id, min(CASE WHEN site % 2 = 0 THEN d END) AS near, min(CASE WHEN site % 2 = 1 THEN d END) AS own FROM (SELECT ra_id, site,
        sqrt(power(greatest(abs(x + y - sx - sy) - r, 0), 2) + power(greatest(abs(x - y - sx + sy) - r, 0), 2)) / sqrt(2) AS d FROM a JOIN s ON true) GROUP BY ra_id)
      SELECT ra_id FROM n WHERE near <= 400 AND NOT coalesce(own <= 5, false)""",
    "label_places": f"{_BASE} SELECT site, round(sx - CASE site % 3 WHEN 0 THEN r / 4 WHEN 1 THEN r / 2 ELSE 0 END, 3) AS x, round(sy + CASE site % 3 WHEN 2 THEN r / 2 ELSE r / 4 END, 3) AS y FROM s",
    "national_grid": f"""{_BASE}, c AS (SELECT 6377397.155::double AS a, 1 - pow(1 - 1 / 299.1528128::double, 2) AS e2, radians(49.5) AS f, radians(24 + 50 / 60.0::double) AS l, radians(30 + 17 / 60.0::double + 17.30311::double / 3600) AS t, radians(78.5) AS s),
      k AS (SELECT *, sqrt(e2) AS e, a * sqrt(1 - e2) / (1 - e2 * pow(sin(f), 2)) AS ra, sqrt(1 + e2 * pow(cos(f), 4) / (1 - e2)) AS b, sin(s) AS n FROM c),
      q AS (SELECT *, tan(pi() / 4 + asin(sin(f) / b) / 2) * pow((1 + e * sin(f)) / (1 - e * sin(f)), e * b / 2) / pow(tan(pi() / 4 + f / 2), b) AS t0, 0.9999 * ra / tan(s) AS r0 FROM k),
      p AS (SELECT ra_id, 16.8::double + x / 10007 * 5.75::double AS lon, 47.7::double + y / 10009 * 1.95::double AS lat FROM a),
      u AS (SELECT p.*, q.*, 2 * (atan(t0 * pow(tan(radians(lat) / 2 + pi() / 4), b) / pow((1 + e * sin(radians(lat))) / (1 - e * sin(radians(lat))), e * b / 2)) - pi() / 4) AS u, b * (l - radians(lon)) AS v FROM p, q),
      d AS (SELECT *, asin(cos(t) * sin(u) + sin(t) * cos(u) * cos(v)) AS w FROM u),
      o AS (SELECT *, asin(cos(u) * sin(v) / cos(w)) * n AS h, r0 * pow(tan(pi() / 4 + s / 2), n) / pow(tan(w / 2 + pi() / 4), n) AS r FROM d)
      SELECT ra_id, round(-r * sin(h), 2) AS x, round(-r * cos(h), 2) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM o""",
    "isolated_knn": f"{_BASE} SELECT ra_id FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.mcnorm = a.mcnorm AND b.ra_id <> a.ra_id AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 400)",
    "overlap_selfjoin": f"{_BASE}, {_SHARED} SELECT a, b, round(overlap, 3) AS overlap FROM p WHERE overlap > 1",
    "shoelace_area": f"{_BASE} SELECT site, round(2 * r * r, 3) AS area FROM s",
    "dissolve_area": f"{_GRID} SELECT c.mcnorm, (SELECT count(*) FROM s o WHERE o.mcnorm = c.mcnorm) AS n, cast(floor(sum((u1 - u0) * (v1 - v0)) / 2 + 0.01) AS bigint) AS area FROM c WHERE held GROUP BY c.mcnorm",
    "dissolve_rings": f"""{_GRID}, e AS (SELECT mcnorm, sum(CASE WHEN NOT coalesce(above, false) THEN u1 - u0 ELSE 0 END + CASE WHEN NOT coalesce(below, false) THEN u1 - u0 ELSE 0 END
        + CASE WHEN NOT coalesce(further, false) THEN v1 - v0 ELSE 0 END + CASE WHEN NOT coalesce(nearer, false) THEN v1 - v0 ELSE 0 END) / sqrt(2) AS length, sum((u1 - u0) * (v1 - v0)) / 2 AS area
      FROM (SELECT *, lead(held) OVER (PARTITION BY mcnorm, u0 ORDER BY v0) AS above, lag(held) OVER (PARTITION BY mcnorm, u0 ORDER BY v0) AS below,
        lead(held) OVER (PARTITION BY mcnorm, v0 ORDER BY u0) AS further, lag(held) OVER (PARTITION BY mcnorm, v0 ORDER BY u0) AS nearer FROM c) WHERE held GROUP BY mcnorm)
      SELECT mcnorm, cast(floor(area + 0.01) AS bigint) AS area, round(length, 1) AS length FROM e""",
    "voronoi_cells": f"{_CELLS.format(x0=BOX[0], y0=BOX[1], x1=BOX[2], y1=BOX[3])} SELECT mcnorm, n AS ra_id, round(area, 1) AS area FROM cell",
    "derive_precincts": f"{_CELLS.format(x0=-1, y0=-1, x1=10010, y1=10010)} SELECT mcnorm, cast(n % 5 + 1 AS int) AS okrsok, round(sum(area) / 10000) AS hectares FROM cell GROUP BY ALL",
    "overlay_areas": f"""{_NOTCHED}, us AS (SELECT DISTINCT mcnorm, unnest([u - r, u + r, ru0, ru1]) AS u FROM p), vs AS (SELECT DISTINCT mcnorm, unnest([v - r, v + r, rv0, rv1]) AS v FROM p),
      ui AS (SELECT mcnorm, u AS u0, lead(u) OVER (PARTITION BY mcnorm ORDER BY u) AS u1 FROM us), vi AS (SELECT mcnorm, v AS v0, lead(v) OVER (PARTITION BY mcnorm ORDER BY v) AS v1 FROM vs),
      c AS (SELECT ui.mcnorm, (u1 - u0) * (v1 - v0) / 2 AS area, bool_or(site % 2 = 0) AS one, bool_or(site % 2 = 1) AS two FROM ui JOIN vi USING (mcnorm) JOIN p ON p.mcnorm = ui.mcnorm
        AND (u0 + u1) / 2 BETWEEN p.u - r AND p.u + r AND (v0 + v1) / 2 BETWEEN p.v - r AND p.v + r AND NOT ((u0 + u1) / 2 BETWEEN ru0 AND ru1 AND (v0 + v1) / 2 BETWEEN rv0 AND rv1) GROUP BY ui.mcnorm, u0, u1, v0, v1)
      SELECT mcnorm, cast(floor(coalesce(sum(area) FILTER (WHERE NOT two), 0) + 0.01) AS bigint) AS only_one, cast(floor(coalesce(sum(area) FILTER (WHERE one AND two), 0) + 0.01) AS bigint) AS both,
        cast(floor(coalesce(sum(area) FILTER (WHERE NOT one), 0) + 0.01) AS bigint) AS only_two FROM c GROUP BY mcnorm""",
    "overlap_concave": f"""{_NOTCHED}, m AS (SELECT a.site AS a, b.site AS b, {_RECT.format(a0='a.u - a.r', a1='a.u + a.r', b0='b.u - b.r', b1='b.u + b.r', c0='a.v - a.r', c1='a.v + a.r', d0='b.v - b.r', d1='b.v + b.r')}
        - {_RECT.format(a0='a.ru0', a1='a.ru1', b0='b.u - b.r', b1='b.u + b.r', c0='a.rv0', c1='a.rv1', d0='b.v - b.r', d1='b.v + b.r')}
        - {_RECT.format(a0='a.u - a.r', a1='a.u + a.r', b0='b.ru0', b1='b.ru1', c0='a.v - a.r', c1='a.v + a.r', d0='b.rv0', d1='b.rv1')}
        + {_RECT.format(a0='a.ru0', a1='a.ru1', b0='b.ru0', b1='b.ru1', c0='a.rv0', c1='a.rv1', d0='b.rv0', d1='b.rv1')} AS overlap FROM p a JOIN p b ON a.site < b.site)
      SELECT a, b, cast(floor(overlap + 0.01) AS bigint) AS overlap FROM m WHERE overlap > 1""",
    "shape_faults": f"""{_BASE} SELECT site, CASE site % 5 WHEN 0 THEN 'self-intersection' WHEN 3 THEN 'self-intersection' WHEN 1 THEN 'hole-lies-outside-shell' WHEN 2 THEN 'holes-are-nested' END AS fault,
      round(CASE site % 5 WHEN 0 THEN sx WHEN 1 THEN sx + 1.5::double * r + 25 WHEN 2 THEN sx + 0.125::double * r WHEN 3 THEN sx + r / 2 END, 3) AS x,
      round(CASE site % 5 WHEN 0 THEN sy WHEN 1 THEN sy + 1.5::double * r - 25 WHEN 2 THEN sy - 0.125::double * r WHEN 3 THEN sy - r / 2 END, 3) AS y FROM s WHERE site % 5 < 4""",
    "border_lengths": """WITH k AS (SELECT cast(p_partkey AS bigint) AS n, p_partkey // 40 AS r, p_partkey % 40 * 100.0::double + p_partkey // 40 % 2 * 50.0::double AS x FROM part)
      SELECT a.n AS a, b.n AS b, CASE WHEN a.r = b.r THEN 100.0::double ELSE 50.0::double END AS length FROM k a JOIN k b ON a.n < b.n AND (a.r = b.r AND b.x = a.x + 100 OR b.r = a.r + 1 AND abs(a.x - b.x) < 100)""",
    "hausdorff": f"{_BASE} SELECT site, cast(site % 5 AS double) AS d FROM s",
    "degree2_vertices": f"""WITH w AS (SELECT node, lead(node) OVER (PARTITION BY way_id ORDER BY pos) AS nxt FROM ({duck(WAYS, "lineitem")})),
      e AS (SELECT node, nxt AS o FROM w WHERE nxt <> node UNION SELECT nxt, node FROM w WHERE nxt <> node) SELECT node FROM e GROUP BY node HAVING count(*) = 2""",
    "distinct_on": f"{_BASE} SELECT mcnorm, min(ra_id) AS ra_id FROM a GROUP BY mcnorm, floor(x / 500), floor(y / 500)",
}
