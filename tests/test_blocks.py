"""Joins block by block: crowded cells give all they hold, over many tasks."""

import random

from pyspark.sql import functions as F

from hustings.operators import blocks, geometry, label, matching, overlay, voronoi

POINTS, RINGS = "p long, x double, y double", "mc string, k long, ring array<struct<x:double,y:double>>"


def diamond(x, y, r):
    return [(x + r, y), (x, y + r), (x - r, y), (x, y - r)]


def crowd(spark, n=3000, m=1500):
    """Points and diamonds of one grid cell, in one partition each; some points on corners and sides."""
    r = random.Random(5)
    points = [(k, float(r.randrange(100)), float(r.randrange(100))) for k in range(n)]
    shapes = [("ab"[k % 2], k, float(r.randrange(100)), float(r.randrange(100)), float(r.randrange(1, 9))) for k in range(m)]
    rings = spark.createDataFrame([(mc, k, diamond(x, y, s)) for mc, k, x, y, s in shapes], RINGS).coalesce(1)
    return points, shapes, spark.createDataFrame(points, POINTS).coalesce(1), rings


def inside(ring, x, y):
    n = 0
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
        n += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return n % 2 == 1


def test_points_of_a_crowded_cell(spark):
    points, shapes, frame, rings = crowd(spark)
    found = geometry.points_in_polygons(frame, rings, 1000.0).select("p", "k", F.spark_partition_id().alias("task")).collect()
    want = {(p, k) for mc, k, sx, sy, r in shapes for ring in [diamond(sx, sy, r)] for p, x, y in points if abs(x - sx) + abs(y - sy) <= r and inside(ring, x, y)}
    assert len(found) == len(want) and {(f.p, f.k) for f in found} == want
    assert len({f.task for f in found}) > 1  # a cell is more than one task


def test_what_holds_a_point_is_counted(spark):
    points, shapes, frame, rings = crowd(spark)
    got = {}
    for f in geometry.each_held(geometry.held_by(frame, rings, 1000.0, ["mc"], "k")).collect():
        n, least = got.get((f.p, f.mc), (0, f.key))
        got[f.p, f.mc] = n + f.n, min(least, f.key)
    want = {}
    for p, k, mc in [(f.p, f.k, f.mc) for f in geometry.points_in_polygons(frame, rings, 1000.0).collect()]:
        n, least = want.get((p, mc), (0, k))
        want[p, mc] = n + 1, min(least, k)
    assert got == want and max(n for n, _ in got.values()) > 10


def test_nothing_known_of_a_place(spark):
    frame = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 1.0, 1.0), (4, 1.0, None)], POINTS)
    rings = spark.createDataFrame([("a", 1, [(0.0, 0.0), (9.0, 0.0), (0.0, 9.0)]), ("a", 2, None), ("a", 3, [])], RINGS)
    assert [(f.p, f.k) for f in geometry.points_in_polygons(frame, rings, 10.0).collect()] == [(3, 1)]


def shared(a, b):
    """Diamonds are squares in x + y and x - y."""
    side = lambda v, w: max(0.0, min(v + a[4], w + b[4]) - max(v - a[4], w - b[4]))
    return side(a[2] + a[3], b[2] + b[3]) * side(a[2] - a[3], b[2] - b[3]) / 2


def test_shapes_of_a_crowded_cell(spark):
    _, shapes, _, rings = crowd(spark, 1)
    found = geometry.overlaps(rings, "k", 1000.0, 1.0).select("a", "b", "overlap", F.spark_partition_id().alias("task")).collect()
    want = {(a[1], b[1]): s for a in shapes for b in shapes if a[1] < b[1] and (s := shared(a, b)) > 1}
    assert len(found) == len(want) and all(abs(want[f.a, f.b] - f.overlap) < 1e-9 for f in found)
    assert len({f.task for f in found}) > 1
    own = {(f.a, f.b) for f in geometry.overlaps(rings, "k", 7.0, 1.0, by=["mc"]).collect()}
    assert own == {p for p in want if (p[0] - p[1]) % 2 == 0}


def test_concave_pierced_and_turned_shapes(spark):
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    shapes = [(1, [square(0.0, 0.0, 10.0), square(2.0, 2.0, 6.0)]), (2, [square(1.0, 1.0, 3.0)[::-1]]), (3, [[(0.0, 0.0), (10.0, 0.0), (10.0, 1.0), (1.0, 1.0), (1.0, 10.0), (0.0, 10.0)]]), (4, [])]
    frame = spark.createDataFrame(shapes, "k long, rings array<array<struct<x:double,y:double>>>")
    got = {(f.a, f.b): round(f.overlap, 9) for f in overlay.overlaps(frame, "k", 4.0, 0.0).collect()}
    assert got == {(1, 2): 5.0, (1, 3): 19.0}
    convex = frame.where("size(rings) > 0").select("k", overlay.is_convex(F.get("rings", F.lit(0))).alias("c")).collect()
    assert {r.k: r.c for r in convex} == {1: True, 2: True, 3: False}


def test_streets_and_numbers_are_matched_once(spark):
    rules = spark.createDataFrame([("a", "dlha", 1, "both", "WHOLE", "orientacne", ([], [], ""), 1)], "mcnorm string, street_norm string, okrsok int, parity string, cls string, number_kind string, spec struct<ranges:array<struct<lo:int,hi:int,parity:string>>,singles:array<string>,raw:string>, row_idx int")
    index = matching.index_rules(rules)
    held = spark.range(100).selectExpr("'a' mcnorm", "cast(id as string) ra_id", "'Dlhá' street", "cast(id % 2 as string) orient", "cast(id as string) supisne", "0.0D x", "0.0D y", "id % 3 n")
    told, each = label._match_held(held.where("n > 0"), index, ["ra_id", "street", "orient", "supisne", "x", "y"])
    assert sorted((t.orient, t.times) for t in told.collect()) == [("0", 50), ("1", 49)]
    rows = each.collect()
    assert len(rows) == 99 and all(r.status == "ok" and r.okrsok == 1 for r in rows)
    assert blocks.BLOCK < 1500  # crowds above are several blocks


def test_first_grid_follows_the_seeds(spark):
    r = random.Random(7)
    frame = spark.createDataFrame([("m", k, r.uniform(0, 100), r.uniform(0, 100)) for k in range(1200)], "mc string, id long, x double, y double")
    size, more = voronoi._finest(frame, ["mc"], "x", "y", 100.0)
    assert size == 100 / 16 and more == 2 and voronoi._finest(frame.limit(2), ["mc"], "x", "y", 100.0) == (100.0, 0)
    limits = spark.createDataFrame([("m", -10.0, -10.0, 110.0, 110.0)], "mc string, x0 double, y0 double, x1 double, y1 double")
    found = voronoi.cells(frame, limits, ["mc"], "id", 100.0).select("id", geometry.signed_area(F.col("ring")).alias("a")).collect()
    assert len(found) == 1200 and abs(sum(f.a for f in found) - 120**2) < 1e-6


def test_near_a_crowd_of_shapes(spark):
    points, shapes, frame, rings = crowd(spark, 400, 60)
    found = overlay.within_reach(frame.withColumn("mc", F.lit("a")), rings.select("mc", F.array("ring").alias("rings")), "p", ["mc"], 0.5)
    off = lambda x, y, s: (max(abs(x + y - s[2] - s[3]) - s[4], 0) ** 2 + max(abs(x - y - s[2] + s[3]) - s[4], 0) ** 2) ** 0.5 / 2**0.5
    assert {r.p for r in found.collect()} == {p for p, x, y in points if any(off(x, y, s) <= 0.5 for s in shapes if s[0] == "a")}


def test_points_of_overlapping_pairs(spark):
    points, shapes, frame, rings = crowd(spark, 300, 1100)
    seeds = frame.select(F.struct(F.when(F.col("p") % 3 == 0, "a").when(F.col("p") % 3 == 1, "b").alias("mc")).alias("home"), "x", "y")
    found = geometry.points_of_pairs(seeds, rings.select(F.col("k").alias("key"), F.struct("mc").alias("home"), "ring"), 40.0)
    got = {(r.a, r.b): (r.na, r.nb) for r in found.groupBy("a", "b").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb")).collect()}
    want = {}
    for p, x, y in points:
        holding = [(k, mc) for mc, k, sx, sy, r in shapes if abs(x - sx) + abs(y - sy) <= r and inside(diamond(sx, sy, r), x, y)]
        for a, ma in holding:
            for b, mb in holding:
                home = {0: "a", 1: "b"}.get(p % 3)
                if a < b and home in (ma, mb):
                    n = want.get((a, b), (0, 0))
                    want[a, b] = n[0] + (home == ma), n[1] + (home == mb)
    assert got == want and len(want) > 1000


def test_lone_shapes_are_not_packed(spark, monkeypatch):
    packed, seen = blocks.packed, []
    monkeypatch.setattr(blocks, "packed", lambda rows, *a, **k: seen.append(rows.count()) or packed(rows, *a, **k))
    square = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
    rings = spark.createDataFrame([(mc, k, square) for k, mc in enumerate("abcdd")], RINGS)
    assert [(r.a, r.b, r.overlap) for r in geometry.overlaps(rings, "k", 100.0, by=["mc"]).collect()] == [(3, 4, 81.0)] and seen == [2]
