"""The national grid: a published point, round trips, and scale and angles near the centre."""

import math

from pyspark.sql import functions as F

from hustings.functions import grid


def test_published_point(spark):
    """The worked example of the projection's public definition: southing 1050538.643, westing 568990.997."""
    lon, lat = 16 + 50 / 60 + 59.179 / 3600, 50 + 12 / 60 + 32.442 / 3600
    p = spark.range(1).select(grid.project(F.lit(lon), F.lit(lat)).alias("p")).first().p
    # a thousandth of a second of latitude, as the example gives it, is 31 mm
    assert abs(p.x + 568990.997) < 0.03 and abs(p.y + 1050538.643) < 0.03
    back = spark.range(1).select(grid.unproject(F.lit(p.x), F.lit(p.y)).alias("p")).first().p
    assert abs(back.x - lon) < 1e-9 and abs(back.y - lat) < 1e-9


def test_round_trips(spark):
    places = [(17.0 + i * 0.5, 47.8 + j * 0.2) for i in range(11) for j in range(9)]
    frame = spark.createDataFrame([*places, (None, 48.0)], "lon double, lat double")
    there = frame.withColumn("g", grid.to_grid(F.col("lon"), F.col("lat")))
    back = there.withColumn("b", grid.from_grid(F.col("g.x"), F.col("g.y"))).collect()
    assert [r for r in back if r.lon is None][0].g is None and [r for r in back if r.lon is None][0].b is None
    for r in back:
        if r.lon is not None:
            metres = math.hypot((r.b.x - r.lon) * 111_320 * math.cos(math.radians(r.lat)), (r.b.y - r.lat) * 110_574)
            assert metres < 0.01 and -600_000 < r.g.x < -160_000 and -1_350_000 < r.g.y < -1_100_000


def test_conformal(spark):
    """Small steps east and north stay at right angles and have one length."""
    lon, lat, d = 19.0, 48.7, 1e-4
    p, e, n = (spark.range(1).select(grid.project(F.lit(lon + a), F.lit(lat + b)).alias("p")).first().p for a, b in ((0, 0), (d, 0), (0, d)))
    a, b = (e.x - p.x, e.y - p.y), (n.x - p.x, n.y - p.y)
    assert abs(a[0] * b[0] + a[1] * b[1]) < 1e-3
    s = math.sin(math.radians(lat))
    axis, e2 = grid.BESSEL
    east, north = math.radians(d) * axis / math.sqrt(1 - e2 * s * s) * math.cos(math.radians(lat)), math.radians(d) * axis * (1 - e2) / (1 - e2 * s * s) ** 1.5
    assert abs(math.hypot(*a) / east - math.hypot(*b) / north) < 1e-4 and abs(math.hypot(*a) / east - 1) < 2e-4
