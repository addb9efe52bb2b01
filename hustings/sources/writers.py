"""Writers; every run writes a new version, never over its own input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assignments_json(rules: DataFrame, path: str) -> None:
    rules.write.mode("errorifexists").json(path)


def assignments_csv(rules: DataFrame, path: str) -> None:
    """Rules as CSV, the specification as its source text."""
    flat = rules.withColumn("spec", F.col("spec.raw")) if "spec" in rules.columns else rules
    flat.write.mode("errorifexists").csv(path, header=True, quote='"', escape='"')


def features(df: DataFrame, geometry: str, props: list[str]) -> DataFrame:
    """value: a GeoJSON feature per row; empty properties are left out and all values are text. geometry holds JSON text."""
    pairs = F.map_from_arrays(F.array(*map(F.lit, props)), F.array(*(F.col(c).cast("string") for c in props)))
    tags = F.to_json(F.map_filter(pairs, lambda _, v: v.isNotNull() & (v != "")))
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), tags, F.lit(',"geometry":'), geometry, F.lit("}")).alias("value"))


def geojson_lines(df: DataFrame, geometry: str, props: list[str], path: str) -> None:
    """A feature per line, as tile builders read them."""
    features(df, geometry, props).write.mode("errorifexists").text(path)


def snapshot(df: DataFrame, root: str, name: str, version: str) -> str:
    """Write df as a version of a named table; returns its path."""
    path = f"{root}/{name}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def polygon_json(shapes: Column, digits: int = 7) -> Column:
    """The GeoJSON text of an area's parts (arrays of rings, holes after the outer ring), each ring closed; one part is a Polygon."""
    place = lambda p: F.array(F.round(p["x"], digits), F.round(p["y"], digits))
    closed = lambda r: F.concat(F.transform(r, place), F.transform(F.slice(r, 1, 1), place))
    parts = F.transform(shapes, lambda rings: F.transform(rings, closed))
    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(parts, F.lit(0)).alias("coordinates")))
    return F.when(F.size(shapes) == 1, one).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates"))))


def point_table(points: DataFrame, root: str, name: str, version: str) -> str:
    """A layer of points as a new version of a table, also without points; what was there stays. Returns its path."""
    return snapshot(points, root, name, version)
