"""Readers of the pipeline's inputs; parsing happens in Spark's expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_COLUMNS = ("level", "page", "par", "block", "line", "word", "left", "top", "width", "height", "conf", "text")


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """idx, geom_type, coordinates (JSON text) and props (a map) of the features of each file."""
    kind = "struct<features: array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>>"
    files = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("c"))
    return files.select(F.posexplode("c.features").alias("idx", "f")).select("idx", F.col("f.geometry.type").alias("geom_type"), F.col("f.geometry.coordinates").alias("coordinates"), F.col("f.properties").alias("props"))


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of files that hold one JSON array each."""
    return spark.read.schema(schema).json(path, multiLine=True)


def whole_streets(spark: SparkSession, path: str) -> DataFrame:
    """mc, mcNorm, okrsok, street of files {mc, mcNorm, okrsky: {number: [street]}}."""
    files = spark.read.schema("mc string, mcNorm string, okrsky map<string,array<string>>").json(path, multiLine=True)
    return files.select("mc", "mcNorm", F.explode("okrsky").alias("okrsok", "streets")).select("mc", "mcNorm", F.col("okrsok").cast("int").alias("okrsok"), F.explode("streets").alias("street"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """doc (file), line_no, text of plain text files, in order."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc"), "value")
    return files.select("doc", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "text"))


def words(spark: SparkSession, path: str) -> DataFrame:
    """page, x, y, text of the words (level 5) in tab-separated word boxes."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="", schema=", ".join(f"`{c}` string" for c in WORD_COLUMNS))
    return rows.where("level = '5'").select(F.col("page").cast("int"), F.col("left").cast("double").alias("x"), F.col("top").cast("double").alias("y"), "text")


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, escape='"')


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """Seed overrides: the four columns that count; empty values are null."""
    rows = csv_table(spark, path, "ra_id string, action string, lon double, lat double, city string, street string, number string, reason string")
    return rows.select(*(F.nullif(F.trim(c), F.lit("")).alias(c) for c in ("ra_id", "action")), "lon", "lat")


def patched(parsed: DataFrame, patch: DataFrame, key: str, value: str) -> DataFrame:
    """parsed with the patch's values over its own, and the patch's new keys."""
    return parsed.select(key, F.col(value).alias("__a")).join(patch.select(key, F.col(value).alias("__b")), key, "full").select(key, F.coalesce("__b", "__a").alias(value))


def html_rows(html: Column) -> Column:
    """Cells of the table rows in a page, tags removed."""
    found = lambda text, tag: F.regexp_extract_all(text, F.lit(rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1))
    return F.transform(found(html, "tr"), lambda r: F.transform(found(r, "td"), plain_text))


def plain_text(html: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(html, r"(?i)<br\s*/?>|</(p|li|div)>", "\n"), "<[^>]*>", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "&nbsp;| ", " "), r"[ \t]+", " "))


def html_words(html: Column) -> Column:
    """(x, y, text) of the word boxes in an HTML layout."""
    pattern = r'<word xMin="([0-9.]+)" yMin="([0-9.]+)"[^>]*>([^<]*)</word>'
    of = lambda g: F.regexp_extract_all(html, F.lit(pattern), F.lit(g))
    return F.transform(F.arrays_zip(of(1).alias("x"), of(2).alias("y"), of(3).alias("t")), lambda w: F.struct(w["x"].cast("double").alias("x"), w["y"].cast("double").alias("y"), w["t"].alias("text")))


def panel_lines(html: Column, start: Column, end: Column) -> Column:
    """Text lines between a mark and the next of another kind (or the end)."""
    tail = F.when(F.instr(html, start) > 0, html.substr(F.instr(html, start), F.length(html))).otherwise("")
    further = F.instr(tail.substr(F.lit(2), F.length(tail)), end)
    cut = F.when(further > 0, tail.substr(F.lit(1), further)).otherwise(tail)
    return F.filter(F.transform(F.split(plain_text(cut), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def embedded_object(source: Column, variable: Column) -> Column:
    """The {...} that follows a variable's name, braces in strings not counted; null if it doesn't close."""
    at = F.instr(source, variable)
    tail = F.when(at > 0, source.substr(at + F.length(variable), F.length(source)))
    opens = F.instr(tail, F.lit("{"))
    body = F.when(opens > 0, tail.substr(opens, F.length(tail)))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("quote"), F.lit(False).alias("skip"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(a: Column, c: Column) -> Column:
        quoted, mark = a["quote"] != "", c.isin('"', "'")
        depth = a["depth"] + F.when(quoted, 0).when(c == "{", 1).when(c == "}", -1).otherwise(0)
        quote = F.when(quoted & ~a["skip"] & (c == a["quote"]), "").when(~quoted & mark, c).otherwise(a["quote"])
        moved = F.struct(depth.alias("depth"), quote.alias("quote"), (quoted & ~a["skip"] & (c == "\\")).alias("skip"), (a["n"] + 1).alias("n"), (depth == 0).alias("done"))
        return F.when(a["done"], a).otherwise(moved)

    ended = F.aggregate(F.split(body, ""), start, step)
    return F.when(ended["done"], body.substr(F.lit(1), ended["n"]))


def gml_members(xml: Column) -> Column:
    """Address records of the members in a feature service's answer; places are "lat lon"."""
    members = F.regexp_extract_all(xml, F.lit(r"(?s)<wfs:member>(.*?)</wfs:member>"), F.lit(1))
    first = lambda m, p: F.nullif(F.regexp_extract(m, p, 1), F.lit(""))
    number = lambda m, kind: first(m, rf"(?s)<ad:designator>([^<]*)</ad:designator>(?:(?!<ad:designator>).)*?{kind}")
    place = r"<gml:pos[^>]*>\s*([-0-9.]+)\s+([-0-9.]+)\s*</gml:pos>"
    return F.transform(members, lambda m: F.struct(
        F.coalesce(first(m, r"<(?:\w+:)?localId>([^<]*)<"), first(m, r'gml:id="([^"]*)"')).alias("ra_id"),
        first(m, r"(?s)ThoroughfareName.*?<(?:\w+:)?text>([^<]*)<").alias("street"), number(m, "buildingIdentifier").alias("orient"), number(m, "addressNumber").alias("supisne"),
        F.regexp_extract(m, place, 2).try_cast("double").alias("lon"), F.regexp_extract(m, place, 1).try_cast("double").alias("lat"),
    ))


def discover(spark: SparkSession, prefix: str) -> dict[str, DataFrame]:
    """Catalog tables whose names begin with a prefix, by the rest of the name."""
    return {t.name.removeprefix(prefix): spark.table(t.name) for t in spark.catalog.listTables(pattern=f"{prefix}*")}


def discovered_union(spark: SparkSession, prefix: str, members: dict[str, list[str]]) -> DataFrame:
    """All tables of a prefix as one, with mesto (the rest of the name); a table named in members stands for those, which are left out."""
    from functools import reduce

    tables = discover(spark, prefix)
    hidden = {part for whole, parts in members.items() if whole in tables for part in parts}
    tagged = [df.withColumn("mesto", F.lit(name)) for name, df in sorted(tables.items()) if name not in hidden]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def pages_of(answers: DataFrame, per_page: int = 5000) -> DataFrame:
    """page, expected, members: the answers of a paged service (page, body) up to its first empty page; expected is the number that it announced."""
    told = F.nullif(F.regexp_extract("body", 'numberMatched="([0-9]+)"', 1), F.lit("")).try_cast("long")
    size = F.size(F.regexp_extract_all("body", F.lit("<wfs:member>"), F.lit(0)))
    read = answers.select("page", told.alias("expected"), size.alias("members"))
    from pyspark.sql.window import Window

    before = Window.orderBy("page").rowsBetween(Window.unboundedPreceding, 0)  # a row per page of one query
    return read.withColumn("__empty", F.max((F.col("members") == 0).cast("int")).over(before)).where("__empty = 0").drop("__empty").where(F.col("page") <= F.ceil(F.coalesce("expected", F.lit(2**40)) / per_page))


def shapes(coordinates: Column, geom_type: Column) -> Column:
    """The parts of a GeoJSON polygon or polygons: an array of rings each, the outer one first and then its holes, as (x, y) without the
    closing point; null for other shapes."""
    to_ring = lambda r: F.transform(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    to_rings = lambda polygon: F.transform(polygon, to_ring)
    one = F.from_json(coordinates, "array<array<array<double>>>")
    many = F.from_json(coordinates, "array<array<array<array<double>>>>")
    return F.when(geom_type == "Polygon", F.array(to_rings(one))).when(geom_type == "MultiPolygon", F.transform(many, to_rings))


def rings(coordinates: Column, geom_type: Column) -> Column:
    """The outer rings of a polygon's parts; holes are left out, `shapes` keeps them."""
    return F.transform(shapes(coordinates, geom_type), lambda part: part[0])


def whole_area_rules(streets: DataFrame, carried: DataFrame, single: DataFrame) -> DataFrame:
    """mcnorm, okrsok, street: every street of areas with one precinct (single: mcnorm, okrsok), from the register, or carried over where it has none."""
    known = streets.select("mcnorm", "street").distinct().join(single, "mcnorm")
    kept = carried.select("mcnorm", "street").join(known.select("mcnorm").distinct(), "mcnorm", "left_anti").join(single, "mcnorm")
    return known.unionByName(kept).select("mcnorm", "okrsok", "street")
