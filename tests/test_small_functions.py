"""Readers, writers and small functions that no query calls."""

import json

import pytest
from pyspark.sql import functions as F

from hustings.functions import text
from hustings.operators import audits, changes, geometry, label, repair, serving
from hustings.sources import readers, writers


def one(spark, expression, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values))
    return frame.select(expression.alias("r")).first()["r"]


def test_text(spark):
    assert one(spark, text.area_name(F.col("s")), s="Mestská časť Košice - Barca") == "Barca"
    assert one(spark, text.reason_tag(F.col("s")), s="Ring Self-intersection[1 2]") == "self-intersection" and one(spark, text.reason_tag(F.col("s")), s="Hole lies outside shell[3 4]") == "hole-lies-outside-shell"
    set_to = lambda fragment, value: one(spark, text.write_param(F.col("f"), "layer", F.lit(value)), f=fragment)
    assert set_to("#map=1/2&layer=a&seeds=0", "b") == "#map=1/2&seeds=0&layer=b" and set_to("#layer=a", None) == "" and set_to("", "x") == "#layer=x"


def test_text_readers(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"a": 1, "b": "x"}, {"a": 2}]')
    assert [tuple(r) for r in readers.records(spark, str(tmp_path / "r.json"), "a int, b string").orderBy("a").collect()] == [(1, "x"), (2, None)]
    (tmp_path / "l.txt").write_text("first\n\n  third\n")
    assert [r.text for r in readers.lines(spark, str(tmp_path / "l.txt")).orderBy("line_no").collect()][:3] == ["first", "", "  third"]
    columns = ["level", "page", "par", "block", "line", "word", "left", "top", "width", "height", "conf", "text"]
    rows = [columns, ["4", "1", "1", "1", "1", "0", "1", "2", "3", "4", "-1", "line"], ["5", "1", "1", "1", "1", "1", "10.5", "20", "3", "4", "99", 'say "hi"']]
    (tmp_path / "w.tsv").write_text("\n".join("\t".join(r) for r in rows))
    assert [(r.page, r.x, r.y, r.text) for r in readers.words(spark, str(tmp_path / "w.tsv")).collect()] == [(1, 10.5, 20.0, 'say "hi"')]
    (tmp_path / "c.csv").write_text("a,b\n1,x\n")
    assert [tuple(r) for r in readers.csv_table(spark, str(tmp_path / "c.csv"), "a int, b string").collect()] == [(1, "x")]


def test_markup_readers(spark):
    html = "<div id='p1'><p>One<br>Two&nbsp;words</p></div><div id='p2'>Other</div>"
    got = one(spark, readers.panel_lines(F.col("h"), F.lit("id='p1'"), F.lit("id='p2'")), h=html)
    assert "Two words" in " ".join(got) and "Other" not in " ".join(got)
    xml = (
        "<wfs:member><ad:Address gml:id='x' ><base:localId>A1</base:localId><gml:pos>48.1 17.2</gml:pos><ad:designator>12/A</ad:designator><ad:type href='buildingIdentifier'/>"
        "<ad:designator>345</ad:designator><ad:type href='addressNumber'/><ad:ThoroughfareName><gn:text>Dlhá</gn:text></ad:ThoroughfareName></ad:Address></wfs:member>"
    )
    (r,) = one(spark, readers.gml_members(F.col("x")), x=xml)
    assert (r.ra_id, r.street, r.orient, r.supisne, r.lon, r.lat) == ("A1", "Dlhá", "12/A", "345", 17.2, 48.1)
    pages = spark.createDataFrame([(1, '<a numberMatched="3"><wfs:member><wfs:member>'), (2, '<a numberMatched="3"><wfs:member>'), (3, "<a>"), (4, "<wfs:member>")], "page int, body string")
    assert [(r.page, r.expected, r.members) for r in readers.pages_of(pages, 2).orderBy("page").collect()] == [(1, 3, 2), (2, 3, 1)]


def test_rings(spark):
    square = "[[[0,0],[2,0],[2,2],[0,2],[0,0]]]"
    frame = spark.createDataFrame([("Polygon", square), ("MultiPolygon", f"[{square},[[[5,5],[6,5],[6,6],[5,5]]]]"), ("Point", "[1,2]")], "t string, c string")
    got = frame.select("t", readers.rings(F.col("c"), F.col("t")).alias("r")).collect()
    assert [None if r.r is None else [len(x) for x in r.r] for r in got] == [[4], [4, 3], None]
    area = frame.where("t = 'Polygon'").select(geometry.area(readers.rings(F.col("c"), F.col("t"))[0]).alias("a")).first().a
    assert area == 4.0
    lines = spark.createDataFrame([("LineString", [1, 2, 3, 1]), ("LineString", [1, 2, 3]), ("Point", [1])], "geom_type string, coordinates array<int>")
    assert [r.geom_type for r in geometry.close_lines(lines).collect()] == ["Polygon", "LineString", "Point"]
    assert one(spark, geometry.snap(F.col("v"), 0.25), v=1.1) == 1.0


def test_tables(spark, tmp_path):
    spark.createDataFrame([(1,)], "okrsok int").createOrReplaceTempView("okrsky_ke")
    spark.createDataFrame([(1, "barca")], "okrsok int, mcnorm string").createOrReplaceTempView("okrsky_barca")
    spark.createDataFrame([(2, "poprad")], "okrsok int, mcnorm string").createOrReplaceTempView("okrsky_poprad")
    got = readers.discovered_union(spark, "okrsky_", {"ke": ["barca"]}).collect()
    assert sorted((r.mesto, r.okrsok) for r in got) == [("ke", 1), ("poprad", 2)]
    parsed, patch = spark.createDataFrame([(1, "bad"), (2, "fine")], "k int, v string"), spark.createDataFrame([(1, "good"), (3, "new")], "k int, v string")
    assert sorted(tuple(r) for r in readers.patched(parsed, patch, "k", "v").collect()) == [(1, "good"), (2, "fine"), (3, "new")]
    single = spark.createDataFrame([("a", 1), ("b", 1)], "mcnorm string, okrsok int")
    streets, carried = spark.createDataFrame([("a", "X"), ("a", "X")], "mcnorm string, street string"), spark.createDataFrame([("a", "old"), ("b", "Y")], "mcnorm string, street string")
    assert sorted(tuple(r) for r in readers.whole_area_rules(streets, carried, single).collect()) == [("a", 1, "X"), ("b", 1, "Y")]
    for view in ("ke", "barca", "poprad"):
        spark.catalog.dropTempView(f"okrsky_{view}")


def test_writers(spark, tmp_path):
    rules = spark.createDataFrame([("Dlhá, \"x\"", ([], ["1"], "1, 2"))], "street string, spec struct<ranges:array<int>,singles:array<string>,raw:string>")
    writers.assignments_csv(rules, f"{tmp_path}/csv")
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/csv", header=True, quote='"', escape='"').collect()] == [('Dlhá, "x"', "1, 2")]
    writers.assignments_json(rules, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").first().spec.raw == "1, 2"
    with pytest.raises(Exception, match="(?i)exists"):
        writers.assignments_json(rules, f"{tmp_path}/json")
    points = spark.createDataFrame([("1", "", 7, '{"type":"Point","coordinates":[1,2]}')], "ra_id string, street string, okrsok int, g string")
    writers.geojson_lines(points, "g", ["ra_id", "street", "okrsok"], f"{tmp_path}/g")
    feature = json.loads(spark.read.text(f"{tmp_path}/g").first().value)
    assert feature["properties"] == {"ra_id": "1", "okrsok": "7"} and feature["geometry"]["type"] == "Point"
    assert spark.read.parquet(writers.snapshot(points, str(tmp_path), "seeds", "v1")).count() == 1
    for version, rows in enumerate((points, points.limit(0))):
        path = writers.point_table(rows, str(tmp_path), "points", f"v{version}")
        assert spark.read.parquet(path).count() == rows.count()
    assert spark.read.parquet(f"{tmp_path}/points/version=v0").count() == 1


def test_changes(spark):
    file = spark.createDataFrame([("seed", 1), ("neighbour", 2)], "kind string, n int")
    once = changes.replace_kind(file, spark.createDataFrame([(7,), (8,)], "n int"), "neighbour")
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in changes.replace_kind(once, spark.createDataFrame([(7,), (8,)], "n int"), "neighbour").collect()) == [("neighbour", 7), ("neighbour", 8), ("seed", 1)]
    seeds = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "ra_id string")
    found = changes.suspects(seeds, spark.createDataFrame([("a",)], "ra_id string"), spark.createDataFrame([("a", 900.0), ("b", 500.0), ("c", 10.0), ("d", None)], "ra_id string, d double"))
    assert {r.ra_id: r.check for r in found.collect()} == {"a": "enclave", "b": "isolated", "c": None, "d": "isolated"}
    assert one(spark, changes.tags_text(F.create_map(F.lit("a"), F.col("x"), F.lit("b"), F.lit(""))), x="1") == '{"a":"1"}'
    features = spark.createDataFrame([(1, "x", "m", "Polygon"), (2, "3", "", "Polygon"), (3, "3", "m", "Point"), (4, "3", "m", "MultiPolygon")], "idx int, okrsok string, mcnorm string, geom_type string")
    assert [r.problem for r in changes.import_problems(features).orderBy("idx").collect()] == ["bad okrsok", "missing mcnorm", "not a polygon", None]
    rules = spark.createDataFrame([("WHOLE", "1. mája"), ("WHOLE", "Dlhá 5"), ("ENUM", "Dlhá 5")], "cls string, source string")
    assert [tuple(r) for r in repair.suspicious_whole(rules).collect()] == [("WHOLE", "Dlhá 5")]


def test_map(spark):
    row = spark.createDataFrame([("Barca", 3, "hsl(1,62%,58%)", 18.0, 97.25, None)], "mc string, okrsok int, color string, turnout double, q1ano double, q2ano double")
    shown = row.select(*(serving.fill(m).alias(m) for m in ("distinct", "turnout", "q1", "q2")), serving.summary().alias("line")).first()
    assert (shown.distinct, shown.turnout, shown.q2, shown.line) == ("hsl(1,62%,58%)", "#6baed6", serving.NO_DATA, "Barca, 3: 18.0 % / 97.3 % / ?")
    got = [one(spark, serving.settings(F.col("f")), f=f) for f in ("#color=q1&seeds=0", "#color=nope")]
    assert [tuple(s) for s in got] == [("q1", "auto", False), ("distinct", "auto", True)]


def test_selection(spark):
    rows = spark.createDataFrame([("a", 1, "X"), ("a", 2, ""), ("b", 1, None)], "mcnorm string, okrsok int, street string")
    assert audits.with_street(rows).count() == 1 and audits.selected(rows, "a", [2]).count() == 1 and audits.selected(rows).count() == 3
    assert [tuple(r) for r in label.unseeded(rows, rows.where("okrsok = 1")).collect()] == [("a", 2)]


def test_shared_edges(spark):
    square = lambda x: [(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0)]
    parts = spark.createDataFrame([(1, "a", 1, square(0.0)), (2, "a", 1, square(1.0)), (3, "a", 1, square(5.0)), (4, "a", 2, [(0.0, 0.0)])], "idx int, mcnorm string, okrsok int, ring array<struct<x:double,y:double>>")
    assert {r.idx: r.fixme for r in label.check_parts(parts, 10.0).collect()} == {1: "parts-share-an-edge", 2: "parts-share-an-edge", 3: None, 4: "not-an-area"}
    points = spark.createDataFrame([(1, "seed", "a", 1, 0.5, 0.5), (2, "neighbour", None, None, 5.5, 0.5)], "idx int, kind string, mcnorm string, okrsok int, x double, y double")
    checked = points.selectExpr("*", "'1 x' as rule", "if(idx = 2, 'outside-address-inside-precinct', null) as fixme")
    summary = {(r.what, r.value): r.n for r in label.check_summary(checked, label.check_parts(parts, 10.0)).collect()}
    assert summary == {("rule", "1 x"): 2, ("point", "outside-address-inside-precinct"): 1, ("part", "parts-share-an-edge"): 2, ("part", "not-an-area"): 1}


def test_served_precincts(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    sources = {"Košice": spark.createDataFrame([("barca", 1, ring)], "mcnorm string, okrsok int, ring array<struct<x:double,y:double>>"), "Poprad": spark.createDataFrame([(2, ring)], "okrsok int, ring array<struct<x:double,y:double>>")}
    manual = spark.createDataFrame([("barca", 1, ring[:2])], "mcnorm string, okrsok int, ring array<struct<x:double,y:double>>")
    turnout = spark.createDataFrame([("5", "Barca", "1", "50.5", "100", "")], "obec_code string, obec_name string, okrsok string, ucast_pct string, zapisani string, zucastneni string")
    answers = spark.createDataFrame([("5", "1", "1", "30", "60.0", "20")], "obec_code string, okrsok string, otazka string, ano string, ano_pct string, nie string")
    got = {r.mc: r for r in label.serve_precincts(sources, manual, turnout, answers, ["Košice"]).collect()}
    assert (got["barca"].turnout, got["barca"].zuc, got["barca"].q1ano, got["barca"].source, got["barca"].key) == (50.5, None, 60.0, "manual", "koicebarca")
    assert got["Poprad"].turnout is None and got["Poprad"].key == "poprad"
