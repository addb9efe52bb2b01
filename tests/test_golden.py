"""Worked examples of the parsers and text functions."""

import pytest
from pyspark.sql import functions as F

from hustings.functions import specs, text
from hustings.operators import serving
from hustings.sources import readers


def one(spark, expression, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values))
    return frame.select(expression.alias("r")).first()["r"]


def test_text(spark):
    rows = [("Nám. Oceliarov", "namestie oceliarov"), ("Ulica 1. mája", "1 maja"), ("Lorinčícka ulica", "lorincicka"), ("Ulica", "ulica"), ("PČL", "povstania ceskeho ludu"), ("Rehol'ná", "reholna")]
    frame = spark.createDataFrame(rows, "s string, want string").select("want", text.street_key(text.norm(F.col("s"))).alias("got"))
    assert [r.got for r in frame.collect()] == [w for _, w in rows]
    assert one(spark, text.tail_of(text.street_key(text.norm(F.col("s")))), s="Kpt. J. Rašu") == "rasu"
    assert one(spark, text.house_norm(F.col("s")), s="40/a") == "40A"
    assert one(spark, text.golden_color(F.col("s")), s="7") == "hsl(243,62%,58%)" and one(spark, text.golden_color(F.col("s")), s="12") == "hsl(210,62%,58%)"
    assert one(spark, text.compatible(F.col("a"), F.col("b")), a="generala l svobodu", b="generala ludvika svobodu")


@pytest.mark.parametrize(("entry", "street", "cls", "ranges", "singles"), [
    ("Zimná (párne)", "Zimná", "WHOLE", None, None),
    ("Fábryho12-16", "Fábryho", "RANGE", [(12, 16, "both")], []),
    ("X 1-7, 9-31 (nepárne)", "X", "RANGE", [(1, 7, "both"), (9, 31, "odd")], []),
    ("X 11-43 (párne)", "X", "RANGE", [(11, 43, "both")], []),
    ("X 1-19, 21, 23", "X", "ENUM", [(1, 19, "both")], ["21", "23"]),
    ("Skladná 1A, B, C", "Skladná", "ENUM", [], ["1A", "1B", "1C"]),
    ("Súpisne čísla 2669, 2671", "", "ENUM", [], ["2669", "2671"]),
    ("1. mája", "1. mája", "WHOLE", None, None),
    ("Ulica 29. augusta", "Ulica 29. augusta", "WHOLE", None, None),
])
def test_spec(spark, entry, street, cls, ranges, singles):
    got = one(spark, specs.parse_street_spec(F.col("s")), s=entry)
    assert (got.street, got.cls) == (street, cls)
    if ranges is not None:
        assert [tuple(r) for r in got.spec.ranges] == ranges and got.spec.singles == singles


@pytest.mark.parametrize(("entry", "want"), [
    ("Železiarenská párne čísla od 2 do 20", "Železiarenská 2-20 (párne)"), ("Kadnárova od 209 do 340", "Kadnárova 209-340"), ("DROBNÉHO 2 AŽ 22", "DROBNÉHO 2-22"),
    ("Kadnárova od 27 do 88 (Kadnárova 27, 29, 31)", "Kadnárova 27, 29, 31"), ("Zeleninová JUDr. Mgr. Jozef Uhler", "Zeleninová"),
])
def test_prose(spark, entry, want):
    assert one(spark, specs.prose_range(F.col("s")), s=entry) == want


def test_entries(spark):
    got = one(spark, specs.parse_entry(F.col("s")), s="Opatovská cesta – párne")
    assert (got.street, got.cls, got.parity) == ("Opatovská cesta", "WHOLE", "even")
    assert len(one(spark, specs.expand_multi(F.col("s")), s="Czambelova párne 8-18, nepárne 7-9")) == 2
    assert one(spark, specs.expand_multi(F.col("s")), s="Moyzesova 17, 19") == ["Moyzesova 17, 19"]
    assert all(e.endswith("párne") for e in one(spark, specs.expand_multi(F.col("s")), s="Južná trieda 2-10 a 20-22 párne"))
    assert len(one(spark, specs.split_glued(F.col("s")), s="Rázusova 1-33 párne i nepárne Dunajská")) == 2
    assert one(spark, specs.split_entries(F.col("s")), s="Ružová 45-50 párne, nepárne, Hlavná 1, 3") == ["Ružová 45-50 párne, nepárne", "Hlavná 1, 3"]


def test_ramp(spark):
    colors = [one(spark, serving.ramp(F.col("v"), serving.TURNOUT_STOPS), v=v) for v in (2.0, 60.0, 5.0)]
    assert colors == ["#f7fbff", "#08306b", "#f7fbff"]
    assert spark.range(1).select(serving.ramp(F.lit(None).cast("double"), serving.TURNOUT_STOPS).alias("c")).first().c == "#cfd8dc"
    assert serving.gradient_css(serving.TURNOUT_STOPS).startswith("linear-gradient(90deg,#f7fbff 0%,")


def test_readers(spark, tmp_path):
    assert one(spark, readers.embedded_object(F.col("s"), F.lit("_data")), s='x; _data = {"a": "}{", "b": {"c": 1}}; y') == '{"a": "}{", "b": {"c": 1}}'
    assert one(spark, readers.html_rows(F.col("s")), s="<table><tr><td>A</td><td><b>1</b></td></tr><tr><td>B</td></tr></table>") == [["A", "1"], ["B"]]
    words = one(spark, readers.html_words(F.col("s")), s='<word xMin="1.5" yMin="2" xMax="3">ab</word>')
    assert [tuple(w) for w in words] == [(1.5, 2.0, "ab")]
    (tmp_path / "f.json").write_text('{"features": [{"properties": {"kind": "seed", "n": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}')
    row = readers.geojson(spark, str(tmp_path / "f.json")).first()
    assert (row.idx, row.geom_type, row.coordinates, row.props) == (0, "Point", "[1,2]", {"kind": "seed", "n": "1"})
    (tmp_path / "w.json").write_text('{"mc": "A", "mcNorm": "a", "okrsky": {"1": ["X", "Y"], "2": ["Z"]}}')
    assert sorted(tuple(r) for r in readers.whole_streets(spark, str(tmp_path / "w.json")).collect()) == [("A", "a", 1, "X"), ("A", "a", 1, "Y"), ("A", "a", 2, "Z")]
    (tmp_path / "o.csv").write_text("ra_id,action,lon,lat,city,street,number,reason\n1,exclude,,,c,s,1,r\n2,move,17.5,48.5,c,s,2,\"a, b\"\n")
    assert [tuple(r) for r in readers.overrides(spark, str(tmp_path / "o.csv")).collect()] == [("1", "exclude", None, None), ("2", "move", 17.5, 48.5)]
