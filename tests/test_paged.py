"""The paged source over answers in local files: every page read once, whatever their number."""

import pytest
from pyspark.sql import functions as F

from hustings.sources import paged, readers

MEMBER = "<wfs:member><ad:Address><base:localId>A{k}</base:localId><gml:pos>{lat} {lon}</gml:pos></ad:Address></wfs:member>"


def answer(ks, matched):
    told = f' numberMatched="{matched}"' if matched is not None else ""
    return f"<wfs:FeatureCollection{told}>" + "\n".join(MEMBER.format(k=k, lat=40 + k, lon=10 + k) for k in ks) + "</wfs:FeatureCollection>"


@pytest.fixture
def load(spark, tmp_path):
    def made(pages, matched, folder="all"):
        top = tmp_path / folder
        top.mkdir(exist_ok=True)
        for page, ks in enumerate(pages):
            (top / f"{page * 3}.xml").write_text(answer(ks, matched), encoding="utf-8")
        return paged.features(spark, f"file://{tmp_path}/{folder}/{{start}}.xml", 3)

    return made


def ids(df):
    parsed = df.select("page", F.explode(readers.gml_members(F.col("member"))).alias("m"))
    return sorted((r.page, r.m.ra_id, r.m.lon, r.m.lat) for r in parsed.collect())


def test_a_partition_per_page(load):
    df = load([[0, 1, 2], [3, 4, 5], [6]], 7)
    assert ids(df) == [(k // 3, f"A{k}", 10.0 + k, 40.0 + k) for k in range(7)]
    assert df.rdd.getNumPartitions() == 3


def test_without_a_number_up_to_an_empty_page(load):
    assert [r[1] for r in ids(load([[0, 1, 2], [3], []], None))] == ["A0", "A1", "A2", "A3"]
    assert ids(load([[]], 0, "none")) == [] and ids(load([[]], None, "nothing")) == []


def test_announced_pages_may_be_empty(load):
    assert [r[1] for r in ids(load([[0, 1, 2], []], 5))] == ["A0", "A1", "A2"]


def test_filters_become_the_box(spark, load, tmp_path):
    load([[1, 2]], 2, "41.0,11.0,42.0,12.0")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = paged.features(spark, f"file://{tmp_path}/{{bbox}}/{{start}}.xml", 3)
        inside = df.where("lon >= 11.0 and lon <= 12.0 and lat >= 41.0 and lat <= 42.0 and lat > 41.0")
        assert [r[1] for r in ids(inside)] == ["A2"]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_url_is_needed(spark):
    spark.dataSource.register(paged.PagedFeatures)
    with pytest.raises(Exception, match="url"):
        spark.read.format("paged_features").load().collect()
