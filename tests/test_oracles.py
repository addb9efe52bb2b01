"""Every registered query against its DuckDB text on the small tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from hustings.plans import registry

SMALL = "/root/testdata/sf0.001"
#: These have no rows on the smallest tables.
LARGER = dict.fromkeys(("clip_cap_300", "degree2_vertices", "overlap_concave", "overlap_seeds", "overlap_selfjoin"), "/root/testdata/sf0.01")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.9g}"
    return str(v) if v is not None and not isinstance(v, (int, bool)) else v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(plain(r[k]) for k in order) for r in found)


def compare(spark, sf_dir, name, queries, oracles):
    frame = queries[name](spark, sf_dir)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = con.execute(oracles[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    want = rows(columns, result.fetchall())
    extra, lacking = got - want, want - got
    assert not extra and not lacking, f"{name}: {sum(got.values())} rows; extra {list(extra)[:4]}, lacking {list(lacking)[:4]}"
    return sum(got.values())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    assert compare(spark, LARGER.get(name, SMALL), name, registry.queries(), registry.oracle_sql()) > 0


def test_every_query_has_rows(spark):
    for name in sorted(set(registry.queries()) - set(registry.oracle_sql())):
        assert registry.queries()[name](spark, SMALL).count() > 0, name
