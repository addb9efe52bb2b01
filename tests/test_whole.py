"""Queries and operators over whole inputs, where a part would give other results."""

import itertools
import random
import re
import unicodedata

from pyspark.sql import functions as F

from hustings.functions import specs
from hustings.operators import matching
from hustings.plans import registry

SMALL = "/root/testdata/sf0.001"


def test_norm_covers_whole_texts(spark):
    raw = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    plain = lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if not 0x300 <= ord(c) <= 0x36F)
    want = {k: re.sub(r"[\s\xa0]+", " ", re.sub("['’`´]", "", plain(s).lower())).strip(" ") for k, s in raw.items()}
    got = {r.doc_id: r.normed for r in registry.queries()["norm_text"](spark, SMALL).collect()}
    assert got == want and any("." in s[:-1] for s in got.values())


def resolved_one_by_one(rows):
    """The rules' ranges as the source resolves them: in order, in place, pair by pair."""
    items = [(r[0], r[1], r[2], [lo, hi, p]) for r in rows for lo, hi, p in r[4]]
    side = lambda a, b: ("odd" if a % 2 else "even") if a % 2 == b % 2 else None
    for *street, okr, x in items:
        for *other, okr2, y in items:
            if street != other or okr >= okr2 or "both" not in (x[2], y[2]) or not (x[0] <= y[1] and y[0] <= x[1]):
                continue
            s, t = side(*x[:2]), side(*y[:2])
            if s and t and s != t:
                x[2], y[2] = s, t
    left = iter(items)
    return {r[3]: [tuple(next(left)[3]) for _ in r[4]] for r in rows}


def test_split_parity_as_one_by_one(spark):
    rnd = random.Random(3)
    spans = lambda: [(lo := rnd.randrange(1, 40), lo + rnd.randrange(0, 12), rnd.choice(["both", "both", "odd", "even"])) for _ in range(rnd.randrange(0, 4))]
    rows = [("mc", f"k{rnd.randrange(25)}", rnd.randrange(4), k, spans()) for k in range(200)]
    schema = "mcnorm string, key string, okrsok int, row_idx int, spec struct<ranges:array<struct<lo:int,hi:int,parity:string>>,singles:array<string>,raw:string>"
    frame = spark.createDataFrame([(*r[:4], (r[4], [], "")) for r in rows], schema)
    got = {r.row_idx: [tuple(x) for x in r.spec.ranges] for r in matching.resolve_split_parity(frame).collect()}
    assert got == resolved_one_by_one(rows)


def test_shared_houses_of_a_split_street(spark):
    entries = [(55, "Tulská 2-38"), (56, "Tulská 1-59"), (1, "Dlhá 2-38 (párne)"), (2, "Dlhá 1-59"), (1, "Krátka 1-7"), (2, "Krátka 9-15")]
    rules = spark.createDataFrame([("bb", o, k, e) for k, (o, e) in enumerate(entries)], "mcnorm string, okrsok int, row_idx int, entry string")
    rules = rules.withColumn("p", specs.parse_street_spec(F.col("entry"))).select("mcnorm", "okrsok", "row_idx", "p.*")
    houses = [(f"{s}{n}", "bb", s, str(n), None) for s in ("Tulská", "Dlhá") for n in (2, 7, 20, 37, 38)] + [("Krátka4", "bb", "Krátka", "4", None)]
    addresses = spark.createDataFrame(houses, "ra_id string, mcnorm string, street string, orient string, supisne string")
    got = {r.ra_id: (r.status, r.okrsok) for r in matching.match(addresses, matching.index_rules(rules)).collect()}
    assert got == {f"{s}{n}": ("ok", o + n % 2) for s, o in (("Tulská", 55), ("Dlhá", 1)) for n in (2, 7, 20, 37, 38)} | {"Krátka4": ("ok", 1)}


def test_split_parity_takes_every_order_and_mark(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").count()
    found = registry.queries()["split_parity"](spark, SMALL)
    assert found.count() == orders and {r.parity for r in found.select("parity").distinct().collect()} == {"both", "odd", "even"}


def test_top_unmatched_of_each_area(spark):
    rows = [("big", f"s{k:02}", "no-street") for k in range(20) for _ in range(k + 2)] + [("small", "only", "no-number"), ("small", "fine", "ok")]
    found = matching.top_unmatched(spark.createDataFrame(rows, "mcnorm string, street string, status string")).collect()
    assert {tuple(r) for r in found} == {("big", f"s{k:02}", k + 2) for k in range(8, 20)} | {("small", "only", 1)}


def test_centroid_query_is_the_best_of_all_partitions(spark, tmp_path):
    rnd = random.Random(11)
    ids = rnd.sample(range(1, 4000), 90)
    events = [(k, f"u{n % 9}", rnd.choice(["click", "view", "signup"])) for n, k in enumerate(ids)]
    spark.createDataFrame(events, "event_id long, user_id string, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = {}
    for r in registry.queries()["centroid_dp"](spark, str(tmp_path)).collect():
        got.setdefault(r.doc, []).append((r.y, r.num))
    numbered = 0
    for doc, found in got.items():
        cells = sorted(k * 7 % 4001 for k, d, t in events if d == doc and t != "signup")
        marks = sorted((k * 7 % 4001 + 0.5, k % 97) for k, d, t in events if d == doc and t == "signup")
        assert [y for y, _ in sorted(found, key=lambda x: x[0])] == cells
        nums = tuple(n for _, n in sorted(found, key=lambda x: x[0]))
        if not marks or len(cells) < len(marks):
            assert set(nums) == {None}
            continue
        costs = {}
        for cut in itertools.combinations(range(1, len(cells)), len(marks) - 1):
            blocks = [cells[a:b] for a, b in itertools.pairwise([0, *cut, len(cells)])]
            shown = tuple(n for (_, n), b in zip(marks, blocks, strict=True) for _ in b)  # markers may share a number
            costs[shown] = min(costs.get(shown, float("inf")), sum(abs(sum(b) / len(b) - y) for (y, _), b in zip(marks, blocks, strict=True)))
        assert costs[nums] <= min(costs.values()) + 1e-9
        numbered += 1
    assert numbered >= 3
