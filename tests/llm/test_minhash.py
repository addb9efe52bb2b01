"""Near-duplicates against all pairs by brute force."""

import random
from itertools import combinations

import pytest
from conftest import DOCS

from hustings.llm import components, minhash_dedup


def shingles(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ")
    words = [w for w in words if w]
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, min(1, len(words))))}


def brute(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for (i, a), (j, b) in combinations(sets, 2):
        if i is not None and j is not None and a and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    return sorted((i if i is not None else -1, len(s), root(i) if i is not None else None, i == root(i)) for i, s in sets)


def result(frame, width, percent):
    got = minhash_dedup.near_duplicates(frame, width=width, percent=percent).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_documents(spark, width, percent):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), width, percent) == brute(rows, width, percent)


def test_edges(spark, docs, no_docs):
    assert result(docs, 3, 85) == brute([(i, t) for i, t, *_ in DOCS], 3, 85)
    assert minhash_dedup.near_duplicates(no_docs).count() == 0
    kept = minhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns and None in {r.doc_id for r in kept.collect()}


def test_large_block_in_cells(spark, monkeypatch):
    """A chain of near copies, each only near to its neighbours, in a block of many cells."""
    monkeypatch.setattr(minhash_dedup, "CELL", 8)
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(90):
        rows.append((i, " ".join(words)))
        for _ in range(rnd.randrange(1, 7)):
            words[rnd.randrange(300)] = f"x{rnd.random()}"
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(frame, 3, 85) == brute(rows, 3, 85)
    sets = {i: shingles(t, 3) for i, t in rows}
    links = {i: sum(100 * len(a & b) >= 85 * len(a | b) for j, b in sets.items() if j != i) for i, a in sets.items()}
    assert {r.doc_id: r.n_links for r in minhash_dedup.near_duplicates(frame, width=3, percent=85).collect()} == links


def test_components(spark):
    rnd = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(rnd.randrange(100, 400), rnd.randrange(100, 400)) for _ in range(170)] + [(500, k) for k in range(501, 800)] + [(900, 900)]
    parent = list(range(1000))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize(("star", "sign"), [(components._large_star, 1), (components._small_star, -1)])
def test_hub_is_split(spark, tmp_path, star, sign):
    """A node with very many neighbours goes to several tasks of the join with the minima."""
    edges = [(sign * k, 0 if k % 4 else sign * (k - 1)) for k in range(1, 20001)]
    spark.createDataFrame(edges, "u long, v long").repartition(12).write.parquet(f"{tmp_path}/edges")
    options = {
        "spark.sql.shuffle.partitions": "20", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        found = star(spark.read.parquet(f"{tmp_path}/edges"))
        rows = {(r.u, r.v) for r in found.collect()}
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    near = {}
    for a, b in edges:
        near.setdefault(max(a, b), set()).add(min(a, b))
        if sign > 0:
            near.setdefault(min(a, b), set()).add(max(a, b))
    least = {u: min(v | {u}) for u, v in near.items()}
    assert rows == {(v, least[u]) for u, all_v in near.items() for v in (all_v if sign > 0 else all_v | {u}) if v != least[u] and (sign < 0 or v > u)}
