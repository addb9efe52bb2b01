"""Operators on ordered documents and shapes against plain versions."""

import itertools
import random

import numpy as np

from hustings.operators import documents, geometry


def test_block_assignment_is_optimal():
    rnd = random.Random(5)
    for _ in range(40):
        cells = np.array(sorted(rnd.randrange(100) for _ in range(rnd.randrange(1, 8))), float)
        anchors = np.array(sorted(rnd.randrange(100) for _ in range(rnd.randrange(1, len(cells) + 1))), float)
        for center, middle in (("mean", np.mean), ("middle", lambda c: (c[0] + c[-1]) / 2)):
            got = documents.block_assignment(cells, anchors, center)
            cost = lambda owner: sum(abs(middle(cells[owner == k]) - a) for k, a in enumerate(anchors))  # noqa: E731, B023
            best = min(
                cost(np.repeat(np.arange(len(anchors)), np.diff([0, *cut, len(cells)])))
                for cut in itertools.combinations(range(1, len(cells)), len(anchors) - 1)
            )
            assert abs(cost(got) - best) < 1e-9
    assert documents.block_assignment(np.array([10.0, 20, 30, 40, 50]), np.array([20.0, 45])).tolist() == [0, 0, 0, 1, 1]


def test_sections(spark):
    text = ["Preamble", "Okrsok č. 1", "Place: school", "Ulice:", "Hlavná 1-9 (nepárne), Ružová", "12, 14", "Okrsok č. 2", "Ulice: Dlhá", "signed", "Krátka"]
    lines = spark.createDataFrame([("d", k, t) for k, t in enumerate(text)], "doc string, line_no int, text string")
    got = documents.sections(lines, r"^Okrsok č\. (\d+)", streets_after="Ulice:", stop="^signed").orderBy("okrsok", "entry_no").collect()
    assert [(r.okrsok, r.street, r.cls) for r in got] == [(1, "Hlavná", "RANGE"), (1, "Ružová", "ENUM"), (2, "Dlhá", "WHOLE")]


def test_lines_and_columns(spark):
    words = spark.createDataFrame([(1, 5.0, 10.0, "b"), (1, 1.0, 12.0, "a"), (1, 1.0, 30.0, "c"), (2, 1.0, 1.0, "d")], "page int, x double, y double, text string")
    assert sorted((r.page, r.line_no, r.text) for r in documents.cluster_lines(words).collect()) == [(1, 0, "a b"), (1, 1, "c"), (2, 0, "d")]
    assert sorted(tuple(r) for r in documents.column_text(words, 0, 3, ["page"]).collect()) == [(1, "a c"), (2, "d")]


def test_degree_two(spark):
    ways = [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "c"), (2, 2, "d"), (3, 1, "c"), (3, 2, "e"), (4, 1, "p"), (4, 2, "q"), (4, 3, "r"), (4, 4, "p")]
    found = geometry.degree_two(spark.createDataFrame(ways, "way_id int, pos int, node string"))
    assert {r.node for r in found.collect()} == {"b", "p", "q", "r"}
