"""Fill-in-the-middle against a plain version, and exact round trips."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from hustings.llm import fill_in_middle as fim

WORD = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
HARD = ["", " ", "\n\t ", "a", " a", "a ", " a  b c   d\x0b\x1fe ", "é" * 10 + " 😀 x", "<P>", "x <S> y", "a<b <", "<S b <P c <M d", "P> <S", "a\r\nb\x85c d"]


def plain(name, text, seed=42, rate=50, spm=80, grammar=WORD):
    text = text or ""
    units = grammar.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(k * 100 + j, t) for k, t in enumerate(HARD) for j in range(12)] + [(None, "no id"), (3, None)], "doc_id long, text string")


def test_against_plain_version(hard, docs):
    for frame in (hard, docs):
        for settings in ({}, {"seed": 7, "rate": 100, "spm": 50}, {"rate": 0}):
            made = fim.transform(frame, **settings)
            assert {"n", "form", "prefix_chars", "middle_chars", "output"} <= set(made.columns)
            got = sorted(map(str, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect())))
            assert got == sorted(map(str, ((r.doc_id, *plain(r.doc_id, r.text, **settings)) for r in frame.select("doc_id", "text").collect())))


def test_every_unit_is_kept(spark, hard):
    for unit, (grammar, _) in fim.UNITS.items():
        found = hard.select("text", fim.units(F.col("text"), unit).alias("u")).collect()
        assert [(r.text, r.u) for r in found] == [(r.text, re.findall(grammar, r.text or "")) for r in found], unit
        back = fim.transform(hard, rate=100, unit=unit).select("text", fim.restore(F.col("output"), F.col("form")).alias("b"))
        assert all((r.text or "") == r.b for r in back.collect())


def test_digests_and_clashing_names(spark, docs, no_docs):
    clashing = docs.withColumn("output", F.lit("x")).withColumn("form", F.lit("y")).withColumn("n", F.lit(1))
    got = {(r.doc_id, r.form, r.output_sha256, r.restored_sha256) for r in fim.digests(clashing).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = set()
    for r in docs.select("doc_id", "text").collect():
        _, form, _, _, output = plain(r.doc_id, r.text)
        want.add((r.doc_id, form, sha(output), sha(r.text or "")))
    assert got == want
    made = fim.transform(clashing)
    assert len(made.columns) == len(set(made.columns)) and made.where("output = 'x'").count() == 0
    assert fim.digests(no_docs).count() == 0 and fim.digests(docs).count() == docs.count()


def test_5_mb(spark):
    row = spark.createDataFrame([(k, "lorem ipsum " * 416_667) for k in range(4)], "doc_id long, text string")
    found = fim.digests(row, rate=100).collect()
    assert {r.restored_sha256 for r in found} == {hashlib.sha256(("lorem ipsum " * 416_667).encode()).hexdigest()}
    assert {r.n for r in found} == {833_335}
