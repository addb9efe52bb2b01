"""Learning, sampling and labels against plain versions; long texts and identifiers that aren't numbers."""

import math
import random
import re
import struct
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from test_text_ops import brute_targets

from hustings.llm import bpe, exact_dedup, license_scan, minhash_dedup, mixing, pii, quality_rules, queries, toxicity


def test_ftrl():
    """Weights of the vectorised steps against the algorithm written out, feature by feature."""
    rnd = random.Random(1)
    rows = [(sorted(rnd.sample(range(40), rnd.randrange(1, 9))), int(rnd.random() < 0.4)) for _ in range(120)]
    bias = 1 << toxicity.BITS
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return (math.copysign(toxicity.L1, z[i]) - z[i]) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(3):
        for features, label in rows:
            w = {i: weight(i) for i in [*features, bias]}
            p = 1 / (1 + math.exp(-sum(w.values())))
            g = (p - label) * (toxicity.POSITIVE if label else 1)
            for i in w:
                step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += g - step * w[i]
                n[i] += g * g
    at, got = toxicity.ftrl([(np.array(f), y) for f, y in rows], epochs=3)
    want = {i: weight(i) for i in z if weight(i)}
    assert dict(zip(at.tolist(), got.tolist(), strict=True)) == pytest.approx(want, rel=1e-9) and len(want) > 10


def test_features():
    """Words, pairs and pairs with a word between: as many as the plain count, equal where the plain ones are."""
    texts = ["A b c d", "x", "", "b C d e a b", "a-b c"]
    seen = {}
    flat = [(f, o) for f, o in toxicity.document_features(pa.array(texts))]
    assert len(flat) == 1
    features, offsets = flat[0]
    for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        words = re.findall(r"[a-z0-9]+", text.lower())
        want = []
        for k, w in enumerate(words):
            want += [(w,)] + [(gap, w, words[k + gap]) for gap in (1, 2) if k + gap < len(words)]
        assert len(want) == b - a
        for name, f in zip(want, features[a:b].tolist(), strict=True):
            assert seen.setdefault(name, f) == f
    assert len(set(seen.values())) == len(seen)


def brute_mix(rows, seed=0):
    """Words taken of each document: whole epochs, then by falling keys until the target is met."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    totals = defaultdict(int)
    for i, _, s in rows:
        totals[s] += size[i]
    targets, out = brute_targets({s: Fraction(n) for s, n in totals.items()}), {}
    for source, target in targets.items():
        docs = []
        for i, t, s in rows:
            if s == source:
                draw = xxhash.xxh64_intdigest(t.encode(), xxhash.xxh64_intdigest(struct.pack("<i", seed), xxhash.xxh64_intdigest(struct.pack("<q", i), 42)))
                solid = re.sub(r"[\x20\x09-\x0D]+", "", t)
                letters = len(re.sub(r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", "", t))
                quality = mixing.QUALITY_FLOOR + (1 - mixing.QUALITY_FLOOR) * (letters / len(solid) if solid else 0.0)
                u = ((draw >> 11) + 0.5) * 2.0**-53
                docs.append((-(u ** (1 / quality)), i))
        epochs = int(target // totals[source]) if totals[source] else 0
        rest = round(target - epochs * totals[source])
        for _, i in sorted(docs):
            part = min(size[i], rest)
            out[i] = epochs * size[i] + part
            rest -= part
    return out


def test_mixing_selection(spark):
    rnd = random.Random(9)
    rows = [(k, " ".join(rnd.choice(["word", "12", "ab#", "é", "Zz"]) for _ in range(rnd.randrange(0, 40))), f"s{rnd.choice([0, 0, 0, 1, 2, 3])}") for k in range(400)]
    got = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == brute_mix(rows)


def brute_labels(text):
    """Phrases by search of words, tags by the expression's own words."""
    words = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())) + " "
    labels = {label for phrase, label in license_scan.BASE.items() if f" {phrase} " in words} | {label for phrase, (label, _) in license_scan.NOTICES.items() if f" {phrase} " in words}
    for m in re.finditer(r"(?:spdx-license-identifier|license-expression):(.*)", text.lower()):
        found = m[1].split()
        labels |= {w for k, w in enumerate(found) if k % 2 == 0 and w in license_scan.KNOWN and all(x in ("and", "or", "with") for x in found[1 : k + 1 : 2])}
    return ",".join(sorted(labels))


def test_license_labels():
    rnd = random.Random(4)
    parts = ["the MIT License", "Apache License, Version 2.0", "GNU General Public License", "CC BY", "all rights reserved", "some words", "public domain", "\n"]
    tags = ["MIT", "Apache-2.0", "GPL-3.0-only", "banana", "ISC OR MIT", "GPL-2.0-only WITH Classpath-exception-2.0"]
    automata = license_scan._automata()
    for _ in range(300):
        text = " ".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 6)))
        if rnd.random() < 0.5:
            text += f"\nSPDX-License-Identifier: {rnd.choice(tags)}\n" + rnd.choice(parts)
        assert license_scan.scan_text(text, *automata)[5] == brute_labels(text), text
    found = license_scan.scan_text("License-Expression: banana", *automata)
    assert found[5] == "" and found[7] == 0 and found[6] is False
    assert license_scan.scan_text("SPDX-License-Identifier: GPL-3.0-only OR MIT", *automata)[6] is True


@pytest.fixture(scope="module")
def long_rows():
    """A text of 5 MB, its copy, one that differs in a word, and a short one."""
    rnd = random.Random(5)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(640_000)]
    text = " ".join(words)
    return [(1, text, "a"), (2, text, "a"), (3, text.replace(words[300_000], "other", 1), "b"), (4, "CC BY 10.0.0.1 short", "b")]


def test_long_texts(spark, long_rows):
    frame = spark.createDataFrame(long_rows, "doc_id long, text string, source string").repartition(4, "doc_id")
    n = {i: len(t.split()) for i, t, _ in long_rows}
    assert {r.doc_id: r.n_words for r in quality_rules.quality_rules(frame).collect()} == n
    assert {r.doc_id: r.n_words for r in license_scan.scan_licenses(frame).collect()} == n | {4: 7}  # marks part words
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in minhash_dedup.near_duplicates(frame, width=3, percent=85).collect()} == {
        i: (1 if i < 4 else 4, len({tuple(w[k : k + 3]) for k in range(len(w) - 2)})) for i, w in ((i, t.split()) for i, t, _ in long_rows)
    }
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(frame).collect()} == {1: 2, 2: 2, 3: 3, 4: 4}
    assert {r.doc_id: r.size for r in mixing.mix(frame).collect()} == n
    model = toxicity.train(frame, spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int"))
    assert toxicity.score(frame, model).count() == 4
    found = {r.doc_id: r.spans for r in pii.span_digests(pii.find_pii(frame, pii.train(pii.training_sentences(60)))).collect()}
    assert found[1] == "" and found[4].startswith("ip:6:14")
    assert all(r.round_trip for r in bpe.encode_checked(frame, queries.tokenizer()).select("round_trip").collect())


def test_string_identifiers(spark):
    rows = [("b", "one two three four five", "s"), ("a", "one two three four five", "s"), (None, "one two three four five", None), ("c", "CC BY other words here now then", "t")]
    frame = spark.createDataFrame(rows, "doc_id string, text string, source string")
    assert {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame).collect()} == {"a": "a", "b": "a", None: None, "c": "c"}
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(frame).collect()} == {"a": "b", "b": "b", None: "b", "c": "c"}
    assert sorted(r.doc_id for r in exact_dedup.keep_one(frame).collect()) == ["b", "c"]
    for result in (license_scan.scan_licenses(frame), quality_rules.quality_rules(frame), mixing.mix(frame), pii.find_pii(frame, pii.SemiCRF()), bpe.round_trip_digests(frame, queries.tokenizer())):
        assert {r.doc_id for r in result.collect()} == {"a", "b", "c", None}


def test_repeated_rows_train_once(spark):
    """A model doesn't depend on how often a table holds its rows, also where one identifier has many texts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    once = toxicity.train(docs, labels, sample=40)
    hot = docs.selectExpr("doc_id", "text").union(docs).union(docs.where("doc_id % 7 = 1"))
    again = toxicity.train(hot, labels.union(labels), sample=40)
    assert once.bias == again.bias and np.array_equal(once.weights, again.weights)
    assert (once.weights != 0).any()
    several = spark.createDataFrame([(1, "bad words"), (1, None), (1, "good words"), (4, "fine")], "doc_id long, text string")
    known = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int")
    turned = toxicity.train(several.orderBy("text"), known)
    assert np.array_equal(toxicity.train(several, known).weights, turned.weights)
