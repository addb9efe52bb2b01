"""License scans, BPE, toxicity and mixing against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import DOCS
from tokenizers import Tokenizer

from hustings.llm import _text, bpe, license_scan, mixing, queries, toxicity

SMALL = "/root/testdata/sf0.001/documents.parquet"


def brute_license(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    places, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base(spark, docs, no_docs):
    rows = [(i, t) for i, t, *_ in DOCS] + [(r.doc_id + 100, r.text) for r in spark.read.parquet(SMALL).collect()]
    rows += [(90, "CC BY cc-by; cc\nby x general public LICENSE. All\tRights, reserved cc"), (91, "general public cc by license all rights reserved all rights reserved")]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((i, *brute_license(t)) for i, t in rows)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert license_scan.scan_licenses(docs).count() == len(DOCS) and license_scan.scan_licenses(no_docs).count() == 0


def test_license_expressions():
    parse = license_scan.parse_expression
    assert parse(" MIT OR Apache-2.0 AND GPL-2.0-only WITH Classpath-exception-2.0") == ["MIT", "Apache-2.0", "GPL-2.0-only", "Classpath-exception-2.0", "WITH", "AND", "OR"]
    assert parse("(MIT or ISC) and GPL-3.0 */") == ["MIT", "ISC", "OR", "GPL-3.0", "AND"]
    assert parse("MIT AND") is None and parse("(MIT") is None and parse("") is None and parse("OR MIT") is None
    assert license_scan.evaluate(parse("(MIT OR GPL-3.0) AND ISC")) == ({"mit", "gpl-3.0", "isc"}, True)
    assert license_scan.evaluate(parse("MIT AND GPL-3.0"))[1] is False
    row = license_scan.scan_text("// SPDX-License-Identifier: Apache-2.0 OR MIT\ncode", *license_scan._automata())
    assert row[5] == "apache-2.0,mit" and row[6] is True and row[7] == 1.0


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def digests(reference, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    decoded = reference.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe(spark, docs, no_docs, reference):
    tok = queries.tokenizer()
    rows = [(i, t) for i, t, *_ in DOCS] + [(r.doc_id + 100, r.text) for r in spark.read.parquet(SMALL).collect()]
    got = bpe.round_trip_digests(spark.createDataFrame(rows, "doc_id long, text string"), tok).collect()
    assert Counter(map(tuple, got)) == Counter((i, *digests(reference, t)) for i, t in rows)
    both = bpe.decode(bpe.encode(docs, tok), tok).collect()
    assert [r.decoded for r in both] == [r.text or "" for r in both]
    assert bpe.round_trip_digests(no_docs, tok).count() == 0 and bpe.encode(no_docs, tok).count() == 0


def test_bpe_any_text(reference):
    tok, rnd = queries.tokenizer(), random.Random(5)
    spaces = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0 ᠎     　﻿​"
    alphabet = spaces + "ab'sdlvremt019²½٣éß漢字ａ!?-_<|>\x00\x7f😀́"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "a" * 2000, "ab" * 999, " " * 500 + "x", "the" * 300]
    texts += ["".join(map(chr, range(a, a + 256))) for a in range(0, 0xD800, 256)] + ["x" + chr(c) + "1" for c in range(0x300, 0x3000, 7)]
    assert [np.frombuffer(x, "<u4").tolist() for x in tok.encode_batch(texts)] == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


def test_word_hashes():
    texts = ["Ab ab", "", None, "ab", " \tx\n", "é é", "a" * 300 + " b", "ab"]
    runs = list(_text.words(pa.array(texts), _text.NOT_SPACE, lower=True))
    hashes = {}
    for run in runs:
        for k, (a, b) in enumerate(zip(run.offsets[:-1], run.offsets[1:], strict=True)):
            found = re.findall(r"[^\x20\x09-\x0D]+", (texts[run.first + k] or "").replace("A", "a"))
            assert b - a == len(found)
            for w, h in zip(found, run.hashes[a:b], strict=True):
                assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


def test_toxicity(spark, docs, no_docs):
    where = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{where}/labels.parquet")
    rows = queries.op10_toxicity(spark, where).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert len(toxic) > 50 and np.mean([a > b for a in toxic for b in clean]) > 0.97
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.01
    some = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (None, 1), (77, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, some)
    assert toxicity.score(docs, model).count() == len(DOCS) and toxicity.score(no_docs, model).count() == 0
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert {r.score < 0.1 for r in toxicity.score(docs, toxicity.train(docs, some.limit(0))).collect()} == {True}


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, limited = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in limited)
        free = sum(weight[s] for s in names if s not in limited)
        target = {s: 3 * sizes[s] if s in limited else left * weight[s] / free for s in names}
        over = {s for s in names if s not in limited and target[s] > 3 * sizes[s]}
        if not over:
            return target
        limited |= over


def check_mix(got, rows, exact=True):
    sizes = defaultdict(int)
    n = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    for i, t, s in rows:
        sizes[s] += n[i]
    target, taken = brute_targets(sizes), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.size == n[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]], rel=1e-9) and 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, x in target.items():
        assert abs(taken[s] - x) <= 1 if exact else abs(taken[s] - x) <= 0.02 * x + 1


def test_mixing(spark, docs, no_docs):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows += [(5000, "x y", "tiny"), (5001, None, "empty"), (5002, "a b c d", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame).collect()
    check_mix(got, rows)
    again = mixing.mix(frame.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    kept = mixing.mixed_rows(frame)
    assert kept.columns == frame.columns
    times = Counter(r.doc_id for r in kept.collect())
    assert all(abs(times[r.doc_id] - r.taken / r.size) <= 0.5 for r in got if r.size)
    assert mixing.mix(docs).count() == len(DOCS) and mixing.mix(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_bpe_pieces_without_merges():
    tokenizer = queries.tokenizer()
    assert tokenizer.encode_pieces([]) == [] and tokenizer.encode_batch([""]) == [b""]
    assert [len(x) for x in tokenizer.encode_pieces(["a", "", "b"])] == [1, 0, 1]
