"""Removal of repeated passages against all windows by brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import DOCS

from hustings.llm import suffix_dedup


def brute(rows, window):
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(hash(b[k : k + window]) for _, b in raw for k in range(len(b) - window + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if count[hash(b[k : k + window])] > 1:
                gone[k : k + window] = b"\1" * window
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def result(frame, **options):
    return Counter(tuple(r)[:5] for r in suffix_dedup.remove_repeats(frame, **options).collect())


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False) == brute(rows, suffix_dedup.WINDOW)


@pytest.mark.parametrize("shard", [200, 600, 1 << 19])
def test_small_windows(spark, monkeypatch, shard):
    """Dense repeats of short windows, periodic texts, anchors in several shards, texts in several chunks."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    rnd = random.Random(shard)
    passages = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(5, 60))) for _ in range(12)]
    rows = [(i, "".join(rnd.choice(passages) if rnd.random() < 0.6 else "".join(rnd.choice("xyz ") for _ in range(rnd.randrange(30))) for _ in range(rnd.randrange(6)))) for i in range(80)]
    rows += [(100 + i, "".join(rnd.choice("pqr") for _ in range(20)) + passages[0][:20] + "".join(rnd.choice("pqr") for _ in range(20))) for i in range(60)]
    rows += [(200, "a" * 200), (201, "ab" * 70), (202, "a" * 33), (203, rows[5][1]), (203, rows[5][1]), (None, rows[7][1]), (204, None), (205, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(frame, window=24, gram=9) == brute(rows, 24)


def test_string_identifiers(spark):
    rows = [("a", "word " * 200), ("b", "word " * 150), (None, "some other text"), ("c", "x" * 500)]
    assert result(spark.createDataFrame(rows, "doc_id string, text string")) == brute(rows, suffix_dedup.WINDOW)


def test_long_text(spark):
    """A text of 5 MB with one passage twice, cut in several chunks."""
    rnd = np.random.default_rng(3)
    text = bytearray(rnd.integers(97, 123, 5_000_000, dtype=np.uint8).tobytes())
    text[4_000_000:4_000_900] = text[1_048_000:1_048_900]
    rows = [(1, text.decode()), (2, "short")]
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False).collect()}
    assert (found[1].n_bytes, found[1].n_removed, found[1].n_spans) == (5_000_000, 1800, 2) and found[2].n_removed == 0


def test_chunks():
    """Where a text is cut doesn't change its segments."""
    data = np.frombuffer(random.Random(4).randbytes(9000), np.uint8)
    whole = suffix_dedup.segments(data, 60, 20)
    for chunk in (70, 500, 2000):
        assert all((a == b).all() for a, b in zip(whole, suffix_dedup.segments(data, 60, 20, chunk), strict=True))


def test_edges(docs, no_docs):
    assert result(docs) == brute([(i, t) for i, t, *_ in DOCS], suffix_dedup.WINDOW)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    kept = {r.doc_id: r.kept.decode() for r in suffix_dedup.remove_repeats(docs).collect()}
    assert kept[9] == dict((i, t) for i, t, *_ in DOCS)[9] and kept[7] == ""


def test_suffix_order():
    """Order and common prefixes against sorted slices."""
    rnd = random.Random(2)
    for depth, alphabet in ((3, b"ab"), (8, b"ab"), (20, b"ab"), (50, b"a"), (37, b"abcd")):
        data = bytes(rnd.choice(alphabet) for _ in range(300)) * 2
        wanted = np.zeros(600, bool)
        wanted[[*range(0, 250), *range(300, 600 - depth + 1)]] = True
        order = suffix_dedup.sort_suffixes(np.frombuffer(data, np.uint8), wanted, depth)
        assert order.tolist() == sorted(np.flatnonzero(wanted).tolist(), key=lambda i: (data[i : i + depth], i))
        before = np.full(600, -1)
        before[order[1:]] = order[:-1]
        place = np.sort(order)
        place = place[before[place] >= 0]
        got = suffix_dedup.common_prefixes(np.frombuffer(data, np.uint8), place, before[place], 700)
        for p, n in zip(place.tolist(), got.tolist(), strict=True):
            q = int(before[p])
            true = next((k for k in range(600) if max(p, q) + k == 600 or data[p + k] != data[q + k]), 600)
            assert n == true or max(p, q) + true == 600 and n >= true


def test_merged_runs():
    rnd = random.Random(6)
    keys = [sorted({bytes(rnd.choices(b"abcd", k=3)) for _ in range(40)}) for _ in range(7)]
    rows, runs, names = 0, [], []
    for k in keys:
        runs.append((np.array(k, "S16"), np.arange(rows, rows + len(k))))
        names += k
        rows += len(k)
    count = Counter(names)
    assert suffix_dedup.merge_runs(runs).tolist() == [i for i, k in enumerate(names) if count[k] > 1]
