"""Importance resampling against a plain version of every step."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hustings.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def grams(text, longest=1):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % resampling.BUCKETS


def plain(docs, target, percent, least_words, seed, longest):
    count = lambda texts: Counter(bucket(f) for t in texts for f in grams(t, longest)[1])
    s, t = count(text for _, text in docs), count(target)
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000))))
    rows = []
    for name, text in docs:
        words, features = grams(text, longest)
        weight = sum(gain(bucket(f)) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        rows.append((name, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in rows if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    rank = {}
    for k, r in enumerate(able[: len(able) * percent // 100]):
        rank.setdefault(r[:4], []).append(k + 1)
    out = []
    for r in rows:
        left = rank.get(r[:4]) if r[4] >= least_words else None
        out.append((*r[:4], left.pop(0) if left else None))
    return Counter(out)


def test_against_plain_version(spark, docs):
    target = ["one two three four five", "w1 w2 word", None, ""]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for percent, least, seed, longest in [(50, 3, 7, 1), (100, 0, 2024, 2), (34, 10, 2024, 3), (0, 1, 1, 1)]:
        got = Counter(tuple(r) for r in resampling.resample(docs, frame, percent, least, seed, longest).collect())
        assert got == plain(rows, target, percent, least, seed, longest)


def test_repeated_rows_share_ranks_beside_each_other(spark, monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK", 3)
    rows = [(1, "a b c")] * 10 + [(k, "b c d e") for k in range(2, 12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("a b c",)], "text string")
    for percent in (30, 55, 100):
        got = resampling.resample(frame, target, percent, 1).collect()
        assert Counter(tuple(r) for r in got) == plain(rows, ["a b c"], percent, 1, 2024, 1)
        assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, 20 * percent // 100 + 1))


def test_empty_tables_and_identifiers_of_text(spark, docs, no_docs):
    target = spark.createDataFrame([("one two",)], "text string")
    assert resampling.resample(no_docs, target).count() == 0
    assert resampling.resample(docs, target.limit(0), 100, 1).where("rank is not null").count() == docs.where(r"text rlike '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]'").count()
    named = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = resampling.resample(named, target, 50, 3)
    assert found.dtypes[0] == ("doc_id", "string") and found.count() == docs.count()
    chosen = resampling.drawn(named.where("doc_id is not null").dropDuplicates(["doc_id"]), found)
    assert chosen.columns == docs.columns and chosen.count() == found.where("rank is not null and doc_id is not null").select("doc_id").distinct().count()


def test_hashes():
    words = ["", "a", "é", "x" * 33, "y" * 200_000, "abc"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    sizes = np.array([len(w.encode()) for w in words])
    assert resampling.crc32_of(data, np.cumsum(sizes) - sizes, sizes).tolist() == [zlib.crc32(w.encode()) for w in words]


def test_features_of_slices_and_long_texts():
    column = pa.array(["skipped", "A b", None, "cD", "", "e" * 3_000_000 + " f"]).slice(1)
    found = [(first + o, b) for first, _, owner, buckets, _ in resampling.features(column) for o, b in zip(owner.tolist(), buckets.tolist(), strict=True)]
    assert Counter(found) == Counter([(0, bucket("a")), (0, bucket("b")), (2, bucket("cd")), (4, bucket("e" * 3_000_000)), (4, bucket("f"))])
