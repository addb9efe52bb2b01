"""Importance resampling towards a target: documents drawn by how much likelier their words are in the target's texts.

Two passes of Arrow batches. The first counts hashed n-grams: np.bincount gives each partition one vector of
BUCKETS counts, and treeReduce adds the vectors, for the documents and for the target. Their smoothed log ratios are the buckets'
gains, BUCKETS numbers that are broadcast. The second pass gathers a gain for every feature and adds them by document, by bincount
with weights. A document's score is its mean gain plus Gumbel noise from a hash of its identifier, so that the highest scores are
a draw without replacement and reruns agree.

Ranks: the scores are written once; the number of documents by score is a small table, however many documents there are (scores
are whole numbers of a few ten thousand values); a score's first rank is a running sum of it. Only documents that can be drawn are numbered
within their score, equal rows as one group with its size, so that no row is ever sorted with all others.

Defined cases: a null text has no words, weight 0 and is never drawn while least_words is above 0; a null identifier is hashed as an empty string and comes
last among ties; repeated rows all count, and get ranks beside each other; an empty table gives no rows, and an empty target counts 0
everywhere. Other columns play no part in `resample`, whatever their names, and stay as they are in `drawn`. Texts of any length are read whole,
about 1 MB of short ones together.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hustings.llm._spark import stage_table
from hustings.llm._text import ALNUM, LOWER, chunks, text_buffers

BUCKETS = 10_000
#: Words up to so many bytes are hashed together, a byte of all at a time.
TOGETHER = 32
#: Copies of a row that are written out at once.
BLOCK = 4096


def _crc_table() -> np.ndarray:
    """The remainders of single bytes under the reflected polynomial 0xEDB88320."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def crc32_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of the runs of data."""
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-sizes, kind="stable")
    long = int(np.searchsorted(-sizes[order], -TOGETHER, "left"))  # runs of more than TOGETHER bytes
    at, size, held = starts[order[long:]], sizes[order[long:]], crc[long:]
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, "left"))
        held[:n] = _CRC[(held[:n] ^ data[at[:n] + k]) & 0xFF] ^ (held[:n] >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order[long:]] = ~held
    for i in order[:long].tolist():
        out[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]].tobytes())
    return out


def _runs(text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a document's end ends a word."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = ALNUM[text]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    cut = np.unique(bounds[(bounds > 0) & (bounds < len(text))])
    cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
    return (np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))) if len(cut) else (starts, ends)


def features(column: pa.Array, longest: int = 1) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first document, documents, document of each feature, its bucket, words of each document), a run of documents at a time.

    Features are the runs of 1 to `longest` words, joined by one blank."""
    offsets, data = text_buffers(column)
    for i, j in chunks(offsets):
        begin, end = int(offsets[i]), int(offsets[j])
        text, bounds = LOWER[data[begin:end]], offsets[i : j + 1] - begin
        starts, ends = _runs(text, bounds)
        owner = np.searchsorted(bounds, starts, "right") - 1
        owners, hashes = [owner], [crc32_of(text, starts, ends - starts)]
        for n in range(2, longest + 1):
            # word n of a feature is hashed behind a blank: lengths and bytes of the joined words in an array of their own
            first = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1]) if len(owner) >= n else np.zeros(0, np.int64)
            sizes = sum((ends - starts)[first + k] for k in range(n)) + n - 1 if len(first) else np.zeros(0, np.int64)
            joined, begins = np.full(int(sizes.sum()) if len(first) else 0, 0x20, np.uint8), np.concatenate([[0], np.cumsum(sizes)])[:-1] if len(first) else np.zeros(0, np.int64)
            place = begins.copy()
            for k in range(n):
                length = (ends - starts)[first + k]
                within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                joined[np.repeat(place, length) + within] = text[np.repeat(starts[first + k], length) + within]
                place = place + length + 1
            owners.append(owner[first])
            hashes.append(crc32_of(joined, begins, sizes))
        yield i, j - i, np.concatenate(owners), (np.concatenate(hashes) % BUCKETS).astype(np.int64), np.bincount(owner, minlength=j - i)


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = 1) -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, buckets, _ in features(batch.column(0), longest):
                total += np.bincount(buckets, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary())], ["counts"])

    vectors = texts.select(text_col).mapInArrow(partial, "counts binary").rdd.map(lambda row: np.frombuffer(row.counts, "<i8"))
    return vectors.treeAggregate(np.zeros(BUCKETS, np.int64), np.add, np.add)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: a thousand times the log ratio of its smoothed shares, rounded down."""
    up = (target + 1).astype(np.float64) * float(source.sum() + BUCKETS)
    down = (source + 1).astype(np.float64) * float(target.sum() + BUCKETS)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = 1) -> DataFrame:
    """identifier, n_features, n_words, weight (the mean gain of a document's features, rounded down; 0 without any)."""
    shipped = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, words, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, many, owner, buckets, own in features(batch.column(1), longest):
                part = slice(first, first + many)
                n[part], words[part] = np.bincount(owner, minlength=many), own
                total[part] = np.bincount(owner, shipped.value[buckets], many).astype(np.int64)  # whole numbers, exact below 2**53
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(words), pa.array(total // np.maximum(n, 1))], [id_col, "n_features", "n_words", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(over, f"`{id_col}` {kind}, n_features long, n_words long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024, longest: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per document: identifier, n_features, weight, score, and rank among the drawn (null elsewhere).

    Of the documents with least_words words, percent in a hundred are drawn.
    """
    gain = gains(bucket_counts(docs, text_col, longest), bucket_counts(target, text_col, longest))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weigh(docs, gain, id_col, text_col, longest).withColumn("score", F.col("weight") + noise)
    # equal rows are one from here on
    scored = stage_table(scored.groupBy(id_col, "n_features", "n_words", "weight", "score").agg(F.count("*").alias("copies")))
    able = scored.where(F.col("n_words") >= least_words)

    # a row per score
    by_score = able.groupBy("score").agg(F.sum("copies").alias("many"))
    all_scores = Window.partitionBy(F.lit(1))
    down = all_scores.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    total = (F.sum("many").over(all_scores) * percent).alias("hundredfold")
    places = by_score.select("score", F.coalesce(F.sum("many").over(down), F.lit(0)).alias("above"), total)
    places = places.select("score", "above", F.expr("hundredfold div 100").alias("drawn")).where("above < drawn")

    tied = Window.partitionBy("score").orderBy(F.asc_nulls_last(id_col), "n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)
    out = [id_col, "n_features", "weight", "score"]
    high = able.join(places, "score").withColumn("before", F.col("above") + F.coalesce(F.sum("copies").over(tied), F.lit(0)))
    numbered = _copies(high).withColumn("rank", F.col("before") + F.col("copy"))
    low = scored.join(places.select("score", F.lit(True).alias("high")), "score", "left").where(f"high is null or n_words < {least_words}")
    return numbered.select(*out, F.when(F.col("rank") <= F.col("drawn"), F.col("rank")).alias("rank")).unionByName(_copies(low).select(*out, F.lit(None).cast("long").alias("rank")))


def _copies(groups: DataFrame) -> DataFrame:
    """A row for each copy of a group, numbered from 1; a group of many is dealt into blocks first, so that no array is long."""
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BLOCK)))
    dealt = groups.withColumn("block", block)
    upto = F.least(F.col("copies"), (F.col("block") + 1) * BLOCK)
    return dealt.withColumn("copy", F.explode(F.sequence(F.col("block") * BLOCK + 1, upto)))


def drawn(docs: DataFrame, resampled: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs whose identifier was drawn, all columns as they are. Identifiers must tell documents apart."""
    tag = f"__{uuid.uuid4().hex}"
    ids = resampled.where("rank is not null").select(F.col(id_col).alias(tag)).distinct()
    return docs.join(ids, docs[f"`{id_col}`"].eqNullSafe(ids[tag]), "left_semi")
