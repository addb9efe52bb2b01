"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words (ASCII letters in lower case, digits, non-ASCII characters) give unigrams,
bigrams and skip-bigrams with one word between, hashed to 2**BITS indices; a
document's features are the indices it holds. Training reads at most SAMPLE
labelled rows, those with the smallest hashes of their identifiers (documented
bound; the scoring covers everything), one text of each: of rows with the same identifier the one
whose text has the smallest hash. Their features are made in parallel, and
one task runs FTRL-proximal with per-coordinate rates over them, in the order of
a hash; positive rows count POSITIVE times. L1 keeps a few thousand weights, at
most 2**BITS, so that the model is small enough to be broadcast by construction.

Defined cases: a null text is empty and gets the score of the bias alone; null
labels and labels without a document don't train; several labels of a document
count by their largest; without labels every score is next to 0; repeated rows
are scored alike and train as one; an empty table gives no rows and trains nothing; a text of any length is hashed
in whole, one of over CHUNK_BYTES by itself; extra columns stay out of training and scores.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm import _text
from hustings.llm._spark import map_arrow
from hustings.llm._text import U64

BITS = 20
#: Bound of the labelled rows that train, and passes over them.
SAMPLE, EPOCHS = 8_000, 12
ALPHA, BETA, L1, L2, POSITIVE = 1.0, 1.0, 6.0, 0.1, 2.0
_SALTS = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]


def document_features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature indices in order, offsets of the documents' own) for runs of documents; repeats within a document stay."""
    for run in _text.words(column, _text.ALNUM, lower=True):
        h, n = run.hashes, len(run.hashes)
        lengths = np.diff(run.offsets)
        left = np.repeat(run.offsets[1:], lengths) - np.arange(n)  # words from here to the document's end
        grams = np.zeros((n, 3), U64)
        grams[:, 0] = h
        for k, salt in ((1, _SALTS[1]), (2, _SALTS[2])):
            joined = _text.mix(h[: max(n - k, 0)] * _SALTS[0] + h[k:] * salt)
            grams[: max(n - k, 0), k] = joined
        keep = np.stack([left > 0, left > 1, left > 2], 1)
        flat = (grams[keep] >> U64(64 - BITS)).astype(np.int32)
        per_word = np.concatenate([[0], np.cumsum(keep.sum(1))])
        yield flat, per_word[run.offsets]


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for flat, offsets in document_features(batch.column(2)):
        rows += [np.unique(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["id", "label", "features"])


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(indices, weights) that are not zero; index 2**BITS is the bias."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        w = (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(zs) <= L1] = 0
        return w

    for _ in range(epochs):
        for features, label in rows:
            at = np.append(features, size - 1)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - label) * (POSITIVE if label else 1.0)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size))
    found = np.flatnonzero(w)
    return found, w[found]


def _train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sampled rows, sorted, to the weights."""
    rows = [(f.values.to_numpy().astype(np.int64), y) for b in batches for y, f in zip(b["label"].to_pylist(), b["features"], strict=True)]
    if rows:
        at, w = ftrl(rows)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w)], ["index", "weight"])


class Model:
    """Weights by feature index, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, column: pa.Array) -> np.ndarray:
        out = []
        for flat, offsets in document_features(column):
            at = np.flatnonzero(self.weights[flat])
            owner = np.searchsorted(offsets, at, "right") - 1
            # a feature counts once in a document
            pairs = np.unique(owner.astype(np.int64) << BITS | flat[at])
            out.append(np.bincount(pairs >> BITS, self.weights[pairs & (1 << BITS) - 1], len(offsets) - 1))
        total = np.concatenate(out) + self.bias if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the identifier as text is divisible by 5; null identifiers are not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learn label_col from the labelled rows that are not held out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("id") == F.col("__id"))  # sample rows of two numbers
    # one text of each identifier, however many rows have it; each task keeps one before anything is exchanged
    rows = rows.groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    featured = map_arrow(rows.select("id", "label", "text"), _features, "id long, label int, features array<int>")
    ordered = featured.repartition(1).sortWithinPartitions(F.xxhash64("id", F.lit(2)), "id")  # sample rows
    found = {r["index"]: r["weight"] for r in ordered.mapInArrow(_train, "index long, weight double").collect()}  # at most 2**BITS + 1
    weights = np.zeros(1 << BITS)
    bias = found.pop(1 << BITS, 0.0 if found else -35.0)
    if found:
        weights[list(found)] = [*found.values()]
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: identifier, held_out, score and predicted."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(shipped.value.scores(batch.column(1)))], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = map_arrow(docs.select(id_col, text_col), over, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", below: float = 0.5) -> DataFrame:
    """The rows of docs that score below the limit, with the columns of docs."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(shipped.value.scores(batch.column(place)) < below))

    return map_arrow(docs, over, docs.schema)
