"""MinHash near-deduplication with min-max hashing and exact confirmation.

A document's set holds its distinct word shingles. Under each permutation both
the smallest and the largest value are kept, two signature values for one hash
evaluation, and each is equal in two documents with probability equal to their
Jaccard similarity. Bands of ROWS values put documents into buckets; the number
of bands follows from the similarity, so that a pair right at the threshold
shares no bucket with a probability below MISS.

1. Documents with equal sets are one class, known by its smallest identifier;
   copies are never paired. Classes are banded; buckets give edges to their
   smallest class only, and the components of these edges are the blocks.
   Two classes that share a bucket are in one block. ROWS keeps unlike texts of one
   template apart: at a similarity of 0.5 two share a bucket with a probability of 0.2.
2. Within blocks, links are confirmed on the full sets. A block is dealt into
   cells of about CELL classes or CELL_SHINGLES shingles, and each pair of cells is
   a task's group of bounded size; nearly every block is a single cell. A task
   counts intersections by matrix products over the shingles that occur twice,
   and returns a spanning forest of the confirmed links and the number of links
   of each class, never the pairs.
3. The components of the forests are the groups of near-duplicates.

Sketches, buckets and texts are exchanged once each, texts only of classes that
share a bucket with another.

Defined cases: white space separates words, A-Z are lower-cased; a document with
fewer words than a shingle has its whole word sequence as its only shingle; one
without words, or with a null text, has no shingles and links with nothing; one
with a null identifier links with nothing and stays; rows with the same identifier are one
node with all their links; repeated rows and exact copies are linked. Identifiers may be of any
ordered type. A text of any length is hashed whole, with about thirty times its bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm import _text
from hustings.llm._spark import drop_table, grouped, map_arrow, stage_table
from hustings.llm._text import U64
from hustings.llm.components import connected_components

ROWS, MISS = 8, 1e-8
#: Classes and shingles of one cell of a block.
CELL, CELL_SHINGLES = 1024, 1 << 20
_SALT = [U64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64) | 1) for k in range(64)]


def band_count(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands of so many rows that a pair at the similarity shares none with a probability below miss."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each document) for runs of documents."""
    for run in _text.words(column, _text.NOT_SPACE, lower=True):
        n, h = len(run.hashes), run.hashes
        joined = h * _SALT[0]
        for k in range(1, min(width, n)):
            joined[: n - k] += h[k:] * _SALT[k]
        joined = _text.mix(joined)
        sets = []
        for a, b in zip(run.offsets[:-1], run.offsets[1:], strict=True):
            if b - a >= width:
                sets.append(np.unique(joined[a : b - width + 1]))
            elif b > a:
                whole = (h[a:b] * np.array(_SALT[width : width + b - a], U64)).sum(keepdims=True)
                sets.append(_text.mix(whole + U64(int(b - a))))
            else:
                sets.append(np.zeros(0, U64))
        yield run.first, sets


def signatures(sets: list[np.ndarray], values: int) -> np.ndarray:
    """Minimum and maximum of each non-empty set under values / 2 permutations of the upper 32 hash bits."""
    random = np.random.default_rng(7)
    flips = random.integers(0, 1 << 32, (values + 1) // 2, dtype=np.uint32)
    factors = random.integers(0, 1 << 31, (values + 1) // 2, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    flat = (np.concatenate(sets) >> U64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), 2 * len(flips)), np.uint32)
    for k, (flip, factor) in enumerate(zip(flips, factors, strict=True)):
        value = (flat ^ flip) * factor
        out[:, 2 * k] = np.minimum.reduceat(value, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(value, starts)
    return out[:, :values]


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    bands = signature.reshape(len(signature), -1, rows).astype(U64)
    keys = np.arange(1, bands.shape[1] + 1, dtype=U64)[None, :] * _SALT[0]
    for k in range(rows):
        keys = _text.mix(keys ^ (bands[:, :, k] * _SALT[k + 1]))
    return keys.view(np.int64)


def _sketch(width: int, bands: int):
    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, low, high, keys = [], [], [], []
        for _, sets in shingle_sets(batch.column(1), width):
            full = [s for s in sets if len(s)]
            banded = iter(band_keys(signatures(full, bands * ROWS), ROWS) if full else ())
            for s in sets:
                counts.append(len(s))
                low.append(int(np.bitwise_xor.reduce(_text.mix(s), initial=0).view(np.int64)) if len(s) else 0)
                high.append(int(np.add.reduce(_text.mix(s ^ _SALT[5])).view(np.int64)) if len(s) else 0)
                keys.append(next(banded) if len(s) else np.zeros(0, np.int64))
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), lists], ["id", "n", "low", "high", "keys"])

    return over


def _counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of left with right sets, which may be the same list."""
    sets = left if left is right else [*left, *right]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [*map(len, sets)])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    rank = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], rank[column[keep]]
    total = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    slab = 2048
    cuts = np.searchsorted(column, np.arange(0, int(shared.sum()) + slab, slab))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            hot = np.zeros((len(sets), slab), np.float32)
            hot[owner[a:b], column[a:b] - k * slab] = 1
            total += hot[: len(left)] @ hot[len(sets) - len(right) :].T
    return total.astype(np.int64)


def links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (left, right) with 100 * intersection >= percent * union."""
    both = _counts(left, right)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - both
    return np.nonzero((100 * both >= percent * union) & (both > 0))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that join different trees, one after the other."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(i), root(j)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((i, j))
    return kept


def _confirm(width: int, percent: int):
    """Rows (block, one, two, side, id, text), sorted, to rows (u, v, n): forest edges, or v null and n links of u."""

    def cells(table: pa.Table) -> Iterator[tuple[list[int], list[np.ndarray]]]:
        for side in (0, 1):
            part = table.filter(pa.compute.equal(table["side"], side))
            ids = part["id"].to_pylist()
            sets = [s for c in part["text"].chunks for _, run in shingle_sets(c, width) for s in run]
            yield ids, sets

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind = pa.int64()
        for (_, one, two), table in grouped(batches, ["block", "one", "two"]):
            kind = table.schema.field("id").type
            (ids, sets), (ids2, sets2) = cells(table)
            if one == two:
                if len(ids) < 2:
                    continue
                a, b = links(sets, sets, percent)
                a, b = a[a < b], b[a < b]
                names = ids
            else:
                if not ids or not ids2:
                    continue
                a, b = links(sets, sets2, percent)
                b = b + len(ids)
                names = ids + ids2
            out += [(names[i], names[j], 0) for i, j in _forest(len(names), a, b)]
            degree = np.bincount(np.concatenate([a, b]), minlength=len(names)) if len(a) else np.zeros(0, int)
            out += [(names[i], None, int(degree[i])) for i in np.flatnonzero(degree)]
            if len(out) > 10_000:
                yield _rows(out, kind)
                out = []
        if out:
            yield _rows(out, kind)

    return over


def _rows(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    u, v, n = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind), pa.array(n, pa.int64())], ["u", "v", "n"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """A row per document: identifier, n_shingles, class_id (smallest identifier with the same set), n_links (classes that
    its class links with), component_id and kept."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bands = band_count(percent / 100)
    kind = docs.schema[id_col].dataType.simpleString()
    sketches = stage_table(map_arrow(slim, _sketch(width, bands), f"id {kind}, n long, low long, high long, keys array<long>"))
    sketched = sketches.where("n > 0 and id is not null")
    same = ["n", "low", "high"]
    classes = stage_table(sketched.groupBy(*same).agg(F.min("id").alias("rep")))  # read from a table, a join with it can be split
    members = stage_table(sketched.select("id", *same).join(classes, same).select("id", "rep"))
    # a document stored with two texts has two classes; its smallest stands for it in the buckets of both
    reps = members.groupBy("rep").agg(F.count("*").alias("size")).select(F.col("rep").alias("id"))
    keyed = sketched.join(reps, "id", "left_semi").select("id", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("key", "first")
    near = keyed.join(buckets, "key").where("id <> first").select("id", "first").distinct()
    blocks = stage_table(connected_components(near, "id", "first").select(F.col("node").alias("id"), F.col("component").alias("block")))

    texts = slim.join(blocks, "id")  # only classes that share a bucket
    sizes = blocks.join(sketched.select("id", "n"), "id").groupBy("block").agg(
        F.ceil(F.greatest(F.count("*") / CELL, F.sum("n") / CELL_SHINGLES)).cast("int").alias("n_cells")
    )
    wide = stage_table(sizes.where("n_cells > 1"))  # most blocks are a single cell
    dealt = texts.join(wide, "block", "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(1)))
    dealt = dealt.withColumn("cell", F.pmod(F.xxhash64("id"), F.col("n_cells")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_cells") - 1)).alias("other")
    pairs = dealt.select("*", other).select(
        "block", F.least("cell", "other").alias("one"), F.greatest("cell", "other").alias("two"),
        F.when(F.col("cell") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "text",
    )
    by = ["block", "one", "two"]
    confirmed = stage_table(pairs.repartition(*by).sortWithinPartitions(*by).mapInArrow(_confirm(width, percent), f"u {kind}, v {kind}, n long"))

    for done in (blocks, wide):
        drop_table(done)
    # documents of one class are linked, and so are the classes of one document
    edges = confirmed.where("v is not null").select("u", "v").unionByName(members.where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v")))
    components = connected_components(edges, "u", "v").select(F.col("node").alias("id"), "component")
    drop_table(members)
    degree = confirmed.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("links"))
    listed = sketches.select("id", *same).join(classes, same, "left").withColumn("rep", F.when(F.col("id").isNotNull(), F.col("rep")))
    found = listed.join(degree, "rep", "left").join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("rep", "id").alias("class_id"), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay: the smallest identifier of each group of near-duplicates."""
    flags = near_duplicates(docs, id_col, text_col, width, percent)
    gone = stage_table(flags.where("not kept").select(F.col(id_col).alias("__gone")).distinct())
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
