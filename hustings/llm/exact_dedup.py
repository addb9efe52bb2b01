"""Exact deduplication by a tree merge of sorted digest runs, on DataFrame functions alone.

Every row's text is reduced to its SHA-256, its length and a second 64-bit hash.
Rows are dealt into RUNS runs by identifier; a run holds one entry per text (the best
identifier and the number of rows) and is cut by the digest's first digits into slices.
In each round FAN neighbouring runs meet, slice by slice: their entries are exchanged by slice
and merged run alone, sorted by digest within the partition, and one pass over that order
keeps the best identifier of each text, so that a partition again holds sorted runs, until one
is left. The binomial tree takes log(RUNS)/log(FAN) exchanges, of digests only. Entries meet only if length
and second hash agree with the digest as well, so that identifiers are verified
at every level. A text shared by a third of all rows is aggregated before it first moves, is RUNS entries
in the first round and FAN entries of a merge, never one large group; slices are even, as digests are.

Defined cases: a null text counts as empty; a null identifier is the smallest;
rows with the same identifier and text are one document stored twice, and all of
them carry kept = true in the flags while keep_one returns one of them; an empty
table gives an empty table; further columns play no part. Identifiers may be of any
ordered type; of a text of any length only its digests are exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.llm._spark import stage_table

RUNS, FAN = 64, 4
#: Leading hexadecimal digits of a digest that cut a run into slices.
SLICE = 4
_TEXT = ["__digest", "__bytes", "__check"]


def digest_columns(text: str) -> list[Column]:
    """What identifies a text: its digest, and what verifies it."""
    value = F.coalesce(F.col(text), F.lit(""))
    return [F.sha2(value, 256).alias(_TEXT[0]), F.octet_length(value).alias(_TEXT[1]), F.xxhash64(value).alias(_TEXT[2])]


def sorted_runs(digests: DataFrame, largest: bool) -> DataFrame:
    """Entries of the first RUNS runs, one per run and text: __run, __slice, the text's digests, __keep, __alike and __size."""
    best = F.max if largest else F.min
    stored = digests.groupBy(*_TEXT, "__id").agg(F.count("*").alias("n"))
    run = F.pmod(F.xxhash64("__id"), F.lit(RUNS)).cast("int").alias("__run")
    entries = stored.groupBy(*_TEXT, run).agg(best(F.struct(F.struct("__id").alias("__keep"), F.col("n").alias("__alike"))).alias("best"), F.sum("n").alias("__size"))
    return entries.select("__run", F.substring(_TEXT[0], 1, SLICE).alias("__slice"), *_TEXT, "best.__keep", "best.__alike", "__size")


def merge_round(level: DataFrame, largest: bool) -> DataFrame:
    """Each FAN neighbouring runs merged into one: exchanged by slice, sorted by digest, a text's entries taken together in that order."""
    place = F.desc("__keep") if largest else F.asc("__keep")
    where = ["__slice", "__run"]
    met = level.withColumn("__run", F.floor(F.col("__run") / FAN).cast("int")).repartition(*where)
    met = met.sortWithinPartitions(*where, *_TEXT, place)  # the order that the window asks for: it sorts nothing again
    text = Window.partitionBy(*where, *_TEXT).orderBy(place)
    merged = met.withColumns({"__place": F.row_number().over(text), "__all": F.sum("__size").over(text.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    return merged.where("__place = 1").select(*where[::-1], *_TEXT, "__keep", "__alike", F.col("__all").alias("__size"))


def merge_runs(digests: DataFrame, largest: bool) -> DataFrame:
    """One row per text: __keep (the largest or smallest identifier), __size (rows), __alike (rows with that identifier)."""
    level, runs = sorted_runs(digests, largest), RUNS
    while runs > 1:
        level, runs = merge_round(level, largest), -(-runs // FAN)
    return level.select(*_TEXT, F.col("__keep.__id").alias("__keep"), "__size", "__alike")


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return stage_table(docs.select(F.col(id_col).alias("__id"), *digest_columns(text_col)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """A row per document: its identifier, keep_id, group_size, kept and text_sha256."""
    digests = _digests(docs, id_col, text_col)
    groups = merge_runs(digests, largest)
    return digests.join(groups, _TEXT).select(
        F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
        F.col("__id").eqNullSafe(F.col("__keep")).alias("kept"), F.col("__digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """The rows of docs that stay, one of each text, with the columns of docs."""
    groups = stage_table(merge_runs(_digests(docs, id_col, text_col), largest)).withColumnRenamed("__keep", "__id")
    keys = [*_TEXT, "__null", "__id0"]
    null_safe = lambda df, c: df.withColumns({"__null": F.col(c).isNull(), "__id0": F.coalesce(F.col(c).cast("string"), F.lit(""))})
    rows = null_safe(docs.withColumns(dict(zip(_TEXT, digest_columns(text_col), strict=True))), id_col)
    rows = rows.join(null_safe(groups, "__id").select(*keys), keys, "left_semi")
    if groups.where("__alike > 1").limit(1).count():  # a document stored twice
        rows = rows.dropDuplicates(keys)
    return rows.select(*docs.columns)
