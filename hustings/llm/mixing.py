"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share of all words by weight, limited to CAP times its
own size; what a limited source leaves is shared among the others by weight,
until none is above its limit. A target takes complete epochs of the source
first. The rest of it is a weighted sample without replacement: each document
draws the key u ** (1 / quality), u uniform from a hash of its identifier and
text, and documents are taken by falling key until the prefix sum of their sizes
comes nearest to the rest; the last document may be taken in part.

The prefix sums don't sort a source in one task: sizes are summed by source and
key bin (BINS of equal width in the key) and the sums prefixed over the bins; the
one bin of each source in which the target is crossed is sorted alone. The
outcome is a small table of a cut for each source, and whether a document is
taken follows from its own row and that table.

Quality is QUALITY_FLOOR plus the share of letters among the characters that are
not white space. Source weights cycle through WEIGHTS in code point order, null
last.

Defined cases: a null text has size 0; documents of size 0 are taken 0 words;
null is a source of its own; repeated rows (same identifier and text) have the same key and
are all taken alike, so that where the cut falls on one that is stored k times, its source
misses its target by up to k - 1 times its size; an empty table gives an empty one; a text of
any length is counted whole in its own row; extra columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hustings.llm._spark import stage_table

WEIGHTS, CAP = (5, 2, 1), 3
BINS, QUALITY_FLOOR = 4096, 0.1


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long"), F.lit(0).cast("long"))


def _keys(id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    """__id, __source, __size, __key (falling keys are taken first), __tie, __bin."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    solid = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    letters = F.length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", ""))
    quality = F.lit(QUALITY_FLOOR) + (1 - QUALITY_FLOOR) * F.coalesce(F.try_divide(letters, solid), F.lit(0.0))
    draw = F.xxhash64(F.col(id_col), F.lit(seed), text)
    u = (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) * F.lit(2.0**-53)
    key = F.pow(u, 1 / quality)
    return [
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), n_words(F.col(text_col)).alias("__size"), key.alias("__key"), draw.alias("__tie"),
    ]


def _binned(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("__bin", F.least(F.floor((1 - F.col("__key")) * BINS).cast("int"), F.lit(BINS - 1)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """__source, __total (its size), __target. sizes: __source, __total, one row each."""
    # one row per source: a ranking of sources, not of documents
    rank = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")).cast("double")
    ranked = stage_table(sizes.select("__source", "__total", weight.alias("__weight")))
    everything = ranked.agg(F.sum("__total")).first()[0] or 0
    level = 0.0  # words per weight of the sources below their limits
    while True:
        full = F.col("__weight") * F.lit(level) >= F.col("__total") * cap if level else F.lit(False)
        left = ranked.agg(F.sum(F.when(full, F.col("__total") * cap)).alias("full"), F.sum(F.when(~full, F.col("__weight"))).alias("open")).first()
        if not left["open"]:
            break
        raised = (everything - (left["full"] or 0)) / left["open"]
        if math.isclose(raised, level, rel_tol=1e-15, abs_tol=0) or raised < level:
            break
        level = raised
    return ranked.select("__source", "__total", F.least(F.col("__weight") * level, (F.col("__total") * cap).cast("double")).alias("__target"))


def _cuts(sized: DataFrame) -> DataFrame:
    """A row per source: total, target, epochs, and where the fractional part ends (__cut_bin, __cut_key, __cut_tie, __cut_words)."""
    bins = stage_table(sized.groupBy("__source", "__bin").agg(F.sum("__size").alias("__words")))
    targets = source_targets(bins.groupBy("__source").agg(F.sum("__words").alias("__total")))
    targets = targets.withColumn("__epochs", F.coalesce(F.floor(F.try_divide("__target", "__total")), F.lit(0)).cast("long"))
    targets = stage_table(targets.withColumn("__rest", F.round(F.col("__target") - F.col("__epochs") * F.col("__total")).cast("long")))

    # the bin in which a source's prefix sum passes the rest
    ahead = F.sum("__words").over(Window.partitionBy("__source").orderBy("__bin")) - F.col("__words")
    crossed = bins.withColumn("__ahead", ahead).join(targets.withColumnRenamed("__source", "__of"), F.col("__source").eqNullSafe(F.col("__of")))
    crossed = stage_table(
        crossed.where("__ahead < __rest and __ahead + __words >= __rest").select("__source", F.col("__bin").alias("__cut_bin"), "__ahead", "__rest")
    )
    inside = sized.where("__size > 0").join(
        crossed.withColumnRenamed("__source", "__of"), F.col("__source").eqNullSafe(F.col("__of")) & (F.col("__bin") == F.col("__cut_bin"))
    )
    order = Window.partitionBy("__source").orderBy(F.col("__key").desc(), "__tie", "__id").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("__upto", F.col("__ahead") + F.sum("__size").over(order))
    last = inside.where("__upto >= __rest and __upto - __size < __rest").select(
        F.col("__source").alias("__of"), "__cut_bin", F.col("__key").alias("__cut_key"), F.col("__tie").alias("__cut_tie"), F.col("__id").alias("__cut_id"),
        (F.col("__rest") - (F.col("__upto") - F.col("__size"))).alias("__cut_words"),
    )
    return stage_table(targets.join(last, F.col("__source").eqNullSafe(F.col("__of")), "left").drop("__of"))


def _taken(sized: DataFrame, cuts: DataFrame) -> DataFrame:
    """sized with its source's totals and __part: words of the fractional part."""
    own = sized.join(cuts.withColumnRenamed("__source", "__of"), F.col("__source").eqNullSafe(F.col("__of")))
    at_cut = (F.col("__key") == F.col("__cut_key")) & (F.col("__tie") == F.col("__cut_tie")) & F.col("__id").eqNullSafe(F.col("__cut_id"))
    before = (F.col("__bin") < F.col("__cut_bin")) | (
        (F.col("__bin") == F.col("__cut_bin"))
        & (
            (F.col("__key") > F.col("__cut_key"))
            | (F.col("__key") == F.col("__cut_key")) & ((F.col("__tie") < F.col("__cut_tie")) | (F.col("__tie") == F.col("__cut_tie")) & (F.col("__id") < F.col("__cut_id")))
        )
    )
    part = F.when(at_cut, F.least("__cut_words", "__size")).when(before, F.col("__size")).otherwise(0)
    return own.withColumn("__part", F.coalesce(part, F.lit(0)).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """A row per document: identifier, size, source_size, target (of its source), epochs and taken."""
    sized = stage_table(_binned(docs.select(*_keys(id_col, text_col, source_col, seed))))
    mixed = _taken(sized, _cuts(sized))
    return mixed.select(
        F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__total").alias("source_size"), F.col("__target").alias("target"),
        F.col("__epochs").alias("epochs"), (F.col("__epochs") * F.col("__size") + F.col("__part")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the columns of docs; a document taken in part comes whole
    if at least half of it is taken. A document without words is not taken."""
    keys = _keys(id_col, text_col, source_col, seed)
    cuts = _cuts(stage_table(_binned(docs.select(*keys))))
    placed = _binned(docs.select(F.struct(*map(F.col, docs.columns)).alias("__row"), *keys))
    times = F.when(F.col("__size") > 0, F.col("__epochs") + (2 * F.col("__part") >= F.col("__size")).cast("long")).otherwise(0)
    copies = _taken(placed, cuts).withColumn("__times", times.cast("int")).where("__times > 0")
    return copies.select("__row", F.explode(F.sequence(F.lit(1), F.col("__times")))).select("__row.*")
