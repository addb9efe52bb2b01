"""Small audits and groupings of rules, addresses and shapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hustings.functions.text import norm, num_part, street_key
from hustings.operators import overlay
from hustings.operators.documents import split_street_rule


def with_street(addresses: DataFrame) -> DataFrame:
    """Addresses that have a street."""
    return addresses.where("coalesce(street, '') <> ''")


def selected(features: DataFrame, mcnorm: str | None = None, okrsky: list[int] | None = None) -> DataFrame:
    """Features of an area and of some of its precincts; without either, all."""
    features = features.where(F.col("mcnorm") == mcnorm) if mcnorm is not None else features
    return features.where(F.col("okrsok").isin(okrsky)) if okrsky is not None else features


def row_counts(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """what, n, keys: rows and distinct keys of each table."""
    counts = [df.agg(F.lit(name).alias("what"), F.count("*").alias("n"), F.count_distinct(key).alias("keys")) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


def class_counts(rules: DataFrame) -> DataFrame:
    """mcnorm, cls, n and share of the area's rules in per cent."""
    counts = rules.groupBy("mcnorm", "cls").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("mcnorm")), 1))


def last_written(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key: the last by order."""
    last = F.max(F.struct(*order, F.struct(*(F.col(c) for c in rows.columns)).alias("row")))
    return rows.groupBy(*keys).agg(last.alias("m")).select("m.row.*")


def merged_parts(parts: DataFrame) -> DataFrame:
    """mcnorm, okrsok, idx, n: precincts of several parts, known by the first."""
    return parts.groupBy("mcnorm", "okrsok").agg(F.min("idx").alias("idx"), F.count("*").alias("n")).where("n > 1")


def streets_of_register(addresses: DataFrame) -> DataFrame:
    """mcnorm, key, street: each street once, by its first spelling."""
    key = street_key(norm(F.col("street")))
    names = with_street(addresses).select("mcnorm", "street").distinct()
    return names.groupBy("mcnorm", key.alias("key")).agg(F.min("street").alias("street"))


def upper_median(rows: DataFrame, by: str, value: str) -> DataFrame:
    """by, median: of an even number of values the upper of the middle two."""
    known = rows.where(F.col(value).isNotNull())
    place = F.row_number().over(Window.partitionBy(by).orderBy(value)) - 1
    size = F.count("*").over(Window.partitionBy(by))
    return known.select(by, value, place.alias("k"), size.alias("n")).where("k = n div 2").select(by, F.col(value).alias("median"))


def row_spacing(lines: DataFrame, by: str, at: str) -> DataFrame:
    """by, median: the usual distance from a line to the next."""
    gap = F.lead(at).over(Window.partitionBy(by).orderBy(at)) - F.col(at)
    return upper_median(lines.withColumn("gap", gap), by, "gap")


def centred_blocks(anchors: DataFrame, first: Column, by: str = "doc", at: str = "y", number: str = "num") -> DataFrame:
    """by, num, top, bottom: blocks that begin at first and have their anchors in the middle, one below the other."""
    start = F.struct(first.cast("double").alias("top"), F.expr("cast(array() as array<struct<num:int,top:double,bottom:double>>)").alias("done"))

    def step(state: Column, a: Column) -> Column:
        bottom = 2 * a["at"] - state["top"]
        block = F.struct(a["num"].alias("num"), state["top"].alias("top"), bottom.alias("bottom"))
        return F.struct(bottom.alias("top"), F.array_append(state["done"], block).alias("done"))

    ordered = anchors.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(F.col(at).cast("double").alias("at"), F.col(number).cast("int").alias("num")))).alias("a"))  # anchors of a document
    return ordered.select(by, F.explode(F.aggregate("a", start, step, lambda s: s["done"])).alias("b")).select(by, "b.*")


def per_address_rules(rows: DataFrame) -> DataFrame:
    """Rules of a register export that names the precinct of each address: mcnorm, street, number, okrsok.

    A street of one precinct is one rule without numbers, one of several a rule with the numbers of each. Rows that lack
    a street or a number, or whose precinct isn't positive, play no part.
    """
    whole = rows.where("coalesce(street, '') <> '' and coalesce(number, '') <> '' and okrsok > 0").select("mcnorm", "street", "number", "okrsok").distinct()
    key = street_key(norm(F.col("street")))
    listed = F.sort_array(F.collect_set(F.struct(F.coalesce(num_part(F.col("number")), F.lit(0)).alias("n"), "number")))
    cells = whole.groupBy("mcnorm", "okrsok", key.alias("key")).agg(F.min("street").alias("street"), F.array_join(F.transform(listed, lambda x: x["number"]), ", ").alias("numspec"))
    placed = cells.withColumn("cell_no", F.row_number().over(Window.partitionBy("mcnorm").orderBy("okrsok", "key")).cast("long"))
    return split_street_rule(placed.select("mcnorm", "okrsok", "cell_no", "street", "numspec"))


def coverage(parts: DataFrame, boundaries: DataFrame, cell: float = 1000.0) -> DataFrame:
    """mcnorm, n, area, covered, gap and spill in hectares: how an area's parts fill its boundary, whatever their shapes.

    parts, boundaries: mcnorm and ring or rings. What several parts hold counts once.
    """
    named = lambda df: overlay.with_rings(df).select("mcnorm", "rings", F.monotonically_increasing_id().alias("part"))
    own = named(parts)
    areas = overlay.overlay_areas(named(boundaries), own, ["mcnorm"], cell)
    counts = own.groupBy("mcnorm").agg(F.count("*").alias("n"))
    ha = lambda v: F.round(v / 10_000, 4)
    found = counts.join(areas, "mcnorm").where("only_one + both > 0")
    return found.select("mcnorm", "n", ha(F.col("only_one") + F.col("both")).alias("area"), ha(F.col("both")).alias("covered"), ha(F.col("only_one")).alias("gap"), ha(F.col("only_two")).alias("spill"))
