"""Matching register addresses to precinct rules.

addresses: ra_id, mcnorm, street, orient, supisne; rules: mcnorm, street_norm, okrsok,
parity, cls, number_kind, spec, row_idx (source order). Rules are gathered by street of the
register first, where names are normalised and tails tried once per street. Addresses
then meet an array of their street's rules in one join, and everything else is a row's own: an
address is one row in and one row out, whether its identifier is its own or not. Spark
broadcasts the streets where its statistics say that they are few, and splits a hot one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.functions.text import endpoint_parity, house_norm, let, norm, num_part, parity_ok, street_key, tail_of


def keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules as printed with their street key and tail; rules without a street name are left out."""
    key = street_key(F.col("street_norm"))
    return rules.where("coalesce(street_norm, '') <> ''").withColumn("key", key).select("*", let(F.col("key"), tail_of).alias("tail"))


def index_rules(rules: DataFrame) -> DataFrame:
    """Rules to match by: keyed, and the ranges of streets that are split by side resolved."""
    return resolve_split_parity(keyed_rules(rules))


def resolve_split_parity(indexed: DataFrame) -> DataFrame:
    """Ranges of one street in two precincts that overlap and start and end on opposite sides get the side of their ends, if one of them is unmarked.

    An unmarked range is still unmarked when it first meets another, so any meeting settles it. A mark
    that contradicts its range's ends gives way only to a range that is unmarked until then: one whose
    first meeting, in source order, is this. Ranges are compared by kind, the distinct ones of a
    precinct's street; a range whose ends differ in parity meets none.
    """
    ranges = indexed.select("mcnorm", "key", "okrsok", "row_idx", F.posexplode("spec.ranges").alias("range_idx", "r"))
    sided = ranges.select("mcnorm", "key", "okrsok", "r.*", endpoint_parity(F.col("r.lo"), F.col("r.hi")).alias("side"), F.struct("row_idx", "range_idx").alias("pos"))
    kinds = sided.where("side is not null").groupBy("mcnorm", "key", "okrsok", "lo", "hi", "side", "parity").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    streets = kinds.groupBy("mcnorm", "key").agg(F.collect_list(F.struct("okrsok", "lo", "hi", "side", "parity", "first", "last")).alias("kinds"))

    def met(k: Column) -> Column:
        return F.filter("kinds", lambda o: (o["okrsok"] != k["okrsok"]) & (o["side"] != k["side"]) & (o["lo"] <= k["hi"]) & (k["lo"] <= o["hi"]))

    def first_met(k: Column, l: Column, h: Column) -> Column:  # noqa: E741
        # pairs come in the order of their lower precinct's range: a range meets the first below before its own turn, or else the first above
        return F.array_compact(F.array(F.when(h.isNull() | (k["last"] > l), l), F.when(l.isNull() | (k["first"] < l), h)))

    def first_of(k: Column) -> Column:
        earliest = lambda below: F.array_min(F.transform(F.filter(met(k), lambda o: (o["okrsok"] < k["okrsok"]) == below), lambda o: o["first"]))
        return let(F.struct(earliest(True).alias("l"), earliest(False).alias("h")), lambda e: first_met(k, e["l"], e["h"]))

    unmarked = F.filter("kinds", lambda k: k["parity"] == "both")
    settled = F.transform(F.filter(unmarked, lambda k: F.size(met(k)) > 0), lambda k: F.struct(k["okrsok"].alias("okrsok"), k["lo"].alias("lo"), k["hi"].alias("hi")))
    contradicted = F.exists("kinds", lambda k: (k["parity"] != "both") & (k["parity"] != k["side"]))
    streets = streets.select("mcnorm", "key", settled.alias("settled"), F.when(contradicted, F.flatten(F.transform(unmarked, first_of))).alias("forced")).where("size(settled) > 0")

    def resolved(r: Column, i: Column) -> Column:
        told = (r["parity"] == "both") & F.array_contains("settled", F.struct(F.col("okrsok"), r["lo"].alias("lo"), r["hi"].alias("hi")))
        told = told | F.coalesce(F.array_contains("forced", F.struct(F.col("row_idx"), i.alias("range_idx"))), F.lit(False))
        return F.struct(r["lo"].alias("lo"), r["hi"].alias("hi"), F.when(told, endpoint_parity(r["lo"], r["hi"])).otherwise(r["parity"]).alias("parity"))

    spec = F.when(F.col("settled").isNotNull(), F.col("spec").withField("ranges", F.transform("spec.ranges", resolved))).otherwise(F.col("spec"))
    return indexed.join(streets, ["mcnorm", "key"], "left").withColumn("spec", spec).select(*indexed.columns)


def street_rules(streets: DataFrame, indexed: DataFrame) -> DataFrame:
    """mcnorm, street, rule_key and rules (in source order) of each distinct street: by its key, else by a tail that names one street of the area.

    Names are normalised once per street, however many addresses it has; a street's rules are those of one document.
    """
    key = street_key(norm(F.col("street")))
    keyed = streets.select("mcnorm", "street").where("street is not null").distinct().withColumn("key", key)
    keyed = keyed.select("*", let(F.col("key"), tail_of).alias("tail"))
    rule = F.struct("row_idx", "okrsok", "parity", "cls", "number_kind", "spec")
    by_key = indexed.groupBy("mcnorm", "key").agg(F.min("tail").alias("tail"), F.sort_array(F.collect_list(rule)).alias("rules"))
    tails = by_key.where("tail is not null").groupBy("mcnorm", "tail").agg(F.min("key").alias("tail_key"), F.count("*").alias("n")).where("n = 1").drop("n")
    known = by_key.select("mcnorm", "key", F.lit(True).alias("known"))
    found = keyed.join(known, ["mcnorm", "key"], "left").join(tails, ["mcnorm", "tail"], "left")
    found = found.select("mcnorm", "street", F.when(F.col("known"), F.col("key")).otherwise(F.col("tail_key")).alias("rule_key"))
    return found.join(by_key.select("mcnorm", F.col("key").alias("rule_key"), "rules"), ["mcnorm", "rule_key"], "left").select("mcnorm", "street", "rule_key", "rules")


def _numbers_of(orient: Column, supisne: Column) -> Column:
    """What rules ask of an address: its numbers in normal form and as integers."""
    return F.struct(
        F.struct(house_norm(orient).alias("house"), num_part(orient).alias("n"), (F.coalesce(orient, F.lit("")) != "").alias("has")).alias("orient"),
        F.struct(house_norm(supisne).alias("house"), num_part(supisne).alias("n"), (F.coalesce(supisne, F.lit("")) != "").alias("has")).alias("supisne"),
    )


def rule_fits(rule: Column, numbers: Column) -> Column:
    """Whether an address with these numbers falls under a rule of its street."""

    def by_number(value: Column) -> Column:
        in_range = F.exists(rule["spec"]["ranges"], lambda r: value["n"].between(r["lo"], r["hi"]) & parity_ok(r["parity"], value["n"]))
        listed = F.exists(rule["spec"]["singles"], lambda s: (house_norm(s) == value["house"]) | (s.rlike("^[0-9]+$") & (s.try_cast("int") == value["n"])))
        return value["has"] & (in_range | ((rule["cls"] == "ENUM") & listed))

    of_side = parity_ok(rule["parity"], numbers["orient"]["n"])
    numbered = let(F.when(rule["number_kind"] == "supisne", numbers["supisne"]).otherwise(numbers["orient"]), by_number)
    return F.coalesce(F.when(rule["cls"] == "INSTITUTION", False).when(rule["cls"] == "WHOLE", (rule["parity"] == "both") | of_side).otherwise(numbered), F.lit(False))


def _with_rules(addresses: DataFrame, indexed: DataFrame) -> DataFrame:
    """addresses, each once, with rule_key, rules and hits: the rules of its street, and those of them that it falls under."""
    found = addresses.join(street_rules(addresses, indexed), ["mcnorm", "street"], "left").select(*addresses.columns, "rule_key", "rules")
    hits = let(_numbers_of(F.col("orient"), F.col("supisne")), lambda n: F.filter("rules", lambda r: rule_fits(r, n)))
    return found.withColumn("hits", hits)


def candidates(addresses: DataFrame, indexed: DataFrame) -> DataFrame:
    """A row per address and rule of its street, with hit; an address without rules is one row."""
    rows = _with_rules(addresses, indexed).withColumn("rule", F.explode_outer("rules"))
    hit = F.coalesce(F.exists("hits", lambda h: h["row_idx"] == F.col("rule.row_idx")), F.lit(False))
    return rows.select(*addresses.columns, "rule_key", "rule.*", hit.alias("hit"))


def match(addresses: DataFrame, indexed: DataFrame) -> DataFrame:
    """addresses, row by row, with status (ok, ambiguous, no-street, no-number), okrsok and row_idx of the first rule that decides."""
    lettered = F.col("orient").rlike("(?i)[a-z]")
    exact = lambda h: (h["cls"] == "ENUM") & F.exists(h["spec"]["singles"], lambda s: house_norm(s) == house_norm(F.col("orient")))
    only = F.when(lettered & (F.size("hits") > 1), F.filter("hits", exact))
    named = _with_rules(addresses, indexed).withColumn("hits", let(only, lambda e: F.when(F.size(e) > 0, e).otherwise(F.col("hits"))))
    single = lambda c: F.size(F.array_distinct(F.transform(c, lambda h: h["okrsok"]))) == 1
    specific = F.filter("hits", lambda h: h["cls"] != "WHOLE")
    chosen = F.when(single(F.col("hits")), F.get("hits", F.lit(0))).otherwise(let(specific, lambda s: F.when(single(s), F.get(s, F.lit(0)))))
    decided = named.withColumn("chosen", chosen)
    status = F.when(F.col("rules").isNull(), "no-street").when(F.size("hits") == 0, "no-number").when(F.col("chosen").isNotNull(), "ok").otherwise("ambiguous")
    return decided.select(*addresses.columns, status.alias("status"), F.col("chosen.okrsok").alias("okrsok"), F.col("chosen.row_idx").alias("row_idx"))


def seed_stats(matched: DataFrame, indexed: DataFrame, times: str | None = None) -> DataFrame:
    """A row per area: precincts, precincts with seeds, addresses by outcome and the match rate in per cent. times: how often a row counts."""
    if times:
        return _seed_stats(matched, indexed, lambda s: F.sum(F.when(F.col("status") == s, F.col(times)).otherwise(0)), F.sum(times))
    return _seed_stats(matched, indexed, lambda s: F.count_if(F.col("status") == s), F.count("*"))


def _seed_stats(matched: DataFrame, indexed: DataFrame, of: Callable[[str], Column], all_rows: Column) -> DataFrame:
    counts = matched.groupBy("mcnorm").agg(
        all_rows.alias("street_pts"), F.count_distinct("okrsok").alias("okrsky_seeded"),
        *(of(s).alias(n) for s, n in (("ok", "matched"), ("no-street", "no_street"), ("no-number", "no_number"), ("ambiguous", "ambiguous"))),
        F.round(F.try_divide(100.0 * of("ok"), all_rows), 1).alias("match_pct"),
    )
    return counts.join(indexed.groupBy("mcnorm").agg(F.count_distinct("okrsok").alias("okrsky")), "mcnorm", "left")


def uncovered_rules(matched: DataFrame, indexed: DataFrame, times: str | None = None) -> DataFrame:
    """Rules other than institutions that decide no address, with the register's addresses on their street. times: how often a row counts."""
    used = matched.where("row_idx is not null").select("row_idx").distinct()
    by_name = matched.groupBy("mcnorm", "street").agg((F.sum(times) if times else F.count("*")).alias("n"))
    on_street = by_name.groupBy("mcnorm", street_key(norm(F.col("street"))).alias("key")).agg(F.sum("n").alias("ra_pts_on_street"))
    left = indexed.where("cls <> 'INSTITUTION'").join(used, "row_idx", "left_anti").join(on_street, ["mcnorm", "key"], "left")
    return left.select("mcnorm", "okrsok", "key", "cls", "row_idx", F.coalesce("ra_pts_on_street", F.lit(0).cast("long")).alias("ra_pts_on_street"))


def top_unmatched(matched: DataFrame, most: int = 12) -> DataFrame:
    """mcnorm, street, n: the streets of each area with the most addresses without a precinct."""
    counts = matched.where("status <> 'ok'").groupBy("mcnorm", "street").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("mcnorm").orderBy(F.desc("n"), "street"))
    return counts.withColumn("place", place).where(F.col("place") <= most).drop("place")


def numbers_of_rules(indexed: DataFrame) -> DataFrame:
    """A row per house number that a rule's ranges name."""
    ranges = indexed.select("mcnorm", "key", "okrsok", "row_idx", F.explode("spec.ranges").alias("r")).where("r.lo <= r.hi")
    step = F.when(F.col("r.parity") == "both", 1).otherwise(2)
    odd = F.col("r.parity") == "odd"
    first = F.when((F.col("r.parity") != "both") & ((F.pmod("r.lo", F.lit(2)) == 1) != odd), F.col("r.lo") + 1).otherwise(F.col("r.lo"))
    ranges = ranges.withColumns({"first": first, "step": step}).where("first <= r.hi")
    return ranges.select("mcnorm", "key", "okrsok", "row_idx", F.explode(F.sequence("first", "r.hi", "step")).alias("number"))


def collisions(keyed: DataFrame) -> DataFrame:
    """House numbers that ranges, as printed, give to more than one precinct."""
    by_number = numbers_of_rules(keyed).groupBy("mcnorm", "key", "number").agg(F.array_sort(F.collect_set("okrsok")).alias("claims"))
    return by_number.where(F.size("claims") > 1)


def self_test(indexed: DataFrame) -> DataFrame:
    """Every number that the rules name, matched back: result is ok, wrong or miss."""
    listed = indexed.where("cls = 'ENUM' and number_kind = 'orientacne'").select("mcnorm", "key", "okrsok", F.explode("spec.singles").alias("orient"))
    named = numbers_of_rules(indexed).select("mcnorm", "key", "okrsok", F.col("number").cast("string").alias("orient")).unionByName(listed).distinct()
    probes = named.select("mcnorm", F.col("key").alias("street"), "orient", F.lit(None).cast("string").alias("supisne"), F.col("okrsok").alias("expected"))
    result = F.when(F.col("status") != "ok", "miss").when(F.col("okrsok") == F.col("expected"), "ok").otherwise("wrong")
    return match(probes, indexed).withColumn("result", result)
