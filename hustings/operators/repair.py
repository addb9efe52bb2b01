"""Repairs and audits of inputs: street names against the register, lost commas, the rule behind an address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import canon, compatible, norm, street_key


def _without_one(words: Column) -> Column:
    """The strings and all that lack one of their characters."""
    cut = lambda w: F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(w.substr(F.lit(1), i - 1), w.substr(i + 1, F.length(w))))).otherwise(F.expr("cast(array() as array<string>)"))
    return F.array_distinct(F.concat(words, F.flatten(F.transform(words, cut))))


def within_two_edits(names: DataFrame, register: DataFrame) -> DataFrame:
    """a, b, edits: pairs of normalised names (a) and register names (b) at most two edits apart.

    Strings that near share a form that lacks up to two characters, so that the join is one of
    equal forms and compares no unlike names.
    """
    forms = lambda df, c: df.withColumn("form", F.explode(_without_one(_without_one(F.array(F.col(c))))))
    pairs = forms(names.select("a").distinct(), "a").join(forms(register.select("b").distinct(), "b"), "form").select("a", "b").distinct()
    return pairs.withColumn("edits", F.levenshtein("a", "b")).where("edits <= 2")


def register_fixes(streets: DataFrame, register: DataFrame) -> DataFrame:
    """street, fix: register names for streets whose key the register doesn't know.

    A single register name with the same confusable letters, else the nearest one if it is at
    most one edit away and the next is two further. Both: street.
    """
    known = register.select("street", norm(F.col("street")).alias("b"), street_key(norm(F.col("street"))).alias("key"), canon(norm(F.col("street"))).alias("canon")).distinct()
    dirty = streets.select("street").distinct().select("street", norm(F.col("street")).alias("a"), street_key(norm(F.col("street"))).alias("key"), canon(norm(F.col("street"))).alias("canon"))
    dirty = dirty.join(known.select("key").distinct(), "key", "left_anti")
    alike = known.groupBy("canon").agg(F.count("*").alias("n"), F.min("street").alias("fix")).where("n = 1").select("canon", "fix")
    by_canon = dirty.join(alike, "canon").select("street", "fix")
    rest = dirty.join(by_canon.select("street"), "street", "left_anti")
    near = within_two_edits(rest, known).join(known.select("b", F.col("street").alias("fix")), "b")
    ranked = near.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("edits", "fix"))), 1, 2).alias("top"))  # names within two edits of one
    first, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    sure = ranked.where((first["edits"] <= 1) & F.coalesce(second["edits"] >= first["edits"] + 2, F.lit(True))).select("a", first["fix"].alias("fix"))
    return by_canon.unionByName(rest.join(sure, "a").select("street", "fix"))


def split_lost_commas(rules: DataFrame, register: DataFrame) -> DataFrame:
    """rules with names like "Old Street Mill Lane" taken apart; register: mcnorm, street.

    A name without digits that the register doesn't know becomes its longest known ending. If
    what stands before it is known too, that is a WHOLE rule of its own, else it is dropped.
    rules: row_idx, mcnorm, okrsok, street, ...; the result has part: kept, fixed or recovered.
    """
    key = lambda c: street_key(norm(c))
    known = register.select("mcnorm", key(F.col("street")).alias("key")).distinct()
    named = rules.withColumn("key", key(F.col("street")))
    strange = named.where("coalesce(street, '') <> '' and not street rlike '[0-9]'").join(known, ["mcnorm", "key"], "left_anti")
    words = F.split(F.trim("street"), r"\s+")
    cuts = strange.where(F.size(words) > 1).select("row_idx", "mcnorm", "okrsok", words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("i"))
    text = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = cuts.select("row_idx", "mcnorm", "okrsok", "i", text(F.lit(1), F.col("i")).alias("head"), text(F.col("i") + 1, F.size("w") - F.col("i")).alias("tail"))
    fits = cuts.withColumn("key", key(F.col("tail"))).join(known, ["mcnorm", "key"])
    best = fits.groupBy("row_idx", "mcnorm", "okrsok").agg(F.min_by(F.struct("head", "tail"), "i").alias("c")).select("row_idx", "mcnorm", "okrsok", "c.*")
    fixed = rules.join(best.select("row_idx", "tail"), "row_idx", "left")
    fixed = fixed.withColumn("part", F.when(F.col("tail").isNotNull(), "fixed").otherwise("kept")).withColumn("street", F.coalesce("tail", "street")).drop("tail")
    heads = best.withColumn("key", key(F.col("head"))).join(known, ["mcnorm", "key"]).groupBy("mcnorm", "okrsok", "key").agg(F.min_by(F.struct("row_idx", "head"), "row_idx").alias("h"))
    found = heads.select(F.col("h.row_idx").alias("row_idx"), "mcnorm", "okrsok", F.col("h.head").alias("street"), F.lit("recovered").alias("part"))
    return fixed.unionByName(found, allowMissingColumns=True)


def rule_for(points: DataFrame, rules: DataFrame) -> DataFrame:
    """points with rule: manual, explicit, explicit-base, range, whole, supisne or unknown.

    points: ra_id, mcnorm, okrsok, street, orient, supisne, assigned; rules: mcnorm, okrsok, key, cls, spec.
    Rules of the point's street count, else those with a compatible key in its precinct.
    """
    p = points.withColumn("key", street_key(norm(F.coalesce("street", F.lit("")))))
    r = rules.select("mcnorm", "okrsok", F.col("key").alias("rkey"), "cls", "spec")
    exact = p.join(r, (p["mcnorm"] == r["mcnorm"]) & (p["okrsok"] == r["okrsok"]) & (p["key"] == r["rkey"])).select("ra_id", "cls", "spec")
    left = p.join(exact.select("ra_id").distinct(), "ra_id", "left_anti")
    # keys meet once each, by the initials of their words, which compatible keys have in common
    initials = lambda k: F.array_join(F.transform(F.split(k, " "), lambda w: F.substring(w, 1, 1)), " ").alias("initials")
    own = ["mcnorm", "okrsok"]
    keys = left.select(*own, "key", initials("key")).distinct().join(r.select(*own, "rkey", initials("rkey")).distinct(), [*own, "initials"])
    pairs = keys.where(compatible(F.col("key"), F.col("rkey"))).select(*own, "key", "rkey")
    loose = left.join(pairs, [*own, "key"]).join(r, [*own, "rkey"]).select("ra_id", "cls", "spec")
    hits = exact.unionByName(loose).join(points.select("ra_id", "orient"), "ra_id")
    raw, n = F.upper(F.coalesce("orient", F.lit(""))), F.nullif(F.regexp_extract("orient", r"^\s*[0-9]+", 0), F.lit("")).try_cast("int")
    lists = lambda v: F.coalesce((F.col("cls") == "ENUM") & F.exists("spec.singles", lambda s: F.upper(s) == v), F.lit(False))
    in_range = F.exists("spec.ranges", lambda x: n.between(x["lo"], x["hi"]) & ((x["parity"] == "both") | ((x["parity"] == "odd") == (F.pmod(n, F.lit(2)) == 1))))
    rank = (
        F.when(lists(raw), 1).when(n.isNotNull() & (raw != n.cast("string")) & lists(n.cast("string")), 2)
        .when(F.coalesce(in_range, F.lit(False)), 3).when(F.col("cls") == "WHOLE", 4).otherwise(5)
    )
    best = hits.withColumn("rank", rank).groupBy("ra_id").agg(F.min("rank").alias("rank"))
    names = F.element_at(F.array(*map(F.lit, ("explicit", "explicit-base", "range", "whole"))), F.col("rank"))
    no_number = (F.coalesce("supisne", F.lit("")) != "") & (F.coalesce("orient", F.lit("")) == "")
    rule = F.when(F.col("assigned").eqNullSafe("manual"), "manual").when(F.col("rank") <= 4, names).when(no_number, "supisne").otherwise("unknown")
    return points.join(best, "ra_id", "left").withColumn("rule", rule).drop("rank")


def suspicious_whole(rules: DataFrame) -> DataFrame:
    """WHOLE rules whose source names a number other than a leading ordinal."""
    bare = F.regexp_replace("source", r"^\s*\d+\.\s*", "")
    return rules.where((F.col("cls") == "WHOLE") & bare.rlike(r"\d"))
