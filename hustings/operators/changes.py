"""Snapshots and working files: what is new, moved or lost, merged edits, restored points, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ids_of(tag: str = "ra_id") -> Column:
    """The identifiers in a tag that editors may have merged with semicolons."""
    return F.filter(F.transform(F.split(F.coalesce(tag, F.lit("")), ";"), lambda s: F.trim(s)), lambda s: s != "")


def apply_changes(file: DataFrame, seeds: DataFrame, unmatched: DataFrame) -> DataFrame:
    """file points (ra_id, kind, mcnorm, okrsok, reason) brought up to date, with change: new, moved, lost or unchanged.

    Points with several identifiers, and other kinds, stay as they are, without a change.
    """
    own = F.col("kind").isin("seed", "unmatched") & (F.size(ids_of()) == 1)
    s = seeds.select("ra_id", F.col("mcnorm").alias("s_mc"), F.col("okrsok").alias("s_okr"))
    u = unmatched.select("ra_id", F.col("reason").alias("u_reason"))
    both = file.join(s, "ra_id", "left").join(u, "ra_id", "left")
    seeded, was = F.col("s_okr").isNotNull(), F.col("kind") == "seed"
    same = F.col("s_okr").eqNullSafe(F.col("okrsok").cast("int")) & F.col("s_mc").eqNullSafe(F.col("mcnorm"))
    change = F.when(~own, None).when(seeded & was & same, "unchanged").when(seeded & was, "moved").when(seeded, "new").when(was, "lost").otherwise("unchanged")
    both = both.withColumns({"change": change, "was": F.when(change == "moved", F.col("okrsok"))})
    hit = F.col("change").isin("new", "moved")
    lost = F.col("change").eqNullSafe("lost")
    return both.withColumns({
        "kind": F.when(hit, "seed").when(lost, "unmatched").otherwise(F.col("kind")),
        "mcnorm": F.when(hit, F.col("s_mc")).otherwise(F.col("mcnorm")),
        "okrsok": F.when(hit, F.col("s_okr")).when(lost, None).otherwise(F.col("okrsok")),
        "reason": F.when(hit, None).when(lost, F.coalesce("u_reason", F.lit("no-street"))).otherwise(F.col("reason")),
    }).drop("s_mc", "s_okr", "u_reason")


def snapshot_diff(before: DataFrame, now: DataFrame, key: str, value: str) -> DataFrame:
    """key, before, now, change (new, moved, lost, unchanged) of two snapshots, each with one row per key."""
    b, n = before.select(key, F.col(value).alias("before"), F.lit(True).alias("__b")), now.select(key, F.col(value).alias("now"), F.lit(True).alias("__n"))
    change = F.when(F.col("__b").isNull(), "new").when(F.col("__n").isNull(), "lost").when(F.col("before").eqNullSafe(F.col("now")), "unchanged").otherwise("moved")
    return b.join(n, key, "full").withColumn("change", change).drop("__b", "__n")


def _as_filed(file: DataFrame, order: str | None) -> DataFrame:
    """ra_id, f_okrsok, f_mcnorm of the address points of a file: first values of merged tags, the last feature of an identifier.

    Points with several identifiers, or none, are left out; an unmatched point has no precinct.
    """
    one = file.where(F.col("kind").isin("seed", "unmatched") & (F.coalesce("ra_id", F.lit("")) != "") & ~F.contains(F.col("ra_id").cast("string"), F.lit(";")))
    first = lambda c: F.split(F.col(c).cast("string"), ";")[0]
    okrsok = F.when(F.col("kind") == "seed", first("okrsok").try_cast("int"))
    kept = one.select("ra_id", F.struct(okrsok.alias("f_okrsok"), first("mcnorm").alias("f_mcnorm")).alias("f"), F.col(order).alias("o") if order else F.lit(0).alias("o"))
    return kept.groupBy("ra_id").agg(F.max_by("f", "o").alias("f")).select("ra_id", "f.*")


def diff_against_file(file: DataFrame, seeds: DataFrame, order: str | None = None) -> DataFrame:
    """seeds that a working file shows otherwise, with change (new: without a precinct; moved: in another), from_okrsok and from_mcnorm (moved only).

    file: ra_id, kind, mcnorm, okrsok and the column `order` in which a later feature of an identifier replaces an earlier
    one. Seeds that the file lacks, or without an identifier, are ignored.
    """
    both = seeds.join(_as_filed(file, order), "ra_id")
    moved = (F.col("f_okrsok") != F.col("okrsok")) | ~F.col("f_mcnorm").eqNullSafe(F.col("mcnorm"))
    found = both.withColumn("change", F.when(F.col("f_okrsok").isNull(), "new").when(moved, "moved")).where("change is not null")
    was = lambda c: F.when(F.col("change") == "moved", F.col(f"f_{c}")).alias(f"from_{c}")
    return found.select(*seeds.columns, "change", was("okrsok"), was("mcnorm"))


def lost_of_file(file: DataFrame, seeds: DataFrame, order: str | None = None) -> DataFrame:
    """ra_id, okrsok, mcnorm of the points that a working file shows in a precinct and that no seed matches any more."""
    shown = _as_filed(file, order).where("f_okrsok is not null")
    return shown.join(seeds.select("ra_id"), "ra_id", "left_anti").select("ra_id", F.col("f_okrsok").alias("okrsok"), F.col("f_mcnorm").alias("mcnorm"))


def seed_diff(seeds: DataFrame, before_seeds: DataFrame, before_unmatched: DataFrame) -> DataFrame:
    """seeds that two snapshots show otherwise: new with the reason it had (was), or moved with from_okrsok and from_mcnorm.

    A point moved only if both precincts, or both areas, are known and differ. A row per pair of rows with the same identifier.
    """
    old = before_seeds.select("ra_id", F.col("okrsok").alias("from_okrsok"), F.col("mcnorm").alias("from_mcnorm"))
    moved = seeds.join(old, "ra_id").where((F.col("okrsok") != F.col("from_okrsok")) | (F.col("mcnorm") != F.col("from_mcnorm")))
    new = seeds.join(before_unmatched.select("ra_id", F.col("reason").alias("was")), "ra_id").withColumn("change", F.lit("new"))
    return new.unionByName(moved.withColumn("change", F.lit("moved")), allowMissingColumns=True).select(*seeds.columns, "change", "was", "from_okrsok", "from_mcnorm")


def upsert(current: DataFrame, edits: DataFrame, keys: list[str]) -> DataFrame:
    """current with the rows of edits put over those with the same keys, and new ones added; values of edits hold even if null."""
    values = [c for c in current.columns if c not in keys]
    new = edits.select(*keys, F.struct(*values).alias("__new"))
    merged = current.select(*keys, F.struct(*values).alias("__old")).join(new, keys, "full").select(*keys, F.coalesce("__new", "__old").alias("v"))
    return merged.select(*keys, "v.*").select(*current.columns)


def restore_missing(rows: DataFrame, file: DataFrame) -> DataFrame:
    """rows whose ra_id no feature of the file carries, tagged change = restored."""
    held = file.select(F.explode(ids_of()).alias("ra_id")).distinct()
    return rows.join(held, "ra_id", "left_anti").withColumn("change", F.lit("restored"))


def replace_kind(file: DataFrame, rows: DataFrame, kind: str) -> DataFrame:
    """file with all features of a kind replaced by rows; doing it again changes nothing."""
    return file.where(~F.col("kind").eqNullSafe(kind)).unionByName(rows.withColumn("kind", F.lit(kind)), allowMissingColumns=True)


def import_problems(features: DataFrame) -> DataFrame:
    """features with problem: why a polygon can't be imported, or null."""
    okr = F.col("okrsok").cast("string")
    problem = F.when(~F.coalesce(okr.rlike(r"^[1-9]\d*$"), F.lit(False)), "bad okrsok").when(F.coalesce("mcnorm", F.lit("")) == "", "missing mcnorm").when(~F.col("geom_type").isin("Polygon", "MultiPolygon"), "not a polygon")
    return features.withColumn("problem", problem)


def suspects(seeds: DataFrame, enclaves: DataFrame, distances: DataFrame, isolated: float = 400.0) -> DataFrame:
    """seeds with check: enclave before isolated, else null. enclaves: ra_id; distances: ra_id, d (null: none near)."""
    e = enclaves.select("ra_id", F.lit(True).alias("__e")).distinct()
    found = seeds.join(e, "ra_id", "left").join(distances.select("ra_id", "d"), "ra_id", "left")
    check = F.when(F.col("__e"), "enclave").when(F.col("d").isNull() | (F.col("d") >= isolated), "isolated")
    return found.withColumn("check", check).drop("__e", "d")


def tags_text(tags: Column) -> Column:
    """A tag map as JSON without empty values."""
    return F.to_json(F.map_filter(tags, lambda _, v: v.isNotNull() & (v != "")))
