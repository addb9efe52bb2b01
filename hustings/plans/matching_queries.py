"""Queries of the matcher over the customer and nation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.functions import specs
from hustings.operators import matching
from hustings.plans.adapters import ENTRIES, MATCHED, RULES, addresses, sql, table
from hustings.sources.staging import stage


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation's document of the same entries, parsed."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("mc"), F.col("n_nationkey")).alias("mcnorm"))
    lines = F.array(*(F.struct(F.lit(k).alias("entry"), F.lit(okrsok).alias("okrsok"), F.lit(text).alias("text")) for k, (okrsok, text) in enumerate(ENTRIES)))
    printed = nations.select("n_nationkey", "mcnorm", F.explode(lines).alias("line"))
    parsed = printed.withColumn("p", specs.parse_street_spec(F.col("line.text")))
    return parsed.select("mcnorm", "line.okrsok", (F.col("n_nationkey") * 100 + F.col("line.entry")).alias("row_idx"), "p.*")


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.keyed_rules(rules(spark, sf_dir))


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules to match by, parsed and resolved once; what reads them begins at a table."""
    return stage(matching.index_rules(rules(spark, sf_dir)))


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match(addresses(spark, sf_dir), indexed(spark, sf_dir))


def match_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).select("ra_id", "status", F.col("okrsok").cast("int").alias("okrsok"), F.col("row_idx").cast("long").alias("row_idx"))


def match_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).where("status = 'ambiguous'").groupBy("mcnorm").agg(F.count("*").alias("n"), F.min("ra_id").alias("first_id"))


def range_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.candidates(addresses(spark, sf_dir), indexed(spark, sf_dir))
    return found.where("hit").groupBy("mcnorm", "okrsok", "cls").agg(F.count("*").alias("n"))


def seed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = indexed(spark, sf_dir)
    return matching.seed_stats(matching.match(addresses(spark, sf_dir), index), index)


def uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = indexed(spark, sf_dir)
    return matching.uncovered_rules(matching.match(addresses(spark, sf_dir), index), index).withColumn("row_idx", F.col("row_idx").cast("long"))


def collision_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.collisions(keyed(spark, sf_dir))
    return found.select("mcnorm", "key", "number", F.array_join(F.transform("claims", lambda c: c.cast("string")), ",").alias("claims"))


def self_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.self_test(indexed(spark, sf_dir)).groupBy("mcnorm", "result").agg(F.count("*").alias("n"))


def top_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve streets of each area with the most addresses without a precinct."""
    return matching.top_unmatched(matched(spark, sf_dir))


def tail_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses whose street the rules know only by its last word."""
    found = matching.candidates(addresses(spark, sf_dir), indexed(spark, sf_dir))
    return found.where("street like 'A. %' and rule_key is not null").groupBy("mcnorm", "rule_key").agg(F.count_distinct("ra_id").alias("n"))


SPLIT = """
SELECT o_orderkey AS row_idx, concat('mc', cast(o_custkey % 50 AS varchar(4))) AS mcnorm, concat('street ', cast(o_custkey % 7 AS varchar(2))) AS key,
  cast(o_orderkey % 5 AS int) AS okrsok, cast(o_orderkey % 13 AS int) AS lo, cast(o_orderkey % 13 + 4 * (o_orderkey % 3) + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS int) AS hi,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'both' WHEN o_orderkey % 13 % 2 = 1 THEN 'odd' ELSE 'even' END AS parity
FROM {orders}
"""


def split_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmarked ranges of one street in several precincts get the side of their ends; a fourth of the ranges is marked."""
    ranges = sql(spark, sf_dir, SPLIT, "orders")
    spec = F.struct(F.array(F.struct("lo", "hi", "parity")).alias("ranges"), F.array().cast("array<string>").alias("singles"), F.lit("").alias("raw"))
    fixed = matching.resolve_split_parity(ranges.withColumn("spec", spec))
    return fixed.select("row_idx", "okrsok", F.col("spec.ranges")[0]["parity"].alias("parity"))


QUERIES = {f.__name__: f for f in (match_status, match_ambiguous, range_membership, seed_stats, collision_audit, self_test, top_unmatched, tail_fallback, split_parity)}
QUERIES["uncovered_rules"] = uncovered

_KEY = MATCHED.rstrip()
ORACLES = {
    "match_status": f"{_KEY} SELECT ra_id, status, cast(okrsok AS int) AS okrsok, cast(row_idx AS bigint) AS row_idx FROM matched",
    "match_ambiguous": f"{_KEY} SELECT mcnorm, count(*) AS n, min(ra_id) AS first_id FROM matched WHERE status = 'ambiguous' GROUP BY mcnorm",
    "range_membership": f"{_KEY} SELECT r.mcnorm, c.okrsok, c.cls, count(*) AS n FROM cand c JOIN rules r USING (row_idx) WHERE hit GROUP BY ALL",
    "seed_stats": f"""{_KEY} SELECT m.mcnorm, count(*) AS street_pts, count(DISTINCT m.okrsok) AS okrsky_seeded, count(*) FILTER (WHERE status = 'ok') AS matched,
      count(*) FILTER (WHERE status = 'no-street') AS no_street, count(*) FILTER (WHERE status = 'no-number') AS no_number, count(*) FILTER (WHERE status = 'ambiguous') AS ambiguous,
      round(100.0::double * count(*) FILTER (WHERE status = 'ok') / count(*), 1) AS match_pct, any_value(o.okrsky) AS okrsky
      FROM matched m JOIN (SELECT mcnorm, count(DISTINCT okrsok) AS okrsky FROM rules GROUP BY mcnorm) o USING (mcnorm) GROUP BY m.mcnorm""",
    "uncovered_rules": f"""{_KEY} SELECT r.mcnorm, r.okrsok, r.key, r.cls, cast(r.row_idx AS bigint) AS row_idx, coalesce(s.n, 0) AS ra_pts_on_street FROM rules r
      LEFT JOIN (SELECT mcnorm, CASE WHEN street LIKE 'A. %' THEN lower(street[4:]) ELSE key END AS k, street LIKE 'A. %' AS tail, count(*) AS n FROM matched GROUP BY ALL) s
        ON s.mcnorm = r.mcnorm AND s.k = r.key AND NOT s.tail
      WHERE r.cls <> 'INSTITUTION' AND r.row_idx NOT IN (SELECT row_idx FROM matched WHERE row_idx IS NOT NULL)""",
    "collision_audit": """SELECT concat('mc', cast(n_nationkey AS varchar)) AS mcnorm, 'furniture' AS key, cast(number AS int) AS number, '1,2' AS claims
      FROM nation, range(40, 61) t(number)""",
    "self_test": """WITH probe(number, okrsok, result) AS (
        SELECT cast(i AS varchar), 1, CASE WHEN i < 40 THEN 'ok' ELSE 'miss' END FROM range(1, 61) t(i) UNION ALL SELECT cast(i AS varchar), 2, CASE WHEN i > 60 THEN 'ok' ELSE 'miss' END FROM range(40, 98) t(i)
        UNION ALL SELECT 'b' || i, 1, 'ok' FROM range(0, 25 + 24 + 31 + 3 + 3) t(i))
      SELECT concat('mc', cast(n_nationkey AS varchar)) AS mcnorm, result, count(*) AS n FROM nation, probe GROUP BY ALL""",
    "top_unmatched": f"""{_KEY} SELECT mcnorm, street, n FROM (SELECT mcnorm, street, count(*) AS n, row_number() OVER (PARTITION BY mcnorm ORDER BY count(*) DESC, street) AS k
      FROM matched WHERE status <> 'ok' GROUP BY mcnorm, street) WHERE k <= 12""",
    "tail_fallback": f"""{_KEY} SELECT k.mcnorm, k.key AS rule_key, count(DISTINCT k.ra_id) AS n FROM keyed k SEMI JOIN rules r ON r.mcnorm = k.mcnorm AND r.key = k.key
      WHERE street LIKE 'A. %' GROUP BY ALL""",
    "split_parity": f"""WITH r AS ({SPLIT.replace("{orders}", "orders")}), s AS (SELECT *, CASE WHEN lo % 2 = hi % 2 THEN CASE WHEN lo % 2 = 1 THEN 'odd' ELSE 'even' END END AS side FROM r),
      k AS (SELECT DISTINCT mcnorm, key, okrsok, lo, hi, side FROM s WHERE side IS NOT NULL)
      SELECT a.row_idx, a.okrsok, CASE WHEN a.parity = 'both' AND EXISTS (SELECT 1 FROM k b WHERE b.mcnorm = a.mcnorm AND b.key = a.key AND b.okrsok <> a.okrsok AND b.side <> a.side AND a.lo <= b.hi AND b.lo <= a.hi)
        THEN a.side ELSE a.parity END AS parity FROM s a""",
}
