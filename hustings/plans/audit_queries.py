"""Queries of the small audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.operators import audits
from hustings.plans import geometry_queries, matching_queries
from hustings.plans.adapters import ADDRESSES, addresses, duck, sql, table
from hustings.sources import catalogue


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"customer": "c_nationkey", "orders": "o_custkey", "supplier": "s_nationkey"}
    return audits.row_counts({n: table(spark, sf_dir, n).withColumnRenamed(c, "k") for n, c in names.items()}, "k")


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.class_counts(matching_queries.rules(spark, sf_dir))


def last_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return audits.last_written(rows, ["user_id"], ["event_id"])


def merged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.merged_parts(sql(spark, sf_dir, "SELECT p_brand AS mcnorm, p_size AS okrsok, p_partkey AS idx FROM {part}", "part"))


def streets_of_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.streets_of_register(addresses(spark, sf_dir)).select("mcnorm", "key")


def row_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.row_spacing(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id")


def centred_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as anchors."""
    marks = sql(spark, sf_dir, "SELECT o_custkey AS doc, cast(o_orderkey AS double) AS y, cast(o_orderkey % 1000 AS int) AS num FROM {orders}", "orders")
    return audits.centred_blocks(marks, F.lit(0.0))


EXPORT = """
SELECT concat('mc', cast(o_custkey % 5 AS varchar(2))) AS mcnorm, concat('Lane ', o_orderpriority) AS street, cast(o_orderkey % 60 AS varchar(4)) AS number,
  cast(CASE WHEN o_orderpriority = '1-URGENT' THEN 3 ELSE o_orderkey % 60 % 4 END AS int) AS okrsok FROM {orders}
"""


def per_address_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = audits.per_address_rules(sql(spark, sf_dir, EXPORT.replace("o_orderpriority)", "substring(o_orderpriority, 3, 20))"), "orders"))
    return rules.select("mcnorm", "okrsok", "street_norm", "cls", F.array_join("spec.singles", ",").alias("singles"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's diamond inside another one, moved."""
    shape = lambda dx: F.transform("ring", lambda p: F.struct((p["x"] + dx).alias("x"), p["y"].alias("y")))
    parts = geometry_queries.polygons(spark, sf_dir).withColumn("mcnorm", F.concat(F.lit("s"), F.col("site").cast("string")))
    return audits.coverage(parts.withColumn("ring", shape(F.col("r"))), parts)


def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rules of the catalogue's areas against the precincts that each should have."""
    areas = catalogue.expected(spark).select("mcnorm", "expected")
    wanted = areas.groupBy("mcnorm").agg(F.max("expected").alias("expected"))
    names = ["barca", "krasna", "saca", "myslava", "cunovo", "raca"]
    rules = table(spark, sf_dir, "part").select(F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % 6 + 1).cast("int")).alias("mcnorm"), (F.col("p_size") % 4 + 1).alias("okrsok"))
    return catalogue.count_check(rules, wanted.where(F.col("mcnorm").isin([*names, "lamac"])))


QUERIES = {f.__name__: f for f in (row_counts, class_counts, last_written, merged_parts, streets_of_register, row_spacing, centred_blocks, per_address_rules, coverage, expected_counts)}

_EXPORT = duck(EXPORT.replace("o_orderpriority)", "substring(o_orderpriority, 3, 20))"), "orders")
ORACLES = {
    "row_counts": "SELECT 'customer' AS what, count(*) AS n, count(DISTINCT c_nationkey) AS keys FROM customer UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'supplier', count(*), count(DISTINCT s_nationkey) FROM supplier",
    "class_counts": """SELECT concat('mc', n_nationkey) AS mcnorm, cls, n, round(100.0::double * n / 12, 1) AS share FROM nation, (VALUES ('RANGE', 5::bigint), ('ENUM', 3), ('WHOLE', 3), ('INSTITUTION', 1)) t(cls, n)""",
    "last_written": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    "merged_parts": "SELECT p_brand AS mcnorm, p_size AS okrsok, min(p_partkey) AS idx, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1",
    "streets_of_register": f"SELECT DISTINCT mcnorm, regexp_replace(replace(replace(lower(strip_accents(street)), 'ul. ', ''), '.', ''), ' ulica$', '') AS key FROM ({duck(ADDRESSES, 'customer')})",
    "row_spacing": """WITH g AS (SELECT user_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) - event_id AS gap FROM events)
      SELECT user_id, list_sort(list(gap))[count(*) // 2 + 1] AS median FROM g WHERE gap IS NOT NULL GROUP BY user_id""",
    "centred_blocks": """WITH o AS (SELECT o_custkey AS doc, cast(o_orderkey AS double) AS y, cast(o_orderkey % 1000 AS int) AS num, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
      s AS (SELECT *, 2 * sum(CASE WHEN k % 2 = 1 THEN y ELSE -y END) OVER (PARTITION BY doc ORDER BY k) AS alternate FROM o)
      SELECT doc, num, CASE WHEN k % 2 = 1 THEN -(alternate - 2 * y) ELSE alternate + 2 * y END + 0.0::double AS top, CASE WHEN k % 2 = 1 THEN alternate ELSE -alternate END + 0.0::double AS bottom FROM s""",
    "per_address_rules": f"""WITH r AS (SELECT DISTINCT * FROM ({_EXPORT}) WHERE okrsok > 0), k AS (SELECT mcnorm, street, count(DISTINCT okrsok) AS n FROM r GROUP BY ALL)
      SELECT r.mcnorm, okrsok, lower(r.street) AS street_norm, CASE WHEN n > 1 THEN 'ENUM' ELSE 'WHOLE' END AS cls, CASE WHEN n > 1 THEN string_agg(number, ',' ORDER BY cast(number AS int)) END AS singles
      FROM r JOIN k ON k.mcnorm = r.mcnorm AND k.street = r.street GROUP BY r.mcnorm, okrsok, r.street, n""",
    "coverage": f"""SELECT concat('s', site) AS mcnorm, 1::bigint AS n, round(2 * r * r / 10000, 4) AS area, round(r * r / 2 / 10000, 4) AS covered, round(3 * r * r / 2 / 10000, 4) AS gap, round(3 * r * r / 2 / 10000, 4) AS spill
      FROM ({duck(geometry_queries.SITES, 'supplier')})""",
    "expected_counts": """WITH e(mcnorm, expected, k) AS (VALUES ('barca', 3, 0), ('krasna', 4, 1), ('saca', 3, 2), ('myslava', 2, 3), ('cunovo', 2, 4), ('raca', 0, 5), ('lamac', 6, NULL)),
      c AS (SELECT mcnorm, any_value(expected) AS expected, count(p_partkey) AS rules, count(DISTINCT p_size % 4) AS okrsky FROM e LEFT JOIN part ON p_partkey % 6 = k GROUP BY mcnorm)
      SELECT mcnorm, rules, okrsky, cast(expected AS bigint) AS expected, CASE WHEN rules = 0 THEN 'missing' WHEN expected = 0 THEN 'unknown' WHEN okrsky < expected THEN 'short' WHEN okrsky > expected THEN 'over' ELSE 'ok' END AS flag FROM c
      UNION ALL SELECT 'total', sum(rules)::bigint, sum(okrsky)::bigint, sum(expected)::bigint, 'total' FROM c""",
}
