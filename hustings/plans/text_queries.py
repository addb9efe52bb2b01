"""Queries of the text functions and parsers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.functions import specs, text
from hustings.operators import repair
from hustings.plans.adapters import ADDRESSES, MATCHED, RULES, addresses, duck, sql, table
from hustings.plans.matching_queries import keyed
from hustings.sources import readers


def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.norm(F.col("text")).alias("normed"))


def street_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).select("ra_id", text.street_key(text.norm(F.col("street"))).alias("key"))


def slug_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).select("ra_id", text.slug(F.concat("mcnorm", F.lit(" "), "street")).alias("slug"))


def house_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).select("ra_id", text.house_norm(F.col("orient")).alias("house"), text.num_part(F.col("orient")).alias("num"))


def golden_angle_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.golden_color(F.col("s_suppkey").cast("string")).alias("color"))


def label_point_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).select("ra_id", text.point_label(F.col("street"), F.col("orient"), F.col("supisne")).alias("name"))


def percent_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", text.percent_label(F.when(F.col("o_orderkey") % 7 != 0, F.floor("o_totalprice").cast("int") % 1000 / 8)).alias("label"))


LISTS = """
SELECT c_custkey, concat(c_mktsegment, ' ', cast(c_custkey % 9 + 1 AS varchar(2)), '-', cast(c_custkey % 9 + 5 AS varchar(3)), ', ', cast(c_custkey % 31 AS varchar(3)), ', Main street, ',
  CASE WHEN c_custkey % 2 = 0 THEN 'nepárne, ' ELSE '' END, 'Old mill.') AS list FROM {customer}
"""


def split_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = sql(spark, sf_dir, LISTS, "customer")
    return lists.select("c_custkey", F.posexplode(specs.split_entries(F.col("list"))).alias("entry_no", "entry"))


PRINTED = """
SELECT c_custkey, concat(c_mktsegment, ' ', cast(c_custkey % 50 + 1 AS varchar(3)), ' – ', cast(c_custkey % 50 + 9 AS varchar(3)), ', ', cast(c_custkey % 31 + 1 AS varchar(3)),
  CASE c_custkey % 3 WHEN 0 THEN ' (párne)' WHEN 1 THEN ' (nepárne)' ELSE '' END) AS entry FROM {customer}
"""


def parse_spec_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = sql(spark, sf_dir, PRINTED, "customer").withColumn("p", specs.parse_street_spec(F.col("entry")))
    first = F.get("p.spec.ranges", F.lit(0))
    return parsed.select("c_custkey", "p.street", F.col("p.street_norm").alias("street_norm"), "p.cls", "p.parity", first["lo"].alias("lo"), first["hi"].alias("hi"), first["parity"].alias("range_parity"), F.array_join("p.spec.singles", ",").alias("singles"))


def hash_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text.hash_params(F.concat(F.lit("#"), F.regexp_extract("url", r"\?(.*)$", 1)))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(found).alias("name", "value"))


def tag_map_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.map_filter(F.from_json("props", "map<string,string>"), lambda _, v: v.isNotNull() & (v != ""))
    return table(spark, sf_dir, "events").select("event_id", F.explode(tags).alias("tag", "value"))


def html_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages' lists with their places, by nested extraction."""
    found = F.regexp_extract_all("html", F.lit(r"(?s)<li><a href=[^>]*>(.*?)</a></li>"), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(found).alias("pos", "item")).select("page_id", "pos", readers.plain_text(F.col("item")).alias("item"))


def rule_for_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = addresses(spark, sf_dir).withColumns({"okrsok": (F.col("ra_id").cast("long") % 4 + 1).cast("int"), "assigned": F.when(F.col("ra_id").cast("long") % 50 == 0, "manual")})
    return repair.rule_for(points, keyed(spark, sf_dir)).select("ra_id", "rule")


NAMES = "SELECT DISTINCT p_name AS street FROM {part}"
DIRTY = """
SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN concat(substring(p_name, 1, cast(p_partkey % 7 + 1 AS int)), substring(p_name, cast(p_partkey % 7 + 3 AS int), 40))
  ELSE concat(substring(p_name, 1, 3), 'xy', substring(p_name, 4, 40)) END AS street FROM {part}
"""


def _streets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return sql(spark, sf_dir, DIRTY, "part"), sql(spark, sf_dir, NAMES, "part")


def levenshtein_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.register_fixes(*_streets(spark, sf_dir))


GLUED = """
SELECT c_custkey AS row_idx, concat('mc', cast(c_custkey % 2 AS varchar(2))) AS mcnorm, cast(c_custkey % 11 AS int) AS okrsok,
  CASE c_custkey % 4 WHEN 0 THEN concat('Household ', c_mktsegment) WHEN 1 THEN concat('Stray ', c_mktsegment) WHEN 2 THEN c_mktsegment ELSE concat('Long lane ', c_mktsegment) END AS street FROM {customer}
"""
KNOWN = "SELECT * FROM (VALUES ('mc0', 'Household'), ('mc0', 'Automobile'), ('mc0', 'Building'), ('mc0', 'Lane building'), ('mc1', 'Machinery'), ('mc1', 'Household'), ('mc1', 'Stray'), ('mc1', 'Long')) t(mcnorm, street)"


def glued_street_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.split_lost_commas(sql(spark, sf_dir, GLUED, "customer"), spark.sql(KNOWN)).select("row_idx", "mcnorm", "okrsok", F.lower("street").alias("street"), "part")


QUERIES = {f.__name__: f for f in (
    norm_text, street_key, slug_key, house_norm, golden_angle_color, label_point_text, percent_label, split_entries, parse_spec_ranges, hash_params, tag_map_filter, html_list_scan,
    rule_for_address, levenshtein_fix, glued_street_split,
)}

_NORM = r"trim(regexp_replace(regexp_replace(lower(strip_accents({})), '[''’`´]', '', 'g'), '[\s\x{{a0}}]+', ' ', 'g'))"
_ADDR = duck(ADDRESSES, "customer")
ORACLES = {
    "norm_text": f"SELECT doc_id, {_NORM.format('text')} AS normed FROM documents",
    "street_key": f"SELECT ra_id, regexp_replace(replace(replace(lower(strip_accents(street)), 'ul. ', ''), '.', ''), ' ulica$', '') AS key FROM ({_ADDR})",
    "slug_key": f"SELECT ra_id, regexp_replace(lower(strip_accents(concat(mcnorm, ' ', street))), '[^a-z0-9]', '', 'g') AS slug FROM ({_ADDR})",
    "house_norm": f"SELECT ra_id, upper(replace(orient, '/', '')) AS house, try_cast(regexp_extract(orient, '[0-9]+') AS int) AS num FROM ({_ADDR})",
    "golden_angle_color": "SELECT s_suppkey, concat('hsl(', cast(round(s_suppkey * 137.508::decimal(9,3))::bigint % 360 AS varchar), ',62%,58%)') AS color FROM supplier",
    "label_point_text": f"SELECT ra_id, trim(concat(coalesce(street, ''), ' ', coalesce(orient, 's.č. ' || supisne, ''))) AS name FROM ({_ADDR})",
    "percent_label": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '?' ELSE format('{:.1f} %', cast(v // 8 AS double) + cast(v % 8 AS double) / 8 + 1e-9) END AS label FROM (SELECT o_orderkey, floor(o_totalprice)::int % 1000 AS v FROM orders)",
    "split_entries": rf"""SELECT c_custkey, cast(k - 1 AS int) AS entry_no, CASE k WHEN 1 THEN a WHEN 2 THEN b ELSE 'Old mill' END AS entry FROM (
      SELECT c_custkey, regexp_extract(list, '^(.*?), Main', 1) AS a, CASE WHEN c_custkey % 2 = 0 THEN 'Main street, nepárne' ELSE 'Main street' END AS b FROM ({duck(LISTS, "customer")})), range(1, 4) t(k)""",
    "parse_spec_ranges": """SELECT c_custkey, c_mktsegment AS street, lower(c_mktsegment) AS street_norm, 'ENUM' AS cls, CASE c_custkey % 3 WHEN 0 THEN 'even' WHEN 1 THEN 'odd' ELSE 'both' END AS parity,
      cast(c_custkey % 50 + 1 AS int) AS lo, cast(c_custkey % 50 + 9 AS int) AS hi,
      CASE WHEN c_custkey % 3 = 2 OR ((c_custkey % 50 + 1) % 2 = 1) = (c_custkey % 3 = 0) THEN 'both' WHEN c_custkey % 3 = 0 THEN 'even' ELSE 'odd' END AS range_parity,
      cast(c_custkey % 31 + 1 AS varchar) AS singles FROM customer""",
    "hash_params": r"""SELECT page_id, split_part(p, '=', 1) AS name, regexp_replace(p, '^[^=]*=', '') AS value FROM (
      SELECT page_id, unnest(string_split(regexp_extract(url, '\?(.*)$', 1), '&')) AS p FROM pages) WHERE p LIKE '_%=_%'""",
    "tag_map_filter": "SELECT event_id, key AS tag, json_extract_string(props, key) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events) WHERE coalesce(json_extract_string(props, key), '') <> ''",
    "html_list_scan": r"""SELECT page_id, cast(k - 1 AS int) AS pos, trim(regexp_replace(regexp_replace(items[k], '<[^>]*>', '', 'g'), '[ \t]+', ' ', 'g')) AS item FROM (
      SELECT page_id, regexp_extract_all(html, '(?s)<li><a href=[^>]*>(.*?)</a></li>', 1) AS items, unnest(range(1, 1 + len(items))) AS k FROM pages)""",
    "rule_for_address": f"""{MATCHED.rstrip()}, p AS (SELECT *, cast(ra_id AS bigint) % 4 + 1 AS okr FROM keyed WHERE street NOT LIKE 'A. %' UNION ALL BY NAME
        SELECT * REPLACE ('a ' || key AS key), cast(ra_id AS bigint) % 4 + 1 AS okr FROM keyed WHERE street LIKE 'A. %'),
      h AS (SELECT p.ra_id, min(CASE WHEN cls = 'ENUM' AND list_contains(singles, coalesce(upper(orient), '')) THEN 1 WHEN cls = 'ENUM' AND num IS NOT NULL AND upper(orient) <> num::varchar AND list_contains(singles, num::varchar) THEN 2
        WHEN num BETWEEN lo AND hi AND (rparity = 'both' OR (num % 2 = 1) = (rparity = 'odd')) THEN 3 WHEN cls = 'WHOLE' THEN 4 ELSE 5 END) AS rank
        FROM p JOIN rules r ON r.mcnorm = p.mcnorm AND r.okrsok = okr AND r.key = p.key GROUP BY p.ra_id)
      SELECT ra_id, CASE WHEN cast(ra_id AS bigint) % 50 = 0 THEN 'manual' WHEN rank <= 4 THEN ['explicit', 'explicit-base', 'range', 'whole'][rank] WHEN orient IS NULL THEN 'supisne' ELSE 'unknown' END AS rule
      FROM p LEFT JOIN h USING (ra_id)""",
    "levenshtein_fix": f"""WITH names AS ({duck(NAMES, "part")}), dirty AS ({duck(DIRTY, "part")}), d AS (SELECT street, lower(street) AS a FROM dirty WHERE lower(street) NOT IN (SELECT lower(street) FROM names)),
      c AS (SELECT street, replace(replace(replace(replace(replace(lower(street), 'rn', '~'), 'm', '~'), 'fll', '^'), 'hl', '^'), ' ', '') AS canon, lower(street) AS a FROM names),
      one AS (SELECT d.street, min(c.street) AS fix FROM d JOIN c ON c.canon = replace(replace(replace(replace(replace(d.a, 'rn', '~'), 'm', '~'), 'fll', '^'), 'hl', '^'), ' ', '') GROUP BY d.street HAVING count(*) = 1),
      e AS (SELECT d.street, c.street AS fix, levenshtein(trim(regexp_replace(d.a, ' +', ' ', 'g')), c.a) AS n, row_number() OVER (PARTITION BY d.street ORDER BY n, c.street) AS k FROM d, c WHERE d.street NOT IN (SELECT street FROM one))
      SELECT * FROM one UNION ALL SELECT x.street, x.fix FROM e x LEFT JOIN e y ON y.street = x.street AND y.k = 2 WHERE x.k = 1 AND x.n <= 1 AND coalesce(y.n >= x.n + 2, true)""",
    "glued_street_split": f"""WITH r AS ({duck(GLUED, "customer")}), known AS (SELECT mcnorm, lower(street) AS s FROM ({KNOWN})),
      cut AS (SELECT row_idx, mcnorm, okrsok, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1:], ' ') AS tail FROM (
        SELECT *, unnest(range(1, len(w))) AS i FROM (SELECT *, string_split(lower(street), ' ') AS w FROM r WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.mcnorm = r.mcnorm AND k.s = lower(r.street))))),
      best AS (SELECT DISTINCT ON (row_idx) c.* FROM cut c JOIN known k ON k.mcnorm = c.mcnorm AND k.s = c.tail ORDER BY row_idx, i),
      lost AS (SELECT DISTINCT ON (b.mcnorm, b.okrsok, head) b.row_idx, b.mcnorm, b.okrsok, head FROM best b JOIN known k ON k.mcnorm = b.mcnorm AND k.s = b.head ORDER BY b.mcnorm, b.okrsok, head, b.row_idx)
      SELECT r.row_idx, r.mcnorm, r.okrsok, coalesce(b.tail, lower(r.street)) AS street, CASE WHEN b.tail IS NULL THEN 'kept' ELSE 'fixed' END AS part FROM r LEFT JOIN best b USING (row_idx)
      UNION ALL SELECT row_idx, mcnorm, okrsok, head, 'recovered' FROM lost""",
}
