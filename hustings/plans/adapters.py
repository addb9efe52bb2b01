"""The provided tables seen as register addresses, rules and results.

Each text is plain SQL that Spark and DuckDB read alike; {table} stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: customers as register addresses: three spellings of a street, numbers 1 to 97, some lettered, some missing.
ADDRESSES = """
SELECT cast(c_custkey AS varchar(20)) AS ra_id, concat('mc', cast(c_nationkey AS varchar(4))) AS mcnorm,
  CASE c_custkey % 4 WHEN 0 THEN concat('Ul. ', c_mktsegment) WHEN 1 THEN concat(c_mktsegment, ' ulica')
    WHEN 2 THEN replace(replace(c_mktsegment, 'E', 'É'), 'U', 'Ú') ELSE concat('A. ', c_mktsegment) END AS street,
  CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN concat(cast(c_custkey % 97 + 1 AS varchar(4)), '/a')
    ELSE cast(c_custkey % 97 + 1 AS varchar(4)) END AS orient,
  cast(c_custkey AS varchar(20)) AS supisne,
  cast((c_custkey * 7919) % 10007 AS double) AS x, cast((c_custkey * 104729) % 10009 AS double) AS y
FROM {customer}
"""

#: Entries as a document would print them: (okrsok, entry).
ENTRIES = [
    (1, "Building 1-49 (nepárne)"), (2, "Building 2-48 (párne)"), (3, "Building 50-80"), (4, "Building 81, 82, 83A"),
    (1, "Automobile"), (2, "Automobile 10A, 20A, 30A"), (1, "Furniture 1-60"), (2, "Furniture 40-97"),
    (5, "Household (párne)"), (6, "Dom služieb /Dlhá ul./"), (7, "Námestie 1. mája"), (8, "Súpisné čísla 11, 12"),
]

#: The same rules by hand, for DuckDB: okrsok, key, cls, parity, low, high, range parity, listed numbers; row_idx by entry.
RULES = """
SELECT concat('mc', cast(n_nationkey AS varchar(4))) AS mcnorm, r.*, n_nationkey * 100 + entry AS row_idx FROM nation, (VALUES
  (0, 1, 'building', 'RANGE', 'odd', 1, 49, 'odd', []::varchar[]), (1, 2, 'building', 'RANGE', 'even', 2, 48, 'even', []),
  (2, 3, 'building', 'RANGE', 'both', 50, 80, 'both', []), (3, 4, 'building', 'ENUM', 'both', NULL, NULL, NULL, ['81', '82', '83A']),
  (4, 1, 'automobile', 'WHOLE', 'both', NULL, NULL, NULL, []), (5, 2, 'automobile', 'ENUM', 'both', NULL, NULL, NULL, ['10A', '20A', '30A']),
  (6, 1, 'furniture', 'RANGE', 'both', 1, 60, 'both', []), (7, 2, 'furniture', 'RANGE', 'both', 40, 97, 'both', []),
  (8, 5, 'household', 'WHOLE', 'even', NULL, NULL, NULL, []), (9, 6, 'dom sluzieb', 'INSTITUTION', 'both', NULL, NULL, NULL, []),
  (10, 7, 'namestie 1 maja', 'WHOLE', 'both', NULL, NULL, NULL, [])
) r(entry, okrsok, key, cls, parity, lo, hi, rparity, singles)
"""

#: Match outcomes for DuckDB.
MATCHED = f"""
WITH addr AS ({ADDRESSES.replace("{customer}", "customer")}),
keyed AS (SELECT *, regexp_replace(regexp_replace(lower(strip_accents(street)), '^(ul\\. |a\\. )', ''), ' ulica$', '') AS key,
  upper(replace(orient, '/', '')) AS house, try_cast(regexp_extract(orient, '[0-9]+') AS int) AS num FROM addr),
rules AS ({RULES}),
cand AS (SELECT k.ra_id, r.row_idx, r.okrsok, r.cls, r.singles, k.house, k.orient,
  CASE r.cls WHEN 'INSTITUTION' THEN false WHEN 'WHOLE' THEN r.parity = 'both' OR (num IS NOT NULL AND (num % 2 = 1) = (r.parity = 'odd'))
    ELSE coalesce(num BETWEEN lo AND hi AND (rparity = 'both' OR (num % 2 = 1) = (rparity = 'odd')), false)
      OR (cls = 'ENUM' AND coalesce(list_contains(singles, house) OR list_contains(singles, cast(num AS varchar)), false)) END AS hit,
  coalesce(cls = 'ENUM' AND orient ~ '[a-zA-Z]' AND list_contains(singles, house), false) AS exact
  FROM keyed k JOIN rules r ON r.mcnorm = k.mcnorm AND r.key = k.key),
hits AS (SELECT * FROM cand c WHERE hit AND (exact OR NOT EXISTS (SELECT 1 FROM cand d WHERE d.ra_id = c.ra_id AND d.hit AND d.exact))),
outcome AS (SELECT ra_id, count(DISTINCT okrsok) AS n, min_by(okrsok, row_idx) AS okrsok, min(row_idx) AS row_idx,
  count(DISTINCT okrsok) FILTER (WHERE cls <> 'WHOLE') AS m, min_by(okrsok, row_idx) FILTER (WHERE cls <> 'WHOLE') AS okrsok2, min(row_idx) FILTER (WHERE cls <> 'WHOLE') AS row2
  FROM hits GROUP BY ra_id),
matched AS (SELECT k.*, CASE WHEN c.ra_id IS NULL THEN 'no-street' WHEN o.ra_id IS NULL THEN 'no-number' WHEN n = 1 OR m = 1 THEN 'ok' ELSE 'ambiguous' END AS status,
  CASE WHEN n = 1 THEN o.okrsok WHEN m = 1 THEN okrsok2 END AS okrsok, CASE WHEN n = 1 THEN o.row_idx WHEN m = 1 THEN row2 END AS row_idx
  FROM keyed k LEFT JOIN (SELECT DISTINCT ra_id FROM cand) c USING (ra_id) LEFT JOIN outcome o USING (ra_id))
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    """text over the named tables."""
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


def duck(text: str, *names: str) -> str:
    for n in names:
        text = text.replace(f"{{{n}}}", n)
    return text


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, ADDRESSES, "customer")
