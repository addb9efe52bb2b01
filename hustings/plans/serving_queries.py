"""Queries of serving and of changes: sources, overrides, results, colours, tiles, snapshots and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.operators import changes, serving
from hustings.plans.adapters import ADDRESSES, MATCHED, addresses, duck, sql, table
from hustings.plans.matching_queries import matched

PRECINCTS = """
SELECT s_suppkey AS okrsok, CASE WHEN s_suppkey % 4 = 0 THEN 'Bratislava' WHEN s_suppkey % 4 = 1 THEN 'Prešov' ELSE 'Košice' END AS mesto,
  CASE WHEN s_suppkey % 4 = 1 THEN 'Prešov' ELSE concat('Časť ', cast(s_nationkey AS varchar(3))) END AS mc, s_nationkey AS nation FROM {supplier}
"""
TURNOUT = """
SELECT concat('SK', cast(s_nationkey AS varchar(3))) AS obec_code, concat('Časť ', cast(s_nationkey AS varchar(3))) AS obec_name, l_suppkey AS okrsok, cast(count(*) AS varchar(20)) AS zapisani,
  cast(count(DISTINCT l_orderkey) AS varchar(20)) AS zucastneni, CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE cast(cast(count(*) AS bigint) % 1000 / 8e0 AS varchar(20)) END AS ucast_pct
FROM {lineitem}, {supplier} WHERE l_suppkey = s_suppkey AND s_nationkey % 6 <> 0 GROUP BY s_nationkey, l_suppkey
"""
ANSWERS = """
SELECT concat('SK', cast(s_nationkey AS varchar(3))) AS obec_code, l_suppkey AS okrsok, CASE l_returnflag WHEN 'A' THEN '1' WHEN 'R' THEN '2' ELSE '3' END AS otazka, cast(sum(CASE WHEN l_linenumber <= 3 THEN 1 ELSE 0 END) AS varchar(20)) AS ano,
  CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE cast(sum(CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END) AS varchar(20)) END AS nie, cast(cast(count(*) AS bigint) % 800 / 8e0 AS varchar(20)) AS ano_pct
FROM {lineitem}, {supplier} WHERE l_suppkey = s_suppkey GROUP BY s_nationkey, l_suppkey, l_returnflag
"""


def _served(spark: SparkSession, sf_dir: str) -> DataFrame:
    precincts = sql(spark, sf_dir, PRECINCTS, "supplier")
    keyed = precincts.withColumn("refkey", serving.result_key(F.col("mesto"), F.col("mc"), ["Bratislava", "Košice"]))
    return serving.serve(serving.with_results(keyed, sql(spark, sf_dir, TURNOUT, "lineitem", "supplier"), sql(spark, sf_dir, ANSWERS, "lineitem", "supplier")))


def results_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(spark, sf_dir).select("okrsok", "mesto", "mc", "key", "color", "turnout", "zap", "zuc", "q1a", "q1n", "q1ano", "q2a", "q2n", "q2ano")


def results_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(spark, sf_dir).groupBy("mesto", "mc").agg(F.sum("q1a").alias("q1_yes"), F.sum("q2a").alias("q2_yes"), F.sum("q1n").alias("q1_no"))


def vintage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(spark, sf_dir).groupBy("mesto").agg(F.count("*").alias("precincts"), F.count("zap").alias("with_results"))


def color_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", serving.ramp(F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderkey") % 321 / F.lit(8.0)), serving.TURNOUT_STOPS).alias("color"))


def labels_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(spark, sf_dir).select("okrsok", serving.label("turnout").alias("turnout_label"), serving.label("distinct").alias("plain_label"))


OVERRIDES = "SELECT cast(c_custkey AS varchar(20)) AS ra_id, CASE c_custkey % 3 WHEN 0 THEN 'exclude' WHEN 1 THEN 'move' END AS action, cast(c_custkey AS double) AS x, cast(7 AS double) AS y FROM {customer} WHERE c_custkey % 20 = 1"


def override_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.apply_overrides(addresses(spark, sf_dir), sql(spark, sf_dir, OVERRIDES, "customer")).select("ra_id", "x", "y")


def exclude_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return override_left_join(spark, sf_dir).groupBy(F.floor(F.col("x") / 1000).alias("band")).agg(F.count("*").alias("n"))


MANUAL = "SELECT s_suppkey, concat('manual ', s_name) AS shape FROM {supplier} WHERE s_suppkey % 6 = 0"


def manual_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("shape"))
    return serving.prefer_manual(derived, sql(spark, sf_dir, MANUAL, "supplier"), ["s_suppkey"], "shape")


def union_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cities' seeds, one without part names."""
    seeds = addresses(spark, sf_dir)
    united = serving.union_sources({"kosice": seeds.where("cast(ra_id as int) % 2 = 0").select("ra_id", "mcnorm"), "nitra": seeds.where("cast(ra_id as int) % 2 = 1").select("ra_id")})
    return united.groupBy("mesto", "mcnorm").agg(F.count("*").alias("n"))


TILED = "SELECT c_custkey, 16 + cast(c_custkey * 7919 % 7000 AS double) / 1000 AS lon, 47.5 + cast(c_custkey * 104729 % 2000 AS double) / 1000 AS lat FROM {customer}"


def tile_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = sql(spark, sf_dir, TILED, "customer").selectExpr("c_custkey", "cast(lon as double) lon", "cast(lat as double) lat")
    return serving.tiles(points, (6, 14)).groupBy("z", "tx", "ty").agg(F.count("*").alias("n"))


BEFORE = "SELECT o_orderkey, cast(o_custkey % 7 AS int) AS okrsok FROM {orders} WHERE o_orderkey % 3 <> 0"
NOW = "SELECT o_orderkey, cast((o_custkey + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) % 7 AS int) AS okrsok FROM {orders} WHERE o_orderkey % 4 <> 0"


def diff_new_moved_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.snapshot_diff(sql(spark, sf_dir, BEFORE, "orders"), sql(spark, sf_dir, NOW, "orders"), "o_orderkey", "okrsok")


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.upsert(sql(spark, sf_dir, BEFORE, "orders"), sql(spark, sf_dir, NOW, "orders"), ["o_orderkey"])


def restore_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = sql(spark, sf_dir, "SELECT concat(cast(c_custkey AS varchar(20)), ';', cast(c_custkey + 1 AS varchar(20))) AS ra_id FROM {customer} WHERE c_custkey % 5 = 0", "customer")
    return changes.restore_missing(addresses(spark, sf_dir).select("ra_id", "mcnorm"), file)


FILE = """
SELECT cast(c_custkey AS varchar(20)) AS ra_id, CASE c_custkey % 3 WHEN 0 THEN 'unmatched' ELSE 'seed' END AS kind, concat('mc', cast(c_nationkey AS varchar(4))) AS mcnorm,
  CASE c_custkey % 3 WHEN 0 THEN NULL ELSE cast(c_custkey % 4 + 1 AS int) END AS okrsok, CASE c_custkey % 3 WHEN 0 THEN 'no-number' END AS reason FROM {customer}
"""


def apply_file_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A working file brought up to the matcher's outcome."""
    now = matched(spark, sf_dir)
    seeds, rest = now.where("status = 'ok'").select("ra_id", "mcnorm", "okrsok"), now.where("status <> 'ok'").select("ra_id", F.col("status").alias("reason"))
    done = changes.apply_changes(sql(spark, sf_dir, FILE, "customer"), seeds, rest)
    return done.select("ra_id", "kind", F.col("okrsok").cast("int").alias("okrsok"), "reason", "change")


#: orders as features of a file edited by hand: merged tags, several identifiers, two features of one identifier; and the seeds of two dates.
EDITED = """
SELECT cast(o_orderkey AS varchar(20)) || CASE WHEN o_orderkey % 13 = 0 THEN ';1' ELSE '' END AS ra_id, CASE WHEN o_orderkey % 7 = 0 THEN 'unmatched' WHEN o_orderkey % 17 = 0 THEN 'precinct' ELSE 'seed' END AS kind,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('mc', cast(o_custkey % 5 AS varchar(3))) END AS mcnorm, concat(cast(o_custkey % 6 AS varchar(3)), CASE WHEN o_orderkey % 9 = 0 THEN ';4' ELSE '' END) AS okrsok, part AS feature_no
FROM {orders}, (VALUES (0), (1)) t(part) WHERE part = 0 OR o_orderkey % 19 = 0
"""
SEEDS = "SELECT cast(o_orderkey AS varchar(20)) AS ra_id, concat('mc', cast((o_custkey + cast(o_orderkey % 23 = 0 AS int)) % 5 AS varchar(3))) AS mcnorm, cast((o_custkey + cast(o_orderkey % 10 = 0 AS int)) % 6 AS int) AS okrsok FROM {orders} WHERE o_orderstatus <> 'P'"
EARLIER = "SELECT cast(o_orderkey AS varchar(20)) AS ra_id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('mc', cast(o_custkey % 5 AS varchar(3))) END AS mcnorm, cast(o_custkey % 6 AS int) AS okrsok FROM {orders} WHERE o_orderkey % 3 > 0"
FAILED = "SELECT cast(o_orderkey AS varchar(20)) AS ra_id, concat('no-', lower(o_orderstatus)) AS reason FROM {orders} WHERE o_orderkey % 3 = 0"


def diff_against_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.diff_against_file(sql(spark, sf_dir, EDITED, "orders"), sql(spark, sf_dir, SEEDS, "orders"), "feature_no")


def lost_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.lost_of_file(sql(spark, sf_dir, EDITED, "orders"), sql(spark, sf_dir, SEEDS, "orders"), "feature_no")


def seed_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.seed_diff(*(sql(spark, sf_dir, text, "orders") for text in (SEEDS, EARLIER, FAILED)))


def string_agg_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.expr("listagg(s_name, '; ') within group (order by s_name)").alias("names"))


QUERIES = {f.__name__: f for f in (
    results_left_join, results_pivot, vintage_gate, color_ramp, labels_by_mode, override_left_join, exclude_nullsafe, manual_coalesce, union_all_sources, tile_xy,
    diff_new_moved_lost, upsert_merge, restore_anti, apply_file_changes, diff_against_file, lost_of_file, seed_diff, string_agg_report,
)}

_A, _O = duck(ADDRESSES, "customer"), duck(OVERRIDES, "customer")
_MOVED = f"SELECT a.ra_id, CASE WHEN action = 'move' THEN o.x ELSE a.x END AS x, CASE WHEN action = 'move' THEN o.y ELSE a.y END AS y FROM ({_A}) a LEFT JOIN ({_O}) o USING (ra_id) WHERE action IS DISTINCT FROM 'exclude'"
_FILED = f"""f AS (SELECT ra_id, CASE WHEN kind = 'seed' THEN cast(string_split(okrsok, ';')[1] AS int) END AS okr, mcnorm FROM ({duck(EDITED, "orders")})
  WHERE kind <> 'precinct' AND ra_id NOT LIKE '%;%' QUALIFY row_number() OVER (PARTITION BY ra_id ORDER BY feature_no DESC) = 1)"""
_SLUG = "regexp_replace(lower(strip_accents({})), '[^a-z0-9]', '', 'g')"
_N = "try_cast(nullif({}, '') AS {})"
_RESULTS = f"""WITH p AS (SELECT *, CASE WHEN mesto IN ('Bratislava', 'Košice') THEN {_SLUG.format("mc")} END AS refkey FROM ({duck(PRECINCTS, "supplier")})), t AS ({duck(TURNOUT, "lineitem", "supplier")}), w AS ({duck(ANSWERS, "lineitem", "supplier")}),
  o AS (SELECT DISTINCT obec_code, {_SLUG.format("obec_name")} AS refkey FROM t),
  served AS (SELECT p.okrsok, mesto, mc, regexp_replace(lower(CASE WHEN mesto = mc THEN mc ELSE mesto || mc END), '[^a-z0-9]', '', 'g') AS key, concat('hsl(', cast(round(p.okrsok * 137.508::decimal(9,3))::bigint % 360 AS varchar), ',62%,58%)') AS color,
    {_N.format("ucast_pct", "double")} AS turnout, {_N.format("zapisani", "int")} AS zap, {_N.format("zucastneni", "int")} AS zuc, {", ".join(f"{_N.format(f'a{q}.{c}', k)} AS q{q}{n}" for q in (1, 2) for c, k, n in (("ano", "int", "a"), ("nie", "int", "n"), ("ano_pct", "double", "ano")))}
    FROM p LEFT JOIN o USING (refkey) LEFT JOIN t ON t.obec_code = o.obec_code AND t.okrsok = p.okrsok LEFT JOIN w a1 ON a1.obec_code = o.obec_code AND a1.okrsok = p.okrsok AND a1.otazka = '1' LEFT JOIN w a2 ON a2.obec_code = o.obec_code AND a2.okrsok = p.okrsok AND a2.otazka = '2')"""


def _lerp(stops: list[tuple[float, str]]) -> str:
    cases = [f"WHEN v IS NULL THEN '{serving.NO_DATA}' WHEN v <= {stops[0][0]} THEN '{stops[0][1]}'"]
    for (a, low), (b, high) in zip(stops, stops[1:], strict=False):
        mixed = [f"printf('%02x', cast(round({int(low[k : k + 2], 16)}::double + (v - {a}) / ({b} - {a})::double * ({int(high[k : k + 2], 16)} - {int(low[k : k + 2], 16)})) AS int))" for k in (1, 3, 5)]
        cases.append(f"WHEN v <= {b} THEN '#' || {' || '.join(mixed)}")
    return f"CASE {' '.join(cases)} ELSE '{stops[-1][1]}' END"


_B, _NOW = duck(BEFORE, "orders"), duck(NOW, "orders")
ORACLES = {
    "results_left_join": f"{_RESULTS} SELECT * FROM served",
    "results_pivot": f"{_RESULTS} SELECT mesto, mc, cast(sum(q1a) AS bigint) AS q1_yes, cast(sum(q2a) AS bigint) AS q2_yes, cast(sum(q1n) AS bigint) AS q1_no FROM served GROUP BY mesto, mc",
    "vintage_gate": f"{_RESULTS} SELECT mesto, count(*) AS precincts, count(zap) AS with_results FROM served GROUP BY mesto",
    "color_ramp": f"SELECT o_orderkey, {_lerp(serving.TURNOUT_STOPS)} AS color FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN (o_orderkey % 321)::double / 8 END AS v FROM orders)",
    "labels_by_mode": f"{_RESULTS} SELECT okrsok, CASE WHEN turnout IS NULL THEN concat(mc, ', ', okrsok) ELSE concat(cast(round(turnout) AS int), ' %', chr(10), mc, ', ', okrsok) END AS turnout_label, concat(okrsok, chr(10), mc) AS plain_label FROM served",
    "override_left_join": _MOVED,
    "exclude_nullsafe": f"SELECT cast(floor(x / 1000) AS bigint) AS band, count(*) AS n FROM ({_MOVED}) GROUP BY band",
    "manual_coalesce": "SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 0 THEN 'manual ' || s_name ELSE s_name END AS shape, CASE WHEN s_suppkey % 6 = 0 THEN 'manual' ELSE 'derived' END AS source FROM supplier",
    "union_all_sources": "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'kosice' ELSE 'nitra' END AS mesto, CASE WHEN c_custkey % 2 = 0 THEN 'mc' || c_nationkey ELSE 'nitra' END AS mcnorm, count(*) AS n FROM customer GROUP BY ALL",
    "tile_xy": f"SELECT cast(z AS int) AS z, cast(floor((lon + 180) / 360 * pow(2, z)) AS int) AS tx, cast(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * pow(2, z)) AS int) AS ty, count(*) AS n FROM ({duck(TILED, 'customer')}), range(6, 15) t(z) GROUP BY ALL",
    "diff_new_moved_lost": f"SELECT o_orderkey, b.okrsok AS before, n.okrsok AS now, CASE WHEN b.okrsok IS NULL THEN 'new' WHEN n.okrsok IS NULL THEN 'lost' WHEN b.okrsok = n.okrsok THEN 'unchanged' ELSE 'moved' END AS change FROM ({_B}) b FULL JOIN ({_NOW}) n USING (o_orderkey)",
    "upsert_merge": f"SELECT o_orderkey, coalesce(n.okrsok, b.okrsok) AS okrsok FROM ({_B}) b FULL JOIN ({_NOW}) n USING (o_orderkey)",
    "restore_anti": "SELECT cast(c_custkey AS varchar) AS ra_id, 'mc' || c_nationkey AS mcnorm, 'restored' AS change FROM customer WHERE c_custkey % 5 > 1",
    "apply_file_changes": f"""{MATCHED.rstrip()}, f AS ({duck(FILE, "customer")}) SELECT ra_id, CASE WHEN status = 'ok' THEN 'seed' ELSE 'unmatched' END AS kind, CASE WHEN status = 'ok' THEN m.okrsok::int END AS okrsok,
      CASE WHEN status = 'ok' THEN NULL WHEN kind = 'seed' THEN status ELSE reason END AS reason, CASE WHEN status = 'ok' AND kind = 'seed' AND f.okrsok = m.okrsok THEN 'unchanged' WHEN status = 'ok' AND kind = 'seed' THEN 'moved'
        WHEN status = 'ok' THEN 'new' WHEN kind = 'seed' THEN 'lost' ELSE 'unchanged' END AS change FROM f JOIN matched m USING (ra_id)""",
    "diff_against_file": f"""WITH {_FILED} SELECT s.ra_id, s.mcnorm, s.okrsok, CASE WHEN f.okr IS NULL THEN 'new' ELSE 'moved' END AS change, f.okr AS from_okrsok, CASE WHEN f.okr IS NOT NULL THEN f.mcnorm END AS from_mcnorm
      FROM ({duck(SEEDS, "orders")}) s JOIN f USING (ra_id) WHERE f.okr IS NULL OR f.okr <> s.okrsok OR f.mcnorm IS DISTINCT FROM s.mcnorm""",
    "lost_of_file": f"WITH {_FILED} SELECT ra_id, okr AS okrsok, mcnorm FROM f WHERE okr IS NOT NULL AND ra_id NOT IN (SELECT ra_id FROM ({duck(SEEDS, 'orders')}))",
    "seed_diff": """SELECT ra_id, 'mc' || m AS mcnorm, k AS okrsok, CASE WHEN id % 3 = 0 THEN 'new' ELSE 'moved' END AS change, CASE WHEN id % 3 = 0 THEN 'no-' || lower(o_orderstatus) END AS was,
        CASE WHEN id % 3 > 0 THEN c % 6 END AS from_okrsok, CASE WHEN id % 3 > 0 AND id % 11 > 0 THEN 'mc' || c % 5 END AS from_mcnorm
      FROM (SELECT o_orderkey AS id, o_orderkey::varchar AS ra_id, o_custkey::int AS c, o_orderstatus, (c + CASE WHEN id % 23 = 0 THEN 1 ELSE 0 END) % 5 AS m, (c + CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END) % 6 AS k FROM orders WHERE o_orderstatus <> 'P')
      WHERE id % 3 = 0 OR id % 10 = 0 OR (id % 23 = 0 AND id % 11 > 0)""",
    "string_agg_report": "SELECT s_nationkey, string_agg(s_name, '; ' ORDER BY s_name) AS names FROM supplier GROUP BY s_nationkey",
}
