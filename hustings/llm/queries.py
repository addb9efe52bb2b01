"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hustings.llm import bpe, exact_dedup, fill_in_middle, license_scan, minhash_dedup, mixing, pii, quality_rules, resampling, suffix_dedup, token_counts, toxicity, url_filters

#: (host, path, verdict) of the registered URL rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.filter_urls(_table(spark, sf_dir, "pages"), rules)


OP1 = r"""
WITH rules(rhost, rpath, rverdict) AS (VALUES ('net','/','block'),('example.net','/en/','allow'),('example.com','/de/','block'),('org','/fr/','allow')),
cut AS (SELECT page_id, CASE WHEN strpos(coalesce(url,''),'://') > 0 THEN substr(url, strpos(url,'://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest,'^[^/?#]*'),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest,'(?s)^[^/?#]*([^?#]*)',1) AS path, row_number() OVER () AS row_no FROM cut),
fits AS (SELECT row_no, rhost || rpath AS rule, rverdict,
  row_number() OVER (PARTITION BY row_no ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS place
  FROM parts JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row_no)
"""


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents")).drop("domain_rates")


OP3 = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (SELECT rn, i, count(*) OVER (PARTITION BY rn, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS n FROM (SELECT rn, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM d)),
repeated AS (SELECT rn, count(DISTINCT i + k) AS n FROM windows, range(5) t(k) WHERE n > 1 GROUP BY rn),
m AS (SELECT doc_id, source, cast(len(w) AS bigint) AS n_words, cast(length(array_to_string(w, '')) AS bigint) AS word_chars, cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
  cast(len(l) - len(list_distinct(l)) AS bigint) AS n_dup_lines, len(l) AS n_lines, coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN repeated r USING (rn)),
f AS (SELECT *, [n_words < 10, 100 * n_repeat_words > 20 * n_words, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines, word_chars > 15 * n_words] AS fails FROM m),
dom AS (SELECT source, i, count(*) AS n, count(*) FILTER (WHERE fails[i]) AS k FROM f, range(1, 6) r(i) GROUP BY source, i),
prior AS (SELECT i, sum(k) / sum(n) AS mean, coalesce(var_samp(k / n), 0) AS spread, avg(1 / n) AS per, sum(n) AS total FROM dom GROUP BY i),
s AS (SELECT i, mean, CASE WHEN spread - mean * (1 - mean) * per > 0 THEN least(greatest(mean * (1 - mean) / (spread - mean * (1 - mean) * per) - 1, 1), total) ELSE total END AS strength FROM prior),
bad AS (SELECT source, coalesce(list(i) FILTER (WHERE (k + mean * strength) / (n + strength) > 1.5 * mean), []) AS rules FROM dom JOIN s USING (i) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fails[1] OR fails[2] AS base_failed,
  NOT (fails[1] OR fails[2]) AND NOT (fails[3] AND list_has_any(rules, [1, 2, 3]) OR fails[4] AND list_has_any(rules, [1, 2, 4]) OR fails[5] AND list_has_any(rules, [1, 2, 5])) AS kept
FROM f JOIN bad ON bad.source IS NOT DISTINCT FROM f.source
"""


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_id", "n_links")


OP4 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rn, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT rn, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM d),
m AS (SELECT rn, doc_id, count(s) AS n, list_sort(list(s) FILTER (s IS NOT NULL)) AS full_set FROM d LEFT JOIN sh USING (rn) GROUP BY rn, doc_id),
n AS (SELECT rn, doc_id, n, CASE WHEN n = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY full_set) END AS class_id FROM m),
both_have AS (SELECT a.rn AS x, b.rn AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.rn < b.rn GROUP BY ALL),
link AS (SELECT a.doc_id AS u, b.doc_id AS v, a.class_id AS cu, b.class_id AS cv FROM both_have JOIN n a ON a.rn = x JOIN n b ON b.rn = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
edge AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
reach AS (SELECT DISTINCT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.v FROM reach r JOIN edge e ON e.u = r.seen),
least_seen AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
degree AS (SELECT c, count(DISTINCT o) AS n_links FROM (SELECT cu AS c, cv AS o FROM link UNION ALL SELECT cv, cu FROM link) WHERE c <> o GROUP BY c)
SELECT n.doc_id, n.n AS n_shingles, component_id, n.doc_id = component_id AS kept, class_id, coalesce(n_links, 0) AS n_links
FROM n JOIN least_seen ON node = n.doc_id LEFT JOIN degree ON c = class_id
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.find_pii(_table(spark, sf_dir, "documents"), pii.train()))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


OP7 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def tokenizer(path: str | None = None) -> bpe.ByteBPE:
    """The byte-level vocabulary at path, by default that of the installed public tokenizers."""
    import public_tokenizers

    return bpe.load(path or public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_table(spark, sf_dir, "documents"), tokenizer())


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), token_counts.load(public_tokenizers.path("word_bpe_49k.json")))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP12 = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS remainder FROM (SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c FROM range(256) r(i))),
d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT rn, unnest(w) AS word FROM d), bw AS (SELECT unnest(w) AS word FROM b),
spelled AS (SELECT word, hex(word) AS x FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
v AS (SELECT word, xor(list_reduce(list_transform(range(1, length(x) + 1, 2), lambda k: cast('0x' || substr(x, k, 2) AS bigint)), lambda a, c: xor(a >> 8, remainder[(xor(a, c) & 255) + 1]), 4294967295), 4294967295) % 10000 AS k FROM spelled, tab),
s AS (SELECT k, count(*) AS n FROM dw JOIN v USING (word) GROUP BY k), t AS (SELECT k, count(*) AS n FROM bw JOIN v USING (word) GROUP BY k),
g AS (SELECT k, cast(floor(1000 * ln(cast(coalesce(t.n, 0) + 1 AS double) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000) / (cast(coalesce(s.n, 0) + 1 AS double) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)))) AS bigint) AS gain
  FROM (SELECT DISTINCT k FROM v) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
f AS (SELECT rn, count(*) AS n, cast(floor(cast(sum(gain) AS double) / count(*)) AS bigint) AS weight FROM dw JOIN v USING (word) JOIN g USING (k) GROUP BY rn),
m AS (SELECT rn, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS bigint) AS h FROM d LEFT JOIN f USING (rn)),
p AS (SELECT *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) AS bigint) AS score FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE n_features >= 20) OVER () AS many FROM p)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * many // 100 THEN place END AS rank FROM r
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(_table(spark, sf_dir, "documents"))


OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || doc_id) AS x FROM documents),
h AS (SELECT *, cast(len(u) AS bigint) AS n, [cast('0x' || substr(x, 8 * k + 1, 8) AS bigint) for k in range(4)] AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN cast(length(pre) AS bigint) END AS prefix_chars, CASE WHEN form <> 'plain' THEN cast(length(mid) AS bigint) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""


_QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_url_filters, op2_license_scan, op3_quality_rules, op4_minhash_dedup, op5_mixing, op6_pii, op7_exact_dedup, op8_suffix_dedup, op9_bpe, op10_toxicity,
    op11_token_counts, op12_resampling, op13_fill_in_middle,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1, "op3_quality_rules": OP3, "op4_minhash_dedup": OP4, "op7_exact_dedup": OP7, "op12_resampling": OP12, "op13_fill_in_middle": OP13}
