"""URL filters by a sort-merge range join, on DataFrame functions alone.

A host is written with its labels reversed and a dot after each ("net.example."),
so that a rule for a host and all its subdomains is a prefix of their keys: the
rules are intervals of the sorted keys, and intervals of prefixes are nested or
apart. A sweep over the sorted union of rule starts and keys holds the stack of
rules that are open. Since intervals nest, the stack at a key is that of the
last rule that starts at or before it, less the rules that the key has left; a
running last value carries it. The same sweep runs a second time within the rule
hosts that a url is under, for the paths.

The sweep runs over distinct keys, dealt by Spark into ranges whose number follows
from their size, and written with the number of their range. What is open at the start
of a range is the stack of the last rule before it, one row per range. Neither urls nor
rules are broadcast, and a host that owns a third of all urls is one key of the first
sweep and is spread by its paths in the second.

A rule fits its host and subdomains if the path starts with the rule's path. The
longest rule (host and path as one string) wins, of equal length the one with
the longer host, of equal rules "block". Without a rule the verdict is default.

Defined cases: a null url or one without "://" has empty host and path and gets
the default; a url listed twice is two rows; rules listed twice count once; no
rules at all gives the default everywhere; an empty table gives an empty table; a url
of any length is cut and compared whole, as a key of the sweep; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hustings.llm._spark import stage_table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host in ASCII lower case, path); both empty for null or without "://"."""
    place = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def host_key(host: Column) -> Column:
    """Reversed labels with a dot after each."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _open_rules(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """key, stack: the rule prefixes of each distinct key that has any, shortest first. One column each, key and prefix, without repeats."""
    # the stack that a rule opens: itself and the rules that are prefixes of it
    opened = (
        rules.select("prefix", F.explode(F.sequence(F.lit(1), F.length("prefix"))).alias("n"))
        .select("prefix", F.expr("left(prefix, n)").alias("outer"))
        .join(rules.select(F.col("prefix").alias("outer")), "outer", "left_semi")
        .groupBy("prefix").agg(F.sort_array(F.collect_set("outer")).alias("stack"))
    )
    events = keys.select("key", F.lit(1).alias("turn"), F.lit(None).cast("array<string>").alias("stack")).unionByName(
        opened.select(F.col("prefix").alias("key"), F.lit(0).alias("turn"), "stack")
    )
    # which range a key is in depends on a sample, so it is written down once
    dealt = stage_table(events.repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    last_of_part = dealt.groupBy("part").agg(F.max_by("stack", F.when(F.col("turn") == 0, F.col("key"))).alias("stack"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    before = last_of_part.select("part", F.last("stack", ignorenulls=True).over(upto).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("turn = 1")
    swept = swept.join(F.broadcast(before), "part", "left")  # a row per range
    stack = F.coalesce("stack", "carried", F.expr("cast(array() as array<string>)"))
    return swept.select("key", F.filter(stack, lambda p: F.startswith(F.col("key"), p)).alias("stack")).where(F.size("stack") > 0)


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """A row per page: its identifier, host, path, rule (host and path of the rule, else null) and verdict.

    rules has the columns host, path and verdict (allow or block).
    """
    host, path = url_parts(F.col(url_col))
    urls = stage_table(pages.select(F.col(id_col), host.alias("host"), path.alias("path")))
    wanted = (
        rules.where("host is not null and path is not null").groupBy(F.translate("host", _UPPER, _LOWER).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict")).withColumn("site", host_key(F.col("host")))
    )

    sites = _open_rules(
        urls.select(host_key(F.col("host")).alias("key")).distinct(), wanted.select(F.col("site").alias("prefix")).distinct()
    ).select(F.col("key").alias("site"), F.col("stack").alias("sites"))
    places = urls.select("host", "path").distinct().withColumn("site", host_key(F.col("host"))).join(sites, "site")
    # "\0" sorts before any path and keeps hosts apart
    places = stage_table(places.select("host", "path", F.explode("sites").alias("site")).withColumn("key", F.concat("site", F.lit("\0"), "path")))
    wanted = wanted.withColumn("prefix", F.concat("site", F.lit("\0"), "path"))
    deepest = _open_rules(places.select("key").distinct(), wanted.select("prefix").distinct()).select(
        "key", F.element_at("stack", -1).alias("prefix")
    )
    fits = wanted.select("prefix", F.concat("host", "path").alias("rule"), F.length("host").alias("__host"), F.col("verdict").alias("__verdict"))
    best = (
        places.join(deepest, "key").join(fits, "prefix").groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule"), "__host", "rule", "__verdict")).alias("__best"))
    )
    return urls.join(best, ["host", "path"], "left").select(
        id_col, "host", "path", F.col("__best.rule").alias("rule"), F.coalesce("__best.__verdict", F.lit(default)).alias("verdict")
    )
