"""Quality rules with verdicts on whole hosts, on DataFrame functions alone.

Each document gets word, symbol, line and repetition counts in one pass over its
text, without a shuffle: repeated 5-word windows are found by sorting the hashes
of a document's windows within its row. The base rules reject single documents.
Host-level rules then look at whole domains: the failures of every rule, base ones
and soft ones, are counted by domain. Each rule has a beta prior of its own, fitted to
the domains' rates by moments: what they differ by beyond the noise of their sizes says
how far a domain may leave the corpus. Where they don't differ beyond noise the prior weighs as
much as all documents, and every domain has the corpus's rate. A domain whose
shrunk rate of a rule is over RATIO times the corpus's is distrusted for that rule: a document there
that fails it goes, and where a base rule is concerned one that fails any soft rule. A
few bad pages can't condemn a small domain, and clean documents stay anywhere.

The counts, not the texts, are aggregated and joined: a domain with a third of
all rows is pre-aggregated before the shuffle, and the join of domain verdicts to
documents is one that Spark broadcasts if the verdicts are small and else splits
when skewed.

Defined cases: a null text is empty and fails; null domains are one domain; an
empty table gives an empty table; repeated rows are judged alike; a text of any length is
read whole, its words and windows held as arrays of its row; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm._spark import stage_table

WINDOW = 5
#: A domain over so many times the corpus's rate of a rule, shrunk, is distrusted.
RATIO = 1.5
#: Rules in order: the first two are the base ones.
RULES = ("short", "repeats", "symbols", "dup_lines", "long_words")
_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words under the windows whose hash is not alone in the array."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = lambda p: F.filter(
        p, lambda x, k: F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))
    )
    starts = F.sort_array(F.transform(_let(placed, again), lambda x: x["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + (i + WINDOW) - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")),
        lambda a: a["n"].cast("long"),
    )


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that the array holds twice or more."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    windows = lambda c: F.transform(
        F.slice(c, 1, F.greatest(F.size(c) - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *(F.get(c, i + k) for k in range(1, WINDOW))),
    )
    alone = lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_covered(g))
    return _let(_let(hashed, windows), alone)


def text_metrics(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with its base counts; the text is dropped."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_word = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
    )
    by_line = lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")
    )
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    counted = docs.withColumns({"__w": _let(words, by_word), "__l": _let(lines, by_line), "n_symbols": symbols.cast("long")})
    return counted.drop(text_col).select("*", "__w.*", "__l.*").drop("__w", "__l")


def _strength(mean: float, spread: float, per: float, total: int) -> float:
    """How many documents a rule's prior weighs: by moments, at least 1 and at most all."""
    noise = mean * (1 - mean)
    between = spread - noise * per
    return min(max(noise / between - 1, 1.0), float(total)) if between > 0 else float(total)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "source", ratio: float = RATIO) -> DataFrame:
    """A row per document: identifier, base counts, base_failed, domain_rates (shrunk, by rule) and kept."""
    slim = docs.select(F.col(id_col).alias("__id"), F.col(domain_col).alias("__domain"), F.col(text_col).alias("__raw"))
    n_words = F.col("n_words")
    fails = [
        n_words < 10, 100 * F.col("n_repeat_words") > 20 * n_words, 10 * F.col("n_symbols") > n_words, 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"), F.col("word_chars") > 15 * n_words,
    ]
    counts = stage_table(text_metrics(slim, "__raw").withColumn("__fails", F.array(*fails)))

    failing = [F.sum(F.col("__fails")[i].cast("long")).alias(rule) for i, rule in enumerate(RULES)]
    domains = stage_table(counts.groupBy("__domain").agg(F.count("*").alias("n"), *failing))
    # beta priors by moments over the domains' rates
    rate = lambda rule: F.col(rule) / F.col("n")
    moments = [m for rule in RULES for m in ((F.sum(rule) / F.sum("n")).alias(f"{rule}_mean"), F.var_samp(rate(rule)).alias(f"{rule}_spread"))]
    prior = domains.agg(F.sum("n").alias("total"), F.avg(1 / F.col("n")).alias("per"), *moments).first()
    shrunk, distrusted = [], []
    for rule in RULES:
        mean = prior[f"{rule}_mean"] or 0.0
        strength = _strength(mean, prior[f"{rule}_spread"] or 0.0, prior["per"] or 0.0, prior["total"] or 1)
        shrunk.append((F.col(rule) + mean * strength) / (F.col("n") + strength))
        distrusted.append(shrunk[-1] > ratio * mean)
    verdicts = domains.select(F.col("__domain").alias("__of"), F.struct(*(v.alias(r) for v, r in zip(shrunk, RULES, strict=True))).alias("domain_rates"), F.array(*distrusted).alias("__bad"))
    joined = counts.join(verdicts, F.col("__domain").eqNullSafe(F.col("__of")))
    failed, bad = (lambda i: F.col("__fails")[i]), (lambda i: F.col("__bad")[i])
    base_failed = failed(0) | failed(1)
    goes = reduce(lambda a, b: a | b, (failed(i) & (bad(0) | bad(1) | bad(i)) for i in range(2, len(RULES))))
    return joined.select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), "domain_rates", (~base_failed & ~goes).alias("kept"),
    )
