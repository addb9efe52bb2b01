"""The operators on DataFrame functions alone: exact dedup, URL filters, quality rules."""

import hashlib
import re
from collections import Counter, defaultdict

from conftest import DOCS

from hustings.llm import exact_dedup, quality_rules, url_filters


def test_exact_dedup_flags(docs, no_docs):
    groups = defaultdict(list)
    for i, text, *_ in DOCS:
        groups[text or ""].append(i)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    got = [tuple(r) for r in exact_dedup.exact_dedup(docs).collect()]
    assert Counter(got) == Counter(expected)
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    smallest = {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(docs, largest=False).collect()}
    assert smallest[5] == 1


def test_exact_dedup_keep_one(docs, no_docs):
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert exact_dedup.keep_one(no_docs).count() == 0


def brute_url(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("example.net", "/en/x", "block"), ("a.example.net", "/en/", "block"), ("com", "", "block"), ("example.com", "/d", "allow"),
]


def test_url_filters(spark):
    hosts = ["net", "NET", "b.net", "example.net", "a.example.net", "x.a.example.net", "myexample.net", "example.com", "www.example.com", "example.org", "org", "com", "", "a..net", "nets", "net.org"]
    paths = ["", "/", "/en/", "/en", "/en/xy", "/en/x/?q=://", "/de/1#f", "/fr/", "/d", "?a/en/", "#/en/", "/en/ü"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "net/en", "://", "a://b://net/", "ftp://net/\n/x"]
    urls += urls[:5]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(RULES + RULES[:2], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.filter_urls(pages, rules).collect()}
    assert got == {i: brute_url(u, RULES) for i, u in enumerate(urls)}
    assert url_filters.filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filters.filter_urls(pages, rules.limit(0), default="block").collect()} == {"block"}


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules(docs, no_docs):
    got = quality_rules.quality_rules(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter((i, *brute_quality(t)) for i, t, *_ in DOCS)
    assert not any(r.kept for r in got if r.base_failed)
    assert {r.doc_id for r in got if r.kept} >= {1, 5}
    assert quality_rules.quality_rules(no_docs).count() == 0


def test_quality_rules_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules.quality_rules(rows).collect()}
    assert got == {r.doc_id: brute_quality(r.text) for r in rows.collect()}


def test_distrusted_domain(spark):
    """A domain whose documents mostly fail loses its doubtful documents, not its clean ones."""
    clean = " ".join(f"clean{i}" for i in range(40))
    rows = [(i, "too short", "spam") for i in range(90)] + [(i, f"{clean} x{i}", "spam") for i in range(100, 105)]
    rows += [(i, f"{clean} y{i} " + "# " * 8, "spam") for i in range(110, 112)] + [(i, f"{clean} z{i} " + "# " * 8, f"good{i % 4}") for i in range(200, 260)]
    rows += [(i, f"{clean} c{i}", f"good{i % 4}") for i in range(300, 600)]
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] for i in [*range(100, 105), *range(200, 260), *range(300, 600)]) and not got[110] and not got[111]


def test_each_rule_has_its_own_prior(spark):
    """A host that stands out in one rule is distrusted for that one; without differences beyond noise none is."""
    clean, marks = " ".join(f"clean{i}" for i in range(40)), "# " * 8
    lines = "\n".join(["once more"] * 30 + [" ".join(f"u{i}" for i in range(120))])
    rows = [(k, f"{clean} {k} {marks}" if k % 100 < bad else f"{clean} {k}", f"h{k // 100}") for bad, hosts in ((5, range(9)), (80, range(9, 10))) for h in hosts for k in range(100 * h, 100 * h + 100)]
    rows += [(5000 + h, lines, f"h{h}") for h in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in quality_rules.quality_rules(frame).collect()}
    lost = {i for i, r in found.items() if not r.kept and not r.base_failed}
    assert lost == {k for k in range(900, 980)}
    assert found[950].domain_rates.symbols > 0.7 and abs(found[10].domain_rates.symbols - 0.05) < 0.01
    even = spark.createDataFrame([(k, f"{clean} {k} {marks}" if k % 10 == 0 else f"{clean} {k}", f"h{k % 7}") for k in range(700)], "doc_id long, text string, source string")
    again = quality_rules.quality_rules(even).collect()
    assert all(r.kept for r in again) and len({round(r.domain_rates.symbols, 12) for r in again}) <= 7
    assert quality_rules._strength(0.1, 0.0, 0.01, 700) == 700.0


def test_exact_dedup_rounds_merge_sorted_runs(spark):
    """Every round leaves one entry per run and text, a quarter of the runs, and nothing lost; a text of a third of the rows among them."""
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 400}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    digests = exact_dedup._digests(docs, "doc_id", "text")
    for largest in (True, False):
        level, runs = exact_dedup.sorted_runs(digests, largest), exact_dedup.RUNS
        best = max if largest else min
        while True:
            got = level.collect()
            assert len({(r["__run"], r["__digest"]) for r in got}) == len(got)
            assert {r["__run"] for r in got} <= set(range(runs)) and sum(r["__size"] for r in got) == len(rows)
            if runs == 1:
                break
            level, runs = exact_dedup.merge_round(level, largest), -(-runs // exact_dedup.FAN)
        of = {}
        for i, t in rows:
            of.setdefault(t, []).append(i)
        assert {(r["__keep"]["__id"], r["__size"]) for r in got} == {(best(ids), len(ids)) for ids in of.values()}
    plan = exact_dedup.merge_round(exact_dedup.sorted_runs(digests, True), True)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.count("REPARTITION_BY_COL") == 1
