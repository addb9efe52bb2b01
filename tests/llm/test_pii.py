"""Personal data: base patterns against the plain regular expressions, the field on held-out sentences."""

import hashlib
import random
import re

from conftest import DOCS

from hustings.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
            holds = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None, "card": 12 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if holds:
                out.append((m.start(), list(PATTERNS).index(kind), kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_base_patterns():
    rnd = random.Random(4)
    alphabet = ["a", "Z9", "@", ".", "-", "+", "1", "23", "255", "256", " ", "(", ")", "4111 1111 1111 1111", "x@y.de", "1.2.3.4", "é", "%", "\n", "@b.c", "00007"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 25))) for _ in range(4000)]
    for text in [*texts, *(t or "" for _, t, *_ in DOCS)]:
        assert pii.base_spans(text) == brute(text), text
    assert pii.base_spans("a" * 200_000 + "@" + "1" * 200_000) == []


def test_field_on_held_out_sentences():
    model = pii.train()
    right = found = wanted = 0
    for text, truth in pii.training_sentences(150, seed=99):
        got = {s for s in pii.find_spans(text, model)[1]}
        right, found, wanted = right + len(got & truth), found + len(got), wanted + len(truth)
    assert right / found > 0.85 and right / wanted > 0.85, (right, found, wanted)


#: (text, kind, the entity), none of them made by the generator that trains the field; no entity: a look-alike.
VARIANTS = [
    ("write to john at site dot com please", "email", "john at site dot com"), ("contact: mary.smith [at] uni [dot] edu", "email", "mary.smith [at] uni [dot] edu"),
    ("info(at)firm(dot)de", "email", "info(at)firm(dot)de"), ("ask anna at uni-bonn dot de", "email", "anna at uni-bonn dot de"), ("to bob @ mail.example.com today", "email", "bob @ mail.example.com"),
    ("call (415) 555-0133 today", "phone", "(415) 555-0133"), ("ring 415.555.0133", "phone", "415.555.0133"), ("tel. 415-555-0133, fax", "phone", "415-555-0133"),
    ("dial 0049 30 123 45 67 now", "phone", "0049 30 123 45 67"), ("at 030 1234 5678 daily", "phone", "030 1234 5678"),
    ("card 4111.1111.1111.1111 ok", "card", "4111.1111.1111.1111"), ("pay with 5500/0000/0000/0004 then", "card", "5500/0000/0000/0004"), ("host 10 . 0 . 0 . 1 is up", "ip", "10 . 0 . 0 . 1"),
    ("at noon the dot moved", None, None), ("2021-03-04 12:30:11", None, None), ("ISBN 978-3-16-148410-0", None, None), ("order #12345678", None, None), ("id 1234567890123456 here", None, None),
    ("population 1,234,567,890", None, None), ("pi is 3.14159265358979", None, None), ("from 1914 to 1918 and 1939 to 1945", None, None), ("look at the end. Dot to dot", None, None),
]


def test_variants():
    model = pii.train()
    right = found = 0
    for text, kind, entity in VARIANTS:
        got = {(k, text[s:e]) for k, s, e in pii.find_spans(text, model)[1]}
        right, found = right + ((kind, entity) in got), found + len(got)
    wanted = sum(kind is not None for _, kind, _ in VARIANTS)
    assert right >= 0.8 * wanted and right >= 0.9 * found, (right, found, wanted)


def test_decode_is_best_segmentation():
    """Against the sum of every set of apart candidates."""
    model = pii.train()
    rnd = random.Random(8)
    tokens = ["415", "-", "555", "0133", ".", "10", "4", "@", "a", "at", "dot", "com", "(", ")", "+1", " ", " ", "4111 1111 1111 1111"]
    for _ in range(150):
        text = "".join(rnd.choice(tokens) for _ in range(rnd.randrange(4, 12)))
        line = pii.Line(text, 0, len(text))
        arcs = []
        for j, firsts in line.by_end():
            for i in firsts:
                gain, kind = model._scored(line.key(i, j))[1][line.facts(i, j)]
                arcs.append((i, j, gain, (pii.KINDS[kind], *line.span(i, j))))

        def best(at):
            return max([0.0, *(gain + best(j) for i, j, gain, _ in arcs if i >= at and gain > 0)])  # noqa: B023

        scores = {span: gain for _, _, gain, span in arcs}
        got = model.decode(line)
        assert all(a[2] <= b[1] for a, b in zip(got, got[1:], strict=False))
        assert abs(sum(scores[s] for s in got) - best(0)) < 1e-6, text


def test_stretches_hold_all_candidates():
    """The parts that are read give what whole lines give."""
    model = pii.train()
    rnd = random.Random(12)
    tokens = ["415", "-", "555 0133", ".", "10", "4", "@", "a", "at", "dot", "com", "(", ")", "+1", " ", " ", "\n", "4111/1111/1111/1111", "word", "é", "10 . 0 . 0 . 1"]
    for _ in range(400):
        text = "".join(rnd.choice(tokens) for _ in range(rnd.randrange(4, 30)))
        whole, at = [], 0
        for line in text.split("\n"):
            whole += model.decode(pii.Line(text, at, at + len(line)))
            at += len(line) + 1
        assert sorted(whole) == sorted(s for a, b in pii.stretches(text) for s in model.decode(pii.Line(text, a, b))), text


def test_long_texts():
    """Texts of numbers take time and memory in proportion."""
    import time
    import tracemalloc

    model = pii.train()
    rnd = random.Random(2)
    text = "".join(f"{rnd.randrange(1000)} " for _ in range(130_000))
    pii.find_spans(text, model)
    tracemalloc.start()
    start = time.time()
    pii.find_spans(text, model)
    assert tracemalloc.get_traced_memory()[1] < 150e6 and time.time() - start < 30
    tracemalloc.stop()


def test_queries(spark, docs, no_docs):
    model = pii.train()
    rows = {r.doc_id: r for r in pii.span_digests(pii.find_pii(docs, model)).collect()}
    assert len(rows) == len({i for i, *_ in DOCS})
    for i, text, *_ in DOCS:
        base = brute(text or "")
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert rows[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert (rows[i].n_email, rows[i].n_ip, rows[i].n_card, rows[i].n_phone) == tuple(sum(b[0] == k for b in base) for k in PATTERNS)
        assert set(filter(None, written.split(","))) <= set(rows[i].spans.split(","))
    assert pii.find_pii(no_docs, model).count() == 0
    masked = pii.mask(docs, model)
    assert masked.columns == docs.columns and "<email>" in next(r.text for r in masked.collect() if r.doc_id == 8)


def test_clean_documents_stay_alone(spark):
    """The field adds next to nothing where the base patterns find nothing."""
    model = pii.train()
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    clean = [t for t in rows if not pii.base_spans(t)]
    assert sum(bool(pii.find_spans(t, model)[1]) for t in clean) < 0.01 * len(clean)
