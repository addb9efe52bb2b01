"""Words in passages that two rows have, against all windows by brute force."""

import random
from collections import Counter, defaultdict

import pytest
from conftest import DOCS

from hustings.llm import shared_passages, suffix_dedup


def brute(rows, width):
    texts = [[w for w in (t or "").translate({k: " " for k in range(9, 14)}).split(" ") if w] for _, t in rows]
    holders = defaultdict(set)
    for r, words in enumerate(texts):
        for k in range(len(words) - width + 1):
            holders[tuple(words[k : k + width])].add(r)
    out = []
    for (i, _), words in zip(rows, texts, strict=True):
        covered = {j for k in range(len(words) - width + 1) if len(holders[tuple(words[k : k + width])]) > 1 for j in range(k, k + width)}
        out.append((i, len(covered)))
    return Counter(out)


def result(frame, **options):
    return Counter((r.doc_id, r.n_shared_words) for r in suffix_dedup.remove_repeats(frame, with_text=False, **options).collect())


def test_short_passage(spark):
    """A passage of 51 words and fewer than 400 bytes stays by the window of bytes, and is counted by words."""
    passage = [f"p{k}" for k in range(60)]
    rows = [(1, "one " + " ".join(passage[:51]) + " two"), (2, "\n".join(passage[:51])), (3, " ".join(passage[9:59])), (4, "other " * 200)]
    found = {r.doc_id: (r.n_removed, r.n_shared_words) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False).collect()}
    assert {i: found[i] for i in (1, 2, 3)} == {1: (0, 51), 2: (0, 51), 3: (0, 0)}
    assert found[4] == (1200, 0)  # its bytes repeat within it, and no other row has them


@pytest.mark.parametrize("width", [1, 2, 7, 20])
def test_all_windows(spark, monkeypatch, width):
    """Passages with and without changes, periodic and repeated rows, repeats within one row, texts in several chunks."""
    monkeypatch.setattr(shared_passages, "GRAM", 3)
    rnd = random.Random(width)
    passages = [[rnd.choice("abcdé") * rnd.randrange(1, 3) for _ in range(rnd.randrange(5, 60))] for _ in range(12)]

    def text():
        words = []
        for _ in range(rnd.randrange(6)):
            some = list(rnd.choice(passages)) if rnd.random() < 0.6 else [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(30))]
            if some and rnd.random() < 0.3:
                some[rnd.randrange(len(some))] = f"w{rnd.randrange(10**6)}"
            words += some
        return "".join(w + rnd.choice([" ", "  ", "\n", "\t "]) for w in words)

    rows = [(i, text()) for i in range(120)]
    rows += [(i, " ".join(f"v{rnd.randrange(10**6)}" for _ in range(20)) + " " + " ".join(passages[0]) + f" u{i}") for i in range(200, 260)]
    rows += [(300, "a " * 200), (301, "a b " * 70), (302, "a " * 33), (303, rows[5][1]), (303, rows[5][1]), (None, rows[7][1]), (304, None), (305, "")]
    rows += [(306, " ".join(f"y{k}" for k in range(90)) * 2), (307, "lone " + "z x " * 80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(frame, words=width) == brute(rows, width)


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, shared_passages.WIDTH)


def test_edges(docs):
    """Odd rows, a repeated row, and a long text whose passage another row has."""
    assert result(docs) == brute([(i, t) for i, t, *_ in DOCS], shared_passages.WIDTH)


def test_long_text(spark):
    words = [f"n{k}" for k in range(700_000)]
    rows = [(1, " ".join(words)), (2, "x " + " ".join(words[600_000:600_080]) + " y")]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == Counter([(1, 80), (2, 80)])
