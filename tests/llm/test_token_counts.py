"""Token counts against the tokenizers library and the transducers against plain versions."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hustings.llm import queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def counter():
    return token_counts.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def agree(counter, library, texts):
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = counter.count(texts).tolist()
    assert [(t[:80], g, w) for t, g, w in zip(texts, got, want, strict=True) if g != w] == []


def test_made_up_texts(counter, library):
    r = random.Random(11)
    alphabet = "abcdefghijklmnopqrstuvwxyz'''''  \n.,!?-0123456789éÀΣσς<|>İßÅé\u0085 漢字​😀"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(3000)]
    words = "the of ing ation er un re low token ization 's 't abc ha haha aaaa oooo".split()
    texts += ["".join(r.choice(words) for _ in range(r.randrange(1, 12))) for _ in range(3000)]
    agree(counter, library, texts)


def test_pieces_and_special_tokens(counter, library):
    texts = ["", " ", "'", "''s", "'sx", "'r", "'re", "'rx", "'r's", "don't we'll I'M x'LLx 'v've", "a<|endoftext|>b", "<|startoftext|>́a<|endoftext|>" * 3, "e<|endoftext|>́", "<|endoftext", "<|ENDOFTEXT|>", "Σ ΑΣ ΑΣΑ", "12 345\t6"]
    agree(counter, library, texts)
    assert counter.count([]).tolist() == [] and counter.count(["", ""]).tolist() == [0, 0]


def test_long_pieces_and_texts(counter, library):
    r = random.Random(5)
    texts = ["a" * 30_001, "ab" * 20_000, "".join(r.choice("etaoin") for _ in range(20_000)), "word " * 3000]
    agree(counter, library, texts)
    for limit in (7, 100, 10**6):
        assert [counter.count_long(t, limit) for t in texts[2:]] == counter.count(texts[2:]).tolist()


def test_chunk_maps_compose(counter):
    """The marks are those of one state after the other."""
    r = np.random.default_rng(3)
    points = np.array([ord(c) for c in "rlvestd m'x. 1"], np.uint32)[r.integers(0, 14, 5000)]
    points[-1] = ord(" ")
    cutter = counter.cutter
    starts, ends = cutter.pieces(points)
    text = "".join(map(chr, points))
    want = [m.span() for m in re.finditer(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", text)]
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == want
    maps = cutter.scan(cutter.chunk_maps(r.integers(0, cutter.next.shape[1], (37, 8), dtype=np.uint8)))
    assert maps.shape == (37, len(cutter.next))


def test_full_table_starts_afresh(counter, library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 40)
    monkeypatch.setattr(token_counts, "MAX_PAIRS", 10)
    small = token_counts.load(PATH)
    r = random.Random(2)
    agree(small, library, ["".join(r.choice("etaoinshr '") for _ in range(300)) for _ in range(20)] + ["".join(r.choice("etaoinshr") for _ in range(900))])
    assert len(small.counter.states) <= 40


def test_tokens_that_their_own_encoding_never_gives():
    """A vocabulary with a merge that is never reached: "abc" is cut as "a" "bc"."""
    from hustings.llm.bpe import byte_symbols

    vocab = {s: k for k, s in enumerate([*byte_symbols(), *(s + "/" for s in byte_symbols())])}
    merges = [("b", "c"), ("a", "b"), ("ab", "c"), ("c", "c"), ("cc", "c")]
    vocab |= {a + b: 512 + k for k, (a, b) in enumerate(merges)}
    counter = token_counts.Counter(vocab, merges, "/")

    def plain(piece):
        parts = [*piece[:-1], piece[-1] + "/"]
        ranks = {m: k for k, m in enumerate(merges)}
        while True:
            at = min(((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks), default=None)
            if at is None:
                return len(parts)
            parts[at[1] : at[1] + 2] = [parts[at[1]] + parts[at[1] + 1]]

    r = random.Random(1)
    for _ in range(500):
        piece = "".join(r.choice("abc") for _ in range(r.randrange(1, 14)))
        data = np.frombuffer(piece.encode(), np.uint8)
        assert counter.count(data, np.array([0]), np.array([len(data)])).tolist() == [plain(piece)], piece


def test_other_files_are_refused():
    import json

    with pytest.raises(ValueError, match="compile"):
        token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))
    with open(PATH, encoding="utf-8") as file:
        changed = json.load(file)
    changed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\w+"
    with pytest.raises(ValueError, match="compile"):
        token_counts.TokenCounter(changed)


def test_query_and_small_cases(spark, docs, no_docs, counter, library):
    found = queries.op11_token_counts(spark, "/root/testdata/sf0.001").toPandas()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    assert len(found) == len(texts)
    for r in found.itertuples():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 2048)

    got = token_counts.count_tokens(docs, counter, limit=11).orderBy("doc_id", "n_tokens").collect()
    want = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(r.doc_id), len(library.encode(r.t, add_special_tokens=False).ids)) for r in want)
    assert {r.over_limit for r in got} == {True, False}
    assert token_counts.count_tokens(no_docs, counter).count() == 0
    named = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("body"))
    assert token_counts.count_tokens(named, counter, "id", "body").dtypes[0] == ("id", "string")


def test_5_mb(spark, counter):
    row = spark.createDataFrame([(1, "lorem ipsum it's 12 " * 250_000), (2, "x")], "doc_id long, text string")
    found = {r.doc_id: r for r in token_counts.count_tokens(row, counter).collect()}
    one = counter.count(["lorem ipsum it's 12 "])[0]
    assert found[1].n_tokens == 250_000 * one and found[1].n_bytes == 5_000_000 and found[2].n_tokens == 1
