"""Every stage of the pipeline against a plain version over what its predecessor kept."""

import os
import re
from collections import Counter, defaultdict

import public_tokenizers
from conftest import DOCS
from test_minhash import brute as near_brute
from test_text_ops import brute_targets
from tokenizers import Tokenizer

import corpus_pipeline
from hustings.llm import exact_dedup
from hustings.llm._spark import scratch, shared_dir, stage_table

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [docs.collect()]
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows.append(docs.collect())
        assert k == 4 or docs.columns == columns
    start, clean, single, apart, mixed, tokens = rows
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    gone = {r.doc_id for r in start} - {r.doc_id for r in clean}
    labelled = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(gone & toxic) > 0.7 * len(toxic) and len((gone & labelled) - toxic) <= 2 and not {*clean} - {*start}

    last = {}
    for r in clean:
        last[r.text] = max(last.get(r.text, r), r, key=lambda r: r.doc_id)
    assert Counter(single) == Counter(last.values())

    kept = {i for i, _, c, k in near_brute([(r.doc_id, r.text) for r in single], 5, 80) if k}
    assert Counter(apart) == Counter(r for r in single if r.doc_id in kept)

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in apart:
        sizes[r.source] += words(r.text)
    for r in mixed:
        taken[r.source] += words(r.text)
    longest = max(words(r.text) for r in apart)
    assert all(abs(taken[s] - t) <= longest for s, t in brute_targets(sizes).items())
    assert max(Counter(mixed).values()) <= 3 and not {*mixed} - {*apart}

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in mixed}
    assert Counter(r.doc_id for r in tokens) == Counter(r.doc_id for r in mixed) and all(r.round_trip for r in tokens)
    some = tokens[::7]
    assert [r.token_ids for r in some] == [e.ids for e in reference.encode_batch([text[r.doc_id] for r in some], add_special_tokens=False)]


def test_edges(spark, docs, no_docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for frame, least in ((docs, 5), (no_docs, 0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, str(tmp_path))
        assert frame.count() >= least
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert 0 < corpus_pipeline.run(spark, str(tmp_path)).count() <= 3 * len(DOCS)


def test_staged_tables_go(spark, docs, tmp_path):
    """Nothing that was staged inside a scratch outlives it, also where it breaks off; what is outside stays."""
    lying = lambda: set(os.listdir(shared_dir(spark).removeprefix("file:")))
    outside = stage_table(docs)
    before = lying()
    with scratch():
        exact_dedup.keep_one(docs).write.parquet(f"{tmp_path}/kept")
        assert lying() > before
    assert lying() == before and outside.count() == len(DOCS)
    try:
        with scratch():
            stage_table(docs)
            raise ValueError
    except ValueError:
        pass
    assert lying() == before
