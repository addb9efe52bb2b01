"""A training corpus from documents: five stages, each written as Parquet and read again.

toxicity drops what the classifier rejects; exact dedup keeps one row of each text; near
dedup keeps one document of each group of near copies (five-word shingles, similarity
0.8); mixing repeats or leaves out documents until each source has its share; BPE adds
the token ids. All stages but the last return the columns of documents.

Null texts count as empty, null identifiers and sources as values of their own, rows may repeat,
tables may be empty and texts of any length: the operators say what each case gives.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hustings.llm import bpe, exact_dedup, minhash_dedup, mixing, toxicity
from hustings.llm._spark import scratch, shared_dir
from hustings.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that score 0.5 or more go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near copies the smallest doc_id stays."""
    return minhash_dedup.keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents as often as their source's target takes them."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the token ids of each text, instead of the text, and whether they decode to it."""
    return bpe.encode_checked(docs, tokenizer()).drop("text")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: Classifier, sampling and tokens are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over documents; each is written and read again.

    folder: where the stages lie, kept and used again: a run that broke off goes on behind its last whole stage. Without one
    they lie in the shared folder, and each goes when the next one is written. Tables that a stage's operator made on the way
    go with the end of the stage, also when it breaks off.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    top = folder or f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{top}/{k}-{name.replace(' ', '-')}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            with scratch():
                stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path.toString())
        docs = spark.read.parquet(path.toString())
        if before is not None and not folder:
            files.delete(before, True)
        before = path
    return docs
