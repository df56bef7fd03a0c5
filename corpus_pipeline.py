"""A corpus pipeline of five stages over the operators of tessera.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet in the
shared folder and rereads it for the next. All but the last return the columns of documents, whatever
others there are besides doc_id, text, source and n_chars, and whatever they are called.

Defined results, of all stages: no rows give no rows; a repeated row is a row of its own, and a null id
or source is a value like others, last in order. Each stage says what becomes of a null, empty or very long text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe_shuffle, mixing, parity, repetition, substring
from tessera.llm.work import small_batches, stash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go; a null or empty text has too few words. Long texts are
    judged whole."""
    small_batches(spark)
    return repetition.keep_clean(docs, rules=repetition.STRICT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 of five-word shingles stays, one with the least
    id; of a row that is there more than once one stays. Texts without words are in no group, and stay."""
    small_batches(spark)
    return parity.keep_one(docs, n=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 20-word windows go but for their first place; a document left without words goes, one
    that had none before stays. n_chars is that of the text that is left."""
    small_batches(spark)
    rows = substring.dedup(docs).filter("n_removed < n_words OR n_words = 0")
    changed = {"text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights; a document comes as often as its copies, so one without words goes."""
    small_batches(spark)
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digests of ids and decoded bytes; those of a null or empty text are of
    nothing."""
    small_batches(spark)
    return bpe_shuffle.digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("substring dedup", repeats), ("mixing", mix), ("byte-level BPE", encode)]

#: Pivotal rounding and BPE are not expressible in SQL; a test compares each stage and run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
