"""From raw documents to token ids: quality rules, near-duplicates, repeated passages, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return the
columns of documents; other columns of docs pass through too, whatever their names.

Defined results of all stages: an empty table gives no rows; texts are taken whole, however long; rows are told apart by a number of
their own where a stage compares them, so null and repeated ids lose no row that its stage does not reject. What each stage does
with nulls, empty texts, ties and repeated rows is said with it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.bpe import encode_digests
from textmill.llm.common import Scratch
from textmill.llm.decontam import keep_clean
from textmill.llm.neardup import keep_one
from textmill.llm.quality import keep_good
from textmill.llm.suffixdedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. Null and empty texts have no words, so they go; repeated rows are judged alike."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id, and of repeated rows one. A text without words
    is near nothing and stays; a row without an id is compared like all others, and stays only if no other row is near it."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that occur elsewhere, in the same text too, are cut out wherever they stand; n_chars follows. Null
    texts stay null, and texts that are cut to nothing stay as empty texts."""
    return remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go. Null and empty texts hold none and stay; repeated rows are judged alike."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the bytes that they decode to, a row for each row; a null text is encoded as
    an empty one."""
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("repeated passages", repeated_passages), ("decontamination", decontaminate), ("byte-level BPE", encode)]

#: Suffix arrays, near-duplicate components and merges by rank are beyond SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the next one's documents."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
