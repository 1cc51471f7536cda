"""Documents to packed training sequences: five stages, each written before the next begins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import exact_dedup, language, packing, secret_scan, simhash
from meterline.session import cut_lineage

VOCABULARY = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain enough; those without a letter go.

    The model learns from the labelled documents outside of the held-out fold. If there are
    none, nothing can be judged and all documents stay.
    """
    model = language.fit(docs.filter(language.fold("doc_id") != 0))
    if model is None:
        return docs
    return language.identify(docs, model).filter("accepted").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the document with the largest id stays."""
    return exact_dedup.without_duplicates(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints, the one with the smallest id stays."""
    return simhash.one_of_each(docs, shingle=3, most_bits=3)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts become a mark, and n_chars is counted anew."""
    found = secret_scan.scan(docs, secret_scan.fit(docs))
    hit = F.size("secrets") > 0
    text = secret_scan.masked(F.col("text"), F.col("secrets"))
    count = F.when(hit, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", count).withColumn("text", text).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

# SQL has neither the trained models nor the tokenizer; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
