"""Corpus pipeline: quality filter, near-duplicates, repeated passages, mixing, tokens.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns a DataFrame.
``run`` applies them to the documents table; every stage's result is written as Parquet in the shared
folder and read again as the next stage's input. All but the last return the columns of documents.

A stage sees every row that its predecessor kept and nothing else; see the operators' modules for
NULLs, repeated rows and empty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import bpe, mixing, neardup, quality, substring
from loadcast.llm.queries import MIX_WEIGHTS, source_domain, table, tokenizer_file
from loadcast.llm.scratch import materialize


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise-ranking classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near copies: five-word shingles, similarity 0.8."""
    return neardup.drop_near_duplicates(docs, shingle=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has are cut out."""
    return substring.drop_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that four fifths of the tokens, shared out by the weights, are taken from."""
    return mixing.keep_mixed(docs, domain=source_domain(), fraction=0.8, weights=MIX_WEIGHTS, max_epochs=1, seed=7)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (little-endian unsigned 32-bit integers) and a digest of their decoding."""
    path = tokenizer_file("word_bpe_49k.json")
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, decoded="decoded")
    return out.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("substring_dedup", substring_dedup),
          ("source_mix", source_mix), ("tokens", tokens)]

# Learned scores, and 64-bit digests inside the stages, are not expressible in SQL; the tests compare
# every stage with a brute-force version of its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION: the last stage's rows over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
