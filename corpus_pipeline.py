"""A training-data pipeline: documents without toxic, foreign, duplicate and contaminated ones, as token ids.

Each stage takes all that the one before kept; its result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import bpe, catalog, langid, similar, toxicity, winnow
from folioforge.llm.shared import Scratch, table, temporary

#: Words in a worker's table of op 6, which runs beside a heap that the stages before have filled.
KEPT_WORDS = 150_000


def clean_speech(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones have."""
    return langid.drop_foreign(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: SimHash fingerprints within two bits (op 1), or sets of five-word shingles that share at least 0.8 of their union."""
    return similar.drop_similar(docs, near=3)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    return winnow.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and digests of the round trip."""
    encoded = bpe.encode(docs, catalog.vocabulary("byte_bpe_50k.json"), ["doc_id"], kept_words=KEPT_WORDS)
    return catalog.digests(encoded)


STAGES = [("toxicity", clean_speech), ("language_id", known_language), ("near_dedup", one_of_each), ("decontamination", uncontaminated), ("bpe", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote on its way, and the stage's input, are deleted once its result is written."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    for i, (_, stage) in enumerate(STAGES):
        with temporary():
            made = scratch.write(stage(spark, docs, sf_dir))
        if i:
            scratch.drop(docs)
        docs = made
    return docs
