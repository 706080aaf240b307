"""A corpus cleaned and packed in stages, each one an operator of ``tiermart.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tiermart.llm import exact_dedup, language, near_dedup, packing, toxicity
from tiermart.llm.common import fresh, stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those that the classifier rejects go."""
    model = language.fit(table(spark, sf_dir, "documents"))
    prefix = fresh(docs.columns, "_")
    return language.identify(docs, model, prefix=prefix).filter(f"NOT {prefix}rejected").select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.sampled(table(spark, sf_dir, "labels"), texts))
    prefix = fresh(docs.columns, "_")
    return toxicity.score(docs, model, prefix=prefix).filter(f"{prefix}predicted = 0").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words."""
    return near_dedup.drop_near_copies(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their place in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", known_language),
    ("toxicity", not_toxic),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("best-fit packing", packed),
]

#: SQL cannot train the two classifiers; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
