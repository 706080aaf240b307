"""The operators applied to their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.llm import byte_bpe, chat, exact_dedup, fingerprints, hard_negatives, html, language, mtree, near_dedup, packing, resampling, sharding, toxicity
from tiermart.llm.common import fold, table


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html.extract(pages, html.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), shingle=4)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 4) == 2
    model = language.fit(docs.filter(~held_out))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 3) == 1
    model = toxicity.fit(toxicity.sampled(labels.filter(~held_out), docs))
    found = toxicity.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts imitate the template's control strings."""
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    made = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    return chat.chat_digests(chats.unionByName(made))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, keep_ids=False)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = mtree.whole_vectors(table(spark, sf_dir, "embeddings"))
    pages, tops, top = mtree.index(vectors)
    return mtree.search(pages, tops, top, vectors.filter("vec_id % 100 = 0"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh row move on by one before the search."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.whole_vectors(rows.select("vec_id", "embedding", moved.alias("label")))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_html_text": op4_html_text,
    "op5_near_dedup": op5_near_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_chat_format": op7_chat_format,
    "op8_sharding": op8_sharding,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_top_k": op10_top_k,
    "op11_fingerprints": op11_fingerprints,
    "op12_resampling": op12_resampling,
    "op13_hard_negatives": op13_hard_negatives,
}
