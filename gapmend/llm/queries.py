"""Each operator over its whole table, with the columns its users are promised."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gapmend.llm.alignment import align_tokenizers
from gapmend.llm.decontaminate import contamination
from gapmend.llm.hyperminhash import near_duplicate_sets
from gapmend.llm.language import identify, learn_texts, page_evidence
from gapmend.llm.line_dedup import line_dedup
from gapmend.llm.merkle import merkle_manifest
from gapmend.llm.nearest import nearest
from gapmend.llm.packing import pack
from gapmend.llm.quality import quality_scores, train
from gapmend.llm.sharding import minimax_shards
from gapmend.llm.simhash import near_duplicates
from gapmend.llm.substring_dedup import substring_dedup
from gapmend.llm.url_filter import judge_urls, labelled_urls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"), 1, long_lines=2)
    return kept.select(
        "doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2("text", 256).alias("kept_sha256"),
        "n_long_removed", "n_long_runs", "longest_long_run", F.sha2("long_text", 256).alias("long_kept_sha256"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(table(spark, sf_dir, "documents"), 35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), labelled_urls(spark))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), VOCABULARY).drop("text_key")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = nearest(vectors, vectors.filter("vec_id % 50 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The language of each document, with the evidence of its page where it has
    one; elsewhere its source stands for the host."""
    evidence = page_evidence(table(spark, sf_dir, "pages"))
    return identify(docs, learn_texts(docs), host="source", evidence=evidence)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = languages(spark, table(spark, sf_dir, "documents"), sf_dir)
    return found.select("doc_id", "language", "probability", "accepted")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "leader"
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = minimax_shards(table(spark, sf_dir, "documents"), 24)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_sets(table(spark, sf_dir, "documents"), 80, size=4).drop("text_key")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The tampering: texts of every other document lose their line ends.
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle_manifest(table(spark, sf_dir, "documents"), check={"text": text})


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), VOCABULARY, PIECES).drop("text_key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_decontamination, op3_substring_dedup, op4_quality, op5_url_filter, op6_packing,
        op7_nearest, op8_language_id, op9_simhash, op10_sharding, op11_minhash, op12_merkle_manifest,
        op13_alignment,
    )
}
