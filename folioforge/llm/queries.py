"""Queries over the problems' operators; SQL beside them in :mod:`folioforge.llm.sql`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.leaks import leaked_items
from folioforge.llm.lookalike import lookalike_pairs, unify_text
from folioforge.llm.mixing import mix_sources
from folioforge.llm.near_duplicates import near_duplicate_groups, near_duplicate_pairs
from folioforge.llm.neighbours import nearest_vectors, recall, similar_pairs
from folioforge.llm.packing import pack_items, packs
from folioforge.llm.repeated_lines import lines_to_remove, remove_repeated_lines
from folioforge.llm.splitting import split_oversized
from folioforge.llm.stuffing import prose_shares


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    near = nearest_vectors(_read(spark, d, "chunk_vectors"), least=0.8)
    return similar_pairs(near, "chunk_id", 0.8).select(F.col("key_a").alias("chunk_a"), F.col("key_b").alias("chunk_b"))


def p1_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return nearest_vectors(_read(spark, d, "chunk_vectors")).withColumn("cosine", F.round("cosine", 4))


def p1_recall(spark: SparkSession, d: str) -> DataFrame:
    vectors = _read(spark, d, "chunk_vectors")
    return recall(vectors, nearest_vectors(vectors))


BLOCK_KEYS = ["group_ord", "block_ord"]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    packed = pack_items(_read(spark, d, "blocks"), "source", BLOCK_KEYS, "text")
    spread = packed.where("pack IS NOT NULL").groupBy("source", *BLOCK_KEYS).agg(F.count_distinct("pack").alias("packs"))
    return spread.where("packs > 1").select("source", *BLOCK_KEYS)


def p2_packing(spark: SparkSession, d: str) -> DataFrame:
    made = packs(pack_items(_read(spark, d, "blocks"), "source", BLOCK_KEYS, "text"), "source", BLOCK_KEYS)
    return made.groupBy("source").agg(F.count("*").alias("chunks"), F.sum("token_count").alias("tokens"), F.max("token_count").alias("largest"), F.ceil(F.sum("token_count") / 700).alias("chunks_at_least"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_pairs(_read(spark, d, "chunks"), "chunk_id").select(F.col("key_a").alias("chunk_a"), F.col("key_b").alias("chunk_b"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_groups(_read(spark, d, "chunks"), "chunk_id").withColumnRenamed("key", "chunk_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pages = lookalike_pairs(_read(spark, d, "pages"), "page_id", "raw_text", 100).select(F.lit("pages").alias("tab"), "key_a", "key_b")
    chunks = lookalike_pairs(_read(spark, d, "chunks"), "chunk_id", "text", 100).select(F.lit("chunks").alias("tab"), "key_a", "key_b")
    return pages.unionByName(chunks)


def p4_forms(spark: SparkSession, d: str) -> DataFrame:
    pages = unify_text(_read(spark, d, "pages"), "page_id", "raw_text")
    return pages.select(F.col("key").alias("page_id"), F.length("form").alias("n_chars"), F.md5(F.col("form").cast("binary")).alias("form_md5")).distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return lines_to_remove(_read(spark, d, "pages"))


def p5_pages(spark: SparkSession, d: str) -> DataFrame:
    kept = remove_repeated_lines(_read(spark, d, "pages"))
    return kept.select("page_id", F.length("text").alias("n_before"), F.length("kept").alias("n_after")).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = split_oversized(_read(spark, d, "chunks"), "chunk_id", "text", only_divided=True, with_text=False)
    return pieces.where("piece = 0 AND chunk_id IS NOT NULL").select("chunk_id").distinct()


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    pieces = split_oversized(_read(spark, d, "chunks"), "chunk_id", "text", only_divided=True)
    return pieces.select("chunk_id", "piece", "pieces", "first_token", "token_count", F.md5(F.col("text").cast("binary")).alias("text_md5")).distinct()


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(_read(spark, d, "documents"), _read(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    found = leaked_items(_read(spark, d, "documents"), _read(spark, d, "eval_items"))
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("run").alias("longest_run"), F.max("item_words").alias("item_words"), F.count_if("answer_found").alias("n_with_answer"))


def p8_corpus(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(_read(spark, d, "documents"), _read(spark, d, "mix_targets"))[0]


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(_read(spark, d, "documents"), _read(spark, d, "mix_targets"))[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return prose_shares(_read(spark, d, "documents")).where("other_share > 0.5 AND doc_id IS NOT NULL").select("doc_id").distinct()


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return prose_shares(_read(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit()}
