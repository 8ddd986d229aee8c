"""One row per document that sums up its ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators.validate import validation_reports


def first_appearances(values):
    """Distinct values of ordered structs (ord, value), in the order they first appear."""
    return F.array_distinct(F.transform(F.array_sort(values), lambda x: x["value"]))


def page_counts(pages: DataFrame) -> DataFrame:
    count = lambda c: F.count_if(F.col("page_class") == c).alias(f"{c}_pages")
    return pages.groupBy("source").agg(F.count("*").alias("total_pages"), count("native_text"), count("hybrid"), count("no_text"))


def chapter_counts(groups: DataFrame) -> DataFrame:
    """Chapters by source: pre-aggregated to one row each before they are listed."""
    each = groups.groupBy("source", F.coalesce("chapter", F.lit("")).alias("chapter")).agg(F.min("group_ord").alias("ord"), F.count("*").alias("n"))
    listed = each.groupBy("source").agg(F.sum("n").alias("logical_groups"), first_appearances(F.collect_list(F.struct("ord", F.col("chapter").alias("value")))).alias("chapters"))
    return listed.withColumn("chapters_detected", F.size("chapters"))


def chunk_counts(chunks: DataFrame) -> DataFrame:
    tokens = F.coalesce("token_count", F.lit(0))
    return chunks.groupBy("source").agg(
        F.count("*").alias("chunks"), F.min(tokens).alias("min_chunk_tokens"), F.max(tokens).alias("max_chunk_tokens"), F.round(F.avg(tokens), 1).alias("avg_chunk_tokens"),
        F.count_if(F.col("has_code")).alias("chunks_with_code"), F.sum(F.coalesce("metadata.code_blocks", F.lit(0))).alias("code_blocks_preserved"),
        F.count_distinct(F.when(F.col("metadata.section") != "", F.col("metadata.section"))).alias("sections_detected"),
    )


def ingestion_report(pages: DataFrame, groups: DataFrame, chunks: DataFrame, found: DataFrame) -> DataFrame:
    """The report: one row per source with pages, zeros where it has no groups, chunks or findings. The average is rounded half up."""
    checked = validation_reports(found).select(
        "source", F.col("ok").alias("validation_ok"), F.col("errors").alias("validation_errors"), F.col("warnings").alias("validation_warnings"), "small_chunk_indices", F.col("suspicious_chunk_indices").alias("suspicious_chunks")
    )
    out = page_counts(pages).join(chapter_counts(groups), "source", "left").join(chunk_counts(chunks), "source", "left").join(checked, "source", "left")
    none = F.array().cast("array<int>")
    zeros = ["chapters_detected", "logical_groups", "chunks", "min_chunk_tokens", "max_chunk_tokens", "chunks_with_code", "code_blocks_preserved", "sections_detected", "validation_warnings", "validation_errors"]
    return out.select(
        "source", "total_pages", "native_text_pages", "hybrid_pages", "no_text_pages", *[F.coalesce(c, F.lit(0)).alias(c) for c in zeros], F.coalesce("avg_chunk_tokens", F.lit(0.0)).alias("avg_chunk_tokens"),
        F.size(F.coalesce("small_chunk_indices", none)).alias("chunks_below_min_tokens"), F.coalesce("suspicious_chunks", none).alias("suspicious_chunks"), F.coalesce("validation_ok", F.lit(True)).alias("validation_ok"),
        F.coalesce("chapters", F.array().cast("array<string>")).alias("chapters"), F.coalesce("small_chunk_indices", none).alias("small_chunk_indices"),
    )


def format_report(row: dict) -> str:
    """A report row as text for a console."""
    names = [n for n in row if n not in ("source", "chapters", "small_chunk_indices")]
    width = max(map(len, names))
    body = [f"  {n.replace('_', ' '):<{width}}  {len(row[n]) if isinstance(row[n], list) else row[n]}" for n in names]
    return "\n".join([f"Ingestion of {row['source']}", *body, "  chapters", *[f"    {c}" for c in row["chapters"]]])
