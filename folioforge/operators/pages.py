"""Pages: one row per (source, page_number), classified and cleaned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.config import DEFAULT, Settings
from folioforge.functions import text as T

BROADCAST_SOURCES = 100_000  # rows of one source's boilerplate, a few lines each


def pages_of(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, page_number, raw_text): each page once, null text as empty; pages beyond ``max_pages`` of a source are left out."""
    rows = df.select("source", "page_number", F.coalesce("raw_text", F.lit("")).alias("raw_text")).where("source IS NOT NULL AND page_number IS NOT NULL")
    if settings.max_pages:
        rows = rows.where(F.col("page_number") <= settings.max_pages)
    return rows.dropDuplicates(["source", "page_number"])


def page_class(raw_text, settings: Settings = DEFAULT):
    """By the length of the raw text without outer white space."""
    n = F.length(T.strip(raw_text))
    return F.when(n <= settings.no_text_max_chars, "no_text").when(n <= settings.hybrid_max_chars, "hybrid").otherwise("native_text")


def classify_pages(pages: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return pages.withColumn("page_class", page_class(F.col("raw_text"), settings))


def boilerplate_lines(pages: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, line, pages): normalized lines on at least the set fraction of a source's pages, empty ones included.

    Lines are counted once a page, partially before the shuffle; only short normalized lines travel.
    """
    totals = pages.groupBy("source").agg(F.count("*").alias("total"))
    lines = pages.select("source", F.explode(F.array_distinct(T.norm_lines("raw_text"))).alias("line")).where("line <> ''")
    counted = lines.where(F.length("line") <= settings.boilerplate_max_chars).groupBy("source", "line").agg(F.count("*").alias("pages"))
    return counted.join(totals, "source").where(F.col("pages") / F.col("total") >= settings.boilerplate_fraction).select("source", "line", "pages")


def drop_line(line, norm, learned, settings: Settings = DEFAULT):
    """Whether cleaning removes a stripped line."""
    out = (line == "") | F.array_contains(learned, norm) | line.rlike(T.any_of(settings.footer_patterns)) | (line.rlike(T.NUMBER_LINE) & (F.length(line) <= 6))
    return out | line.rlike(T.EMAIL) if settings.remove_emails else out


def clean_pages(pages: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``pages`` with cleaned_text, page_class, has_code and extraction_status.

    The learned lines of a source, at most the mean number of lines a page over the fraction, come to its pages as one
    array, broadcast if there are few sources; page texts are not exploded, and not shuffled for it.
    """
    learned = boilerplate_lines(pages, settings).groupBy("source").agg(F.collect_set("line").alias("learned"))
    rows = pages.join(learned, "source", "left").withColumn("norms", T.norm_lines("raw_text"))
    zipped = F.zip_with(F.split("raw_text", "\n"), "norms", lambda a, b: F.struct(T.strip(a).alias("line"), b.alias("norm")))
    known = F.coalesce("learned", F.array().cast("array<string>"))
    kept = F.transform(F.filter(zipped, lambda x: ~drop_line(x["line"], x["norm"], known, settings)), lambda x: x["line"])
    joined = F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), "\\x{A0}", " "), "[ \\t]+", " ")
    cleaned = rows.withColumn("cleaned_text", T.strip(joined)).drop("learned", "norms")
    with_code = cleaned.withColumn("has_code", F.exists(F.split("cleaned_text", "\n"), lambda x: T.is_code_line(x, settings)))
    return classify_pages(with_code, settings).withColumn("extraction_status", F.lit("extracted"))


def text_for_chunking(cleaned, raw):
    """The cleaned text, or the raw one where cleaning left nothing."""
    return F.when(F.coalesce(cleaned, F.lit("")) != "", cleaned).otherwise(F.coalesce(raw, F.lit("")))
