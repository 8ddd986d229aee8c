"""Chapters, titles and groups of consecutive pages."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.config import DEFAULT, Settings
from folioforge.functions import text as T
from folioforge.functions.text import norm_title
from folioforge.operators.pages import text_for_chunking

_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def page_heads(pages: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, page_number, line1, line2, chapter_line, label): what structure needs of a page, without its text."""
    lines = T.lines_of(text_for_chunking(F.col("cleaned_text"), F.col("raw_text")))
    rows = pages.select("source", "page_number", lines.alias("lines"))
    chapter = F.try_element_at(F.filter("lines", lambda x: x.rlike(T.any_of(settings.chapter_patterns))), F.lit(1))
    heads = rows.select("source", "page_number", F.try_element_at("lines", F.lit(1)).alias("line1"), F.try_element_at("lines", F.lit(2)).alias("line2"), chapter.alias("chapter_line"))
    return heads.withColumn("label", T.norm_titles(F.coalesce("line1", F.lit(""))))


def first_line_labels(heads: DataFrame) -> DataFrame:
    """(source, label, freq): how many pages of a source begin with a line of that normalized form."""
    return heads.where("label <> ''").groupBy("source", "label").agg(F.count("*").alias("freq"))


def doc_types(heads: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, doc_type): a slide deck has at least three first lines that come back often enough."""
    often = F.count_if(F.col("freq") >= settings.first_line_label_min_freq)
    labels = first_line_labels(heads).groupBy("source").agg(often.alias("n"))
    return heads.select("source").distinct().join(labels, "source", "left").select("source", F.when(F.col("n") >= 3, "slide_deck").otherwise("document").alias("doc_type"))


def page_titles(heads: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``heads`` with title: the first line, or the second where the first is a label that comes back; "(page N)" without lines."""
    freq = F.when(F.col("label") != "", F.count("*").over(Window.partitionBy("source", "label"))).otherwise(0)
    second = F.when(freq >= settings.first_line_label_min_freq, F.coalesce("line2", "line1")).otherwise(F.col("line1"))
    return heads.withColumn("title", F.coalesce(second, F.format_string("(page %d)", "page_number")))


def page_chapters(titled: DataFrame) -> DataFrame:
    """``titled`` with chapter: the last marker so far; before the first one, the last of the source; without any, the first title."""
    w = Window.partitionBy("source").orderBy("page_number")
    so_far = F.last("chapter_line", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return titled.withColumn("chapter", F.coalesce(so_far, F.last("chapter_line", ignorenulls=True).over(w.rowsBetween(*_ALL)), F.first("title").over(w.rowsBetween(*_ALL)), F.lit("")))


def titles_similar(a: str, b: str, threshold: float) -> bool:
    """Of normalized titles; the order counts. Cheap bounds come first."""
    if not a or not b:
        return False
    if a == b:
        return True
    if threshold >= 1:
        return False
    m = SequenceMatcher(None, a, b)
    return m.real_quick_ratio() >= threshold and m.quick_ratio() >= threshold and m.ratio() >= threshold


def page_groups(chaptered: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, page_number, chapter, title, group_ord, group_title): a page joins the open group of its source if the chapter is
    the same and the title like that of the group's first page.

    One pass over sorted compact rows with one open group as state: a source's rows stream by and are never held.
    """
    limit = settings.title_similarity_threshold

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source = chapter = anchor = title = None
        number = -1
        for b in batches:
            orders, titles = [], []
            for s, c, t in zip(b["source"], b["chapter"], b["title"]):
                norm = norm_title(t)
                if s != source:
                    source, number, chapter, anchor, title = s, 0, c, norm, t
                elif c != chapter or not titles_similar(anchor, norm, limit):
                    number, chapter, anchor, title = number + 1, c, norm, t
                orders.append(number)
                titles.append(title)
            yield b.assign(group_ord=pd.Series(orders, dtype="int32", index=b.index), group_title=titles)

    rows = chaptered.select("source", "page_number", "chapter", "title").repartition("source").sortWithinPartitions("source", "page_number")
    return rows.mapInPandas(fold, "source string, page_number int, chapter string, title string, group_ord int, group_title string")


def detect_structure(pages: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Pages to their groups: see ``page_groups``."""
    return page_groups(page_chapters(page_titles(page_heads(pages, settings), settings)), settings)


def groups_of(grouped: DataFrame, types: DataFrame) -> DataFrame:
    """(source, group_ord, chapter, title, page_numbers, doc_type), one row a group."""
    rows = grouped.groupBy("source", "group_ord").agg(F.first("chapter").alias("chapter"), F.first("group_title").alias("title"), F.array_sort(F.collect_list("page_number")).alias("page_numbers"))
    return rows.join(types, "source")
