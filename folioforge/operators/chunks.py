"""Chunks: blocks packed in order, small ones merged, with context and overlap."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.config import DEFAULT, Settings
from folioforge.functions import text as T
from folioforge.sources.stage import table

GROUP = ["source", "group_ord"]
_LABELLED = "source string, group_ord int, ord bigint, part int, section string, subsection string"


def heading_title(text):
    return F.substring(T.strip(F.split(T.strip(text), "\n")[0]), 1, 120)


class Fold:
    """The state of packing: one open part of a group, and the headings above it."""

    def __init__(self, settings: Settings):
        self.most, self.least = settings.max_tokens, settings.min_tokens
        self.part, self.tokens, self.open = 0, 0, False
        self.section, self.second, self.third = None, None, None

    @property
    def label(self) -> tuple[str | None, str | None]:
        return self.section, self.second or self.third

    def close(self) -> tuple[int, str | None, str | None] | None:
        """The open part with the labels that hold now; the next block opens another."""
        if not self.open:
            return None
        closed = (self.part, *self.label)
        self.part, self.tokens, self.open = self.part + 1, 0, False
        return closed

    def take(self, tokens: int, heading: bool, level: int, title: str | None) -> tuple[int, tuple | None]:
        """The part of a block, and the part that it closed, if any."""
        closed = None
        if heading:
            level = level or 1
            if level == 1:
                self.section, self.second, self.third = title, None, None
            elif level == 2:
                self.second, self.third = title, None
            elif level == 3:
                self.third = title
            if level == 1 and self.open and self.tokens >= self.least:
                closed = self.close()
        elif self.open and self.tokens + tokens > self.most and self.tokens >= self.least:
            closed = self.close()
        self.tokens, self.open = self.tokens + tokens, True
        return self.part, closed


def pack_parts(blocks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, group_ord, ord, part, section, subsection) of ``blocks`` (source, group_ord, ord, tokens, kind, level, title):
    the part of each block, and one row per part with a null ord that carries its labels.

    One streaming pass over rows without texts, sorted by group and order; the state is one ``Fold``, whatever a group's size.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, fold = None, Fold(settings)
        for b in batches:
            out = []
            for s, g, o, n, kind, level, title in zip(b["source"], b["group_ord"], b["ord"], b["tokens"], b["kind"], b["level"], b["title"]):
                if (s, g) != at:
                    if closed := fold.close():
                        out.append((*at, None, *closed))
                    at, fold = (s, g), Fold(settings)
                part, closed = fold.take(n, kind == "heading", 0 if pd.isna(level) else int(level), title)
                if closed:
                    out.append((s, g, None, *closed))
                out.append((s, g, o, part, None, None))
            yield pd.DataFrame(out, columns=["source", "group_ord", "ord", "part", "section", "subsection"]).astype({"ord": "Int64"})
        if closed := fold.close():
            yield pd.DataFrame([(*at, None, *closed)], columns=["source", "group_ord", "ord", "part", "section", "subsection"]).astype({"ord": "Int64"})

    rows = blocks.select("source", "group_ord", "ord", "tokens", "kind", "level", "title").repartition("source", "group_ord").sortWithinPartitions("source", "group_ord", "ord")
    return rows.mapInPandas(run, _LABELLED)


def merge_small(parts: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, group_ord, part, chunk, section, subsection) of ``parts`` (source, group_ord, part, tokens, section, subsection): a
    part below the minimum joins the chunk before it; the labels are the first of the chunk's parts that are not empty."""
    w = Window.partitionBy(*GROUP).orderBy("part")
    opens = ((F.col("part") > 0) & (F.col("tokens") >= settings.min_tokens)).cast("int")
    numbered = parts.withColumn("chunk", F.sum(opens).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    whole = Window.partitionBy(*GROUP, "chunk").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = lambda c: F.first(F.when(F.col(c) != "", F.col(c)), ignorenulls=True).over(whole)
    return numbered.select(*GROUP, "part", "chunk", first("section").alias("section"), first("subsection").alias("subsection"))


def chunk_numbers(chunks: DataFrame) -> DataFrame:
    """(source, group_ord, before): how many chunks the groups before have, from rows without texts."""
    counted = chunks.groupBy(*GROUP).agg((F.max("chunk") + 1).alias("n"))
    w = Window.partitionBy("source").orderBy("group_ord").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(*GROUP, F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))


def overlap_tail(body, settings: Settings = DEFAULT):
    """The last words of a body, at most the overlap."""
    w, ov = T.words(body), settings.overlap_tokens
    return F.array_join(F.slice(w, F.greatest(F.size(w) - ov + 1, F.lit(1)), ov), " ")


def assemble(blocks: DataFrame, groups: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Chunks of ``blocks`` (source, group_ord, ord, page, kind, level, text) and ``groups`` (source, group_ord, chapter, title)."""
    sized = table(blocks.withColumn("tokens", T.count_tokens(F.col("text"))).withColumn("title", F.when(F.col("kind") == "heading", heading_title(F.col("text")))))
    packed = table(pack_parts(sized, settings))
    of_block = packed.where("ord IS NOT NULL").select(*GROUP, "ord", "part")
    labels = packed.where("ord IS NULL").select(*GROUP, "part", "section", "subsection")
    placed = sized.join(of_block, [*GROUP, "ord"])
    merged = merge_small(placed.groupBy(*GROUP, "part").agg(F.sum("tokens").alias("tokens")).join(labels, [*GROUP, "part"]), settings)
    pieces = placed.join(merged, [*GROUP, "part"])
    ordered = F.array_sort(F.collect_list(F.struct("ord", "text")))
    built = pieces.groupBy(*GROUP, "chunk").agg(
        F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("body"), F.max_by("kind", "ord").alias("last_kind"), F.count_if(F.col("kind") == "code").cast("int").alias("code_blocks"),
        F.array_sort(F.collect_set("page")).alias("pages"), F.first("section").alias("section"), F.first("subsection").alias("subsection"),
    )
    built = table(built)
    tail = F.when(F.col("last_kind") != "code", overlap_tail(F.col("body"), settings)) if settings.overlap_tokens > 0 else F.lit(None).cast("string")
    w = Window.partitionBy(*GROUP).orderBy("chunk")
    lapped = built.withColumn("tail", tail).withColumn("overlap", F.lag("tail").over(w))
    titled = lapped.join(groups.select(*GROUP, "chapter", F.col("title").alias("slide_title")), GROUP)
    line = lambda name, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"{name}: "), F.col(c)))
    context = F.concat_ws("\n", line("Title", "chapter"), line("Section", "section"), line("Subsection", "subsection"))
    content = F.when(context != "", F.concat(context, F.lit("\n\n"), F.col("body"))).otherwise(F.col("body"))
    text = F.when(F.coalesce("overlap", F.lit("")) != "", F.concat("overlap", F.lit("\n\n"), content)).otherwise(content)
    indexed = titled.join(chunk_numbers(built), GROUP).withColumn("chunk_index", (F.col("before") + F.col("chunk")).cast("int")).withColumn("text", text)
    flat = indexed.select(
        F.format_string("%s::chunk-%04d", "source", "chunk_index").alias("chunk_id"), "chunk_index", "text", "source", F.array_min("pages").alias("page_start"), F.array_max("pages").alias("page_end"), "chapter", "slide_title",
        F.when(F.col("code_blocks") > 0, "code").otherwise("text").alias("content_type"), (F.col("code_blocks") > 0).alias("has_code"), T.count_tokens(F.col("text")).cast("int").alias("token_count"), "pages", "section", "subsection", "code_blocks",
    )
    return flat.withColumn("metadata", compose_metadata()).drop("code_blocks")


def compose_metadata():
    """The metadata of a chunk as a struct of 15 fields."""
    return F.struct(
        "chunk_id", "source", "page_start", "page_end", "chapter", "slide_title", "section", "subsection", "content_type", "has_code", "chunk_index", "token_count", "pages", F.col("text").alias("content"), "code_blocks"
    )


def chunk_summary(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk_index", "page_start", "page_end", "chapter", "slide_title", "content_type", "has_code", "token_count")
