"""Typed blocks of page texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.config import DEFAULT, Settings
from folioforge.functions import text as T

PAGE = ["source", "group_ord", "page"]


def runs_of(texts: DataFrame) -> DataFrame:
    """(source, group_ord, page, run, lines, next_line): runs of non-blank lines of ``texts`` (source, group_ord, page, text), in order."""
    inner = F.regexp_replace(F.regexp_replace("text", rf"^[{T.SPACE}]*\n", ""), rf"\n[{T.SPACE}]*$", "")
    runs = F.split(inner, rf"\n[{T.SPACE}]*\n")
    rows = texts.where(~T.is_blank(F.col("text"))).select(*PAGE, runs.alias("runs"))
    after = F.try_element_at("runs", F.col("run") + 2)
    return rows.select(*PAGE, "runs", F.posexplode("runs").alias("run", "body")).select(*PAGE, "run", F.split("body", "\n").alias("lines"), F.split(after, "\n")[0].alias("next_line"))


def typed_runs(texts: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, group_ord, page, run, kind, level, text)."""
    rows = runs_of(texts).withColumn("kind", T.block_kind(F.col("lines"), F.col("next_line"), settings))
    level = F.when(F.col("kind") == "heading", T.heading_level(T.strip(F.col("lines")[0]))).otherwise(0)
    return rows.select(*PAGE, "run", "kind", level.cast("int").alias("level"), F.array_join("lines", "\n").alias("text"))


def split_into_blocks(texts: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, group_ord, page, block, kind, level, atomic, text): runs, with the paragraphs that directly follow an example, a
    note or a definition made part of it."""
    runs = typed_runs(texts, settings)
    w = Window.partitionBy(*PAGE).orderBy("run")
    head = F.last(F.when(F.col("kind") != "paragraph", F.col("kind")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    opens = ~((F.col("kind") == "paragraph") & F.coalesce(head.isin("example", "note", "definition"), F.lit(False)))
    marked = runs.withColumn("opens", opens).withColumn("block", (F.sum(F.col("opens").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    glued = marked.groupBy(*PAGE, "block").agg(
        F.min_by("kind", "run").alias("kind"), F.min_by("level", "run").alias("level"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "text"))), lambda x: x["text"]), "\n").alias("text")
    )
    return glued.select(*PAGE, "block", "kind", "level", T.is_atomic(F.col("kind")).alias("atomic"), "text")


def split_overlong(blocks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``blocks`` with piece: non-atomic blocks beyond the limit cut at sentence and line ends, and such pieces beyond it by words."""
    most = settings.max_tokens
    over = ~F.coalesce("atomic", F.lit(False)) & (T.count_tokens(F.col("text")) > most)

    def by_words(p):
        w = T.words(p)
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / most).cast("int")), lambda i: F.array_join(F.slice(w, i * most + 1, most), " "))

    cut = F.flatten(F.transform(F.split("text", rf"(?<=[.;])[{T.SPACE}]+|\n+", -1), lambda p: F.when(T.count_tokens(p) > most, by_words(p)).otherwise(F.array(p))))
    pieces = F.when(over, cut).otherwise(F.array("text"))
    return blocks.select(*[c for c in blocks.columns if c != "text"], F.posexplode(pieces).alias("piece", "text"))
