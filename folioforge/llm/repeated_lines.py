"""Problem 5: lines that come back on a large part of one source's pages."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.store import table
from folioforge.llm.textform import without_accents

_DIGITS = re.compile(r"\d+")
BROADCAST_ROWS = 1_000_000  # (source, line) pairs of 16 to 80 bytes; beyond this the set is joined by shuffle


def line_hashes(text: str | None) -> np.ndarray:
    """A hash per line of ``text`` cut at LF; 0 for blank lines. Lines equal but for case, accents, whitespace and the value of numbers agree."""
    lines = _DIGITS.sub("0", without_accents(text or "")).split("\n")
    out = np.zeros(len(lines), np.int64)
    for i, line in enumerate(lines):
        if parts := line.split():
            out[i] = np.uint64(xxhash.xxh3_64_intdigest(" ".join(parts))).view(np.int64) or 1
    return out


def _compact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"source": b["source"], "page_id": b["page_id"], "lines": [line_hashes(t if isinstance(t, str) else None) for t in b["text"]]})


class Summary:
    """A mergeable heavy-hitter summary (Misra-Gries with batch updates): counts are at most ``error`` too low.

    The capacity follows the mean number of lines a page has, so that ``error`` stays under ``share`` of the pages.
    """

    def __init__(self, share: float):
        self.share, self.counts, self.pages, self.items, self.error = share, {}, 0, 0, 0

    def add(self, pages: list[np.ndarray]) -> None:
        distinct = [x[x != 0] for x in (np.unique(p) for p in pages)]
        self.pages += len(pages)
        values, n = np.unique(np.concatenate(distinct), return_counts=True)
        self.items += int(n.sum())
        counts = self.counts
        for v, c in zip(values.tolist(), n.tolist()):
            counts[v] = counts.get(v, 0) + c
        room = max(64, math.ceil(4 / self.share * self.items / max(1, self.pages)))
        if len(counts) > 2 * room:
            cut = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -room - 1)[-room - 1])
            self.error += cut
            self.counts = {v: c - cut for v, c in counts.items() if c > cut}

    def candidates(self) -> list[tuple[int, int]]:
        """(line, upper bound of its count) of every line that can be on ``share`` of these pages."""
        return [(v, c + self.error) for v, c in self.counts.items() if c + self.error >= self.share * self.pages]


def _heavy(share: float, at_once: int = 512):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, summary, held = None, Summary(share), []

        def close() -> pd.DataFrame:
            if held:
                summary.add(held)
            if summary.error >= share * summary.pages > 0:
                raise ValueError("a summary lost its guarantee")  # excluded by its capacity
            found = summary.candidates()
            return pd.DataFrame({"source": source, "line": np.array([v for v, _ in found], np.int64), "most": np.array([c for _, c in found], np.int64)})

        for b in batches:
            for s, lines in zip(b["source"], b["lines"]):
                if s != source:
                    if summary.pages or held:
                        yield close()
                    source, summary, held = s, Summary(share), []
                held.append(lines)
                if len(held) >= at_once:
                    summary.add(held)
                    held = []
        if summary.pages or held:
            yield close()

    return run


def _small(df: DataFrame) -> DataFrame:
    """``df`` as a broadcast side if its counted size is under the bound, else left to a shuffle join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def compact_lines(pages: DataFrame, source: str, page_id: str, text: str, block_pages: int = 20_000) -> DataFrame:
    """(source, page_id, lines): each page once with its line hashes, as a written table whose files hold runs of one source.

    A source is split into blocks of about ``block_pages`` pages, so that no task gets a hot source whole. Pages without source
    or page_id are left out; a repeated page_id counts once.
    """
    rows = pages.select(F.col(source).alias("source"), F.col(page_id).alias("page_id"), F.col(text).alias("text")).where("source IS NOT NULL AND page_id IS NOT NULL")
    hot = rows.groupBy("source").count().where(F.col("count") > block_pages).select("source", F.ceil(F.col("count") / block_pages).alias("blocks"))
    compact = rows.mapInPandas(_compact, "source string, page_id string, lines array<bigint>")
    compact = compact.join(_small(table(hot)), "source", "left").withColumn("block", F.pmod(F.xxhash64("page_id"), F.coalesce("blocks", F.lit(1)))).drop("blocks")
    once = compact.repartition("source", "block").dropDuplicates(["source", "block", "page_id"])
    return table(once.select("source", "page_id", "lines").sortWithinPartitions("source"))


def repeated_lines(compact: DataFrame, share: float = 0.25, least: int = 5) -> DataFrame:
    """(source, line, pages): line hashes on at least ``share`` of a source's pages and on at least ``least`` of them, exactly.

    A line on ``share`` of all pages of a source is on ``share`` of the pages of at least one part of them; the summary of
    each part keeps every such line. The second pass counts these candidates exactly.
    """
    candidates = table(compact.select("source", "lines").mapInPandas(_heavy(share), "source string, line bigint, most bigint").groupBy("source", "line").agg(F.sum("most").alias("most")).select("source", "line"))
    sizes = compact.groupBy("source").agg(F.count("*").alias("total"))
    exact = (
        compact.select("source", F.explode(F.array_distinct("lines")).alias("line"))
        .where("line <> 0")
        .join(_small(candidates), ["source", "line"], "left_semi")
        .groupBy("source", "line")
        .agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= least)
    )
    return exact.join(sizes, "source").where(F.col("pages") >= F.lit(share) * F.col("total")).select("source", "line", "pages")


def lines_to_remove(pages: DataFrame, source: str = "source", page_id: str = "page_id", text: str = "raw_text", share: float = 0.25, least: int = 5) -> DataFrame:
    """(page_id, line_no): every line to take out, counted from 1 in the text cut at LF. Empty or null texts have no lines to remove."""
    compact = compact_lines(pages, source, page_id, text)
    confirmed = table(repeated_lines(compact, share, least).select("source", "line"))
    lines = compact.select("source", "page_id", F.posexplode("lines").alias("at", "line")).where("line <> 0")
    return lines.join(_small(confirmed), ["source", "line"], "left_semi").select("page_id", (F.col("at") + 1).alias("line_no")).distinct()


def remove_repeated_lines(pages: DataFrame, source: str = "source", page_id: str = "page_id", text: str = "raw_text", share: float = 0.25, least: int = 5) -> DataFrame:
    """Every row of ``pages`` as (source, page_id, text, kept): ``kept`` is the text without the source's repeated lines.

    Other lines stay as they were; null text stays null. Rows without source or page_id keep their text.
    """
    confirmed = table(repeated_lines(compact_lines(pages, source, page_id, text), share, least).groupBy("source").agg(F.collect_set("line").alias("gone")))

    @F.pandas_udf("string")
    def strip(texts: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for t, g in zip(texts, gone):
            if not isinstance(t, str) or g is None:
                out.append(t)
                continue
            drop = np.isin(line_hashes(t), np.asarray(g, np.int64))
            out.append("\n".join(x for x, d in zip(t.split("\n"), drop) if not d))
        return pd.Series(out, dtype=object)

    rows = pages.select(F.col(source).alias("source"), F.col(page_id).alias("page_id"), F.col(text).alias("text"))
    joined = rows.join(_small(confirmed), "source", "left")
    return joined.select("source", "page_id", "text", F.when(F.col("page_id").isNull() | F.col("gone").isNull(), F.col("text")).otherwise(strip("text", "gone")).alias("kept"))
