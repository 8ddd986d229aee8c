"""Documents to validated chunks: the stages put together."""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.config import DEFAULT, Settings
from folioforge.operators import blocks, chunks, pages, report, structure, validate
from folioforge.sources.stage import table


@dataclass
class Ingested:
    pages: DataFrame
    groups: DataFrame
    blocks: DataFrame
    chunks: DataFrame
    findings: DataFrame
    report: DataFrame


def numbered_blocks(cleaned: DataFrame, grouped: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, group_ord, ord, page, block, piece, kind, level, atomic, text): all blocks of a group in order, overlong ones cut."""
    text = pages.text_for_chunking(F.col("cleaned_text"), F.col("raw_text"))
    texts = cleaned.join(grouped.select("source", "page_number", "group_ord"), ["source", "page_number"]).select("source", "group_ord", F.col("page_number").alias("page"), text.alias("text"))
    cut = blocks.split_overlong(blocks.split_into_blocks(texts, settings), settings)
    order = F.col("page").cast("bigint") * 2**40 + F.col("block").cast("bigint") * 2**20 + F.col("piece")
    return cut.withColumn("ord", order)


def ingest(raw_pages: DataFrame, settings: Settings = DEFAULT) -> Ingested:
    """All results of a table of pages (source, page_number, raw_text). What several stages read is written once."""
    cleaned = table(pages.clean_pages(pages.pages_of(raw_pages, settings), settings))
    heads = table(structure.page_heads(cleaned, settings))
    grouped = table(structure.page_groups(structure.page_chapters(structure.page_titles(heads, settings)), settings))
    groups = structure.groups_of(grouped, structure.doc_types(heads, settings))
    parts = table(numbered_blocks(cleaned, grouped, settings))
    made = table(chunks.assemble(parts, groups, settings))
    found = validate.findings(cleaned, made, settings)
    return Ingested(cleaned, groups, parts, made, found, report.ingestion_report(cleaned, groups, made, found))


def main(argv: list[str] | None = None) -> None:
    """Ingest documents from the command line: ``python -m folioforge.plans.pipeline OUT FILE...``."""
    from folioforge.sources.pages import read_documents, read_text_pages
    from folioforge.sources.sinks import write_chunks, write_reports

    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("out")
    parser.add_argument("files", nargs="+")
    parser.add_argument("--max-pages", type=int, default=0)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    settings = Settings(max_pages=args.max_pages)
    texts = [f for f in args.files if f.endswith(".txt")]
    parts = [read_text_pages(spark, f) for f in texts] + [read_documents(spark, others, max_pages=args.max_pages)] if (others := [f for f in args.files if f not in texts]) else [read_text_pages(spark, f) for f in texts]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    done = ingest(rows, settings)
    write_chunks(done.chunks, f"{args.out}/chunks")
    write_reports(done.report, f"{args.out}/reports")
    for row in done.report.orderBy("source").toLocalIterator():
        print(report.format_report(row.asDict(recursive=True)))


if __name__ == "__main__":
    main()
