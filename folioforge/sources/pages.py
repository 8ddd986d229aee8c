"""Readers of pages, chunks and vectors."""

from __future__ import annotations

import glob
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA = "struct<chunk_id:string,source:string,page_start:int,page_end:int,chapter:string,slide_title:string,section:string,subsection:string,content_type:string,has_code:boolean,chunk_index:int,token_count:int,pages:array<int>,content:string,code_blocks:int>"
CHUNK = f"chunk_id string, chunk_index int, text string, metadata {METADATA}"
VECTOR = f"chunk_id string, text string, metadata {METADATA}, embedding array<float>, model string"


def pdf_page_texts(data: bytes) -> Iterator[str]:
    """Texts of a PDF's pages, "" where a page cannot be read; needs the optional library pypdf."""
    import io

    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise ImportError("reading PDF files needs pypdf; pass another extractor") from e
    for page in PdfReader(io.BytesIO(data)).pages:
        try:
            yield page.extract_text() or ""
        except Exception:
            yield ""


def existing(paths: list[str]) -> tuple[list[str], list[str]]:
    """Local paths or patterns that exist, and those that do not."""
    there = [p for p in paths if glob.glob(p)]
    return there, [p for p in paths if p not in there]


def read_documents(spark: SparkSession, paths: list[str], extract: Callable[[bytes], Iterator[str]] = pdf_page_texts, max_pages: int = 0) -> DataFrame:
    """(source, page_number, raw_text): the pages of binary documents, read in parallel by file; missing paths are printed and skipped.

    ``source`` is the file's name, pages count from 1; reading stops after ``max_pages`` of a document if that is set.
    """
    there, missing = existing(paths)
    for p in missing:
        print(f"not found, skipped: {p}")
    if not there:
        return spark.createDataFrame([], "source string, page_number int, raw_text string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                rows = []
                for n, text in enumerate(extract(content), 1):
                    rows.append((path.rsplit("/", 1)[-1], n, text or ""))
                    if n == max_pages:
                        break
                yield pd.DataFrame(rows, columns=["source", "page_number", "raw_text"])

    files = spark.read.format("binaryFile").load(there).select("path", "content")
    return files.mapInPandas(run, "source string, page_number int, raw_text string")


def read_text_pages(spark: SparkSession, path: str, page_break: str = "\f") -> DataFrame:
    """Pages of text files, divided at form feeds."""
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source"), "value")
    return files.select("source", F.posexplode(F.split("value", page_break)).alias("at", "raw_text")).select("source", (F.col("at") + 1).alias("page_number"), "raw_text")


def pages_from_documents(documents: DataFrame, source: str = "source", order: str = "doc_id", text: str = "text") -> DataFrame:
    """A table of texts as pages: within a source, texts are numbered in the given order; numbers come from rows without texts."""
    from pyspark.sql.window import Window

    rows = documents.where(F.col(source).isNotNull()).select(F.col(source).alias("source"), F.col(order).alias("order"), F.col(text).alias("raw_text"))
    numbered = rows.select("source", "order").withColumn("page_number", F.row_number().over(Window.partitionBy("source").orderBy("order")))
    return rows.join(numbered, ["source", "order"]).select("source", "page_number", "raw_text")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk records, one JSON object a line; blank lines are skipped, and the id is taken from the metadata where the top has none."""
    rows = spark.read.schema(CHUNK).json(path)
    return rows.withColumn("chunk_id", F.coalesce("chunk_id", "metadata.chunk_id"))


def read_vectors(spark: SparkSession, path: str, dimension: int | None = None) -> DataFrame:
    """Vector records of JSON lines or Parquet; a wrong size fails."""
    rows = spark.read.parquet(path) if os.path.splitext(path.rstrip("/"))[1] == ".parquet" else spark.read.schema(VECTOR).json(path)
    if dimension is None:
        return rows
    from folioforge.operators.vectors import check_dimension

    return check_dimension(rows, dimension)
