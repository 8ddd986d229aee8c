"""Writers of chunks, vectors and reports."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunk records as JSON lines, a folder per source; null fields stay in, and chunk_id stands at the top too."""
    chunks.select("source", "chunk_id", "chunk_index", "text", "metadata").write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("source").json(path)


def write_vectors(records: DataFrame, path: str, form: str = "parquet") -> None:
    writer = records.write.mode("overwrite")
    writer.parquet(path) if form == "parquet" else writer.option("ignoreNullFields", "false").json(path)


def write_reports(report: DataFrame, path: str) -> None:
    """Report rows as JSON, a folder per source."""
    report.withColumn("document", F.col("source")).write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("document").json(path)


def save_report_files(report: DataFrame, folder: str) -> list[str]:
    """A readable JSON file per source in a local folder, rows fetched one by one."""
    os.makedirs(folder, exist_ok=True)
    out = []
    for row in report.toLocalIterator():
        path = os.path.join(folder, f"report_{os.path.splitext(row['source'])[0]}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(row.asDict(recursive=True), f, ensure_ascii=False, indent=2)
        out.append(path)
    return out
