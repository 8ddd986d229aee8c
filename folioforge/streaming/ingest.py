"""Whole documents as they arrive: a batch plan per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from folioforge.config import DEFAULT, Settings
from folioforge.plans.pipeline import ingest

PAGES = "source string, page_number int, raw_text string"


def ingest_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, settings: Settings = DEFAULT, trigger: dict | None = None) -> StreamingQuery:
    """Ingest page files (Parquet) of ``folder`` as they appear and append chunks and reports under ``out``.

    Cleaning needs all pages of a document, so a document's pages must arrive in one micro-batch, e.g. as one file. A
    repeated batch overwrites its own folder, so each batch counts once.
    """

    def one(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            done = ingest(rows, settings)
            done.chunks.write.mode("overwrite").parquet(f"{out}/chunks/batch={number}")
            done.report.write.mode("overwrite").parquet(f"{out}/reports/batch={number}")
        finally:
            rows.unpersist()

    stream = spark.readStream.schema(PAGES).parquet(folder)
    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
