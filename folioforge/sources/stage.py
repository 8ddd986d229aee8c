"""Intermediate tables that cut lineage and survive the loss of an executor."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session; a temporary folder only where that is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        where = tempfile.mkdtemp(prefix="folioforge-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:
        pass


@atexit.register
def drop_written() -> None:
    """Remove the tables that this driver wrote."""
    while _written:
        _drop(*_written.pop())


def table(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: no recomputation, no lineage, column pruning intact."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)
