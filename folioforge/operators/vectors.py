"""A table of vectors with exact search by inner product of unit vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_BLOCK = 256  # queries of a batch search scored at a time against a batch of rows


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(vector: Column) -> Column:
    """The vector divided by its length; a zero vector as it is."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(vector, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(x.cast("double")))


def check_dimension(df: DataFrame, dimension: int, column: str = "embedding") -> DataFrame:
    """``df``, failing when read if a vector is null or has another size."""
    fits = F.coalesce(F.size(column) == dimension, F.lit(False))
    return df.withColumn(column, F.when(fits, F.col(column)).otherwise(F.raise_error(F.concat(F.lit(f"a vector does not have {dimension} numbers: "), F.size(column).cast("string")))))


def append_vectors(store: DataFrame, more: DataFrame) -> DataFrame:
    """Both tables' rows: repeats stay."""
    return store.unionByName(more)


def top_k(store: DataFrame, query: list[float], k: int = 5, key: str = "chunk_id", column: str = "embedding", where: Column | None = None) -> DataFrame:
    """The ``k`` rows of ``store`` nearest to ``query``, with score, best first; ties by key. Fewer rows give fewer hits."""
    rows = store.where(where) if where is not None else store
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = rows.where(F.size(column) == len(query)).withColumn("score", inner_product(unit(F.col(column)), unit(q)))
    return scored.orderBy(F.desc("score"), key).limit(k)


def top_k_batch(store: DataFrame, queries: list[tuple], k: int = 5, key: str = "chunk_id", column: str = "embedding") -> DataFrame:
    """(query, rank, key, score) for a list of (query, vector): one matrix product per batch of rows and block of queries, of which only
    the best ``k`` of each query leave it. The vectors of the queries must fit a task, their scores need not."""
    names = [q for q, _ in queries]
    matrix = np.array([v for _, v in queries], np.float64).reshape(len(queries), -1)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = np.divide(matrix, length, out=matrix.copy(), where=length > 0)
    rows = store.select(F.col(key).alias("key"), F.col(column).alias("vector")).where(F.size(column) == matrix.shape[1])
    kind = dict(rows.dtypes)["key"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = np.stack(b["vector"].to_numpy()).astype(np.float64)
            n = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, n, out=x.copy(), where=n > 0).T
            ids = b["key"].to_numpy()
            by_key = np.argsort(ids, kind="stable")
            for at in range(0, len(matrix), QUERY_BLOCK):
                score = matrix[at : at + QUERY_BLOCK] @ x
                top = by_key[np.argsort(-score[:, by_key], axis=1, kind="stable")[:, :k]]
                yield pd.DataFrame({"query": np.repeat(np.arange(at, at + len(top)), top.shape[1]), "key": ids[top.ravel()], "score": np.take_along_axis(score, top, 1).ravel()})

    best = rows.mapInPandas(run, f"query int, key {kind}, score double")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))).where(F.col("rank") <= k)
    named = store.sparkSession.createDataFrame(list(enumerate(names)), ["at", "name"])
    return ranked.join(named, F.col("query") == F.col("at")).select(F.col("name").alias("query"), "rank", F.col("key").alias(key), "score")
