"""Problem 1: the most similar vectors of every vector, exactly, by comparing blocks of vectors read from one staged table."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.llm.store import table

BLOCK, AT_ONCE = 1_024, 1_024  # stored vectors, and asked ones, of one matrix product
SLICE = 16_384  # vectors asked by one task
KEYS = 1_000  # keys of a class in one row
MARGIN = 1e-5  # more than the rounding of a product of unit vectors in single precision


def _signs(tables: int, size: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(97)).choice(np.array([-1, 1], np.float32), (tables, 3, size))


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """A pseudo-rotation of the rows: three rounds of random signs and a fast Hadamard transform, zero-padded to a power of two."""
    size = signs.shape[1]
    y = np.zeros((len(x), size), np.float32)
    y[:, : x.shape[1]] = x
    for s in signs:
        y *= s
        h = 1
        while h < size:
            z = y.reshape(len(y), -1, 2, h)
            y = np.concatenate((z[:, :, :1] + z[:, :, 1:], z[:, :, :1] - z[:, :, 1:]), axis=2).reshape(len(y), size)
            h *= 2
        y /= np.float32(math.sqrt(size))
    return y


def _packed(row: np.ndarray) -> bytes:
    """The numbers in the fewest bytes that lose nothing."""
    with np.errstate(over="ignore"):
        for kind in (np.float16, np.float32):
            if ((small := row.astype(kind)) == row).all():
                return small.tobytes()
    return row.tobytes()


def _unit(packed: list[bytes], dimension: int) -> np.ndarray:
    """Rows of length 1 from packed ones."""
    x, widths = np.empty((len(packed), dimension)), np.fromiter(map(len, packed), np.int64, len(packed)) // dimension
    for width, kind in ((2, np.float16), (4, np.float32), (8, np.float64)):
        if len(at := np.flatnonzero(widths == width)):
            x[at] = np.frombuffer(b"".join([packed[i] for i in at.tolist()]), kind).reshape(-1, dimension)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _usable(dimension: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, nodes, rows = [], [], []
            for k, e in zip(b["key"], b["embedding"]):
                if e is None or len(e) != dimension:
                    continue
                v = np.asarray(e, np.float64)
                with np.errstate(over="ignore"):
                    n = np.sqrt((v * v).sum()) if np.isfinite(v).all() else 0.0
                if n > 0 and np.isfinite(n):
                    ids.append(k)
                    nodes.append(np.uint64(xxhash.xxh3_64_intdigest(np.round(v / n * 1e5).astype(np.int32).tobytes())).view(np.int64))
                    rows.append(_packed(v))
            yield pd.DataFrame({"key": ids, "node": nodes, "vector": rows})

    return run


def _classes(most: int):
    """From rows by node and key, a row for each ``most`` keys of a node, with the vector of the first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, part, keys, vector, done = None, 0, [], None, []
        for b in batches:
            for n, k, v in zip(b["node"].tolist(), b["key"].tolist(), b["vector"]):
                if n != node or len(keys) == most:
                    if keys:
                        done.append((node, part, keys, vector))
                    node, part, keys, vector = n, part + 1 if n == node else 0, [], vector if n == node else v
                keys.append(k)
            yield pd.DataFrame(done, columns=["node", "part", "keys", "vector"])
            done = []
        if keys:
            yield pd.DataFrame([(node, part, keys, vector)], columns=["node", "part", "keys", "vector"])

    return run


def _stored(files: list[tuple[str, int]], size: int, first: int, end: int) -> Iterator[pd.DataFrame]:
    """The staged rows from ``first`` to before ``end``, in batches."""
    at = 0
    for uri, rows in files:
        if at >= end or at + rows <= first:
            at += rows
            continue
        where, path = fs.FileSystem.from_uri(uri)
        with where.open_input_file(path) as f:
            for b in pq.ParquetFile(f).iter_batches(batch_size=size, columns=["node", "part", "keys", "vector"]):
                lo, hi = max(first - at, 0), min(end - at, len(b))
                at += len(b)
                if lo < hi:
                    yield b.slice(lo, hi - lo).to_pandas()


def _axes(dimension: int) -> np.ndarray:
    """Orthonormal axes, as columns, in which vectors that lie along few of the given ones spread over many."""
    return np.linalg.qr(rotate(np.eye(dimension, dtype=np.float32), _signs(1, 1 << (dimension - 1).bit_length())[0])[:, :dimension].astype(np.float64))[0].astype(np.float32)


def _true(mask: np.ndarray) -> np.ndarray:
    """np.flatnonzero of a mask with few true entries, eight at a time."""
    flat = mask.ravel()
    n = len(flat) // 8 * 8
    at = (np.flatnonzero(flat[:n].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate((at[flat[at]], n + np.flatnonzero(flat[n:])))


class _Best:
    """The ``k`` best other classes of each of the asked rows, as (minus cosine, smallest key, keys), in that order."""

    def __init__(self, asked: pd.DataFrame, dimension: int, k: int, least: float, axes: np.ndarray) -> None:
        self.k, self.least, self.axes, self.half = k, least, axes, dimension // 2
        self.node, self.unit = asked["node"].to_numpy(), _unit(asked["vector"].tolist(), dimension)
        self.x = self.unit.astype(np.float32)
        self.short = self.shorter(self.x) if least > 0.7 else None
        self.kth = np.full(len(asked), least)  # what a class must reach to count
        self.best: list[list[tuple]] = [[] for _ in range(len(asked))]
        self.own = dict.fromkeys(self.node.tolist(), ())

    def shorter(self, x: np.ndarray) -> np.ndarray:
        """Half of the rotated axes, and the length of the rest: products of these are never less than the cosines."""
        y = x @ self.axes
        return np.concatenate((y[:, : self.half], np.sqrt((y[:, self.half :] ** 2).sum(1, keepdims=True))), axis=1)

    def hits(self, s: slice, data: np.ndarray, short: np.ndarray | None, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The (asked, stored) pairs of a tile that may reach the floors."""
        rows = s.stop - s.start
        if short is not None:
            mask = self.short[s] @ short.T >= floor[s, None]
            if np.count_nonzero(mask) <= 0.02 * mask.size:
                return np.divmod(_true(mask), len(data))
        tile = self.x[s] @ data.T
        mask = tile >= floor[s, None]
        if tile.shape[1] > self.k + 1 and np.count_nonzero(mask) > 8 * self.k * rows:  # k stored ones of the tile, and itself perhaps, reach this
            np.maximum(floor[s], np.partition(tile, -(self.k + 1), axis=1)[:, -(self.k + 1)] - np.float32(2 * MARGIN), out=floor[s])
            mask = tile >= floor[s, None]
        return np.divmod(_true(mask), len(data))

    def add(self, stored: pd.DataFrame) -> None:
        node, unit = stored["node"].to_numpy(), _unit(stored["vector"].tolist(), self.unit.shape[1])
        x = unit.astype(np.float32)
        short = None if self.short is None else self.shorter(x)
        keys = [tuple(v[: self.k + 1]) for v in stored["keys"]]
        for i in np.flatnonzero(np.isin(node, self.node)).tolist():
            self.own[int(node[i])] = keys[i]
        floor, found = (self.kth - MARGIN).astype(np.float32), []
        for d in range(0, len(x), BLOCK):
            for q in range(0, len(self.x), AT_ONCE):
                i, j = self.hits(slice(q, min(q + AT_ONCE, len(self.x))), x[d : d + BLOCK], None if short is None else short[d : d + BLOCK], floor)
                for a in range(0, len(i), 65_536):
                    qi, dj = i[a : a + 65_536] + q, j[a : a + 65_536] + d
                    cosine = np.einsum("ij,ij->i", self.unit[qi], unit[dj])
                    keep = (cosine >= np.maximum(self.kth[qi], floor[qi].astype(np.float64))) & (self.node[qi] != node[dj])
                    found.append((qi[keep], dj[keep], cosine[keep]))
        qi, dj, cosine = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        order = np.argsort(qi, kind="stable")
        qi, dj, cosine = qi[order], dj[order].tolist(), (-cosine[order]).tolist()
        edges = np.flatnonzero(np.concatenate(([True], qi[1:] != qi[:-1], [True]))).tolist() if len(qi) else [0]
        for s, e in zip(edges[:-1], edges[1:]):
            r = int(qi[s])
            best = self.best[r] + [(c, keys[j][0], keys[j]) for c, j in zip(cosine[s:e], dj[s:e])]
            best.sort(key=lambda x: x[:2])
            del best[self.k :]
            self.best[r] = best
            if len(best) == self.k:
                self.kth[r] = max(self.least, -best[-1][0])


def _searched(files: list[tuple[str, int]], size: int, dimension: int, k: int, least: float, axes: np.ndarray):
    """For each number of a slice of the staged rows, the neighbours of all keys in it; every task reads all vectors, some at a time."""
    total = sum(n for _, n in files)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for n in (n for b in batches for n in b["id"].tolist()):
            asked = pd.concat(list(_stored(files, SLICE, n * size, (n + 1) * size)), ignore_index=True)
            best = _Best(asked, dimension, k, least, axes)
            for stored in _stored(files, 16 * BLOCK, 0, total):
                if len(stored := stored[stored["part"] == 0]):
                    best.add(stored)
            out = []
            for node, members, others in zip(best.node.tolist(), asked["keys"], best.best):
                near = sorted([(-1.0, x) for x in best.own[node]] + [(c, x) for c, _, keys in others for x in keys])
                for key in members:
                    out += [(key, r, x, -c) for r, (c, x) in enumerate([p for p in near[: len(best.own[node]) + k + 1] if p[1] != key][:k], 1)]
                if len(out) > 100_000:
                    yield pd.DataFrame(out, columns=["key", "rank", "neighbour", "cosine"])
                    out = []
            yield pd.DataFrame(out, columns=["key", "rank", "neighbour", "cosine"])

    return run


def nearest_vectors(df: DataFrame, key: str = "chunk_id", embedding: str = "embedding", k: int = 10, dimension: int = 96, probes: int | None = None, least: float = -2.0) -> DataFrame:
    """(key, rank, neighbour, cosine): for every usable embedding the ``k`` keys most nearly in its direction, itself left out.

    Null, zero, non-finite and wrongly sized embeddings and null keys take no part; a repeated key counts once; ties go by
    key. Vectors of one direction are one class: they are stored and asked once, and the k smallest keys of a class stand for
    it. Classes are written once, in the fewest bytes that lose nothing; each task reads a slice of them to ask and all of
    them block by block, so nothing is copied per block and no vector is left out. With ``least``, only neighbours of at
    least that cosine come out, and most pairs are ruled out by a bound from half of their rotated axes. The search is exact
    without ``probes``, which is kept for callers and changes nothing.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(embedding).alias("embedding")).where("key IS NOT NULL AND embedding IS NOT NULL")
    kind = dict(rows.dtypes)["key"]
    base = rows.mapInPandas(_usable(dimension), f"key {kind}, node bigint, vector binary").dropDuplicates(["key"])
    classes = table(base.repartition("node").sortWithinPartitions("node", "key").mapInPandas(_classes(max(KEYS, k + 1)), f"node bigint, part int, keys array<{kind}>, vector binary"))
    counts = classes.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
    files = sorted((r["file"], r["count"]) for r in counts)
    total = sum(n for _, n in files)
    size = min(SLICE, max(256, math.ceil(total / (2 * spark.sparkContext.defaultParallelism))))
    parts = math.ceil(total / size)
    out = spark.range(0, parts, 1, max(1, parts)).mapInPandas(_searched(files, size, dimension, k, least, _axes(dimension)), f"key {kind}, rank int, neighbour {kind}, cosine double")
    return out.where(F.col("cosine") >= least).withColumnRenamed("key", key)


def similar_pairs(near: DataFrame, key: str, least: float) -> DataFrame:
    """(key_a, key_b), smaller first, of the neighbours with a cosine of at least ``least``."""
    return near.where(F.col("cosine") >= least).select(F.least(key, "neighbour").alias("key_a"), F.greatest(key, "neighbour").alias("key_b")).distinct()


def recall(df: DataFrame, near: DataFrame, key: str = "chunk_id", embedding: str = "embedding", k: int = 10, dimension: int = 96, one_in: int = 100, at_once: int = 4_096) -> DataFrame:
    """(queries, wanted, found, recall): against brute force for the keys whose hash is divisible by ``one_in``, asked of all rows in blocks."""
    rows = df.select(F.col(key).alias("key"), F.col(embedding).alias("embedding")).where("key IS NOT NULL AND embedding IS NOT NULL")
    kind = dict(rows.dtypes)["key"]
    base = table(rows.mapInPandas(_usable(dimension), f"key {kind}, node bigint, vector binary").dropDuplicates(["key"]))
    asked = base.where(F.pmod(F.xxhash64("key"), F.lit(one_in)) == 0)
    parts, out = max(1, math.ceil(asked.count() / at_once)), None
    for p in range(parts):
        held = asked.where(F.pmod("node", F.lit(parts)) == p).collect()
        ids, x = [r["key"] for r in held], _unit([r["vector"] for r in held], dimension).astype(np.float32)

        def run(batches: Iterator[pd.DataFrame], ids=ids, x=x) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b) or not len(ids):
                    continue
                cosine = x @ _unit(b["vector"].tolist(), dimension).astype(np.float32).T
                top = np.argsort(-cosine, axis=1)[:, : k + 1]
                yield pd.DataFrame({"key": np.repeat(np.array(ids, object), top.shape[1]), "neighbour": b["key"].to_numpy()[top.ravel()], "cosine": np.take_along_axis(cosine, top, 1).ravel().astype(np.float64)})

        best = base.mapInPandas(run, f"key {kind}, neighbour {kind}, cosine double").where("key <> neighbour")
        best = best.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("cosine"), "neighbour"))).where(F.col("n") <= k)
        out = best if out is None else out.unionAll(best)
    floor = out.groupBy("key").agg(F.count("*").alias("wanted"), F.min("cosine").alias("least"))
    got = near.select(F.col(key).alias("key"), "cosine").join(floor, "key").where(F.col("cosine") >= F.col("least") - 1e-6).groupBy("key").agg(F.count("*").alias("found"))
    both = floor.join(got, "key", "left").select("wanted", F.least("wanted", F.coalesce("found", F.lit(0))).alias("found"))
    return both.agg(F.count("*").alias("queries"), F.sum("wanted").alias("wanted"), F.sum("found").alias("found")).withColumn("recall", F.col("found") / F.col("wanted"))
