"""Problem 3: near-duplicate texts by banded candidates and sequential Bayesian verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.components import components
from folioforge.llm.store import table
from folioforge.llm.textform import word_bytes

BROADCAST_ROWS = 500_000  # rows of two numbers or of a key and a number
ALL_PAIRS_OF_COPIES = 64  # copies of one stored title and text beyond this are linked to the smallest key instead of to each other


class WordHashes(dict):
    """64-bit hashes of words, kept for the words of late."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def shingle_hashes(found: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; a text with fewer words is one shingle, one without words has none."""
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if len(h) == 0:
        return h
    size = min(size, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for i in range(size):
        out = (out ^ h[i : len(h) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def _seeds(n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, n, dtype=np.uint64)


def signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Minimum hash of the shingles under each seed."""
    low = np.full(len(seeds), 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(low, ((shingles[i : i + 512, None] ^ seeds) * np.uint64(0xD6E8FEB86659FD93)).min(0), out=low)
    return low


def _sketches(bands: int, rows: int, size: int, least_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, seeds = WordHashes(), _seeds(bands * rows)
        weights = _seeds(rows + 1)[1:] | np.uint64(1)
        salt = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for b in batches:
            out = []
            for key, title, text in zip(b["key"], b["title"], b["text"]):
                own = word_bytes(text)
                if len(own) < least_words:
                    continue
                sh = shingle_hashes(word_bytes(title) + own, size, hashes)
                raw = sh.tobytes()
                low = signature(sh, seeds)
                band = ((low.reshape(bands, rows) ^ (low.reshape(bands, rows) >> np.uint64(31))) * weights).sum(1, dtype=np.uint64) ^ salt
                band = (band ^ (band >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                stored = xxhash.xxh3_64_intdigest(f"{title is None}\0{title}\0{text}".encode("utf-8", "surrogatepass")) >> 1
                out.append((key, stored, np.uint64(xxhash.xxh3_64_intdigest(raw)).view(np.int64), xxhash.xxh3_64_intdigest(raw, 7) >> 1, (((low ^ (low >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes(), band.view(np.int64)))
            yield pd.DataFrame(out, columns=["key", "stored", "node", "check", "signature", "bands"])

    return run


def _bucket_pairs(cap: int):
    """Pairs of each run of equal band; of a run longer than ``cap`` its members, each with a null partner."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, held_band, hot = np.zeros(0, np.int64), None, False

        def close(nodes: np.ndarray, band: int, hot: bool) -> pd.DataFrame | None:
            if hot or len(nodes) > cap:
                return pd.DataFrame({"band": band, "a": nodes, "b": pd.array([None] * len(nodes), "Int64")})
            if len(nodes) < 2:
                return None
            nodes = np.unique(nodes)
            i, j = np.triu_indices(len(nodes), 1)
            return pd.DataFrame({"band": band, "a": nodes[i], "b": pd.array(nodes[j], "Int64")})

        for b in batches:
            band, node = b["band"].to_numpy(), b["node"].to_numpy()
            if not len(band):
                continue
            starts = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
            ends = np.r_[starts[1:], len(band)]
            out = []
            for k in np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == 0) | (np.arange(len(starts)) == len(starts) - 1)).tolist():
                s, e = starts[k], ends[k]
                if held_band is not None and (k > 0 or band[s] != held_band):
                    if (x := close(held, held_band, hot)) is not None:
                        out.append(x)
                    held, held_band, hot = np.zeros(0, np.int64), None, False
                if k == len(starts) - 1 or (k == 0 and held_band is not None):
                    held, held_band = np.r_[held, node[s:e]], band[s]
                    if len(held) > cap:  # give the members away: a run has no bound
                        out.append(close(held, held_band, True))
                        held, hot = np.zeros(0, np.int64), True
                    if k < len(starts) - 1:
                        if (x := close(held, held_band, hot)) is not None:
                            out.append(x)
                        held, held_band, hot = np.zeros(0, np.int64), None, False
                elif (x := close(node[s:e], band[s], False)) is not None:
                    out.append(x)
            if out:
                yield pd.concat(out, ignore_index=True)
        if held_band is not None and (x := close(held, held_band, hot)) is not None:
            yield x

    return run


def least_matches(n: int, threshold: float, miss: float) -> int:
    """The fewest equal places of ``n`` at which the posterior probability of a similarity of at least ``threshold`` is ``miss`` or more.

    Places of one byte agree with probability s + (1 - s) / 256; the prior of that probability is uniform.
    """
    p = threshold + (1 - threshold) / 256
    total = 0.0
    for m in range(n + 1):
        total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(p) + (n + 1 - m) * math.log1p(-p))
        if total >= miss:
            return m
    return n


def _verify(places: int, batch: int, threshold: float, miss: float):
    bounds = [(i, min(i + batch, places), least_matches(min(i + batch, places), threshold, miss)) for i in range(0, places, batch)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = np.frombuffer(b"".join(b["sa"]), np.uint8).reshape(len(b), places)
            y = np.frombuffer(b"".join(b["sb"]), np.uint8).reshape(len(b), places)
            alive, equal = np.arange(len(b)), np.zeros(len(b), np.int32)
            for lo, hi, least in bounds:  # the next batch of places only for pairs still alive
                equal = equal + (x[alive, lo:hi] == y[alive, lo:hi]).sum(1)
                keep = equal >= least
                alive, equal = alive[keep], equal[keep]
            yield b[["a", "b"]].iloc[alive]

    return run


def _exact(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for a, c, x, y in zip(b["a"], b["b"], b["sa"], b["sb"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both >= threshold * (len(x) + len(y) - both):
                    out.append((a, c, both / (len(x) + len(y) - both)))
            yield pd.DataFrame(out, columns=["a", "b", "likeness"])

    return run


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def near_duplicates(
    df: DataFrame,
    key: str = "chunk_id",
    title: str | None = "slide_title",
    text: str = "text",
    threshold: float = 0.6,
    size: int = 3,
    least_words: int = 20,
    bands: int = 40,
    rows: int = 4,
    miss: float = 1e-4,
    cap: int = 200,
) -> tuple[DataFrame, DataFrame]:
    """(members, links): members (key, node, stored) gives each text's class of copies (by shingle set) and the hash of its title and
    text as stored, in which copies of a class may differ; links (a, b, likeness) gives the pairs of classes whose sets of ``size``-word shingles overlap by at least ``threshold``.

    Title (empty if null) and text count together; texts of fewer than ``least_words`` words, null texts and null keys take no
    part; a repeated key counts once. Sketches are made once and written; only classes meet, so copies cost nothing. A bucket
    beyond ``cap`` is cut into blocks whose pairs of blocks are joined on their own, so no task or driver gets it whole and no
    pair is lost. Candidates are verified batch by batch of signature places; survivors exactly, from their whole texts.
    """
    base = df.select(F.col(key).alias("key"), (F.col(title) if title else F.lit("")).alias("title"), F.col(text).alias("text")).where("key IS NOT NULL AND text IS NOT NULL")
    kind = dict(base.dtypes)["key"]
    sketch = table(base.mapInPandas(_sketches(bands, rows, size, least_words), f"key {kind}, stored bigint, node bigint, check bigint, signature binary, bands array<bigint>"))
    members = sketch.groupBy("key", "node").agg(F.min("stored").alias("stored"))
    nodes = table(sketch.select("node", "signature", "bands").dropDuplicates(["node"]))
    banded = nodes.select("node", F.explode("bands").alias("band")).repartition("band").sortWithinPartitions("band")
    found = table(banded.select("band", "node").mapInPandas(_bucket_pairs(cap), "band bigint, a bigint, b bigint"))
    hot = found.where("b IS NULL").select("band", "a")
    sized = hot.join(hot.groupBy("band").agg(F.ceil(F.count("*") / cap).cast("int").alias("blocks")), "band").withColumn("block", F.pmod(F.hash("a"), F.col("blocks")))
    left = sized.select("band", "a", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    right = sized.select("band", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"), F.col("block").alias("j"))
    of_blocks = left.join(right, ["band", "i", "j"]).where("i < j OR a < b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = found.where("b IS NOT NULL").select("a", "b").unionAll(of_blocks).distinct()
    sa = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    sb = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    alive = table(pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInPandas(_verify(bands * rows, 32, threshold, miss), "a bigint, b bigint"))
    wanted = alive.select(F.col("a").alias("node")).union(alive.select("b")).distinct()
    chosen = table(members.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key")))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            yield pd.DataFrame({"node": b["node"], "shingles": [shingle_hashes(word_bytes(t) + word_bytes(x), size, hashes).tobytes() for t, x in zip(b["title"], b["text"])]})

    whole = table(base.join(_bounded(chosen), "key").select("node", F.coalesce("title", F.lit("")).alias("title"), "text").mapInPandas(sets, "node bigint, shingles binary").dropDuplicates(["node"]))
    sa = whole.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    sb = whole.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    links = table(alive.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInPandas(_exact(threshold), "a bigint, b bigint, likeness double"))
    return members, links


def near_duplicate_pairs(df: DataFrame, key: str = "chunk_id", **options) -> DataFrame:
    """(key_a, key_b), smaller first: the links between different texts and between copies, for every pair of keys.

    Of a stored title and text with more than ALL_PAIRS_OF_COPIES copies the smallest key stands for the others: it carries the
    links, and each copy is linked to it. Texts stored differently are linked all the same, also where their shingles are equal.
    """
    members, links = near_duplicates(df, key, **options)
    sized = members.groupBy("node", "stored").agg(F.count("*").alias("n"), F.min("key").alias("first"))
    several = sized.groupBy("node").agg(F.sum("n").alias("n")).where("n > 1").select("node")
    linked = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    busy = table(members.join(linked.unionAll(several).distinct(), "node", "left_semi").join(sized.where(f"n > {ALL_PAIRS_OF_COPIES}"), ["node", "stored"], "left"))
    standing = busy.where("n IS NULL OR key = first").select("node", "key")
    a, b = standing.select(F.col("node").alias("a"), F.col("key").alias("x")), standing.select(F.col("node").alias("b"), F.col("key").alias("y"))
    between = links.join(a, "a").join(b, "b").select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))
    within = standing.select("node", F.col("key").alias("key_a")).join(standing.select("node", F.col("key").alias("key_b")), "node").where("key_a < key_b").select("key_a", "key_b")
    many = busy.where("key > first").select(F.col("first").alias("key_a"), F.col("key").alias("key_b"))
    return between.unionAll(within).unionAll(many).distinct()


def near_duplicate_groups(df: DataFrame, key: str = "chunk_id", **options) -> DataFrame:
    """One row per key that takes part: (key, class, copies, links): the smallest key of its group, the copies of its text (itself
    included) and the number of different texts linked to it."""
    members, links = near_duplicates(df, key, **options)
    classes = components(links.select("a", "b"))
    degree = links.select(F.col("a").alias("node")).unionAll(links.select("b")).groupBy("node").agg(F.count("*").alias("links"))
    per_node = members.groupBy("node").agg(F.count("*").alias("copies"), F.min("key").alias("least")).join(classes, "node", "left").join(degree, "node", "left")
    per_node = per_node.select("node", "copies", "least", F.coalesce("class", "node").alias("class_node"), F.coalesce("links", F.lit(0)).alias("links"))
    names = per_node.groupBy("class_node").agg(F.min("least").alias("class"))
    return members.join(per_node.join(names, "class_node").select("node", "class", "copies", "links"), "node").select("key", "class", "copies", "links")
