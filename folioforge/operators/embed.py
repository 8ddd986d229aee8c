"""Embedding of texts behind one interface, with a model that needs no files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Embedder(Protocol):
    """Texts to unit vectors; ``name`` is stored beside the vectors, and a search with another model is refused."""

    name: str
    dimension: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEmbedder:
    """Signed hashing of words into a fixed number of places, scaled to length 1; a text without words is a zero vector."""

    def __init__(self, dimension: int = 256):
        self.dimension, self.name, self._places = dimension, f"hashing-{dimension}", {}

    def _place(self, word: str) -> tuple[int, float]:
        if word not in self._places:
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
            self._places[word] = (h >> 1) % self.dimension, 1.0 if h & 1 else -1.0
        return self._places[word]

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for row, text in zip(out, texts):
            for word in re.findall(r"[^\W_]+", (text or "").lower()):
                place, sign = self._place(word)
                row[place] += sign
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, length, out=out, where=length > 0)


def embed(df: DataFrame, embedder: Embedder, text: str = "text") -> DataFrame:
    """``df`` with embedding and model; the embedder comes to each worker once."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(list(embedder.encode(b.fillna("").tolist())))

    return df.withColumn("embedding", encode(text)).withColumn("model", F.lit(embedder.name))


def embedding_records(chunks: DataFrame, embedder: Embedder) -> DataFrame:
    """(chunk_id, text, metadata, embedding, model); the id may stand at the top or only in the metadata."""
    key = F.coalesce("chunk_id", "metadata.chunk_id") if "chunk_id" in chunks.columns else F.col("metadata.chunk_id")
    return embed(chunks.select(key.alias("chunk_id"), "text", "metadata"), embedder)
