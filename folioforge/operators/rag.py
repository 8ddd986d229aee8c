"""Questions answered from retrieved passages."""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.embed import Embedder
from folioforge.operators.vectors import top_k

PROMPT = "Réponds à la question avec les seuls extraits de cours ci-dessous ; s'ils ne suffisent pas, dis-le.\n\nExtraits :\n{context}\n\nQuestion : {question}\n\nRéponse :"


class TextModel(Protocol):
    def generate(self, prompt: str) -> str: ...


class Extractive:
    """Answers with the first passage of the prompt: a stand-in that needs no network."""

    def generate(self, prompt: str) -> str:
        passages = prompt.split("[Source: ")
        return passages[1].split("\n", 1)[-1].split("\n\n")[0].strip() if len(passages) > 1 else ""


def api_key(name: str) -> str:
    """A provider's key from the driver's environment; it never becomes a column."""
    if not os.environ.get(name):
        raise KeyError(f"{name} is not set")
    return os.environ[name]


def tagged(key: Column, text: Column) -> Column:
    return F.concat(F.lit("[Source: "), key, F.lit("]\n"), text)


def context_of(hits: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(context): the hits' tagged texts, best first, between blank lines. Hits are few: the k of a search."""
    each = F.struct((-F.col("score")).alias("minus"), F.col(key), tagged(F.col(key), F.coalesce("text", F.lit(""))).alias("passage"))
    return hits.agg(F.array_join(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["passage"]), "\n\n").alias("context"))


def prompt_of(context: Column, question: Column) -> Column:
    head, rest = PROMPT.split("{context}")
    middle, tail = rest.split("{question}")
    return F.concat(F.lit(head), context, F.lit(middle), question, F.lit(tail))


@dataclass
class Retriever:
    """A vector table and the embedder it was made with."""

    store: DataFrame
    embedder: Embedder

    def __post_init__(self) -> None:
        if "model" in self.store.columns:
            other = self.store.where(F.col("model").isNotNull() & (F.col("model") != self.embedder.name)).select("model").limit(1).collect()
            if other:
                raise ValueError(f"the store was made with {other[0][0]}, not {self.embedder.name}")

    def retrieve(self, question: str, k: int = 5, where: Column | None = None) -> DataFrame:
        """(score, chunk_id, text, metadata), best first."""
        return top_k(self.store, self.embedder.encode([question])[0].tolist(), k, where=where).select("score", "chunk_id", "text", "metadata")


@dataclass
class Assistant:
    retriever: Retriever
    model: TextModel

    def ask(self, question: str, k: int = 5) -> dict:
        """{answer, sources}: the model's answer and the hits it was given."""
        hits = self.retriever.retrieve(question, k).collect()
        context = "\n\n".join(f"[Source: {h.chunk_id}]\n{h.text or ''}" for h in hits)
        return {"answer": self.model.generate(PROMPT.format(context=context, question=question)), "sources": [h.asDict(recursive=True) for h in hits]}
