"""Problem 7: evaluation texts inside training text, by a BM25 index of the items with block-max bounds."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.textform import word_bytes

K1, B = 1.2, 0.75
ITEMS_PER_INDEX = 2_000  # a larger set is cut into several indexes, each of which meets the whole corpus


class ItemIndex:
    """An inverted index of items with BM25 impacts and the largest impact of each term per block of items.

    ``least[i]`` is the smallest score that any ``run`` consecutive words of item i can give it, so a passage that holds
    such a run always reaches it: retrieval above this threshold loses nothing.
    """

    def __init__(self, items: list[tuple[int, str | None, str | None]], run: int, per_block: int = 8):
        kept = [(i, w, word_bytes(a, False)) for i, t, a in items if len(w := word_bytes(t, False)) >= run]
        self.run, self.per_block = run, per_block
        self.ids = [i for i, _, _ in kept]
        self.vocabulary = {w: n + 1 for n, w in enumerate(sorted({x for _, ws, _ in kept for x in ws}))}
        self.words = [np.array([self.vocabulary[x] for x in ws], np.int32) for _, ws, _ in kept]
        self.answers = [b" ".join(a) for _, _, a in kept]
        n, size = len(kept), -(-max(1, len(kept)) // per_block) * per_block
        mean = sum(map(len, self.words)) / max(1, n)
        df = Counter(x for ws in self.words for x in set(ws.tolist()))
        self.impact = np.zeros((len(self.vocabulary) + 1, size), np.float32)
        for i, ws in enumerate(self.words):
            for x, tf in Counter(ws.tolist()).items():
                idf = math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5))
                self.impact[x, i] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ws) / mean))
        self.least = np.full(size, np.inf, np.float32)
        for i, ws in enumerate(self.words):
            self.least[i] = min(self.impact[np.unique(ws[s : s + run]), i].sum() for s in range(len(ws) - run + 1)) * (1 - 1e-5)
        blocks = self.impact.reshape(len(self.impact), -1, per_block)
        self.block_max = blocks.max(2)
        self.block_least = self.least.reshape(-1, per_block).min(1)
        self.term_max = self.impact.max(1)
        self.powers = np.array([pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(run)], np.uint64)
        self.runs = np.unique(np.concatenate([self._hashes(ws) for ws in self.words])) if n else np.zeros(0, np.uint64)
        self.grams = [set(map(bytes, np.lib.stride_tricks.sliding_window_view(ws, run).copy())) for ws in self.words]

    def _hashes(self, words: np.ndarray) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(words.astype(np.uint64), self.run)
        return (view * self.powers).sum(1, dtype=np.uint64)

    def has_run(self, document: np.ndarray) -> bool:
        """Whether some run of the document may be an item's: a test by hash before the word by word one."""
        if len(document) < self.run:
            return False
        h = self._hashes(document)
        at = np.minimum(np.searchsorted(self.runs, h), len(self.runs) - 1)
        return bool((self.runs[at] == h).any())

    def candidates(self, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, item) with a score of at least the item's threshold; ``passages`` holds term ids, 0 for none."""
        x = np.sort(passages, axis=1)
        x[:, 1:][x[:, 1:] == x[:, :-1]] = 0  # a term counts once
        at = np.flatnonzero(self.term_max[x].sum(1) >= self.block_least.min())
        out_p, out_i = [], []
        for s in range(0, len(at), 4096):
            part = at[s : s + 4096]
            bound = np.zeros((len(part), len(self.block_least)), np.float32)
            for c in range(x.shape[1]):
                bound += self.block_max[x[part, c]]
            p, b = np.nonzero(bound >= self.block_least)  # blocks that no bound rules out
            for q in range(0, len(p), 65536):
                pp, bb = p[q : q + 65536], b[q : q + 65536]
                score = np.zeros((len(pp), self.per_block), np.float32)
                columns = bb[:, None] * self.per_block + np.arange(self.per_block)
                for c in range(x.shape[1]):
                    score += self.impact[x[part[pp], c][:, None], columns]
                k, o = np.nonzero(score >= self.least[columns])
                out_p.append(part[pp[k]])
                out_i.append(columns[k, o])
        return (np.concatenate(out_p), np.concatenate(out_i)) if out_p else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def longest_run(self, document: np.ndarray, item: int) -> int:
        """The most consecutive words of the item found in the document, 0 if under ``run``."""
        view = np.lib.stride_tricks.sliding_window_view(document, self.run)
        grams = self.grams[item]
        hits = [i for i, g in enumerate(map(bytes, view.copy())) if g in grams]
        if not hits:
            return 0
        ws, best, done = self.words[item], 0, -1
        for h in hits:
            if h < done:
                continue
            for s in np.flatnonzero((np.lib.stride_tricks.sliding_window_view(ws, self.run) == document[h : h + self.run]).all(1)).tolist():
                n = self.run
                while s + n < len(ws) and h + n < len(document) and ws[s + n] == document[h + n]:
                    n += 1
                best, done = max(best, n), max(done, h + n - self.run + 1)
        return best


def shared_runs(ids: np.ndarray, run: int) -> np.ndarray:
    """``ids`` with 0 for every term outside runs of at least ``run`` terms of the vocabulary: no item's run can reach there."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).astype(np.int8), [0]))))
    out = np.zeros_like(ids)
    for s, e in edges.reshape(-1, 2)[(edges[1::2] - edges[::2]) >= run].tolist():
        out[s:e] = ids[s:e]
    return out


def _search(index: ItemIndex, passage: int):
    step = passage - index.run + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, zeros, gap = index.vocabulary.get, iter(int, 1), np.zeros(passage, np.int32)
        for whole in batches:
            for at in range(0, len(whole), 1000):
                b = whole.iloc[at : at + 1000]
                out, texts, flat, starts, total = [], b["text"].tolist(), [gap], [], passage
                for t in texts:
                    found = word_bytes(t if isinstance(t, str) else None, False)
                    flat += [np.fromiter(map(get, found, zeros), np.int32, len(found)), gap]  # no passage spans two documents
                    starts.append(total)
                    total += len(found) + passage
                words, starts = np.concatenate(flat), np.array(starts)
                kept = shared_runs(words, index.run)
                count = np.concatenate(([0], np.cumsum(kept > 0)))
                first = np.arange(0, len(kept) - passage + 1, step)
                first = first[count[first + passage] - count[first] >= index.run]
                p, i = index.candidates(kept[first[:, None] + np.arange(passage)])
                middle = np.searchsorted(count, count[first] + 1) - 1  # the first term of each passage
                owner = np.searchsorted(starts, middle, side="right") - 1
                pairs = np.unique(np.stack([owner[p], i], 1), axis=0) if len(p) else np.zeros((0, 2), np.int64)
                for n, items in zip(*np.unique(pairs[:, 0], return_index=True)) if len(pairs) else ():
                    document = kept[starts[n] : starts[n + 1] - passage if n + 1 < len(starts) else len(kept) - passage]
                    if not index.has_run(document):
                        continue
                    answers = None
                    while items < len(pairs) and pairs[items, 0] == n:
                        item, items = int(pairs[items, 1]), items + 1
                        if length := index.longest_run(document, item):
                            answers = answers or b" " + b" ".join(word_bytes(texts[n], False)) + b" "
                            answer = index.answers[item]
                            out.append((b["key"].iloc[n], index.ids[item], length, len(index.words[item]), bool(answer) and b" " + answer + b" " in answers))
                yield pd.DataFrame(out, columns=["key", "item_id", "run", "item_words", "answer_found"])

    return run


def leaked_items(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", run: int = 12, passage: int = 24) -> DataFrame:
    """(key, item_id, run, item_words, answer_found): the documents that hold at least ``run`` consecutive words of an item's text.

    ``items`` has (item_id, text, answer). Case, accents, punctuation and line breaks do not count. Each passage of
    ``passage`` words (overlapping by run - 1) queries the index; (passage, item) pairs above the item's threshold are
    verified word by word in the whole document, and the answer's words are looked up. Items or documents with null or too
    short texts take no part. The corpus is scanned without a shuffle; items are cut into indexes of ITEMS_PER_INDEX, so
    what travels with a task is bounded whatever their number.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key IS NOT NULL AND text IS NOT NULL")
    kind = dict(rows.dtypes)["key"]
    out = None
    batch: list = []

    def add(batch: list):
        index = ItemIndex(batch, run)
        if not index.ids:
            return out
        found = rows.mapInPandas(_search(index, passage), f"key {kind}, item_id int, run int, item_words int, answer_found boolean")
        return found if out is None else out.unionAll(found)

    for r in items.select("item_id", "text", "answer").where("item_id IS NOT NULL").dropDuplicates(["item_id"]).orderBy("item_id").toLocalIterator():
        batch.append((r[0], r[1], r[2]))
        if len(batch) == ITEMS_PER_INDEX:
            out, batch = add(batch), []
    if batch:
        out = add(batch)
    if out is None:
        out = spark.createDataFrame([], f"key {kind}, item_id int, run int, item_words int, answer_found boolean")
    return out.withColumnRenamed("key", key)
