"""Problem 9: keyword-stuffed pages and link lists, by a hidden Markov model over lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.store import table
from folioforge.llm.textform import canonical, word_bytes

STATES = ("prose", "link list", "tag list", "menu")
SYMBOLS = ("sentence", "words", "code", "link", "tags", "phrase", "half phrase", "fragment")
# Function words of French and English.
FUNCTION_WORDS = frozenset(
    "le la les l un une des du de d au aux et ou où que qui qu dans en sur sous par pour sans avec puis est sont il elle on ne pas se s son sa ses ce cette ces lorsque quand si dès tant comme à plus faut chaque leur leurs entre avant après pendant depuis selon "
    "the a an of to in on at by for with and or that which is are it its not this these when if once then as be was were from into before after during under between no each every".split()
)
_LINK = re.compile(r"\S*(?:://|www\.|href=)\S*")
_CURRENCIES = ("EUR", "USD", "GBP", "€", "$", "£")
_PRICE = re.compile(r"\d[\d.,]*\s*(?:EUR|USD|GBP|€|\$|£)|(?:EUR|USD|€|\$|£)\s*\d")
_STATEMENT = re.compile(
    r"(?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|MERGE|GRANT|REVOKE|BEGIN|DECLARE|END|FROM|WHERE|GROUP BY|ORDER BY|HAVING|JOIN|IF|ELSE|ELSIF|LOOP|FOR|WHILE|RETURN|EXCEPTION|COMMIT|ROLLBACK|WHEN|CASE|VALUES|SET|AND|OR"
    r"|def|class|import|return|for|while|if)\b"
)
_TYPES = (" NUMBER", " VARCHAR", " DATE", " INTEGER")


def is_code(line: str) -> bool:
    """Whether a line reads as a statement of SQL, PL/SQL or a common language, or as a part of one."""
    x = line.strip()
    if ":=" in x or ");" in x or x.endswith(("{", "}")) or x.startswith("--"):
        return True
    if _STATEMENT.match(x):
        return len(x) < 12 or any(c in x for c in "(;=*:,") or x.endswith((" IS", " THEN", " LOOP", " BEGIN")) or " FROM " in x
    return x.endswith((",", ";", ")")) and any(t in x for t in _TYPES)


_SEPARATORS = ("|", ";", ",", "•", "·", " - ", " – ", " / ")
_HASHTAG = re.compile(r"(?<!\S)[#@](?=[^\W_])|(?<=\w)#(?=[^\W\d_])")  # a mark before each entry of its own, also without spaces between
WINDOW = 12  # words of a segment; longer lines are cut

# The prior of training, as counts: emissions by state and symbol, and the chance of staying in a state.
EMISSION = np.array([
    [0.52, 0.17, 0.20, 0.005, 0.01, 0.005, 0.02, 0.07],
    [0.02, 0.04, 0.01, 0.80, 0.04, 0.03, 0.02, 0.04],
    [0.01, 0.04, 0.01, 0.03, 0.81, 0.04, 0.03, 0.03],
    [0.02, 0.05, 0.005, 0.01, 0.04, 0.60, 0.20, 0.075],
])
PRIOR_COUNTS, STAY = 2_000.0, 0.85
WORTH = 400  # the counts of more documents are scaled to as many, so that the prior weighs the same at every size
CELLS = 250_000  # segments of one batch in training


def phrase_cover(ids: np.ndarray, content: np.ndarray, least: int = 5) -> np.ndarray:
    """Which words lie in runs of two to four words that come back at least ``least`` times, begin and end with words of content."""
    cover = np.zeros(len(ids), bool)
    gram = ids.astype(np.uint64)
    for n in (2, 3, 4):
        if len(ids) < n + least - 1:
            break
        gram = (gram[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (ids[n - 1 :].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
        order = np.argsort(gram)
        run = gram[order]
        edge = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1], [True])))
        count = np.diff(edge)
        if count.max() < least:
            break
        often = np.zeros(len(gram), bool)
        often[order] = np.repeat(count >= least, count)
        hit = np.flatnonzero(often & content[: len(gram)] & content[n - 1 :])  # a key phrase begins and ends with a word of content
        for i in range(n):
            cover[hit + i] = True
    return cover


class _Ids(dict):
    """A number per word; those of function words are under 1000."""

    def __init__(self) -> None:
        super().__init__({w.encode("latin-1", "replace"): i for i, w in enumerate(sorted(FUNCTION_WORDS))})

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
            self.update(_Ids())
        self[word] = out = (xxhash.xxh3_64_intdigest(word) >> 1) | 1024
        return out


def segments(text: str, place: dict | None = None) -> tuple[list[int], list[int]]:
    """(symbol, words) of each segment: a line, or a run of WINDOW words of a longer one; blank lines have none."""
    place = _Ids() if place is None else place
    lines = [x for x in canonical(text).split("\n") if x and not x.isspace()]
    found = [word_bytes(x) for x in lines]
    every = [w for ws in found for w in ws]
    if not every:
        return [], []
    ids = np.fromiter(map(place.__getitem__, every), np.int64, len(every))
    function = ids < 1000
    cover = phrase_cover(ids, ~function)
    ends_f, ends_c = [0, *np.cumsum(function).tolist()], [0, *np.cumsum(cover).tolist()]
    symbols, sizes, at = [], [], 0
    for line, ws in zip(lines, found):
        n = len(ws)
        if not n:
            continue
        code, linked, price = is_code(line), 0, False
        if "://" in line or "www." in line or "href=" in line:
            linked = sum(len(word_bytes(x)) for x in _LINK.findall(line)) / n
        if not code and not linked and any(c in line for c in _CURRENCIES):
            price = bool(_PRICE.search(line))
        hashtags = len(_HASHTAG.findall(line)) if "#" in line or "@" in line else 0
        separators = sum(map(line.count, _SEPARATORS)) + hashtags
        entry = n / (separators + 1)
        parts = max(1, round(n / WINDOW))
        for k in range(parts):
            s, e = at + n * k // parts, at + n * (k + 1) // parts
            m = e - s
            share, covered = (ends_f[e] - ends_f[s]) / m, (ends_c[e] - ends_c[s]) / m
            if linked >= 0.4:
                symbol = 3
            elif code:
                symbol = 2
            elif 2 * hashtags >= n or price and separators >= 2 or separators >= 3 and (entry <= 3.5 and share < 0.2 or entry <= 5.5 and covered >= 0.25):
                symbol = 4
            elif covered >= 0.45:
                symbol = 5
            elif covered >= 0.25:
                symbol = 6
            elif m <= 4 and not share:
                symbol = 7
            else:
                symbol = 0 if share >= 0.25 else 1
            symbols.append(symbol)
            sizes.append(m)
        at += n
    return symbols, sizes


class LineModel:
    """A hidden Markov model whose states are STATES and whose symbols are SYMBOLS."""

    def __init__(self) -> None:
        k = len(STATES)
        self.emission = EMISSION / EMISSION.sum(1, keepdims=True)
        self.step = np.full((k, k), (1 - STAY) / (k - 1))
        np.fill_diagonal(self.step, STAY)
        self.start = np.array([0.91, 0.03, 0.03, 0.03])

    def counts(self, sequences: list[list[int]]) -> np.ndarray:
        """Expected emissions, steps and starts, one after the other in one row, of many sequences step by step."""
        k, width = len(STATES), self.emission.shape[1]
        e, s, first = np.zeros((width, k)), np.zeros((k, k)), np.zeros(k)
        order = sorted((q for q in sequences if len(q)), key=len, reverse=True)
        while order:
            held, order = order[: max(1, CELLS // len(order[0]))], order[max(1, CELLS // len(order[0])) :]
            length = np.array([len(q) for q in held])
            grid = np.zeros((int(length[0]), len(held)), np.int64)
            for r, q in enumerate(held):
                grid[: len(q), r] = q
            alive = np.searchsorted(-length, -np.arange(1, len(grid) + 1), side="right")  # sequences longer than t
            ahead = np.zeros((*grid.shape, k))
            for t, a in enumerate(alive.tolist()):
                now = (np.broadcast_to(self.start, (a, k)) if t == 0 else ahead[t - 1, :a] @ self.step) * self.emission.T[grid[t, :a]]
                ahead[t, :a] = now / now.sum(1, keepdims=True)
            back = np.ones((len(held), k))
            for t in range(len(grid) - 1, -1, -1):
                if t + 1 < len(grid):
                    n = alive[t + 1]
                    after = self.emission.T[grid[t + 1, :n]] * back[:n]
                    both = ahead[t, :n, :, None] * self.step * after[:, None, :]
                    s += (both / both.sum((1, 2), keepdims=True)).sum(0)
                    back[:n] = after @ self.step.T
                    back[:n] /= back[:n].sum(1, keepdims=True)
                state = ahead[t, : alive[t]] * back[: alive[t]]
                state /= state.sum(1, keepdims=True)
                for i in range(k):
                    e[:, i] += np.bincount(grid[t, : alive[t]], weights=state[:, i], minlength=width)
                if t == 0:
                    first += state.sum(0)
        return np.concatenate((e.T.ravel(), s.ravel(), first))

    def learned(self, counts: np.ndarray, documents: int) -> LineModel:
        """A model from the prior, as counts, and the expected counts of so many documents."""
        k, width = self.emission.shape
        prior, model, counts = LineModel(), LineModel(), counts * min(1.0, WORTH / max(documents, 1))
        e = prior.emission * PRIOR_COUNTS + counts[: k * width].reshape(k, width)
        s = prior.step * PRIOR_COUNTS + counts[k * width : -k].reshape(k, k)
        first = prior.start * PRIOR_COUNTS / 10 + counts[-k:]
        model.emission, model.step, model.start = e / e.sum(1, keepdims=True), s / s.sum(1, keepdims=True), first / first.sum()
        return model

    def label(self, sequences: list[list[int]]) -> list[np.ndarray]:
        """The most likely states of each sequence, all of a batch step by step."""
        order = sorted((i for i, q in enumerate(sequences) if len(q)), key=lambda i: -len(sequences[i]))
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(sequences)
        if not order:
            return out
        step, emit = np.log(self.step), np.log(self.emission)
        length = np.array([len(sequences[i]) for i in order])
        grid = np.zeros((len(order), int(length[0])), np.int8)
        for r, i in enumerate(order):
            grid[r, : length[r]] = sequences[i]
        score = np.log(self.start) + emit[:, grid[:, 0]].T
        came = np.zeros((*grid.shape, len(STATES)), np.int8)
        alive = np.searchsorted(-length, -np.arange(1, grid.shape[1] + 1), side="right")  # sequences longer than t
        for t in range(1, grid.shape[1]):
            a = alive[t]
            reach = score[:a, :, None] + step
            came[:a, t] = reach.argmax(1)
            score[:a] = reach.max(1) + emit[:, grid[:a, t]].T
        state = score.argmax(1).astype(np.int8)
        states = np.zeros(grid.shape, np.int8)
        for t in range(grid.shape[1] - 1, -1, -1):
            a = alive[t]
            states[:a, t] = state[:a]
            state[:a] = came[np.arange(a), t, state[:a]]
        for r, i in enumerate(order):
            out[i] = states[r, : length[r]]
        return out


def segmented(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, symbols, sizes): the segments of each text, a byte for each symbol and two for its words."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = _Ids()
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.iloc[at : at + 1000]
                found = [segments(t, place) if isinstance(t, str) else ([], []) for t in part["text"]]
                yield pd.DataFrame({"key": part["key"], "symbols": [bytes(s) for s, _ in found], "sizes": [np.array(n, np.uint16).tobytes() for _, n in found]})

    return rows.mapInPandas(run, f"key {kind}, symbols binary, sizes binary")


def fit_line_model(documents: DataFrame, key: str = "doc_id", text: str = "text") -> LineModel:
    """A model trained on all documents."""
    return _fitted(table(segmented(documents, key, text)))


def _fitted(cut: DataFrame, rounds: int = 4) -> LineModel:
    """Expectation maximization from the prior over the segments of all documents; a row of counts a task comes to the driver."""
    model, rows = LineModel(), cut.select("symbols").where("length(symbols) > 0")
    for _ in range(rounds):

        def run(batches: Iterator[pd.DataFrame], model: LineModel = model) -> Iterator[pd.DataFrame]:
            total, documents = 0.0, 0
            for b in batches:
                total, documents = total + model.counts([np.frombuffer(x, np.uint8) for x in b["symbols"]]), documents + len(b)
            if documents:
                yield pd.DataFrame({"documents": [documents], "counts": [total]})

        found = rows.mapInPandas(run, "documents bigint, counts array<double>").collect()
        model = model.learned(np.sum([r["counts"] for r in found], axis=0) if found else np.zeros(model.emission.size + model.step.size + len(STATES)), sum(r["documents"] for r in found))
    return model


def prose_shares(documents: DataFrame, key: str = "doc_id", text: str = "text", model: LineModel | None = None) -> DataFrame:
    """(key, words, link_words, tag_words, menu_words, other_share): words of each text by the label of their line.

    ``other_share`` is the share of words outside prose and program code. Texts without words and null texts have 0 words
    and a null share. Every row of ``documents`` comes out; no shuffle. Without ``model``, one is trained on all texts, whose
    segments are written once for it.
    """
    cut = segmented(documents, key, text)
    if model is None:
        cut = table(cut)
        model = _fitted(cut)
    kind = dict(cut.dtypes)["key"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.iloc[at : at + 1000]
                labels = model.label([np.frombuffer(s, np.uint8) for s in part["symbols"]])
                sizes = [np.frombuffer(n, np.uint16) for n in part["sizes"]]
                count = np.array([np.bincount(x, weights=n, minlength=4)[:4] if len(x) else np.zeros(4) for x, n in zip(labels, sizes)]).reshape(-1, 4).astype(np.int64)
                total = count.sum(1)
                share = np.where(total > 0, count[:, 1:].sum(1) / np.maximum(total, 1), np.nan)
                yield pd.DataFrame({"key": part["key"], "words": total, "link_words": count[:, 1], "tag_words": count[:, 2], "menu_words": count[:, 3], "other_share": share})

    done = cut.mapInPandas(run, f"key {kind}, words bigint, link_words bigint, tag_words bigint, menu_words bigint, other_share double")
    return done.withColumn("other_share", F.nanvl("other_share", F.lit(None).cast("double"))).withColumnRenamed("key", key)
