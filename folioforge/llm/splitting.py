"""Problem 6: cutting oversized texts at natural boundaries by their content."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"[^\s\x1c-\x1f]+")
_LIST = re.compile(r"[-*+•–—]\s|\d+[.)]\s")
_CODE = re.compile(r"(;|\()\s*$|^\s*(SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|BEGIN|END|DECLARE|IF|FOR|FROM|WHERE)\b")


def _line_kind(line: str) -> str:
    """A coarse kind like those of Block.kind, for boundaries where one kind of block ends."""
    if _LIST.match(line):
        return "list"
    if _CODE.search(line):
        return "code"
    if line.count("|") >= 2:
        return "table"
    return "paragraph"


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[token] = out = xxhash.xxh3_64_intdigest(token)
        return out


def boundaries(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """How natural a cut before each token is: 3 after a blank line or where the kind of line changes, 2 at a line's end, 1 at a sentence's end, 0 else."""
    strength = np.zeros(len(spans), np.int8)
    kind = _line_kind(text[spans[0][0] : text.find("\n", spans[0][0]) if "\n" in text[spans[0][0] :] else len(text)])
    for i in range(1, len(spans)):
        end, start = spans[i - 1][1], spans[i][0]
        gap = text[end:start]
        if "\n" in gap:
            stop = text.find("\n", start)
            now = _line_kind(text[start : stop if stop >= 0 else len(text)])
            strength[i] = 3 if gap.count("\n") > 1 or now != kind else 2
            kind = now
        elif text[end - 1] in ".!?;:…":
            strength[i] = 1
    return strength


def cut_points(text: str, spans: list[tuple[int, int]], most: int, overlap: int, least: int, window: int, every: int, reach: int, hashes: dict) -> list[int]:
    """Token positions where pieces begin anew (the overlap not counted), 0 first."""
    n = len(spans)
    room = most - overlap
    if n <= most:
        return [0]
    h = np.fromiter((hashes[text[a:b]] for a, b in spans), np.uint64, n)
    rolling = np.zeros(n, np.uint64)  # of the ``window`` tokens before each position
    for back in range(1, window + 1):
        rolling[back:] += h[:-back] * np.uint64(pow(0x9E3779B97F4A7C15, back, 2**64))
    rolling ^= rolling >> np.uint64(29)
    rolling *= np.uint64(0xBF58476D1CE4E5B9)
    rolling >>= np.uint64(16)
    landmark = np.flatnonzero(rolling % np.uint64(every) == 0)
    strength = boundaries(text, spans)
    cuts = [0]
    while n - cuts[-1] > (most if len(cuts) == 1 else room):
        lo, hi = cuts[-1] + least, cuts[-1] + (most if len(cuts) == 1 else room)
        i = np.searchsorted(landmark, lo)
        mark = int(landmark[i]) if i < len(landmark) and landmark[i] <= hi else lo + int(np.argmin(rolling[lo : hi + 1]))
        cut = mark
        natural = np.flatnonzero(strength[lo : hi + 1]) + lo
        if len(natural):
            near = natural[np.abs(natural - mark) <= reach]
            if len(near):  # among the near ones the strongest, then the nearest
                cut = int(min(near, key=lambda p: (-strength[p], abs(p - mark), p)))
            else:
                cut = int(natural[np.argmin(np.abs(natural - mark))])
        cuts.append(cut)
    return cuts


def pieces_of(text: str, most: int = 700, overlap: int = 80, least: int = 240, window: int = 12, every: int = 96, reach: int = 60, hashes: dict | None = None) -> list[tuple[int, int, int, int]]:
    """(first token, tokens, first character, end) of each piece; one piece if the text has at most ``most`` tokens, none if it has none."""
    spans = [m.span() for m in _TOKEN.finditer(text)]
    if not spans:
        return []
    cuts = cut_points(text, spans, most, overlap, min(least, most - overlap), window, every, reach, _Hashes() if hashes is None else hashes)
    out = []
    for i, c in enumerate(cuts):
        first, end = max(0, c - overlap) if i else 0, cuts[i + 1] if i + 1 < len(cuts) else len(spans)
        out.append((first, end - first, spans[first][0] if i else 0, spans[end - 1][1] if i + 1 < len(cuts) else len(text)))
    return out


def split_oversized(df: DataFrame, key: str = "chunk_id", text: str = "text", most: int = 700, overlap: int = 80, only_divided: bool = False, with_text: bool = True) -> DataFrame:
    """Pieces of at most ``most`` tokens: (key, piece, pieces, first_token, token_count[, text]).

    Each piece but the first begins with the last ``overlap`` tokens of the one before. A landmark of a rolling hash over the
    tokens chooses each cut and snaps to a natural boundary nearby, between a least and a most size, so an edit alters only
    the pieces around it. The count is taken from the text; a stored count is not read. Texts within the limit come out as
    one piece (not at all with ``only_divided``); blank text as one piece of 0 tokens; null text as one piece with null text.
    Rows are not deduplicated here; a null key passes through. Narrow: no shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for b in batches:
            out = []
            for k, t in zip(b["key"], b["text"]):
                if not isinstance(t, str):
                    if not only_divided:
                        out.append((k, 0, 1, 0, 0, None))
                    continue
                if only_divided and len(t) < 2 * most:
                    continue
                found = pieces_of(t, most, overlap, hashes=hashes)
                if len(found) < 2:
                    if not only_divided:
                        out.append((k, 0, 1, 0, found[0][1] if found else 0, t if with_text else None))
                    continue
                out += [(k, i, len(found), f, n, t[a:z] if with_text else None) for i, (f, n, a, z) in enumerate(found)]
            yield pd.DataFrame(out, columns=["key", "piece", "pieces", "first_token", "token_count", "text"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if only_divided:
        rows = rows.where(F.length("text") > 2 * most)
    kind = dict(rows.dtypes)["key"]
    done = rows.mapInPandas(run, f"key {kind}, piece int, pieces int, first_token int, token_count int, text string")
    return done.withColumnRenamed("key", key) if with_text else done.drop("text").withColumnRenamed("key", key)
