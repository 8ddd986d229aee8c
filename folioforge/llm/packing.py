"""Problem 2: filling containers of fixed capacity, by shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOKEN = r"[^\s\x0B\x1C-\x1F\x85   -     　]+"
PARTS = 16  # a (source, length) is ranked in this many parts, so that no task ranks a hot one whole

_SLOTS = "array<struct<length:int,part:int,offset:bigint,slots:array<struct<start:bigint,stop:bigint,base:bigint,copies:bigint>>>>"


def count_tokens(text: Column) -> Column:
    """Whitespace-separated words in the Unicode sense; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0))


def shortest_pack_first(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(copies, lengths) of packing patterns that hold ``counts`` items of each length.

    Lengths go longest first, each into the pack with the most room; a pattern's copies are divided where fewer items are
    left than packs. The work depends on the number of lengths, not of items.
    """
    rooms: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for length in sorted((x for x in counts if x > 0), reverse=True):
        left = counts[length]
        while left:
            room = max((r for r in rooms if r >= length), default=None)
            if room is None:
                rooms[capacity - length].append((left, [length]))
                break
            copies, pattern = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
            used = min(copies, left)
            if copies > used:
                rooms[room].append((copies - used, pattern))
            rooms[room - length].append((used, [*pattern, length]))
            left -= used
    return [p for r in sorted(rooms) for p in rooms[r]]


def _slots(entries: list[dict], capacity: int) -> list[dict]:
    """For each (length, part): where its items' ranks begin and which packs the ranks go to."""
    total: dict[int, int] = defaultdict(int)
    for e in entries:
        total[e["length"]] += e["n"]
    next_rank: dict[int, int] = defaultdict(int)
    slots: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    base = 0
    for copies, pattern in shortest_pack_first(total, capacity):
        for length in pattern:
            start = next_rank[length]
            next_rank[length] = start + copies
            slots[length].append((start, start + copies, base, copies))
        base += copies
    out, begun = [], defaultdict(int)
    for e in sorted(entries, key=lambda e: (e["length"], e["part"])):
        lo = begun[e["length"]]
        hi = begun[e["length"]] = lo + e["n"]
        own = [dict(zip(("start", "stop", "base", "copies"), s)) for s in slots[e["length"]] if s[0] < hi and s[1] > lo]
        out.append({"length": e["length"], "part": e["part"], "offset": lo, "slots": own})
    return out


def pack_items(df: DataFrame, group: str, keys: list[str], text: str, capacity: int = 700) -> DataFrame:
    """(group, keys..., piece, pieces, first_token, length, pack): the pack of every piece of every item.

    An item is one distinct (group, keys); repeated rows count once. It is divided (into pieces of ``capacity`` tokens and a
    rest) only if it is longer than a pack by itself. Items without tokens (blank or null text) need no room: one piece of
    length 0 with a null pack. Rows with a null group or key are no items and are left out. Texts are not shuffled: only
    keys and lengths are; patterns are made from the histogram of lengths, of at most ``capacity`` times PARTS entries a group.
    """
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(F.col(group).alias("g"), *[F.col(k).alias(n) for k, n in zip(keys, names)], count_tokens(F.col(text)).alias("tokens")).dropna(subset=["g", *names])
    items = rows.groupBy("g", *names).agg(F.max("tokens").alias("tokens"))
    pieces = F.greatest(F.ceil(F.col("tokens") / capacity).cast("int"), F.lit(1))
    cut = items.withColumn("pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    cut = cut.withColumn("first_token", F.col("piece") * capacity).withColumn("length", F.least(F.lit(capacity), F.col("tokens") - F.col("first_token")).cast("int"))
    cut = cut.withColumn("part", F.pmod(F.xxhash64(*names, "piece"), F.lit(PARTS)).cast("int"))

    @F.pandas_udf(_SLOTS)
    def plan(entries: pd.Series) -> pd.Series:
        return pd.Series([_slots(list(e), capacity) for e in entries])

    counted = cut.where("length > 0").groupBy("g", "length", "part").agg(F.count("*").alias("n"))
    planned = counted.groupBy("g").agg(F.collect_list(F.struct("length", "part", "n")).alias("entries")).select("g", F.explode(plan("entries")).alias("p")).select("g", "p.*")
    at = Window.partitionBy("g", "length", "part").orderBy(*names, "piece")
    ranked = cut.withColumn("rank", F.row_number().over(at) - 1)
    joined = ranked.join(planned, ["g", "length", "part"], "left").withColumn("rank", F.col("rank") + F.col("offset"))
    slot = F.element_at(F.filter("slots", lambda s: (s["start"] <= F.col("rank")) & (F.col("rank") < s["stop"])), 1)
    packed = joined.withColumn("slot", F.when(F.size("slots") > 0, slot)).withColumn("pack", F.col("slot.base") + F.pmod(F.col("rank") - F.col("slot.start"), F.col("slot.copies")))
    return packed.select(F.col("g").alias(group), *[F.col(n).alias(k) for k, n in zip(keys, names)], "piece", "pieces", "first_token", "length", "pack")


def packs(packed: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """(group, pack, token_count, items): each pack with the number of tokens it truly holds and its items' keys in order."""
    return packed.where("pack IS NOT NULL").groupBy(group, "pack").agg(F.sum("length").alias("token_count"), F.array_sort(F.collect_list(F.struct(*keys, "piece"))).alias("items"))


def pack_texts(df: DataFrame, group: str, keys: list[str], text: str, capacity: int = 700) -> DataFrame:
    """(group, pack, token_count, text): the packs written out, items in key order with a blank line between them; a divided item's piece keeps its words."""
    packed = pack_items(df, group, keys, text, capacity).where("pack IS NOT NULL")
    texts = df.select(group, *keys, F.col(text).alias("item_text")).dropDuplicates([group, *keys])
    words = F.slice(F.regexp_extract_all("item_text", F.lit(TOKEN), 0), F.col("first_token") + 1, F.col("length"))
    body = F.when(F.col("pieces") == 1, F.col("item_text")).otherwise(F.array_join(words, " "))
    joined = packed.join(texts, [group, *keys]).withColumn("body", body)
    return joined.groupBy(group, "pack").agg(F.sum("length").alias("token_count"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*keys, "piece", "body"))), lambda x: x["body"]), "\n\n").alias("text"))
