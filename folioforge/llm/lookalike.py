"""Problem 4: one stored form for texts that print alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.store import table
from folioforge.llm.textform import mapped

BROADCAST_KEYS = 200_000  # keys of the texts that may have a partner; beyond this they are joined by shuffle
COLLATION = "UNICODE"  # case- and accent-sensitive; canonically equivalent strings are equal


def _coarse(form: Column) -> Column:
    """A hash that cannot tell equal forms apart: ASCII letters and digits without those that carry marks."""
    return F.xxhash64(F.regexp_replace(form, r"\p{L}\p{M}+|[^0-9A-Za-z]", ""))


def lookalike_classes(df: DataFrame, key: str, text: str, least: int = 0) -> DataFrame:
    """Classes of texts that print alike and are stored in at least two ways.

    Returns (key, raw_hash, form): one row per distinct (key, stored text) of such a class; ``form`` is the class's canonical
    member, the smallest mapped text by character code. Texts with fewer than ``least`` characters and null texts or keys take
    no part. A coarse hash finds the texts that can have a partner, so only those are shuffled whole; these are grouped by
    their look-alike-mapped value under the accent-sensitive collation, and the canonical member is joined back.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("key").isNotNull() & F.col("text").isNotNull() & (F.length("text") >= least))
    hashed = table(rows.select("key", F.xxhash64("text").alias("raw_hash"), _coarse(mapped(F.col("text"))).alias("coarse")))
    shared = hashed.groupBy("coarse").agg(F.min("raw_hash").alias("lo"), F.max("raw_hash").alias("hi")).where("lo <> hi").select("coarse")
    wanted = table(hashed.join(shared, "coarse", "left_semi").select("key").distinct())
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    candidates = rows.join(wanted, "key", "left_semi").select("key", F.xxhash64("text").alias("raw_hash"), mapped(F.col("text")).alias("mapped")).dropDuplicates(["key", "raw_hash"])
    spark = df.sparkSession
    grouped = spark.sql(
        f"SELECT mapped COLLATE {COLLATION} AS printed, min(mapped) AS form FROM {{rows}} GROUP BY mapped COLLATE {COLLATION} HAVING min(raw_hash) <> max(raw_hash)",
        rows=candidates,
    )
    return spark.sql(
        f"SELECT r.key, r.raw_hash, g.form FROM {{rows}} r JOIN {{grouped}} g ON r.mapped COLLATE {COLLATION} = g.printed",
        rows=candidates,
        grouped=grouped,
    )


def unify_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every row of ``df`` with (key, text, form): ``form`` is the same string for all texts that print alike.

    Null text gives a null form; a null key keeps its own mapped text. Repeated rows stay repeated; an empty table gives an
    empty result. Only key and text of ``df`` are read, so other columns may have any name.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    classes = lookalike_classes(df, key, text).select(F.col("key").alias("k"), F.col("raw_hash").alias("h"), F.col("form").alias("f"))
    joined = rows.join(classes, (F.col("key") == F.col("k")) & (F.xxhash64("text") == F.col("h")), "left")
    return joined.select("key", "text", F.coalesce("f", mapped(F.col("text"))).alias("form"))


def lookalike_pairs(df: DataFrame, key: str, text: str, least: int = 0) -> DataFrame:
    """(key_a, key_b): pairs of different keys, smaller first, whose texts print alike and are not the same string."""
    rows = lookalike_classes(df, key, text, least).select("key", "raw_hash", F.xxhash64("form").alias("c1"), F.hash("form").alias("c2"))
    a, b = rows.select("c1", "c2", F.col("key").alias("key_a"), F.col("raw_hash").alias("ha")), rows.select("c1", "c2", F.col("key").alias("key_b"), F.col("raw_hash").alias("hb"))
    return a.join(b, ["c1", "c2"]).where("key_a < key_b AND ha <> hb").select("key_a", "key_b").distinct()
