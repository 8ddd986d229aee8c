"""Problem 8: combining sources to target weights under a cap on repeats."""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.llm.store import table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed value: belongs to the vocabulary
BUCKETS = 1024  # of a source's seeded order
MOST_SOURCES = 100_000

_encoders: dict = {}


def token_sizes(df: DataFrame, key: str, text: str, carry: list[str], ranks: str = RANKS) -> DataFrame:
    """(key, carry..., tokens): the size of each text in tokens of a public byte-level tokenizer; 0 for null text."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), *carry)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        encoder = tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        for b in batches:
            b["tokens"] = [len(encoder.encode_ordinary(t)) if isinstance(t, str) else 0 for t in b["text"]]
            yield b.drop(columns="text")

    return rows.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in ["key", *carry]) + ", tokens bigint").withColumnRenamed("key", key)


@dataclass
class Node:
    """A node of the budget tree: its weight among its siblings and, of a leaf, the tokens it can give at most."""

    name: str
    weight: float = 0.0
    capacity: float = 0.0
    children: list[Node] = field(default_factory=list)

    def close(self) -> Node:
        """Sum weights and capacities upwards."""
        if self.children:
            for c in self.children:
                c.close()
            self.weight, self.capacity = sum(c.weight for c in self.children), sum(c.capacity for c in self.children)
        return self

    def spread(self, budget: float) -> dict[str, float]:
        """Budgets of the leaves: by weight among siblings; what one cannot use goes to its siblings, then up."""
        budget = min(budget, self.capacity)
        if not self.children:
            return {self.name: budget}
        given = dict.fromkeys(range(len(self.children)), 0.0)
        open_ = [i for i, c in enumerate(self.children) if c.capacity > 0 and c.weight > 0]
        left = budget
        while open_ and left > 1e-6:
            weight = sum(self.children[i].weight for i in open_)
            share = {i: left * self.children[i].weight / weight for i in open_}
            full = [i for i in open_ if given[i] + share[i] >= self.children[i].capacity]
            if not full:
                for i in open_:
                    given[i] += share[i]
                break
            for i in full:
                left -= self.children[i].capacity - given[i]
                given[i] = self.children[i].capacity
            open_ = [i for i in open_ if i not in full]
        out: dict[str, float] = {}
        for i, c in enumerate(self.children):
            out |= c.spread(given[i])
        return out


def budgets(sources: list[dict], total: float, domain: Callable[[str], str] | None = None) -> dict[str, float]:
    """Token budgets by source through the tree domain - language - source; ``sources`` has source, share, repeats, tokens, language."""
    tree: dict[str, dict[str, list[Node]]] = defaultdict(lambda: defaultdict(list))
    for s in sources:
        tree[domain(s["source"]) if domain else ""][s["language"] or ""].append(Node(s["source"], s["share"], float(s["tokens"] * s["repeats"])))
    root = Node("", children=[Node(d, children=[Node(x, children=leaves) for x, leaves in sorted(by.items())]) for d, by in sorted(tree.items())])
    return root.close().spread(total)


def mix_sources(
    documents: DataFrame,
    targets: DataFrame,
    total_tokens: float | None = None,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    language: str = "lang",
    seed: int = 11,
    domain: Callable[[str], str] | None = None,
    ranks: str = RANKS,
) -> tuple[DataFrame, DataFrame]:
    """(corpus, report). corpus: (key, source, tokens, copies), the documents used and how often; report: one row per target source.

    ``targets`` has (source, target_share, max_repeats); shares are scaled to their sum, null or negative ones count as 0,
    max_repeats below 1 as 0. Without ``total_tokens`` the corpus is half of what the listed sources hold. A source's budget
    is used up by whole epochs and then a prefix of the next epoch's seeded order, up to but not beyond the budget, so a
    share falls short by less than one document. Documents of unlisted or null sources, null keys and null texts are not
    used; a repeated key counts once. Sums over a source are taken by buckets of its order: no task gets a source whole.
    """
    spark = documents.sparkSession
    wanted = targets.select("source", "target_share", "max_repeats").where("source IS NOT NULL").dropDuplicates(["source"]).orderBy("source").limit(MOST_SOURCES + 1).collect()
    if len(wanted) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} target sources")
    listed = spark.createDataFrame([(r["source"],) for r in wanted], "source string")
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(source).alias("source"), F.lower(F.substring(F.col(language), 1, 2)).alias("language"))
    rows = rows.where("key IS NOT NULL AND text IS NOT NULL").join(F.broadcast(listed), "source", "left_semi")
    sizes = table(token_sizes(rows, "key", "text", ["source", "language"], ranks).dropDuplicates(["key"]))
    held: dict[str, dict] = {}
    for r in sizes.groupBy("source", "language").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("n").alias("n"), F.max_by("language", "tokens").alias("language")).collect():
        held[r["source"]] = r.asDict()
    leaves = [
        {"source": r["source"], "share": max(0.0, r["target_share"] or 0.0), "repeats": max(0, r["max_repeats"] or 0), "tokens": held.get(r["source"], {}).get("tokens", 0), "language": held.get(r["source"], {}).get("language")}
        for r in wanted
    ]
    total = total_tokens if total_tokens is not None else sum(x["tokens"] for x in leaves) / 2
    budget = budgets(leaves, total, domain)
    plan = []
    for x in leaves:
        b = int(budget.get(x["source"], 0.0) + 1e-6)
        whole = min(x["repeats"], b // x["tokens"]) if x["tokens"] else 0
        plan.append((x["source"], x["share"], x["repeats"], int(x["tokens"]), b, whole, b - whole * x["tokens"] if whole < x["repeats"] else 0))
    planned = spark.createDataFrame(plan, "source string, target_share double, max_repeats int, available bigint, budget bigint, epochs int, rest bigint")
    ordered = sizes.join(F.broadcast(planned.select("source", "epochs", "rest")), "source").withColumn("at", F.xxhash64(F.lit(seed), "epochs", F.col("key").cast("string"))).withColumn("bucket", F.pmod("at", F.lit(BUCKETS)))
    before = ordered.groupBy("source", "bucket").agg(F.sum("tokens").alias("t")).withColumn("before", F.sum("t").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    running = F.sum("tokens").over(Window.partitionBy("source", "bucket").orderBy("at", "key").rowsBetween(Window.unboundedPreceding, 0))
    reached = ordered.withColumn("running", running).join(before.select("source", "bucket", "before"), ["source", "bucket"])
    copies = F.col("epochs") + F.when(F.coalesce("before", F.lit(0)) + F.col("running") <= F.col("rest"), 1).otherwise(0)
    corpus = reached.withColumn("copies", copies).where("copies > 0").select("key", "source", "tokens", "copies")
    got = corpus.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used"), F.max("copies").alias("most_repeats"), F.count("*").alias("documents"))
    report = planned.select("source", "target_share", "max_repeats", "available", "budget").join(got, "source", "left")
    report = report.select("source", "target_share", "max_repeats", "available", "budget", F.coalesce("used", F.lit(0)).alias("used"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))
    report = report.withColumn("actual_share", F.col("used") / F.sum("used").over(Window.partitionBy()))
    return corpus.withColumnRenamed("key", key), report


def written_out(corpus: DataFrame) -> DataFrame:
    """One row per use of a document: ``epoch`` counts its repeats from 0."""
    return corpus.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
