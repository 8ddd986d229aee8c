"""Rules that pages and chunks must meet, as rows of findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.config import CONTENT_TYPES, DEFAULT, PAGE_CLASSES, STATEMENTS, Settings
from folioforge.functions import text as T


def _finding(rule: Column, severity: str, name: str, message: Column, suspicious: bool = False) -> Column:
    row = F.struct(F.lit(severity).alias("severity"), F.lit(name).alias("rule"), message.alias("message"), F.lit(suspicious).alias("suspicious"))
    return F.when(F.coalesce(rule, F.lit(False)), row)


def _rows(df: DataFrame, keys: list, rules: list[Column]) -> DataFrame:
    return df.select(*keys, F.inline(F.filter(F.array(*rules), lambda x: x.isNotNull())))


def cut_statement(text: Column) -> Column:
    """The keyword of a statement that seems cut off: of the first keyword (in their fixed order) that occurs, the rest of the text is
    short and ends neither in a semicolon nor in END."""
    upper = F.upper(text)
    out = F.lit(None).cast("string")
    for k in reversed(STATEMENTS):
        at = F.locate(f"{k} ", upper)
        rest = F.substring(text, at, F.length(text))
        ends = T.rstrip(rest)
        bad = ~ends.endswith(";") & ~ends.endswith("END") & (F.length(rest) < 200)
        out = F.when(at > 0, F.when(bad, F.lit(k))).otherwise(out)
    return out


def unbalanced(text: Column) -> Column:
    """BEGIN and END both occur, not equally often, and differ by three at most."""
    upper = F.upper(text)
    begins, ends = F.regexp_count(upper, F.lit("BEGIN")), F.regexp_count(upper, F.lit("END"))
    return (begins > 0) & (ends > 0) & (begins != ends) & (F.abs(begins - ends) <= 3)


def chunk_findings(chunks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, chunk_index, severity, rule, message, suspicious), a row per rule that a chunk breaks; one pass over the chunks.

    Null text is blank; a null token_count is not positive. Which of several chunks of one index is the first goes by text.
    """
    per_source = Window.partitionBy("source")
    nth = F.row_number().over(Window.partitionBy("source", "chunk_index").orderBy(F.xxhash64("text"), "page_start", "page_end"))
    flags = chunks.select(
        "source", "chunk_index", "page_start", "page_end", "token_count", "has_code", "metadata", F.coalesce(T.is_blank(F.col("text")), F.lit(True)).alias("blank"),
        F.when(F.col("has_code"), cut_statement(F.col("text"))).alias("cut"), (F.col("has_code") & unbalanced(F.col("text"))).alias("unbalanced"), F.xxhash64("text").alias("text"),
    )
    has_section = F.coalesce(F.col("metadata.section") != "", F.lit(False))
    df = flags.withColumn("nth", nth).withColumn("no_section", ~has_section & F.bool_or(has_section).over(per_source))
    tokens, said = F.coalesce("token_count", F.lit(0)), lambda text, *c: F.format_string(text, "chunk_index", *c)
    content = F.col("metadata.content_type")
    rules = [
        _finding(F.col("blank"), "error", "empty_text", said("Chunk %d: empty text")),
        _finding(F.col("nth") > 1, "error", "duplicate_index", said("Chunk %d: duplicate chunk_index")),
        _finding(F.col("page_start") > F.col("page_end"), "error", "page_order", said("Chunk %d: page_start > page_end")),
        _finding(content.isNull() | ~content.isin(*CONTENT_TYPES), "error", "content_type", said("Chunk %d: invalid content_type")),
        _finding(tokens <= 0, "error", "token_count", said("Chunk %d: non-positive token_count")),
        _finding(tokens < settings.min_tokens, "warning", "below_min", said(f"Chunk %d: below min_tokens (%d < {settings.min_tokens})", tokens)),
        _finding(tokens < settings.small_chunk_tokens, "warning", "extremely_small", said("Chunk %d: extremely small (%d tokens)", tokens), True),
        _finding(tokens > settings.large_chunk_tokens, "warning", "extremely_large", said("Chunk %d: extremely large (%d tokens)", tokens), True),
        _finding(F.coalesce(F.col("metadata.source"), F.lit("")) == "", "error", "missing_source", said("Chunk %d: missing source metadata"), True),
        _finding(F.col("cut").isNotNull(), "warning", "cut_statement", said("Chunk %d: possible truncated code near '%s'", "cut")),
        _finding(F.col("unbalanced"), "warning", "unbalanced_code", said("Chunk %d: possible broken/unbalanced code block"), True),
        _finding(F.col("no_section"), "warning", "missing_section", said("Chunk %d: missing section metadata"), True),
    ]
    return _rows(df, ["source", "chunk_index"], rules)


def page_findings(pages: DataFrame) -> DataFrame:
    """(source, page_number, severity, rule, message, suspicious) of pages; page_number is null where the source as a whole fails."""
    own = _rows(
        pages,
        ["source", "page_number"],
        [
            _finding(F.col("extraction_status") == "pending", "error", "status_pending", F.format_string("Page %d: extraction status never set", "page_number")),
            _finding(F.col("page_class").isNull() | ~F.col("page_class").isin(*PAGE_CLASSES), "error", "page_class", F.format_string("Page %d: invalid page_class %s", "page_number", "page_class")),
        ],
    )
    # numbers are 1..n exactly if they are distinct, begin with 1 and end with n: no order over a source is needed
    numbers = pages.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("page_number").alias("d"), F.min("page_number").alias("lo"), F.max("page_number").alias("hi"))
    broken = (F.col("n") != F.col("d")) | (F.col("lo") != 1) | (F.col("hi") != F.col("n"))
    gaps = _rows(numbers, ["source", F.lit(None).cast("int").alias("page_number")], [_finding(broken, "error", "page_numbers", F.format_string("Page numbers not contiguous: expected 1..%d", "n"))])
    return own.unionByName(gaps)


def findings(pages: DataFrame, chunks: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(source, severity, rule, chunk_index, page_number, message, suspicious) of all rules, sources without chunks and chunks of
    unknown sources among them."""
    none = F.lit(None).cast("int")
    of_chunks = chunk_findings(chunks, settings).withColumn("page_number", none)
    of_pages = page_findings(pages).withColumn("chunk_index", none)
    sources, chunked = pages.select("source").distinct(), chunks.select("source").distinct()
    empty = _rows(sources.join(chunked, "source", "left_anti"), ["source"], [_finding(F.lit(True), "error", "no_chunks", F.lit("No chunks produced"))]).withColumn("chunk_index", none).withColumn("page_number", none)
    stray = chunks.select("source", "chunk_index").join(sources, "source", "left_anti")
    unknown = _rows(stray, ["source", "chunk_index"], [_finding(F.lit(True), "error", "source_mismatch", F.format_string("Chunk %d: source mismatch", "chunk_index"))]).withColumn("page_number", none)
    columns = ["source", "severity", "rule", "chunk_index", "page_number", "message", "suspicious"]
    return of_chunks.select(columns).unionByName(of_pages.select(columns)).unionByName(empty.select(columns)).unionByName(unknown.select(columns))


def validation_reports(found: DataFrame) -> DataFrame:
    """(source, ok, errors, warnings, small_chunk_indices, suspicious_chunk_indices) by source with findings."""
    return found.groupBy("source").agg(
        (F.count_if(F.col("severity") == "error") == 0).alias("ok"), F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.array_sort(F.collect_list(F.when(F.col("rule") == "below_min", F.col("chunk_index")))).alias("small_chunk_indices"),
        F.array_sort(F.collect_set(F.when(F.col("suspicious"), F.col("chunk_index")))).alias("suspicious_chunk_indices"),
    )
