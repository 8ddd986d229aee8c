"""The registered queries of the core and the DuckDB statements that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.config import CODE_START, DEFAULT, SQL_KEYWORDS, STATEMENTS, Settings
from folioforge.functions import text as T
from folioforge.operators import blocks as B
from folioforge.operators import chunks as C
from folioforge.operators import pages as P
from folioforge.operators import report as R
from folioforge.operators import structure as S
from folioforge.operators import validate as V
from folioforge.operators import vectors as X
from folioforge.operators.embed import HashingEmbedder, embed, embedding_records
from folioforge.operators.rag import context_of, prompt_of, tagged
from folioforge.plans.pipeline import ingest
from folioforge.sources.pages import pages_from_documents

Query = Callable[[SparkSession, str], DataFrame]
EXACT = Settings(title_similarity_threshold=1.0)
QUERY_VECTOR = 7  # vec_id of embeddings that is asked
BATCH_VECTORS = tuple(range(0, 40))


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return P.pages_of(_read(spark, d, "pages"))


def _once(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropDuplicates(list(keys))


def token_counts(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d).select("source", "page_number", T.count_tokens(F.col("raw_text")).alias("tokens"))


def page_counts(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d).groupBy("source").agg(F.count("*").alias("n_pages"), F.max("page_number").alias("last_page"))


def document_pages(s: SparkSession, d: str) -> DataFrame:
    return pages_from_documents(_read(s, d, "documents")).select("source", "page_number", F.length("raw_text").alias("n"))


def first_pages(s: SparkSession, d: str) -> DataFrame:
    return P.pages_of(_read(s, d, "pages"), Settings(max_pages=3)).select("source", "page_number", F.length("raw_text").alias("n"))


def chunk_grep(s: SparkSession, d: str) -> DataFrame:
    return _once(_read(s, d, "chunks"), "chunk_id").where(F.lower("text").contains("proc")).select("chunk_id")


def page_classification(s: SparkSession, d: str) -> DataFrame:
    return P.classify_pages(_pages(s, d)).select("source", "page_number", "page_class")


def class_counts(s: SparkSession, d: str) -> DataFrame:
    return R.page_counts(P.classify_pages(_pages(s, d)))


def _lines(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d).select("source", "page_number", F.posexplode(F.split("raw_text", "\n")).alias("at", "line")).select("source", "page_number", F.col("at").alias("line_no"), T.strip(F.col("line")).alias("line"))


def line_explode(s: SparkSession, d: str) -> DataFrame:
    return _lines(s, d).where("line <> ''")


def email_lines(s: SparkSession, d: str) -> DataFrame:
    lines = embed_free(_read(s, d, "documents"))
    return lines.where(F.col("line").rlike(T.EMAIL)).select("doc_id", "line_no")


def embed_free(documents: DataFrame) -> DataFrame:
    rows = documents.where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.select("doc_id", "line_no", T.strip(F.col("line")).alias("line"))


def footer_lines(s: SparkSession, d: str) -> DataFrame:
    settings = Settings(footer_patterns=(*DEFAULT.footer_patterns, r"reproduction interdite", r"^page\s+\d+"))
    return _lines(s, d).where(F.col("line").rlike(T.any_of(settings.footer_patterns))).select("source", "page_number", "line_no")


def number_lines(s: SparkSession, d: str) -> DataFrame:
    return _lines(s, d).where(F.col("line").rlike(T.NUMBER_LINE) & (F.length("line") <= 6)).select("source", "page_number", "line_no")


def normalized_lines(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d).select("source", "page_number", F.posexplode(T.norm_lines("raw_text")).alias("line_no", "norm"))


def boilerplate_lines(s: SparkSession, d: str) -> DataFrame:
    return P.boilerplate_lines(_pages(s, d))


def _cleaned(s: SparkSession, d: str) -> DataFrame:
    return P.clean_pages(_pages(s, d))


def cleaned_pages(s: SparkSession, d: str) -> DataFrame:
    return _cleaned(s, d).select("source", "page_number", "cleaned_text", "has_code", "page_class")


def chunking_text(s: SparkSession, d: str) -> DataFrame:
    return _cleaned(s, d).select("source", "page_number", F.length(P.text_for_chunking(F.col("cleaned_text"), F.col("raw_text"))).alias("n"), (F.col("cleaned_text") == "").alias("fell_back"))


def _raw_heads(s: SparkSession, d: str) -> DataFrame:
    """Heads of the raw pages: structure on its own input, which labels and markers survive."""
    return S.page_heads(_pages(s, d).withColumn("cleaned_text", F.lit("")))


def first_line_labels(s: SparkSession, d: str) -> DataFrame:
    return S.first_line_labels(_raw_heads(s, d))


def doc_types(s: SparkSession, d: str) -> DataFrame:
    return S.doc_types(_raw_heads(s, d))


def page_titles(s: SparkSession, d: str) -> DataFrame:
    return S.page_titles(_raw_heads(s, d)).select("source", "page_number", "title")


def chapter_fill(s: SparkSession, d: str) -> DataFrame:
    return S.page_chapters(S.page_titles(_raw_heads(s, d))).select("source", "page_number", "chapter")


def title_groups_exact(s: SparkSession, d: str) -> DataFrame:
    return S.page_groups(S.page_chapters(S.page_titles(_raw_heads(s, d))), EXACT).select("source", "page_number", "group_ord")


def title_groups(s: SparkSession, d: str) -> DataFrame:
    return S.page_groups(S.page_chapters(S.page_titles(_raw_heads(s, d)))).select("source", "page_number", "group_ord", "group_title", "chapter")


def group_pages(s: SparkSession, d: str) -> DataFrame:
    groups = _once(_read(s, d, "page_groups"), "source", "group_ord").select("source", "group_ord", F.explode("page_numbers").alias("page_number"))
    return groups.join(_pages(s, d), ["source", "page_number"]).select("source", "group_ord", "page_number", F.length("raw_text").alias("n"))


def code_lines(s: SparkSession, d: str) -> DataFrame:
    rows = _lines(s, d).where("line <> ''")
    return rows.select("source", "page_number", "line_no", T.is_code_line(F.col("line")).alias("is_code"), T.looks_like_code(F.col("line")).alias("looks_like_code"), T.is_list_item(F.col("line")).alias("is_list"), T.special_kind(F.col("line")).alias("special"))


def _texts(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d).select("source", F.lit(0).alias("group_ord"), F.col("page_number").alias("page"), F.col("raw_text").alias("text"))


def block_kinds(s: SparkSession, d: str) -> DataFrame:
    return B.typed_runs(_texts(s, d)).select("source", "page", "run", "kind", "level")


def page_blocks(s: SparkSession, d: str) -> DataFrame:
    return B.split_into_blocks(_texts(s, d)).select("source", "page", "block", "kind", "level", "atomic", F.length("text").alias("n"))


def _block_rows(s: SparkSession, d: str) -> DataFrame:
    rows = _once(_read(s, d, "blocks"), "source", "group_ord", "block_ord").where("text IS NOT NULL")
    return rows.select("source", "group_ord", F.col("block_ord").cast("bigint").alias("ord"), "page", F.coalesce("kind", F.lit("paragraph")).alias("kind"), F.coalesce("level", F.lit(0)).alias("level"), F.coalesce("atomic", F.lit(False)).alias("atomic"), "text")


def sentence_split(s: SparkSession, d: str) -> DataFrame:
    cut = B.split_overlong(_block_rows(s, d))
    return cut.groupBy("source", "group_ord", "ord").agg(F.count("*").alias("pieces"), F.sum(T.count_tokens(F.col("text"))).alias("tokens"))


def _parts(s: SparkSession, d: str) -> DataFrame:
    rows = _block_rows(s, d).withColumn("tokens", T.count_tokens(F.col("text"))).withColumn("title", F.when(F.col("kind") == "heading", C.heading_title(F.col("text"))))
    packed = C.pack_parts(rows)
    of_block = packed.where("ord IS NOT NULL").select("source", "group_ord", "ord", "part")
    sums = rows.join(of_block, ["source", "group_ord", "ord"]).groupBy("source", "group_ord", "part").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_blocks"))
    return sums.join(packed.where("ord IS NULL").select("source", "group_ord", "part", "section", "subsection"), ["source", "group_ord", "part"])


def chunk_parts(s: SparkSession, d: str) -> DataFrame:
    return _parts(s, d)


def merged_parts(s: SparkSession, d: str) -> DataFrame:
    return C.merge_small(_parts(s, d)).select("source", "group_ord", "part", "chunk", "section", "subsection")


def overlap_tails(s: SparkSession, d: str) -> DataFrame:
    return _once(_read(s, d, "chunks"), "chunk_id").where("text IS NOT NULL").select("chunk_id", C.overlap_tail(F.col("text")).alias("tail"))


def chunk_ids(s: SparkSession, d: str) -> DataFrame:
    rows = _once(_read(s, d, "page_groups"), "source", "group_ord").select("source", "group_ord", F.lit(0).alias("chunk"))
    numbered = rows.join(C.chunk_numbers(rows), ["source", "group_ord"]).withColumn("chunk_index", F.col("before") + F.col("chunk"))
    return numbered.select("source", "group_ord", F.format_string("%s::chunk-%04d", "source", "chunk_index").alias("chunk_id"))


def chunks_of_blocks(s: SparkSession, d: str) -> DataFrame:
    groups = _once(_read(s, d, "page_groups"), "source", "group_ord").select("source", "group_ord", "chapter", "title")
    made = C.assemble(B.split_overlong(_block_rows(s, d)).withColumn("ord", F.col("ord") * 2**20 + F.col("piece")), groups)
    return made.select("chunk_id", "source", "chunk_index", "page_start", "page_end", "token_count", "content_type", "section", "subsection", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def chunk_metadata(s: SparkSession, d: str) -> DataFrame:
    rows = _once(_read(s, d, "chunks"), "chunk_id").withColumn("code_blocks", F.col("metadata.code_blocks"))
    return rows.select("chunk_id", F.to_json(C.compose_metadata().dropFields("content"), {"ignoreNullFields": "false"}).alias("record"))


def chunk_summaries(s: SparkSession, d: str) -> DataFrame:
    return C.chunk_summary(_once(_read(s, d, "chunks"), "chunk_id")).groupBy("content_type", "has_code").agg(F.count("*").alias("n"), F.min("page_start").alias("first_page"), F.max("page_end").alias("last_page"))


def chunks_full(s: SparkSession, d: str) -> DataFrame:
    return ingest(_read(s, d, "pages")).chunks.select("chunk_id", "chunk_index", "source", "page_start", "page_end", "chapter", "slide_title", "section", "subsection", "content_type", "token_count", "text")


def chunk_findings(s: SparkSession, d: str) -> DataFrame:
    return V.chunk_findings(_once(_read(s, d, "chunks"), "chunk_id")).select("source", "chunk_index", "severity", "rule", "suspicious")


def page_findings(s: SparkSession, d: str) -> DataFrame:
    pages = _once(_read(s, d, "pages"), "source", "page_number")
    return V.page_findings(pages).select("source", "page_number", "severity", "rule")


def validation_findings(s: SparkSession, d: str) -> DataFrame:
    return V.findings(_once(_read(s, d, "pages"), "source", "page_number"), _once(_read(s, d, "chunks"), "chunk_id")).groupBy("severity", "rule").agg(F.count("*").alias("n"))


def suspicious_chunks(s: SparkSession, d: str) -> DataFrame:
    found = V.validation_reports(V.chunk_findings(_once(_read(s, d, "chunks"), "chunk_id")))
    return found.select("source", "ok", "errors", "warnings", F.array_join("small_chunk_indices", ",").alias("small"), F.array_join("suspicious_chunk_indices", ",").alias("suspicious"))


def report_counts(s: SparkSession, d: str) -> DataFrame:
    groups, chunks = _once(_read(s, d, "page_groups"), "source", "group_ord"), _once(_read(s, d, "chunks"), "chunk_id")
    return R.chapter_counts(groups).withColumn("chapters", F.array_join("chapters", "|")).join(R.chunk_counts(chunks).drop("avg_chunk_tokens"), "source", "full")


def ingestion_report(s: SparkSession, d: str) -> DataFrame:
    return ingest(_read(s, d, "pages")).report


def l2_normalize(s: SparkSession, d: str) -> DataFrame:
    rows = _read(s, d, "embeddings").select("vec_id", X.unit(F.col("embedding")).alias("u"))
    return rows.select("vec_id", F.round(F.element_at("u", 1), 5).alias("first"), F.round(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x), 4).alias("norm"))


def _query_vector(s: SparkSession, d: str) -> list[float]:
    return _read(s, d, "embeddings").where(F.col("vec_id") == QUERY_VECTOR).first()["embedding"]


def vector_topk(s: SparkSession, d: str) -> DataFrame:
    return X.top_k(_read(s, d, "embeddings"), _query_vector(s, d), 5, "vec_id").select("vec_id", F.round("score", 4).alias("score"))


def filtered_topk(s: SparkSession, d: str) -> DataFrame:
    return X.top_k(_read(s, d, "embeddings"), _query_vector(s, d), 5, "vec_id", where=F.col("label") == 1).select("vec_id", F.round("score", 4).alias("score"))


def vector_topk_batch(s: SparkSession, d: str) -> DataFrame:
    rows = _read(s, d, "embeddings")
    asked = [(r.vec_id, r.embedding) for r in rows.where(F.col("vec_id").isin(*BATCH_VECTORS)).orderBy("vec_id").collect()]
    return X.top_k_batch(rows, asked, 5, "vec_id").select("query", "rank", "vec_id", F.round("score", 4).alias("score"))


def append_vectors(s: SparkSession, d: str) -> DataFrame:
    rows = _read(s, d, "chunk_vectors").select("chunk_id", F.size("embedding").alias("n"))
    return X.append_vectors(rows, rows).groupBy("chunk_id").agg(F.count("*").alias("n_rows"))


def vector_shapes(s: SparkSession, d: str) -> DataFrame:
    rows = _read(s, d, "chunk_vectors")
    return rows.groupBy("model", F.coalesce(F.size("embedding"), F.lit(-1)).alias("dimension")).agg(F.count("*").alias("n"))


def hash_embed(s: SparkSession, d: str) -> DataFrame:
    rows = embed(_once(_read(s, d, "chunks"), "chunk_id").select("chunk_id", "text"), HashingEmbedder(64))
    return rows.select("chunk_id", "model", F.round(X.inner_product(F.col("embedding"), F.col("embedding")), 3).alias("norm"))


def retrieve_text(s: SparkSession, d: str) -> DataFrame:
    embedder = HashingEmbedder(256)
    records = embedding_records(_once(_read(s, d, "chunks"), "chunk_id"), embedder)
    return X.top_k(records, embedder.encode(["Création du dictionnaire de données"])[0].tolist(), 5).select("chunk_id", F.round("score", 4).alias("score"))


def source_tags(s: SparkSession, d: str) -> DataFrame:
    return _once(_read(s, d, "chunks"), "chunk_id").select("chunk_id", F.length(tagged(F.col("chunk_id"), F.coalesce("text", F.lit("")))).alias("n"))


def prompt_context(s: SparkSession, d: str) -> DataFrame:
    best = _once(_read(s, d, "chunks"), "chunk_id").select("chunk_id", "text", F.coalesce("token_count", F.lit(0)).cast("double").alias("score")).orderBy(F.desc("score"), "chunk_id").limit(5)
    return context_of(best).select(prompt_of(F.col("context"), F.lit("Qu'est-ce qu'un index ?")).alias("prompt"))


_NAMES = """token_counts page_counts document_pages first_pages chunk_grep page_classification class_counts line_explode email_lines footer_lines number_lines normalized_lines boilerplate_lines cleaned_pages
chunking_text first_line_labels doc_types page_titles chapter_fill title_groups_exact title_groups group_pages code_lines block_kinds page_blocks sentence_split chunk_parts merged_parts overlap_tails chunk_ids
chunks_of_blocks chunk_metadata chunk_summaries chunks_full chunk_findings page_findings validation_findings suspicious_chunks report_counts ingestion_report l2_normalize vector_topk filtered_topk vector_topk_batch
append_vectors vector_shapes hash_embed retrieve_text source_tags prompt_context""".split()


def queries() -> dict[str, Query]:
    return {n: globals()[n] for n in _NAMES}


def oracle_sql() -> dict[str, str]:
    from folioforge.plans.oracle import statements

    return statements(CODE_START, SQL_KEYWORDS, STATEMENTS, QUERY_VECTOR, BATCH_VECTORS)
