"""DuckDB statements that compute what the core's queries compute."""

from __future__ import annotations

import re

from folioforge.config import DEFAULT, PAGE_CLASSES
from folioforge.functions import text as T
from folioforge.plans import catalog

W = T.SPACE
_WIDE = "".join(chr(i) for i in range(0xFF01, 0xFF5F))
_SPACES = "".join(map(chr, [0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]))
_LIGATURES = {0xFB00: "ff", 0xFB01: "fi", 0xFB02: "fl", 0xFB03: "ffi", 0xFB04: "ffl", 0x2026: "..."}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{W}]+|[{W}]+$', '', 'g')"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{W}]+')"


def tokens(x: str) -> str:
    return f"coalesce(len({words(x)}), 0)"


def folded(x: str) -> str:
    spaces = "||".join(f"chr({ord(c)})" for c in _SPACES)
    out = f"translate(translate({x}, {spaces}, '{' ' * len(_SPACES)}'), {q(_WIDE)}, {q(''.join(chr(ord(c) - 0xFEE0) for c in _WIDE))})"
    for i, y in _LIGATURES.items():
        out = f"replace({out}, chr({i}), '{y}')"
    return f"strip_accents(lower({out}))"


def norm_line(x: str) -> str:
    return f"regexp_replace({strip(folded(x))}, '[{W}]+', ' ', 'g')"


def norm_title(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({folded(x)}, '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def rx(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def any_of(patterns: tuple[str, ...]) -> str:
    return "(?i)" + "|".join(f"(?:{T.python_pattern(p)})" for p in patterns)


UPPER = r"^\p{Lu}"
PAGES = "pg AS (SELECT DISTINCT ON (source, page_number) source, page_number, coalesce(raw_text, '') AS raw_text FROM pages WHERE source IS NOT NULL AND page_number IS NOT NULL)"
LINES = f"{PAGES}, ln AS (SELECT source, page_number, CAST(i - 1 AS INTEGER) AS line_no, {strip('l[i]')} AS line FROM (SELECT *, string_split(raw_text, chr(10)) AS l FROM pg), unnest(range(1, len(l) + 1)) AS u(i))"
CHUNKS = "ck AS (SELECT DISTINCT ON (chunk_id) * FROM chunks)"
GROUPS = "gr AS (SELECT DISTINCT ON (source, group_ord) * FROM page_groups)"
BOILER = (
    f"{LINES}, tot AS (SELECT source, count(*) AS total FROM pg GROUP BY source), nm AS (SELECT DISTINCT source, page_number, {norm_line('line')} AS norm FROM ln), "
    "bp AS (SELECT nm.source, norm AS line, count(*) AS pages FROM nm JOIN tot USING (source) WHERE norm <> '' AND length(norm) <= 120 GROUP BY nm.source, norm, total HAVING count(*) / total >= 0.25)"
)
CLASS = f"CASE WHEN length({strip('raw_text')}) <= 20 THEN 'no_text' WHEN length({strip('raw_text')}) <= 120 THEN 'hybrid' ELSE 'native_text' END"
CLEAN = (
    f"{BOILER}, kept AS (SELECT ln.source, page_number, line_no, ln.line FROM ln LEFT JOIN bp ON ln.source = bp.source AND {norm_line('ln.line')} = bp.line WHERE bp.line IS NULL AND ln.line <> '' "
    f"AND NOT {rx('ln.line', T.EMAIL)} AND NOT {rx('ln.line', any_of(DEFAULT.footer_patterns))} AND NOT ({rx('ln.line', T.NUMBER_LINE)} AND length(ln.line) <= 6)), "
    "joined AS (SELECT source, page_number, string_agg(line, chr(10) ORDER BY line_no) AS t FROM kept GROUP BY ALL), "
    f"cl AS (SELECT pg.source, pg.page_number, pg.raw_text, {CLASS} AS page_class, coalesce({strip('''regexp_replace(replace(t, chr(160), ' '), '[ \\t]+', ' ', 'g')''')}, '') AS cleaned_text FROM pg LEFT JOIN joined USING (source, page_number))"
)
HEADS = (
    f"{LINES}, nb AS (SELECT *, row_number() OVER (PARTITION BY source, page_number ORDER BY line_no) AS n FROM ln WHERE line <> ''), "
    "hd AS (SELECT pg.source, pg.page_number, max(line) FILTER (n = 1) AS line1, max(line) FILTER (n = 2) AS line2, "
    f"arg_min(line, line_no) FILTER ({rx('line', any_of(DEFAULT.chapter_patterns))}) AS chapter_line FROM pg LEFT JOIN nb USING (source, page_number) GROUP BY ALL), "
    f"lb AS (SELECT *, {norm_title('''coalesce(line1, '')''')} AS label FROM hd), "
    "fq AS (SELECT source, label, count(*) AS freq FROM lb WHERE label <> '' GROUP BY ALL), "
    "ti AS (SELECT lb.*, coalesce(CASE WHEN coalesce(freq, 0) >= 4 THEN coalesce(line2, line1) ELSE line1 END, '(page ' || page_number || ')') AS title FROM lb LEFT JOIN fq USING (source, label)), "
    "ch AS (SELECT *, coalesce(last_value(chapter_line IGNORE NULLS) OVER (PARTITION BY source ORDER BY page_number), last_value(chapter_line IGNORE NULLS) OVER (PARTITION BY source ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), "
    "first_value(title) OVER (PARTITION BY source ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '') AS chapter FROM ti)"
)


def _re2(pattern: str) -> str:
    return pattern.replace("(?iu)", "(?i)").replace(r"(?![\p{L}\p{N}_])", r"(?:[^\p{L}\p{N}_]|$)")


def _block_kinds() -> str:
    code = lambda x: rx(x, T.code_like_pattern())
    first, special = strip("l[1]"), f"lower(regexp_extract(f, {q(_re2(T.SPECIAL))}, 1))"
    nxt = strip("coalesce(nx, '')")
    heading = (
        f"CASE WHEN length(f) > 90 THEN false WHEN {rx('f', T.NUMBERED)} THEN true WHEN {code('f')} OR {rx('f', T.LIST_ITEM)} OR length(f) - length(replace(f, '.', '')) >= 3 THEN false WHEN upper(f) = f AND length(f) > 3 THEN true "
        f"WHEN {nxt} = '' OR starts_with({nxt}, '(p.') THEN true ELSE length(f) <= 60 AND {rx('f', UPPER)} AND NOT {rx('f', '[.;:]$')} END"
    )
    inner = f"regexp_replace(regexp_replace(raw_text, '^[{W}]*\\n', ''), '\\n[{W}]*$', '')"
    return (
        f"WITH {PAGES}, r0 AS (SELECT source, page_number AS page, regexp_split_to_array({inner}, '\\n[{W}]*\\n') AS r FROM pg WHERE {rx('raw_text', f'[^{W}]')}), "
        "r1 AS (SELECT source, page, CAST(i - 1 AS INTEGER) AS run, string_split(r[i], chr(10)) AS l, string_split(r[i + 1], chr(10))[1] AS nx FROM r0, unnest(range(1, len(r) + 1)) AS u(i)), "
        f"r2 AS (SELECT *, {first} AS f, len(list_filter(l, lambda x: {code('x')})) AS codes FROM r1), "
        f"r3 AS (SELECT *, CASE WHEN {special} IN ('exemple', 'example') THEN 'example' WHEN {special} IN ('note', 'remarque') THEN 'note' WHEN {special} <> '' THEN 'definition' WHEN {code('f')} OR (len(l) >= 3 AND codes * 2 > len(l)) THEN 'code' "
        f"WHEN {heading} THEN 'heading' WHEN {rx('f', T.LIST_ITEM)} THEN 'list' WHEN contains(f, '|') THEN 'table' ELSE 'paragraph' END AS kind FROM r2) "
        f"SELECT source, page, run, kind, CAST(CASE WHEN kind <> 'heading' THEN 0 WHEN regexp_extract(f, {q(T.NUMBERED)}, 1) = '' THEN 1 ELSE len(string_split(regexp_extract(f, {q(T.NUMBERED)}, 1), '.')) END AS INTEGER) AS level FROM r3"
    )


def _chunk_findings(statements: tuple[str, ...]) -> str:
    cut = "CASE " + " ".join(f"WHEN contains(u, '{k} ') THEN {_cut(k)}" for k in statements) + " END"
    count = lambda w: f"len(regexp_extract_all(u, '{w}'))"
    rules = [
        ("error", "empty_text", False, f"text IS NULL OR NOT {rx('text', f'[^{W}]')}"),
        ("error", "duplicate_index", False, "nth > 1"),
        ("error", "page_order", False, "page_start > page_end"),
        ("error", "content_type", False, "metadata.content_type IS NULL OR metadata.content_type NOT IN ('text', 'code')"),
        ("error", "token_count", False, "tk <= 0"),
        ("warning", "below_min", False, "tk < 300"),
        ("warning", "extremely_small", True, "tk < 20"),
        ("warning", "extremely_large", True, "tk > 1500"),
        ("error", "missing_source", True, "coalesce(metadata.source, '') = ''"),
        ("warning", "cut_statement", False, f"has_code AND {cut}"),
        ("warning", "unbalanced_code", True, f"has_code AND {count('BEGIN')} > 0 AND {count('END')} > 0 AND {count('BEGIN')} <> {count('END')} AND abs({count('BEGIN')} - {count('END')}) <= 3"),
        ("warning", "missing_section", True, "coalesce(metadata.section, '') = '' AND any_section"),
    ]
    base = f"WITH {CHUNKS}, c1 AS (SELECT *, upper(text) AS u, coalesce(token_count, 0) AS tk, row_number() OVER (PARTITION BY source, chunk_index) AS nth, bool_or(coalesce(metadata.section, '') <> '') OVER (PARTITION BY source) AS any_section FROM ck) "
    return base + " UNION ALL ".join(f"SELECT source, chunk_index, '{s}' AS severity, '{r}' AS rule, {str(x).lower()} AS suspicious FROM c1 WHERE {w}" for s, r, x, w in rules)


def _cut(k: str) -> str:
    rest = f"substr(text, instr(u, '{k} '))"
    ends = f"regexp_replace({rest}, '[{W}]+$', '')"
    return f"(NOT ends_with({ends}, ';') AND NOT ends_with({ends}, 'END') AND length({rest}) < 200)"


def _page_findings() -> str:
    return f"""WITH p AS (SELECT DISTINCT ON (source, page_number) * FROM pages)
SELECT source, page_number, 'error' AS severity, 'status_pending' AS rule FROM p WHERE extraction_status = 'pending'
UNION ALL SELECT source, page_number, 'error', 'page_class' FROM p WHERE page_class IS NULL OR page_class NOT IN ({", ".join(map(q, PAGE_CLASSES))})
UNION ALL SELECT source, NULL, 'error', 'page_numbers' FROM p GROUP BY source HAVING count(*) <> count(DISTINCT page_number) OR min(page_number) <> 1 OR max(page_number) <> count(*)"""


def statements(code_start, keywords, statement_words, query_vector: int, batch: tuple[int, ...]) -> dict[str, str]:
    unit = "list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])))"
    scores = f"WITH v AS (SELECT *, {unit} AS u FROM embeddings), s AS (SELECT b.vec_id AS query, a.vec_id, a.label, list_inner_product(a.u, b.u) AS score FROM v a, v b WHERE b.vec_id IN ({{}}))"
    findings = _chunk_findings(statement_words)
    extra = (*DEFAULT.footer_patterns, r"reproduction interdite", r"^page\s+\d+")
    blocks = "bk AS (SELECT DISTINCT ON (source, group_ord, block_ord) * FROM blocks WHERE text IS NOT NULL)"
    pieces = f"list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '([.;])[{W}]+', concat('\\1', chr(1)), 'g'), '\\n+', chr(1), 'g'), chr(1)), lambda p: CASE WHEN {tokens('p')} > 700 THEN CAST(ceil({tokens('p')} / 700) AS INTEGER) ELSE 1 END), lambda n: true)"
    count_class = ", ".join(f"count(*) FILTER (page_class = '{c}') AS {c}_pages" for c in PAGE_CLASSES)
    out = {
        "token_counts": f"WITH {PAGES} SELECT source, page_number, {tokens('raw_text')} AS tokens FROM pg",
        "page_counts": f"WITH {PAGES} SELECT source, count(*) AS n_pages, max(page_number) AS last_page FROM pg GROUP BY source",
        "document_pages": "SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS page_number, CAST(length(text) AS INTEGER) AS n FROM documents WHERE source IS NOT NULL",
        "first_pages": f"WITH {PAGES} SELECT source, page_number, CAST(length(raw_text) AS INTEGER) AS n FROM pg WHERE page_number <= 3",
        "chunk_grep": f"WITH {CHUNKS} SELECT chunk_id FROM ck WHERE contains(lower(text), 'proc')",
        "page_classification": f"WITH {PAGES} SELECT source, page_number, {CLASS} AS page_class FROM pg",
        "class_counts": f"WITH {PAGES} SELECT source, count(*) AS total_pages, {count_class} FROM (SELECT source, {CLASS} AS page_class FROM pg) GROUP BY source",
        "line_explode": f"WITH {LINES} SELECT source, page_number, line_no, line FROM ln WHERE line <> ''",
        "email_lines": f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), unnest(range(1, len(l) + 1)) AS u(i) WHERE {rx(strip('l[i]'), T.EMAIL)}",
        "footer_lines": f"WITH {LINES} SELECT source, page_number, line_no FROM ln WHERE {rx('line', any_of(extra))}",
        "number_lines": f"WITH {LINES} SELECT source, page_number, line_no FROM ln WHERE {rx('line', T.NUMBER_LINE)} AND length(line) <= 6",
        "normalized_lines": f"WITH {LINES} SELECT source, page_number, line_no, {norm_line('line')} AS norm FROM ln",
        "boilerplate_lines": f"WITH {BOILER} SELECT source, line, pages FROM bp",
        "cleaned_pages": f"WITH {CLEAN} SELECT source, page_number, cleaned_text, page_class, len(list_filter(string_split(cleaned_text, chr(10)), lambda x: {rx('x', T.code_line_pattern())})) > 0 AS has_code FROM cl",
        "chunking_text": f"WITH {CLEAN} SELECT source, page_number, CAST(length(CASE WHEN cleaned_text <> '' THEN cleaned_text ELSE raw_text END) AS INTEGER) AS n, cleaned_text = '' AS fell_back FROM cl",
        "first_line_labels": f"WITH {HEADS} SELECT source, label, freq FROM fq",
        "doc_types": f"WITH {HEADS} SELECT s.source, CASE WHEN count(*) FILTER (freq >= 4) >= 3 THEN 'slide_deck' ELSE 'document' END AS doc_type FROM (SELECT DISTINCT source FROM lb) s LEFT JOIN fq USING (source) GROUP BY s.source",
        "page_titles": f"WITH {HEADS} SELECT source, page_number, title FROM ti",
        "chapter_fill": f"WITH {HEADS} SELECT source, page_number, chapter FROM ch",
        "title_groups_exact": f"WITH {HEADS}, nt AS (SELECT *, {norm_title('title')} AS nt FROM ch), mk AS (SELECT *, CASE WHEN chapter = lag(chapter) OVER w AND nt <> '' AND nt = lag(nt) OVER w THEN 0 ELSE 1 END AS o FROM nt WINDOW w AS (PARTITION BY source ORDER BY page_number)) "
        "SELECT source, page_number, CAST(sum(o) OVER (PARTITION BY source ORDER BY page_number) - 1 AS INTEGER) AS group_ord FROM mk",
        "group_pages": f"WITH {PAGES}, {GROUPS} SELECT g.source, group_ord, g.page_number, CAST(length(raw_text) AS INTEGER) AS n FROM (SELECT source, group_ord, unnest(page_numbers) AS page_number FROM gr) g JOIN pg USING (source, page_number)",
        "code_lines": f"WITH {LINES} SELECT source, page_number, line_no, {rx('line', T.code_line_pattern())} AS is_code, {rx('line', T.code_like_pattern())} AS looks_like_code, {rx('line', T.LIST_ITEM)} AS is_list, "
        f"CASE WHEN lower(regexp_extract(line, {q(_re2(T.SPECIAL))}, 1)) IN ('exemple', 'example') THEN 'example' WHEN lower(regexp_extract(line, {q(_re2(T.SPECIAL))}, 1)) IN ('note', 'remarque') THEN 'note' WHEN regexp_extract(line, {q(_re2(T.SPECIAL))}, 1) <> '' THEN 'definition' END AS special FROM ln WHERE line <> ''",
        "block_kinds": _block_kinds(),
        "sentence_split": f"WITH {blocks} SELECT source, group_ord, CAST(block_ord AS BIGINT) AS ord, CAST(CASE WHEN NOT coalesce(atomic, false) AND {tokens('text')} > 700 THEN list_sum({pieces}) ELSE 1 END AS BIGINT) AS pieces, {tokens('text')} AS tokens FROM bk",
        "overlap_tails": f"WITH {CHUNKS} SELECT chunk_id, array_to_string(list_slice({words('text')}, greatest(len({words('text')}) - 79, 1), len({words('text')})), ' ') AS tail FROM ck WHERE text IS NOT NULL",
        "chunk_ids": f"WITH {GROUPS} SELECT source, group_ord, printf('%s::chunk-%04d', source, row_number() OVER (PARTITION BY source ORDER BY group_ord) - 1) AS chunk_id FROM gr",
        "chunk_summaries": f"WITH {CHUNKS} SELECT content_type, has_code, count(*) AS n, min(page_start) AS first_page, max(page_end) AS last_page FROM ck GROUP BY ALL",
        "chunk_findings": findings,
        "page_findings": _page_findings(),
        "suspicious_chunks": f"WITH f AS ({findings}) SELECT source, count(*) FILTER (severity = 'error') = 0 AS ok, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, "
        "coalesce(string_agg(chunk_index::VARCHAR, ',' ORDER BY chunk_index) FILTER (rule = 'below_min'), '') AS small, coalesce(array_to_string(list_sort(list(DISTINCT chunk_index) FILTER (suspicious)), ','), '') AS suspicious FROM f GROUP BY source",
        "report_counts": f"WITH {GROUPS}, {CHUNKS}, e AS (SELECT source, coalesce(chapter, '') AS c, min(group_ord) AS o, count(*) AS n FROM gr GROUP BY ALL), a AS (SELECT source, CAST(sum(n) AS BIGINT) AS logical_groups, string_agg(c, '|' ORDER BY o) AS chapters, CAST(count(*) AS INTEGER) AS chapters_detected FROM e GROUP BY source), "
        "b AS (SELECT source, count(*) AS chunks, min(coalesce(token_count, 0)) AS min_chunk_tokens, max(coalesce(token_count, 0)) AS max_chunk_tokens, count(*) FILTER (has_code) AS chunks_with_code, CAST(sum(coalesce(metadata.code_blocks, 0)) AS BIGINT) AS code_blocks_preserved, count(DISTINCT nullif(metadata.section, '')) AS sections_detected FROM ck GROUP BY source) SELECT * FROM a FULL JOIN b USING (source)",
        "l2_normalize": f"SELECT vec_id, round(u[1], 5) AS first, round(list_inner_product(u, u), 4) AS norm FROM (SELECT vec_id, {unit} AS u FROM embeddings)",
        "vector_topk": f"{scores.format(query_vector)} SELECT vec_id, round(score, 4) AS score FROM s ORDER BY s.score DESC, vec_id LIMIT 5",
        "filtered_topk": f"{scores.format(query_vector)} SELECT vec_id, round(score, 4) AS score FROM s WHERE label = 1 ORDER BY s.score DESC, vec_id LIMIT 5",
        "vector_topk_batch": f"{scores.format(', '.join(map(str, batch)))} SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY s.score DESC, vec_id) AS INTEGER) AS rank, vec_id, round(score, 4) AS score FROM s QUALIFY rank <= 5",
        "append_vectors": "SELECT chunk_id, 2 * count(*) AS n_rows FROM chunk_vectors GROUP BY chunk_id",
        "vector_shapes": "SELECT model, CAST(coalesce(len(embedding), -1) AS INTEGER) AS dimension, count(*) AS n FROM chunk_vectors GROUP BY ALL",
        "source_tags": f"WITH {CHUNKS} SELECT chunk_id, CAST(length('[Source: ' || chunk_id || ']' || chr(10) || coalesce(text, '')) AS INTEGER) AS n FROM ck",
    }
    assert not [n for n in out if not re.fullmatch(r"\w+", n) or n not in catalog._NAMES]
    return out
