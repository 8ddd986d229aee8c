"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

import functools
import unicodedata

from folioforge.llm.textform import TABLE

_SPACE = "[\\s\\x0b\\x1c-\\x1f\\x85\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _quoted(text: str) -> str:
    return "||".join(f"chr({ord(c)})" if not c.isprintable() or unicodedata.category(c) in ("Zs", "Mn") and c != " " else "'" + c.replace("'", "''") + "'" for c in text) or "''"


def canonical_sql(column: str) -> str:
    """The printed form of a text in SQL: single characters by translate, ligatures by replace, accents composed."""
    single = {chr(i): x for i, x in TABLE.items() if len(x) == 1}
    gone = "".join(chr(i) for i, x in TABLE.items() if not x)
    out = f"translate({column}, {_quoted(''.join(single) + gone)}, {_quoted(''.join(single.values()))})"
    for i, x in TABLE.items():
        if len(x) > 1:
            out = f"replace({out}, chr({i}), {_quoted(x)})"
    return f"nfc_normalize({out})"


def tokens_sql(column: str) -> str:
    return f"len(list_filter(regexp_split_to_array({column}, '{_SPACE}+'), lambda x: x <> ''))"


def _p4_found() -> str:
    part = """SELECT '{tab}' AS tab, a.k AS key_a, b.k AS key_b FROM {tab}_form a JOIN {tab}_form b ON a.f = b.f AND a.k < b.k AND a.t <> b.t"""
    form = """{tab}_form AS (SELECT DISTINCT {key} AS k, {text} AS t, {f} AS f FROM {tab} WHERE length({text}) >= 100)"""
    tabs = [{"tab": "pages", "key": "page_id", "text": "raw_text"}, {"tab": "chunks", "key": "chunk_id", "text": "text"}]
    return "WITH " + ", ".join(form.format(**t, f=canonical_sql(t["text"])) for t in tabs) + " " + " UNION ".join(part.format(**t) for t in tabs)


def _lines_cte() -> str:
    norm = f"regexp_replace(regexp_replace(trim(regexp_replace(strip_accents(lower({canonical_sql('raw_text')})), '[^\\S\\n]+', ' ', 'g')), '[0-9]+', '0', 'g'), ' *\\n *', chr(10), 'g')"
    return f"""p AS (SELECT DISTINCT source, page_id, string_split({norm}, chr(10)) AS l FROM pages WHERE source IS NOT NULL AND page_id IS NOT NULL),
q AS (SELECT DISTINCT source, page_id, i AS line_no, trim(l[i]) AS line FROM p, unnest(range(1, len(l) + 1)) AS u(i)),
n AS (SELECT source, count(DISTINCT page_id) AS total FROM pages GROUP BY source),
r AS (SELECT q.source, line FROM q JOIN n USING (source) WHERE line <> '' GROUP BY q.source, line, total HAVING count(DISTINCT page_id) >= 5 AND count(DISTINCT page_id) >= 0.25 * total)"""


def oracle_sql() -> dict[str, str]:
    words = f"list_filter(string_split(regexp_replace(strip_accents(lower({canonical_sql('text')})), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '')"
    grams = "SELECT DISTINCT k, array_to_string(w[i:i + 11], ' ') AS g FROM {t}, unnest(range(1, len(w) - 10)) AS u(i)"
    return {
        "p7_found": f"WITH e AS (SELECT item_id AS k, {words} AS w FROM eval_items WHERE item_id IS NOT NULL AND text IS NOT NULL), d AS (SELECT doc_id AS k, {words} AS w FROM documents WHERE text IS NOT NULL), "
        f"eg AS ({grams.format(t='e')}), dg AS ({grams.format(t='d')}) SELECT DISTINCT dg.k AS doc_id, eg.k AS item_id FROM dg JOIN eg USING (g)",
        "p1_found": """WITH v AS (SELECT chunk_id, any_value(embedding)::FLOAT[96] AS e FROM chunk_vectors WHERE chunk_id IS NOT NULL AND len(embedding) = 96 GROUP BY chunk_id
HAVING list_sum(list_transform(any_value(embedding), lambda x: abs(x))) > 0),
s AS (SELECT a.chunk_id AS a, b.chunk_id AS b, array_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.chunk_id <> b.chunk_id),
r AS (SELECT a, b, c FROM s QUALIFY row_number() OVER (PARTITION BY a ORDER BY c DESC, b) <= 10)
SELECT DISTINCT least(a, b) AS chunk_a, greatest(a, b) AS chunk_b FROM r WHERE c >= 0.8""",
        "p2_found": f"SELECT DISTINCT source, group_ord, block_ord FROM blocks WHERE {tokens_sql('text')} > 700",
        "p4_found": _p4_found(),
        "p5_found": f"WITH {_lines_cte()} SELECT DISTINCT page_id, CAST(line_no AS INTEGER) AS line_no FROM q JOIN r USING (source, line)",
        "p6_found": f"SELECT DISTINCT chunk_id FROM chunks WHERE {tokens_sql('text')} > 700 AND chunk_id IS NOT NULL",
    }
