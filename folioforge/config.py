"""Settings of the pipeline; the defaults are the ones results are compared under."""

from __future__ import annotations

from dataclasses import dataclass

# Words that open a statement of SQL or PL/SQL.
SQL_KEYWORDS = (
    "CREATE", "ALTER", "DROP", "GRANT", "REVOKE", "SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "TRUNCATE", "COMMENT", "BEGIN", "DECLARE",
    "CURSOR", "LOOP", "COMMIT", "ROLLBACK", "END", "IF", "THEN", "ELSE", "ELSIF", "FOR", "WHILE", "TYPE", "PROCEDURE", "FUNCTION", "TRIGGER",
    "PACKAGE", "EXCEPTION", "RETURN", "EXIT", "VARRAY", "VARYING", "DBMS_OUTPUT", "PRAGMA", "RAISE", "WHEN", "CASE",
)
CODE_START = tuple(k for k in SQL_KEYWORDS if k not in ("COMMIT", "ROLLBACK"))
# Keywords after which a statement should end, in the order they are tried.
STATEMENTS = ("CREATE", "SELECT", "INSERT", "UPDATE", "DELETE", "ALTER", "DROP", "GRANT", "REVOKE")
# Lines that are footers or signatures, and lines that open a chapter (case ignored).
FOOTER_PATTERNS = (r"A\.?Amine", r"ABDELLAH", r"Pr\.?\s*Dr\.?\s*Ing", r"Ann[eé]e universitaire", r"usms\.ma")
CHAPTER_PATTERNS = (r"^\s*chapitre\s+\d+", r"^\s*chapter\s+\d+", r"^\s*partie\s+\d+", r"^\s*part\s+\d+")
PAGE_CLASSES = ("native_text", "hybrid", "no_text")
CONTENT_TYPES = ("text", "code")
ATOMIC_KINDS = ("code", "table", "definition", "example", "note")


@dataclass(frozen=True)
class Settings:
    overlap_tokens: int = 80
    max_tokens: int = 700
    min_tokens: int = 300
    no_text_max_chars: int = 20
    hybrid_max_chars: int = 120
    first_line_label_min_freq: int = 4
    boilerplate_fraction: float = 0.25
    boilerplate_max_chars: int = 120
    remove_emails: bool = True
    footer_patterns: tuple[str, ...] = FOOTER_PATTERNS
    chapter_patterns: tuple[str, ...] = CHAPTER_PATTERNS
    title_similarity_threshold: float = 0.9
    small_chunk_tokens: int = 20
    large_chunk_tokens: int = 1500
    sql_keywords: tuple[str, ...] = SQL_KEYWORDS
    max_pages: int = 0
    top_k: int = 5


DEFAULT = Settings()
