"""Scalar text functions with the semantics of Unicode white space, on the JVM where it can express them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from folioforge.config import ATOMIC_KINDS, CODE_START, DEFAULT, Settings

#: Members of a character class: all Unicode white space, for Java and RE2 alike.
SPACE = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+"
NUMBER_LINE = rf"^[\p{{Nd}}{SPACE}./-]+$"
LIST_ITEM = rf"^[{SPACE}]*([•\-*+–—]|\p{{Nd}}+[.)])[{SPACE}]+[^{SPACE}]"
NUMBERED = rf"^[{SPACE}]*(\p{{Nd}}+(?:\.\p{{Nd}}+)*)[.)]?[{SPACE}]+[^{SPACE}]"
SPECIAL = rf"(?iu)^[{SPACE}]*(exemple|example|note|remarque|définition|definition)(?![\p{{L}}\p{{N}}_])"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACE}]+$", "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{SPACE}]")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), 0)


def count_tokens(text: Column) -> Column:
    """Runs of characters other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0))


def lines_of(text: Column) -> Column:
    """The non-blank lines of a text, stripped."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def python_pattern(pattern: str) -> str:
    """A pattern written for Python's re, for Java: white space, digits and word characters in the Unicode sense."""
    return pattern.replace(r"\s", f"[{SPACE}]").replace(r"\d", r"\p{Nd}")


def any_of(patterns: tuple[str, ...]) -> str:
    return "(?iu)" + "|".join(f"(?:{python_pattern(p)})" for p in patterns) if patterns else r"(?!)"


def _fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def norm_line(line: str) -> str:
    """Without compatibility forms and accents, lower case, white space stripped and single."""
    return re.sub(r"\s+", " ", _fold(line).strip())


def norm_title(title: str) -> str:
    """Letters a-z and digits of the folded title, other runs as one space."""
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9 ]+", " ", _fold(title))).strip()


@F.pandas_udf(ArrayType(StringType()))
def norm_lines(text: pd.Series) -> pd.Series:
    """``norm_line`` of each line of a text, one Python call a text."""
    return pd.Series([None if t is None else [norm_line(x) for x in t.split("\n")] for t in text])


@F.pandas_udf(StringType())
def norm_titles(title: pd.Series) -> pd.Series:
    return title.map(lambda t: None if t is None else norm_title(t))


def code_line_pattern(settings: Settings = DEFAULT) -> str:
    """A line that opens with a keyword, or ends in a semicolon and has one anywhere; for Java and RE2 alike."""
    any_word = "|".join(map(re.escape, settings.sql_keywords))
    return rf"(?is)^[{SPACE}]*[();]*(?:{any_word})[();]*(?:[{SPACE}]|$)|(?:{any_word}).*;[{SPACE}]*$"


def code_like_pattern(settings: Settings = DEFAULT) -> str:
    """The looser test: also an assignment, a line of several words that ends in a semicolon, or one that opens as code does."""
    start = "|".join(map(re.escape, CODE_START))
    return rf"{code_line_pattern(settings)}|:=|[^{SPACE}][{SPACE}]+[^{SPACE}].*;[{SPACE}]*$|[^{SPACE}][{SPACE}]+;[{SPACE}]*$|^[{SPACE}]*[();]*(?:{start})[();]*(?:[{SPACE}]|$)"


def is_code_line(line: Column, settings: Settings = DEFAULT) -> Column:
    return line.rlike(code_line_pattern(settings))


def looks_like_code(line: Column, settings: Settings = DEFAULT) -> Column:
    return line.rlike(code_like_pattern(settings))


def is_list_item(line: Column) -> Column:
    return line.rlike(LIST_ITEM)


def special_kind(line: Column) -> Column:
    """example, note or definition for a line with such a lead-in, else null."""
    word = F.lower(F.regexp_extract(line, SPECIAL, 1))
    return F.when(word.isin("exemple", "example"), "example").when(word.isin("note", "remarque"), "note").when(word != "", "definition")


def is_heading(line: Column, next_line: Column, settings: Settings = DEFAULT) -> Column:
    s = strip(line)
    after = strip(F.coalesce(next_line, F.lit("")))
    dots = F.length(s) - F.length(F.replace(s, F.lit("."), F.lit("")))
    first = F.substring(s, 1, 1)
    return (
        F.when((s == "") | (F.length(s) > 90), False)
        .when(s.rlike(NUMBERED), True)
        .when(looks_like_code(s, settings) | is_list_item(s) | (dots >= 3), False)
        .when((F.upper(s) == s) & (F.length(s) > 3), True)
        .when((after == "") | after.startswith("(p."), True)
        .otherwise((F.length(s) <= 60) & first.rlike(r"^\p{Lu}") & ~s.rlike(r"[.;:]$"))
    )


def heading_level(line: Column) -> Column:
    number = F.regexp_extract(line, NUMBERED, 1)
    return F.when(number == "", 1).otherwise(F.size(F.split(number, r"\.")))


def block_kind(lines: Column, next_line: Column, settings: Settings = DEFAULT) -> Column:
    """The kind of a run of lines, given the first line of the next run (null if there is none)."""
    first = strip(lines[0])
    code: Callable[[Column], Column] = lambda x: looks_like_code(x, settings)
    codes = F.size(F.filter(lines, code))
    return (
        F.when(special_kind(first).isNotNull(), special_kind(first))
        .when(code(first) | ((F.size(lines) >= 3) & (codes * 2 > F.size(lines))), "code")
        .when(is_heading(first, next_line, settings), "heading")
        .when(is_list_item(first), "list")
        .when(first.contains("|"), "table")
        .otherwise("paragraph")
    )


def is_atomic(kind: Column) -> Column:
    return kind.isin(*ATOMIC_KINDS)
