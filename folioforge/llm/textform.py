"""The printed form of a text: what the reader sees, whatever characters store it.

``canonical`` is the Python form used inside Arrow batches, ``mapped`` the same mapping as a Spark column (without the
composition of accents, which the collation in :mod:`folioforge.llm.lookalike` brings). Null stays null.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of other scripts that print like Latin ones.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "‐": "-", "‑": "-",
}
# Format characters of category Cf that do print.
PRINTING_FORMATS = {0x600, 0x601, 0x602, 0x603, 0x604, 0x605, 0x6DD, 0x70F, 0x890, 0x891, 0x8E2}
LIGATURES = [*range(0xFB00, 0xFB07), 0x132, 0x133, *range(0x1C4, 0x1CD), *range(0x1F1, 0x1F4)]


def _table() -> dict[int, str]:
    out = {ord(a): b for a, b in LOOKALIKES.items()}
    for i in range(0xFFFF):
        c, kind = chr(i), unicodedata.category(chr(i))
        if kind == "Zs":
            out[i] = " "
        elif kind == "Cf" and i not in PRINTING_FORMATS or 0xFE00 <= i <= 0xFE0F or i in (0x34F, 0x0D):
            out[i] = ""
        elif 0xFF01 <= i <= 0xFF5E or i in LIGATURES:
            out[i] = unicodedata.normalize("NFKC", c)
    out.pop(0x20)
    return out


TABLE = _table()
SPECIAL = (
    "[" + "".join(f"\\u{i:04x}" for i in sorted(i for i in TABLE if i < 0x300)) + "\\u0300-\\u052f\\u0600-\\u0605\\u061c\\u1680\\u17b4-\\u180f\\u1ab0-\\u1aff\\u1dc0-\\u1dff\\u2000-\\u2011\\u2028-\\u202f\\u205f-\\u206f\\u20d0-\\u20ff"
    "\\u3000\\ufb00-\\ufb06\\ufe00-\\ufe0f\\ufe20-\\ufe2f\\ufeff\\uff01-\\uff5e\\ufff9-\\ufffb]"
)
_SPECIAL = re.compile(SPECIAL)
_WORD = re.compile(r"[^\W_]+")


def canonical(text: str) -> str:
    """Texts that print alike get the same string; line breaks stay. The form of a text without special characters is itself."""
    try:
        stored = text.encode("latin-1")  # the quick way to rule out nearly all special characters
        if b"\r" not in stored and b"\xa0" not in stored and b"\xad" not in stored:
            return text
    except UnicodeEncodeError:
        if not _SPECIAL.search(text):
            return text
    return unicodedata.normalize("NFC", text.translate(TABLE))


def words(text: str | None) -> list[str]:
    """Runs of letters and digits of the canonical form, lower-cased; [] for null."""
    return _WORD.findall(canonical(text).lower()) if text else []


def without_accents(text: str) -> str:
    """``text`` in canonical form, lower-cased, without combining marks."""
    text = canonical(text).lower()
    if text.isascii():
        return text
    decomposed = unicodedata.normalize("NFD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c)) if not _only_latin(decomposed) else _MARKS.sub("", decomposed)


_MARKS = re.compile("[̀-ͯ]+")
_OTHER = re.compile("[Ͱ-῿Ⰰ-퟿豈-￿]")


def _only_latin(text: str) -> bool:
    return not _OTHER.search(text)


def plain_words(text: str | None) -> list[str]:
    """``words`` without accents."""
    return _WORD.findall(without_accents(text)) if text else []


def mapped(text: Column) -> Column:
    """The look-alike mapping on the JVM; rows without special characters pass unchanged."""
    single = {chr(i): x for i, x in TABLE.items() if len(x) == 1}
    gone = "".join(chr(i) for i, x in TABLE.items() if not x)
    out = F.translate(text, "".join(single) + gone, "".join(single.values()))
    for i, x in TABLE.items():
        if len(x) > 1:
            out = F.replace(out, F.lit(chr(i)), F.lit(x))
    return F.when(text.rlike(SPECIAL), out).otherwise(text)


def _byte_table(accents: bool) -> bytes:
    """For texts of Latin-1 bytes: letters and digits lower-cased (without accents on request), all else a space."""
    out = bytearray(256)
    for i in range(256):
        c = chr(i).lower()
        if not accents:
            c = unicodedata.normalize("NFD", c)[0]
        out[i] = ord(c) if _WORD.fullmatch(chr(i)) and ord(c) < 256 else 0x20
    return bytes(out)


_BYTES = {accents: _byte_table(accents) for accents in (False, True)}
# Common marks outside Latin-1 that are neither letters nor digits.
_MARKS_OUTSIDE = str.maketrans(dict.fromkeys("•–—‘’“”…€", " "))


def word_bytes(text: str | None, accents: bool = True) -> list[bytes]:
    """``words`` (or ``plain_words``) as bytes, by table lookup where the text allows it."""
    if not text:
        return []
    try:
        stored = text.encode("latin-1")
    except UnicodeEncodeError:
        try:
            stored = text.translate(_MARKS_OUTSIDE).encode("latin-1")
        except UnicodeEncodeError:
            stored = None
    if stored is not None and b"\r" not in stored and b"\xa0" not in stored and b"\xad" not in stored:
        return stored.translate(_BYTES[accents]).split()
    out = []
    for w in words(text) if accents else plain_words(text):
        try:
            out.append(w.encode("latin-1"))
        except UnicodeEncodeError:
            out.append(w.encode())
    return out
