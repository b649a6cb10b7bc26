"""Text-level column functions: whitespace pre-tokenisation and UTF-8 bytes.

Whitespace follows Python's ``str.split()`` with no argument: runs of code
points for which ``str.isspace()`` is true, empty pieces dropped.  Java's
``\\s`` is ASCII-only and ``(?U)\\s`` misses U+001C..U+001F, so the class is
spelled out code point by code point.  The same pattern runs in RE2 (DuckDB).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ranges(cps: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for cp in cps:
        if out and out[-1][1] == cp - 1:
            out[-1] = (out[-1][0], cp)
        else:
            out.append((cp, cp))
    return out


def _char_class(cps: list[int]) -> str:
    parts = []
    for lo, hi in _ranges(cps):
        parts.append(f"\\x{{{lo:02X}}}" if lo == hi else f"\\x{{{lo:02X}}}-\\x{{{hi:02X}}}")
    return "[" + "".join(parts) + "]"


# Python's whitespace set, derived from the rule rather than listed.
WHITESPACE_CODEPOINTS: list[int] = [cp for cp in range(0x110000) if chr(cp).isspace()]
# Single-byte (ASCII) members: no BPE rule can contain their byte, because
# training never sees them inside a word.  Splitting on these is exact.
ASCII_WHITESPACE_CODEPOINTS: list[int] = [cp for cp in WHITESPACE_CODEPOINTS if cp < 0x80]

WS_CLASS = _char_class(WHITESPACE_CODEPOINTS)
WS_PATTERN = WS_CLASS + "+"
ASCII_WS_CLASS = _char_class(ASCII_WHITESPACE_CODEPOINTS)
ASCII_WS_PATTERN = ASCII_WS_CLASS + "+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: Column | str) -> Column:
    """``text.split()`` as ``array<string>`` (no empty strings)."""
    return F.filter(F.split(_col(text), WS_PATTERN), lambda w: w != F.lit(""))


def array_size(arr: Column) -> Column:
    """``size`` that is null for a null array whatever ``spark.sql.ansi.enabled``
    and ``spark.sql.legacy.sizeOfNull`` say (the legacy answer is -1)."""
    return F.when(arr.isNotNull(), F.size(arr))


def word_count(text: Column | str) -> Column:
    """``len(text.split())``; null for null text."""
    return array_size(words(text))


def utf8_byte_string(text: Column | str) -> Column:
    """One character per UTF-8 byte: byte ``b`` becomes code point ``b``.

    This is the starting token string; ``char_length`` of it equals
    ``octet_length`` of the text.
    """
    return F.decode(F.encode(_col(text), "UTF-8"), "ISO-8859-1")


def utf8_bytes(text: Column | str) -> Column:
    """``list(text.encode('utf-8'))`` as ``array<int>``."""
    chars = F.split(utf8_byte_string(text), "")
    return F.transform(F.filter(chars, lambda c: c != F.lit("")), lambda c: F.ascii(c))


def byte_length(text: Column | str) -> Column:
    """``len(text.encode('utf-8'))``."""
    return F.octet_length(_col(text))
