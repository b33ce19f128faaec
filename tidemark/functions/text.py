"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the blank.
CONTROL_AND_BLANK = "".join(chr(code) for code in range(0x21))

_HIGH_LATIN = "".join(chr(code) for code in range(0x80, 0x100))


def _high_half(charset: str) -> str:
    return "".join(bytes([code]).decode(charset, errors="replace") for code in range(0x80, 0x100))


def decode_single_byte(content: Column, charset: str = "cp1251") -> Column:
    """Decode bytes in any ASCII-compatible single-byte charset.

    Spark's decode() knows only a handful of charsets, so bytes go to Latin-1 first and the upper half is
    then translated; both steps run in the JVM.
    """
    return F.translate(F.decode(content, "ISO-8859-1"), _HIGH_LATIN, _high_half(charset))


def strip_control(text: Column) -> Column:
    """Trim blanks and control characters on both ends; Spark's trim() alone removes only blanks."""
    return F.btrim(text, F.lit(CONTROL_AND_BLANK))


def last_path_part(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
