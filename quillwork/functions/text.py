"""Text expressions: normalisation, stripping and fixed-width windows, all as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that counts at the ends of lines and texts (line feed apart), as a regex class body.
BLANKS = r"\x{09}\x{0b}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
EDGE = rf"\A[{BLANKS}\x{{0a}}]+|[{BLANKS}\x{{0a}}]+\z"
TRAILING = rf"[{BLANKS}]+\n"
NEWLINE = r"\r\n?"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, EDGE, "")


def normalize(text: Column) -> Column:
    """CR and CRLF become LF, lines lose trailing white space, the whole is stripped. A null text is empty."""
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), NEWLINE, "\n")
    return strip(F.regexp_replace(lines, TRAILING, "\n"))


def windows(text: Column, width: int) -> Column:
    """Consecutive windows of `width` code points, each stripped, empty ones dropped; a text that fits stays as it is."""
    parts = F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{width}}}"), F.lit(0)), strip)
    return F.filter(F.when(F.length(text) <= width, F.array(text)).otherwise(parts), lambda x: F.length(x) > 0)


def sha256(text: Column) -> Column:
    """The prefixed digest of a text's UTF-8 bytes."""
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))
