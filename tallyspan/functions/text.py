"""Text expressions: cleaning, labels, classification, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c\u00a0"


def strip_quotes(c: str | Column) -> Column:
    """Outer whitespace off, then outer double quotes off."""
    c = F.col(c) if isinstance(c, str) else c
    return F.btrim(F.btrim(c, F.lit(WHITESPACE)), F.lit('"'))


def code_number(c: str) -> Column:
    """Text as a long, blanks around it ignored; null where it is none."""
    return F.btrim(F.col(c).cast("string")).try_cast("bigint")


def is_bad_code(c: str) -> Column:
    """Whether a filled cell is no whole number."""
    return F.coalesce((F.btrim(F.col(c).cast("string")) != "") & code_number(c).isNull(), F.lit(False))


def first_match(c: str | Column, patterns: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """Label of the first pattern found in the text, case-insensitively.

    NULL text falls through to ``otherwise``.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(
        *[F.when(c.rlike(f"(?i){pattern}"), F.lit(label)) for pattern, label in patterns],
        F.lit(otherwise),
    )


def code_label(name: str | Column, code: str | Column) -> Column:
    """``name (code)``."""
    name = F.col(name) if isinstance(name, str) else name
    code = F.col(code) if isinstance(code, str) else code
    return F.concat(name, F.lit(" ("), code.cast("string"), F.lit(")"))


def whole_number(c: str | Column) -> Column:
    """Truncated integer with thousands separators; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.format_number(c.cast("bigint"), 0)


def two_decimals(c: str | Column) -> Column:
    """Fixed two-decimal text; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.format_string("%.2f", c)


def sha256_hex(c: str | Column) -> Column:
    """Hex SHA-256 of text (as UTF-8) or of binary content."""
    return F.sha2(c, 256)
