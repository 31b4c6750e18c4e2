"""Row and column scoping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.fixed_values import DEFAULT_GEO_PREFIX


def clean_prefix(prefix: str, default: str = DEFAULT_GEO_PREFIX) -> str:
    """User input to a usable prefix: trimmed, blank falls back to the default."""
    return prefix.strip() or default


#: Least and largest value of the integer types.
INTEGERS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}


def prefix_ranges(prefix: str, bits: int = 63) -> list[tuple[int, int]]:
    """The integers whose decimal text starts with the prefix, as inclusive ranges within a type of so many value bits.

    1714 gives 1714-1714, 17140-17149, 171400-171499 and so on; -17 the mirrored
    ranges, - all negative numbers. Numbers are written without leading zeros, a
    plus or blanks, so a prefix with one of these gives none.
    """
    least, largest = -(1 << bits), (1 << bits) - 1
    sign, digits = (-1, prefix[1:]) if prefix.startswith("-") else (1, prefix)
    if not digits:
        return [(least, -1)] if sign < 0 else [(least, largest)]
    if not (digits.isascii() and digits.isdigit()):
        return []
    if digits[0] == "0":
        return [(0, 0)] if prefix == "0" else []
    found, low, high = [], int(digits), int(digits)
    while low <= (largest if sign > 0 else -least):
        ends = sorted((sign * low, sign * high))
        found.append((max(ends[0], least), min(ends[1], largest)))
        low, high = low * 10, high * 10 + 9
    return found


def in_prefix(df: DataFrame, prefix: str | None, code: str = "geo_code") -> DataFrame:
    """Rows whose code starts with the prefix, read as text; all rows for ``None``.

    For an integer code the prefix is a union of ranges, which file statistics
    can answer; null codes start with nothing. The prefix is a literal, so ``%``
    and ``_`` are ordinary characters. Blank text, as user input may be, falls
    back to the default.
    """
    if prefix is None:
        return df
    prefix = clean_prefix(prefix)
    kind = df.schema[code].dataType.simpleString() if code in df.columns else ""
    if kind not in INTEGERS:
        return df.where(F.col(code).cast("string").startswith(prefix))
    inside = F.lit(False)
    for low, high in prefix_ranges(prefix, INTEGERS[kind]):
        inside = inside | F.col(code).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return df.where(inside)


def in_region(df: DataFrame, prefix: str | None, code: str = "geo_code", region: str = "region_code") -> DataFrame:
    """Same rows as :func:`in_prefix`, plus a predicate the file scan can use.

    ``region`` holds the first four characters of the code, for codes that are
    not integers or files that are partitioned by it.
    """
    if prefix is None:
        return df
    prefix = clean_prefix(prefix)
    scoped = in_prefix(df, prefix, code)
    if region not in df.columns:
        return scoped
    return scoped.where(F.col(region).startswith(prefix[:4]))


def with_region_code(df: DataFrame, code: str = "geo_code", length: int = 4, name: str = "region_code") -> DataFrame:
    """Region part of a hierarchical code as its own text column."""
    return df.withColumn(name, F.substring(F.col(code).cast("string"), 1, length))


def slice_on(df: DataFrame, **equals: object) -> DataFrame:
    """Rows equal on every given attribute."""
    for name, wanted in equals.items():
        df = df.where(F.col(name) == F.lit(wanted))
    return df


def keys_in(df: DataFrame, column: str, keys: Sequence[object]) -> DataFrame:
    """Rows whose attribute is in the list."""
    return df.where(F.col(column).isin(*keys))


def year_range(df: DataFrame, first: int | None = None, last: int | None = None, year: str = "year") -> DataFrame:
    """Inclusive year range; an open end is not filtered."""
    if first is not None:
        df = df.where(F.col(year) >= F.lit(first))
    if last is not None:
        df = df.where(F.col(year) <= F.lit(last))
    return df


def existing(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def rename_only(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Project to the given columns under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])
