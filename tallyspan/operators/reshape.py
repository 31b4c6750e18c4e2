"""Wide to long and long to wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str],
    name: str = "name",
    value: str = "value",
    value_type: str | None = "double",
    keep_nulls: bool = False,
) -> DataFrame:
    """One row per (row, column): a map-only reshape, no shuffle.

    Columns are cast before the reshape, so an empty column that a reader typed
    as text cannot break the common value type. ``keep_nulls=False`` drops
    missing cells (typed contracts), ``True`` keeps them (chart series).
    """
    cells = [f"cast(`{c}` as {value_type}) as `{c}`" if value_type else f"`{c}`" for c in columns]
    typed = df.selectExpr(*[f"`{i}`" for i in ids], *cells)
    long = typed.unpivot([f"`{i}`" for i in ids], [f"`{c}`" for c in columns], name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def pivot_max(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column | str],
    key_column: str = "metric_key",
    value: str = "value",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One column per measure, the larger value winning on duplicate keys.

    ``measures`` maps an output name to the metric key it takes, or to a
    condition. The explicit list keeps this to a single partial + final hash
    aggregate over one exchange; a key without any matching metric keeps an
    all-NULL row.
    """
    aggs = []
    for name, rule in measures.items():
        cond = F.col(key_column) == F.lit(rule) if isinstance(rule, str) else rule
        aggs.append(F.max(F.when(cond, F.col(value))).alias(name))
    return df.groupBy(*keys).agg(*aggs, *extra)


def stack_structs(df: DataFrame, keep: Sequence[str], rows: Sequence[Column]) -> DataFrame:
    """Several output rows per input row, one per struct. Map-only."""
    return df.select(*keep, F.inline(F.array(*rows)))
