"""Column predicates and reshaping helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def is_absent(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_missing(df: DataFrame, column: str, blank: bool = False) -> Column:
    """Null, NaN or empty text; with ``blank`` also text of white space only."""
    missing = is_absent(df, column)
    if isinstance(df.schema[column].dataType, T.StringType):
        c = F.col(f"`{column}`")
        missing = missing | ((F.trim(c) if blank else c) == "")
    return missing


def clean_double(df: DataFrame, column: str) -> Column:
    """The column as double; NaN and text that is no number become null."""
    value = F.col(f"`{column}`").try_cast("double")
    return F.when(~F.isnan(value), value)


def keep_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every column.

    One condition per column: each can be pushed into the scan, and the
    optimizer need not rewrite a condition over all columns for every rename.
    """
    out = df
    for c in columns:
        out = out.filter(~is_absent(df, c))
    return out


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")


def to_long(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """One row per (row, column): ``column``, ``value`` (string), plus ``keep``.

    One scan serves all columns, and the aggregation that follows combines
    on the map side, so only distinct values are shuffled.
    """
    require_columns(df, columns)
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in columns
    ])
    return df.select(*keep, F.inline(cells))


def one_row_to_long(row: DataFrame, columns: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate with fields ``{column}|{stat}`` into rows per column."""
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"`{c}|{s}`").alias(s) for s in stats],
        )
        for c in columns
    ])
    return row.select(F.inline(cells))
