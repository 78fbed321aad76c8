"""Row filters, casts, fills and projections."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import is_absent, keep_present, require_columns
from plumbline.functions.quantiles import exact_quantiles

logger = logging.getLogger(__name__)


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without null and NaN in any (or the named) columns."""
    return keep_present(df, list(columns or df.columns))


def drop_blank(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    """Keep rows whose critical column holds more than white space."""
    require_columns(df, [column])
    c = F.col(f"`{column}`")
    return df.filter(c.isNotNull() & (F.trim(c.cast("string")) != ""))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; absent names are skipped, bad values become null."""
    for c in types:
        if c not in df.columns:
            logger.warning("cast: column %s not found", c)
    return df.withColumns({
        c: F.col(f"`{c}`").try_cast(t) for c, t in types.items() if c in df.columns
    })


def lookup(column: Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Value by key from a small fixed mapping; unknown keys give ``default``."""
    if not mapping:
        return F.lit(default)
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.element_at(F.create_map(*pairs), column)
    return found if default is None else F.coalesce(found, F.lit(default))


def map_values(df: DataFrame, column: str, mapping: Mapping[Any, Any]) -> DataFrame:
    """Replace values by their mapped twin; unmapped values become null."""
    require_columns(df, [column])
    return df.withColumn(column, lookup(F.col(f"`{column}`"), mapping))


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop identifier columns where present."""
    return df.drop(*columns)


def replace_in_place(df: DataFrame, replaced: Mapping[str, Sequence[Column]]) -> DataFrame:
    """Put new columns where their source column stood, in one projection."""
    out: list[Column] = []
    for c in df.columns:
        out.extend(replaced.get(c, [F.col(f"`{c}`")]))
    return df.select(*out)


def align_columns(df: DataFrame, expected: Sequence[str], fill: Any = 0) -> DataFrame:
    """Exactly the expected columns in order: absent ones filled, extras dropped."""
    present = set(df.columns)
    return df.select(*[
        F.col(f"`{c}`") if c in present else F.lit(fill).alias(c) for c in expected
    ])


def split_features_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Feature columns and target column as two projections of one plan."""
    require_columns(df, [target])
    return df.drop(target), df.select(target)


def impute_constant(df: DataFrame, columns: Sequence[str], value: str = "missing") -> DataFrame:
    require_columns(df, columns)
    return df.fillna(value, subset=list(columns))


def median_fills(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column; columns without values are left out."""
    found = exact_quantiles(df, {c: [0.5] for c in columns})
    return {c: q[0] for c, q in found.items() if q[0] is not None}


def fill_values(df: DataFrame, fills: Mapping[str, float]) -> DataFrame:
    """Fill null and NaN of numeric columns; integer columns turn to double."""
    return df.withColumns({
        c: F.when(is_absent(df, c), F.lit(float(v))).otherwise(F.col(f"`{c}`").cast(T.DoubleType()))
        for c, v in fills.items()
    })


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    return fill_values(df, median_fills(df, columns))
