"""Fixed-edge binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.clean import replace_in_place
from plumbline.spec import TENURE_BINS, BinSpec


def bin_value(value: Column, bins: BinSpec = TENURE_BINS) -> Column:
    """Label of the first upper edge the value does not exceed, else the last label."""
    def chain(pairs: Sequence[tuple[float, str]]) -> Column:
        out = F
        for edge, label in pairs:
            out = out.when(value <= edge, label)
        return out

    open_end = chain(list(zip(bins.edges, bins.labels))).otherwise(bins.labels[-1])
    return F.when(value.isNull(), F.lit(bins.null_label)).otherwise(open_end)


def bin_fixed(df: DataFrame, column: str, bins: BinSpec = TENURE_BINS) -> DataFrame:
    """Replace a numeric column by its bin label, as ``{column}_bins``."""
    if column not in df.columns:
        raise KeyError(f"column {column!r} not found")
    label = bin_value(F.col(f"`{column}`"), bins)
    return replace_in_place(df, {column: [label.alias(f"{column}_bins")]})
