"""Checks a table or model must pass before the next step runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.files import is_complete


def table_gate(df: DataFrame, required: Sequence[str], min_rows: int = 1) -> DataFrame:
    """One row per check: ``check, status, detail``.

    The row check stops reading once ``min_rows`` rows are found.
    """
    absent = [c for c in required if c not in df.columns]
    enough = F.count(F.lit(1)) >= min_rows
    found = df.select(F.lit(1)).limit(min_rows).agg(enough.alias("enough"))
    return found.select(F.inline(F.array(
        F.struct(
            F.lit("columns").alias("check"),
            F.lit("fail" if absent else "pass").alias("status"),
            F.lit("missing: " + ", ".join(absent) if absent else "all present").alias("detail"),
        ),
        F.struct(
            F.lit("rows").alias("check"),
            F.when(F.col("enough"), "pass").otherwise("fail").alias("status"),
            F.concat(F.when(F.col("enough"), "at least ").otherwise("fewer than "), F.lit(str(min_rows))).alias("detail"),
        ),
    )))


def assert_gate(checks: DataFrame) -> None:
    """Stop the run when a check failed."""
    failed = [f"{r['check']}: {r['detail']}" for r in checks.filter(F.col("status") == "fail").collect()]
    if failed:
        raise ValueError("; ".join(failed))


def model_gate(spark: SparkSession, path: str) -> bool:
    """Is a saved model complete at the path?"""
    return is_complete(spark, f"{path.rstrip('/')}/metadata")
