"""Independence and mean tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import clean_double, require_columns
from plumbline.functions.pvalues import chi2_p, student_p


def chi2_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square test of independence of two columns: ``stat, dof, p_value``.

    Only the contingency counts are shuffled. Empty cells need no row, because
    summing ``o(o-e)/e`` over the filled cells equals the full statistic. With
    one degree of freedom the continuity correction applies; in a 2x2 table
    ``|o-e|`` is the same in all cells, so marginals suffice.
    """
    require_columns(df, [a, b])
    cells = (
        df.select(F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b"))
        .dropna()
        .groupBy("a", "b")
        .agg(F.count("*").cast("double").alias("o"))
    )
    rows = cells.groupBy("a").agg(F.sum("o").alias("row_n"))
    columns = cells.groupBy("b").agg(F.sum("o").alias("col_n"))
    shape = F.struct(F.sum("row_n").alias("n"), F.count("*").alias("k"), F.sum(1 / F.col("row_n")).alias("inv"))
    row_side = rows.agg(shape.alias("s")).scalar()
    col_shape = F.struct(F.count("*").alias("k"), F.sum(1 / F.col("col_n")).alias("inv"))
    col_side = columns.agg(col_shape.alias("s")).scalar()

    n = row_side.getField("n")
    e = F.col("row_n") * F.col("col_n") / F.col("n")
    sums = (
        cells.join(rows, "a")
        .join(columns, "b")
        .withColumn("n", n)
        .agg(
            F.sum(F.col("o") * (F.col("o") - e) / e).alias("plain"),
            F.max(F.abs(F.col("o") - e)).alias("gap"),
        )
    )
    sized = sums.select(
        "plain",
        "gap",
        ((row_side.getField("k") - 1) * (col_side.getField("k") - 1)).alias("dof"),
        (n * row_side.getField("inv") * col_side.getField("inv")).alias("inverse"),
    )
    corrected = F.pow(F.col("gap") - F.least(F.lit(0.5), F.col("gap")), 2) * F.col("inverse")
    stat = F.when(F.col("dof") == 1, corrected).when(F.col("dof") == 0, 0.0).otherwise(F.col("plain"))
    return sized.select(stat.alias("stat"), F.col("dof").cast("bigint").alias("dof")).withColumn(
        "p_value", chi2_p("stat", "dof")
    )


def t_test(df: DataFrame, value: str, label: str, first=1, second=0) -> DataFrame:
    """Two-sided Student test with pooled variance: ``t, dof, p_value``; missing values omitted."""
    require_columns(df, [value, label])
    v = clean_double(df, value)
    aggs = []
    for side, group in (("1", first), ("2", second)):
        x = F.when(F.col(f"`{label}`") == F.lit(group), v)
        aggs += [
            F.count(x).cast("double").alias(f"n{side}"),
            F.avg(x).alias(f"mean{side}"),
            F.var_samp(x).alias(f"var{side}"),
        ]
    m = df.agg(*aggs)
    dof = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("var1") + (F.col("n2") - 1) * F.col("var2")) / F.when(dof > 0, dof)
    spread = F.sqrt(pooled * (F.try_divide(F.lit(1.0), F.col("n1")) + F.try_divide(F.lit(1.0), F.col("n2"))))
    t = F.try_divide(F.col("mean1") - F.col("mean2"), spread)
    return m.select(t.alias("t"), dof.cast("bigint").alias("dof")).withColumn("p_value", student_p("t", "dof"))
