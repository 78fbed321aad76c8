"""Classification metrics and prediction summaries.

All metrics follow from one count per (label, prediction); no row leaves the
executors and the arithmetic runs on the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(
        F.col(f"`{label}`").cast("double").alias("label"),
        F.col(f"`{prediction}`").cast("double").alias("prediction"),
    ).agg(F.count("*").alias("count"))


def _share(part: Column, whole: Column) -> Column:
    """Ratio with 0.0 for an empty denominator."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def binary_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1.0
) -> DataFrame:
    """One row: counts of the 2x2 table, accuracy, precision, recall, F1 of the positive class."""
    actual = F.col(f"`{label}`").cast("double") == F.lit(float(positive))
    guess = F.col(f"`{prediction}`").cast("double") == F.lit(float(positive))
    counts = df.agg(
        F.count_if(actual & guess).alias("tp"),
        F.count_if(~actual & guess).alias("fp"),
        F.count_if(actual & ~guess).alias("fn"),
        F.count_if(~actual & ~guess).alias("tn"),
        F.count_if(F.col(f"`{label}`").cast("double") == F.col(f"`{prediction}`").cast("double")).alias("hits"),
        F.count(F.lit(1)).alias("n"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        _share(F.col("hits"), F.col("n")).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages and accuracy."""
    cells = confusion_counts(df, label, prediction)
    sides = cells.select(
        F.inline(F.array(
            F.struct(F.col("label").alias("class"), F.col("count").alias("actual"), F.lit(0).cast("bigint").alias("guessed"),
                     F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0).alias("hit")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("count").alias("guessed"),
                     F.lit(0).cast("bigint").alias("hit")),
        ))
    )
    per_class = sides.groupBy("class").agg(
        F.sum("hit").alias("hit"), F.sum("actual").alias("support"), F.sum("guessed").alias("guessed")
    ).select(
        "class",
        _share(F.col("hit"), F.col("guessed")).alias("precision"),
        _share(F.col("hit"), F.col("support")).alias("recall"),
        _share(2 * F.col("hit"), F.col("support") + F.col("guessed")).alias("f1"),
        "hit",
        "support",
    )
    weight = F.col("support")

    def weighted(c: str) -> Column:
        return _share(F.sum(F.col(c) * weight), F.sum(weight))

    totals = per_class.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
        _share(F.sum("hit"), F.sum(weight)).alias("accuracy"),
        F.sum(weight).alias("support"),
    )
    accuracy = F.col("accuracy")
    summary = totals.select(F.inline(F.array(
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("row"),
                *[F.col(f"{kind}_{c}").alias(c) for c in ("precision", "recall", "f1")],
                "support",
            )
            for kind in ("macro", "weighted")
        ],
        F.struct(
            F.lit("accuracy").alias("row"), accuracy.alias("precision"), accuracy.alias("recall"),
            accuracy.alias("f1"), "support",
        ),
    )))
    classes = per_class.select(F.col("class").cast("int").cast("string").alias("row"), "precision", "recall", "f1", "support")
    return classes.unionByName(summary)


# Lower edges (exclusive) of the high and medium risk tiers.
HIGH_RISK = 0.7
MEDIUM_RISK = 0.5


def risk_summary(
    df: DataFrame, prediction: str = "prediction", probability: str = "probability", *by: str
) -> DataFrame:
    """Prediction counts, means and risk tiers, one row (per group)."""
    p = F.col(f"`{probability}`")
    aggs = [
        F.count(F.lit(1)).alias("num_predictions"),
        F.avg(prediction).alias("avg_prediction"),
        F.sum(F.col(prediction).cast("bigint")).alias("churn"),
        (F.count(F.lit(1)) - F.sum(F.col(prediction).cast("bigint"))).alias("retain"),
        F.avg(p).alias("avg_churn_probability"),
        F.count_if(p > HIGH_RISK).alias("high_risk"),
        F.count_if((p > MEDIUM_RISK) & (p <= HIGH_RISK)).alias("medium_risk"),
        F.count_if(p <= MEDIUM_RISK).alias("low_risk"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def format_probability(probability: Column) -> Column:
    """Probability as percent text, at most two decimals, at least one: ``87.5%``."""
    percent = F.round(probability * 100, 2)
    text = percent.cast("string")
    return F.concat(text, F.lit("%"))


