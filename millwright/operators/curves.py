"""Rank metrics of a binary score, from counts per distinct score.

Rows are counted per score first; only the distinct scores are ordered, and their running
counts are built chunk by chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.operators.ordered import running_sum


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"),
        F.sum((F.col(label) != 1).cast("long")).alias("neg"),
    )


def curve_points(df: DataFrame, label: str, score: str, rows: int | None = None) -> DataFrame:
    """One row per distinct threshold: true and false positives, precision, recall, fpr."""
    cum = running_sum(
        score_counts(df, label, score), [], "threshold", {"pos": "tp", "neg": "fp"}, descending=True, rows=rows
    )
    positives, negatives = (F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in ("tp_total", "fp_total"))
    return cum.withColumns(
        {
            "precision": F.col("tp").cast("double") / (F.col("tp") + F.col("fp")),
            "recall": F.col("tp").cast("double") / positives,
            "fpr": F.col("fp").cast("double") / negatives,
        }
    )


def average_precision(points: DataFrame) -> Column:
    """Step sum of precision over recall gains."""
    gain = F.col("pos").cast("double") / F.nullif(F.col("tp_total").cast("double"), F.lit(0.0))
    return F.sum(gain * F.col("precision"))


def roc_auc(points: DataFrame) -> Column:
    """Share of (positive, negative) pairs in the right order, ties counting half."""
    above = F.col("tp") - F.col("pos") / 2
    pairs = F.col("tp_total").cast("double") * F.col("fp_total")
    return F.sum(F.col("neg") * above / F.nullif(pairs, F.lit(0.0)))


def rank_metrics(df: DataFrame, label: str, score: str, rows: int | None = None) -> DataFrame:
    points = curve_points(df, label, score, rows)
    return points.agg(average_precision(points).alias("pr_auc"), roc_auc(points).alias("roc_auc"))


def best_threshold(df: DataFrame, label: str, score: str, rows: int | None = None) -> DataFrame:
    """Threshold with the best F1; the lowest one when several are best, 0.5 without data."""
    points = curve_points(df, label, score, rows)
    recall = F.coalesce("recall", F.lit(1.0))
    f1 = F.lit(2.0) * F.col("precision") * recall / (F.col("precision") + recall + F.lit(1e-12))
    best = F.max(F.struct(f1.alias("f1"), (-F.col("threshold")).alias("t")))
    return points.agg(best.alias("b")).select(
        F.coalesce(-F.col("b.t"), F.lit(0.5)).alias("threshold"), F.col("b.f1").alias("f1")
    )


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"), (F.col(score) >= threshold).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """F1, precision, recall and accuracy at a threshold; 0 where a ratio is undefined."""
    hit, true = F.col(score) >= threshold, F.col(label) == 1

    def count(c: Column) -> Column:
        return F.sum(c.cast("long")).cast("double")

    counts = df.agg(
        count(hit & true).alias("tp"), count(hit & ~true).alias("fp"), count(~hit & true).alias("fn"),
        count(hit == true).alias("ok"), F.count(F.lit(1)).alias("n"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(top / F.nullif(bottom, F.lit(0.0)), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(F.col("ok"), F.col("n").cast("double")).alias("accuracy"),
    )


def classification_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, rows: int | None = None
) -> DataFrame:
    """All six classification metrics in one row."""
    ranks = rank_metrics(df, label, score, rows)
    return threshold_metrics(df, label, score, threshold).select(
        ranks.select("pr_auc").scalar().alias("pr_auc"), ranks.select("roc_auc").scalar().alias("roc_auc"), "*"
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R2 in one pass over the residuals."""
    y, error = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted).cast("double")
    spread = F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - F.sum(error * error) / spread).alias("r2"),
    )


def residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.withColumn("residual", F.col(actual).cast("double") - F.col(predicted).cast("double"))


def rank_models(metrics: DataFrame, by: str, higher_is_better: bool) -> DataFrame:
    return metrics.orderBy(F.desc(by) if higher_is_better else F.asc(by), "model")


def top_importances(importances: DataFrame, n: int = 20) -> DataFrame:
    return importances.orderBy(F.desc(F.abs("importance")), "feature").limit(n)
