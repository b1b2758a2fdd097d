"""Batch scoring with fitted models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions.status import clamp_rul, state_of
from millwright.ml.train import risk_scores


def score_state(model, prepared: DataFrame, threshold: float = 0.5, name: str = "state", version: str = "1") -> DataFrame:
    """State and risk score per machine reading."""
    return risk_scores(model, prepared).select(
        "machine_id",
        state_of("risk_score", threshold).alias("state"),
        "risk_score",
        F.lit(name).alias("model_name"),
        F.lit(version).alias("model_version"),
    )


def score_rul(model, prepared: DataFrame, required: list[str], name: str = "rul", version: str = "1") -> DataFrame:
    """RUL per machine reading; a reading without its inputs gets null, the others a value."""
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    return model.transform(prepared).select(
        "machine_id",
        F.when(complete, clamp_rul("prediction")).alias("remaining_useful_life_days"),
        F.lit(name).alias("model_name"),
        F.lit(version).alias("model_version"),
    )


def anomaly_flag(df: DataFrame, raw_score: str, threshold: float) -> DataFrame:
    """Raw scores where low means odd, turned so that high means odd."""
    return df.withColumn("anomaly_score", -F.col(raw_score)).withColumn(
        "is_anomaly", F.col("anomaly_score") >= -threshold
    )


def score_with(df: DataFrame, predict: Callable[[pd.DataFrame], pd.DataFrame], keep: list[str], output: str) -> DataFrame:
    """User scoring hook: ``predict`` maps a batch of rows to columns of schema ``output``."""
    kept = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep)

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            scored = predict(part).reset_index(drop=True)
            yield pd.concat([part[keep].reset_index(drop=True), scored], axis=1)

    return df.mapInPandas(batches, f"{kept}, {output}")
