"""Writers of gold tables, reference tables, logs and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S


def write_tables(tables: dict[str, DataFrame], folder: str, partition_by: dict[str, str] | None = None) -> None:
    """One Parquet table per entry."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        column = (partition_by or {}).get(name)
        (writer.partitionBy(column) if column else writer).parquet(f"{folder}/{name}")


def overwrite_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace only the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def prediction_log(
    predictions: DataFrame,
    action: str,
    model_name: str,
    model_version: str,
    model_alias: str | None,
    inputs: list[str],
    outputs: list[str],
) -> DataFrame:
    """One record per inference, inputs and outputs as JSON."""
    site = F.col("site") if "site" in predictions.columns else F.lit(None).cast("string")
    return predictions.select(
        F.current_timestamp().alias("created_at"),
        "machine_id",
        site.alias("site"),
        F.lit(action).alias("action"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.lit(model_alias).cast("string").alias("model_alias"),
        F.to_json(F.struct(*inputs)).alias("input"),
        F.to_json(F.struct(*outputs)).alias("output"),
    )


def append_prediction_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").partitionBy("action").parquet(path)


def ml_extract(silver: DataFrame) -> DataFrame:
    """The learning table in machine and time order."""
    return silver.select(*S.EXTRACT_COLUMNS).orderBy("machine_id", "event_ts")


def write_model_comparison(metrics: DataFrame, path: str, **metadata: str) -> None:
    """Metrics per model as CSV, with the selection rule beside them as JSON."""
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/metrics")
    notes = F.create_map(*[F.lit(x) for pair in metadata.items() for x in pair])
    summary = metrics.agg(F.collect_list(F.struct(*metrics.columns)).alias("results"))
    summary.withColumn("metadata", notes).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
