"""Machine-health scores, labels and maintenance dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S

def degradation_flags(flag_set: str = "clean", columns: list[str] | None = None) -> dict[str, Column]:
    """0/1 flags of one named threshold set; a missing measure gives 0."""
    return {
        name: F.expr(f"CAST(coalesce({measure} {op} {threshold}, false) AS int)")
        for name, (measure, op, threshold) in S.FLAG_SETS[flag_set].items()
        if columns is None or measure in columns
    }


def degradation_score(flag_set: str = "clean") -> tuple[Column, Column]:
    """Weighted flag sum and its share of the maximum in percent, from flag columns."""
    names = list(S.FLAG_SETS[flag_set])
    total = " + ".join(f"{n} * {S.FLAG_WEIGHTS[n]}" for n in names)
    top = sum(round(float(S.FLAG_WEIGHTS[n]) * 10) for n in names) / 10
    return (
        F.expr(f"round({total}, 2)"),
        F.expr(f"round(greatest(0, least(100, ({total}) / {top} * 100)), 1)"),
    )


def failure_within_7(rul: Column, probability: Column, degradation_pct: Column) -> Column:
    soon = (rul <= 7) | ((probability >= 0.72) & (degradation_pct >= 65))
    return F.coalesce(soon, F.lit(False)).cast("int")


def maintenance_within_45(rul: Column, probability: Column, degradation_pct: Column) -> Column:
    soon = (rul <= 45) | ((probability >= 0.55) & (degradation_pct >= 45))
    return F.coalesce(soon, F.lit(False)).cast("int")


def with_engineered_rul(
    df: DataFrame,
    pct: str = "degradation_rate_pct",
    wear: str = "Operational_Hours",
    failing: str | None = None,
    noise_seed: int | None = None,
) -> DataFrame:
    """Experimental RUL from degradation and min-max scaled wear, within 1 to 365 days."""
    bounds = df.agg(F.struct(F.min(wear).cast("double").alias("lo"), F.max(wear).cast("double").alias("hi")))
    df = df.withColumn("_wear", bounds.scalar())
    span = F.nullif(F.col("_wear.hi") - F.col("_wear.lo"), F.lit(0.0))
    rul = (
        F.lit(365.0)
        - F.col(pct).cast("double") / 100 * 330
        - (F.col(wear).cast("double") - F.col("_wear.lo")) / span * 35
    )
    if noise_seed is not None:
        rul = rul + F.randn(noise_seed) * 8
    rul = F.when(rul.isNotNull(), F.greatest(F.lit(1.0), F.least(F.lit(365.0), rul)))
    if failing:
        rul = F.when(F.col(failing) == 1, F.least(F.lit(45.0), rul)).otherwise(rul)
    return df.withColumn("engineered_rul_days", F.round(rul, 1)).drop("_wear")


def maintenance_priority(rul: Column, lowest: int = -1) -> Column:
    """Right-closed bands; ``lowest=0`` leaves a RUL of 0 without a band."""
    return (
        F.when((rul > lowest) & (rul <= 7), "urgent")
        .when((rul > 7) & (rul <= 30), "high")
        .when((rul > 30) & (rul <= 90), "medium")
        .when((rul > 90) & (rul <= S.RUL_HORIZON_DAYS), "low")
    )


def maintenance_due(ts: Column, rul: Column) -> Column:
    """Timestamp plus the RUL rounded up to whole days."""
    return ts + F.make_dt_interval(days=F.ceil(rul).cast("int"))


def degradation_from_rul(rul: Column) -> Column:
    pct = (F.lit(1.0) - rul.cast("double") / S.RUL_HORIZON_DAYS) * 100
    return F.when(
        rul.isNotNull(), F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), pct)), 1)
    )


def reading_defaults(df: DataFrame) -> DataFrame:
    """Serving defaults of one sensor reading: zeros, a valid status and a fixed timestamp."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in S.SENSOR_FLOATS}
    filled |= {c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in S.SENSOR_INTS}
    filled["quality_status"] = F.coalesce(
        F.nullif(F.col("quality_status"), F.lit("")), F.lit("valid_sensor_event")
    )
    filled["event_ts"] = F.coalesce(
        F.col("event_ts").cast("timestamp_ntz"), F.lit(S.DEFAULT_READING_TS).cast("timestamp_ntz")
    )
    return df.withColumns({c: e for c, e in filled.items() if c in df.columns})
