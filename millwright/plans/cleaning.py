"""Full cleaning of one raw source. Every rule applies only when its columns exist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas as S
from millwright.functions import rules as R
from millwright.functions.parse import coerce_number, missing_to_null, shift_from_hour
from millwright.operators import ordered as O
from millwright.session import materialise

# Numeric columns with their plausible range; an open lower bound excludes its value.
QUANTITIES = {
    "planned_production_qty": (0, 3000, True),
    "actual_production_qty": (0, 2500, True),
    "good_qty": (0, 2500, False),
    "scrap_qty": (0, 500, False),
    "cycle_time_sec": (20, 120, False),
    "target_cycle_time_sec": (20, 120, False),
    "dimension_measurement": (8, 12, False),
    "Installation_Year": (1990, 2026, False),
    "predicted_failure_probability": (0, 1, False),
    "sensor_anomaly_score": (0, 1, False),
    "Remaining_Useful_Life_days": (0, 365, False),
    "repair_time_minutes": (0, 500, False),
    "downtime_minutes": (0, 500, False),
}
PLAIN_NUMBERS = [
    "setup_time_minutes", "production_speed", "tolerance_min", "tolerance_max", "quality_score",
    "Operational_Hours", "Last_Maintenance_Days_Ago", "Maintenance_History_Count",
    "Failure_History_Count", "Error_Codes_Last_30_Days", "AI_Override_Events", "maintenance_cost",
]
MAINTENANCE_NUMBERS = [
    "Operational_Hours", "Installation_Year", "Last_Maintenance_Days_Ago", "Maintenance_History_Count",
    "Failure_History_Count", "Error_Codes_Last_30_Days", "Remaining_Useful_Life_days",
    "predicted_failure_probability", "sensor_anomaly_score", "AI_Override_Events",
    "repair_time_minutes", "downtime_minutes", "maintenance_cost",
]
CARRIED = [
    "plant_id", "production_line_id", "machine_id", "machine_status", "operator_id", "tolerance_min",
    "tolerance_max", "defect_severity", "inspection_id", "Installation_Year", "Failure_Within_7_Days",
    "maintenance_event_id", "maintenance_type", "failure_type", "failure_code", "failure_severity",
    "technician_id", "spare_part_used",
]
FLAGS = ["rework_required", "vision_defect_detected", "operator_validation"]


class _Rows:
    """The rows between steps, chunked once along the row order."""

    def __init__(self, df: DataFrame, order: str, rows: int | None):
        self.order = order
        self.cut = O.chunked(df, order, None, rows)
        self.df = self.cut.df

    def has(self, *columns: str) -> bool:
        return all(c in self.df.columns for c in columns)

    def present(self, columns: list[str]) -> list[str]:
        return [c for c in columns if c in self.df.columns]

    def project(self, **columns) -> None:
        self.df = self.df.withColumns(columns)

    def ordered(self, operator: Callable, columns: list[str], group: list[str] | None = None) -> None:
        """One ordered pass over several columns.

        Across chunks a pass reads its input twice (summary and rows), so its result is
        written once before the next pass builds on it.
        """
        if not columns:
            return
        self.df = operator(self.df, columns, self.order, group or [], cut=self.cut)
        self.df = materialise(self.df, "cleaning")


def clean_with_business_rules(df: DataFrame, order: str, rows: int | None = None) -> DataFrame:
    """Cleaned rows of one source; ``order`` is the row number that defines before and after."""
    columns = df.columns
    t = _Rows(_typed(df, order), order, rows)

    if t.has("timestamp"):
        t.df = O.interpolate_timestamps(t.df, "timestamp", order, cut=t.cut)
        t.df = materialise(t.df, "cleaning")
    if t.has("repair_time_minutes", "failure_type"):
        t.df = O.group_median_fill(t.df, "failure_type", "repair_time_minutes", rows)
    t.ordered(O.fill_forward_back, t.present(CARRIED))
    _identifiers(t)
    _measures(t)
    _quality(t)
    _leftovers(t)
    return _final_types(t.df).select(*columns)


def _typed(df: DataFrame, order: str) -> DataFrame:
    """Missing markers to null, numbers parsed, implausible numbers to null."""
    numeric = {*QUANTITIES, *PLAIN_NUMBERS, *S.SENSOR_LIMITS, "Failure_Within_7_Days"}

    def typed(c: str):
        value = F.col(c)
        if c == order:
            return value
        if isinstance(df.schema[c].dataType, T.StringType):
            value = missing_to_null(value)
        if c == "timestamp":
            return value.try_cast("timestamp_ntz")
        if c in FLAGS:
            return F.lower(value.cast("string")).try_cast("boolean")
        return coerce_number(value) if c in numeric else value

    def checked(c: str) -> str:
        if c in S.SENSOR_LIMITS:
            return R.within_sql(c, *S.SENSOR_LIMITS[c])
        if c in QUANTITIES:
            return R.within_sql(c, *QUANTITIES[c])
        return f"coalesce({c}, 0D)" if c == "Error_Codes_Last_30_Days" else f"`{c}`"

    parsed = df.select(*[typed(c).alias(c) for c in df.columns])
    return parsed.selectExpr(*[f"{checked(c)} AS `{c}`" for c in df.columns])


def _identifiers(t: _Rows) -> None:
    """Product, batch and work order complete each other inside their groups, in this order."""
    fill = O.fill_forward_back
    if t.has("product_id"):
        for key in t.present(["work_order_id", "batch_id"]):
            t.ordered(fill, ["product_id"], [key])
    if t.has("batch_id"):
        keys = t.present(["machine_id", "work_order_id"])
        if keys:
            t.ordered(fill, ["batch_id"], keys)
    t.ordered(fill, t.present(["product_id", "batch_id"]))
    if t.has("work_order_id", "batch_id"):
        t.ordered(fill, ["work_order_id"], ["batch_id"])
    t.ordered(fill, t.present(["work_order_id"]))


def _measures(t: _Rows) -> None:
    per_machine = t.present(["cycle_time_sec", *S.SENSOR_LIMITS])
    t.ordered(O.interpolate_linear, per_machine, t.present(["machine_id"]))
    overall = [
        "planned_production_qty", "actual_production_qty", "good_qty", "target_cycle_time_sec",
        "dimension_measurement", *MAINTENANCE_NUMBERS,
    ]
    t.ordered(O.interpolate_linear, t.present(overall))
    if t.has("actual_production_qty", "good_qty", "scrap_qty"):
        t.df = R.quantity_identity(t.df)
    if t.has("production_speed", "actual_production_qty", "cycle_time_sec"):
        speed = R.speed_fallback(*[F.col(c) for c in ("production_speed", "actual_production_qty", "cycle_time_sec")])
        t.project(production_speed=speed)
    if t.has("shift", "timestamp"):
        t.project(shift=F.coalesce(shift_from_hour("timestamp"), F.col("shift")))


def _quality(t: _Rows) -> None:
    fill = O.fill_forward_back
    measured = t.has("dimension_measurement", "tolerance_min", "tolerance_max")
    if measured:
        bounds = [F.col(c) for c in ("dimension_measurement", "tolerance_min", "tolerance_max")]
        t.project(is_conforming=R.conforming(*bounds))
    if t.has("defect_type", "is_conforming"):
        if measured:
            kind = F.when(F.col("is_conforming"), "no_defect").otherwise(F.col("defect_type"))
            t.project(defect_type=kind)
        t.ordered(fill, ["defect_type"])
    if t.has("defect_category", "defect_type"):
        t.project(defect_category=R.defect_category(F.col("defect_category"), F.col("defect_type")))
        t.ordered(fill, ["defect_category"])
    if t.has("scrap_flag", "is_conforming") and measured:
        t.project(scrap_flag=~F.col("is_conforming"))
    if t.has("rework_required", "defect_severity"):
        severe = F.coalesce(F.col("defect_severity").isin("major", "critical"), F.lit(False))
        t.project(rework_required=F.coalesce(F.col("rework_required"), severe))
    if t.has("quality_score", "is_conforming") and measured:
        score = F.when(F.col("is_conforming"), F.lit(95.0)).otherwise(F.lit(70.0))
        t.project(quality_score=F.coalesce(F.col("quality_score"), score))
    t.ordered(O.interpolate_linear, t.present(["production_speed", "quality_score"]))
    for c in t.present(["vision_defect_detected", "operator_validation"]):
        t.project(**{c: F.coalesce(F.col(c), F.lit(False))})


def _leftovers(t: _Rows) -> None:
    """Columns that still have gaps get a last global pass; one aggregate finds them.

    The rows are written first: the aggregate and the last pass both read them.
    """
    t.df = materialise(t.df, "cleaning")
    inner = {t.order, O.CHUNK}
    candidates = [c for c in t.df.columns if c not in inner]
    gaps = t.df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in candidates]).first()
    open_ = [c for c in candidates if gaps[c]]
    kinds = {c: t.df.schema[c].dataType for c in open_}
    t.ordered(O.interpolate_linear, [c for c in open_ if isinstance(kinds[c], T.NumericType)])
    t.ordered(O.fill_forward_back, [c for c in open_ if not isinstance(kinds[c], T.NumericType)])


def _final_types(df: DataFrame) -> DataFrame:
    if "Failure_Within_7_Days" in df.columns:
        flag = F.coalesce(F.col("Failure_Within_7_Days"), F.lit(0.0)).cast("int")
        return df.withColumn("Failure_Within_7_Days", flag)
    return df
