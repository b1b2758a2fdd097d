"""Value rules of the cleaning step; comparisons with a missing value count as false."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S


def within_sql(e: str, low, high, low_open: bool = False) -> str:
    above = ">" if low_open else ">="
    return f"CASE WHEN {e} {above} {low} AND {e} <= {high} THEN {e} END"


def within(e: str, low, high, low_open: bool = False) -> Column:
    """The value when plausible, else null."""
    return F.expr(within_sql(e, low, high, low_open))


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def conforming(measure: Column, low: Column, high: Column) -> Column:
    return _is(measure.between(low, high))


def conformity(df: DataFrame) -> DataFrame:
    """Conformity, its scrap flag and the defect type it implies."""
    ok = conforming(F.col("dimension_measurement"), F.col("tolerance_min"), F.col("tolerance_max"))
    return df.withColumns(
        {
            "is_conforming": ok,
            "scrap_flag": ~ok,
            "defect_type": F.when(ok, "no_defect").otherwise(F.col("defect_type")),
        }
    )


def defect_category(category: Column, kind: Column) -> Column:
    pairs = [F.lit(x) for pair in S.DEFECT_CATEGORIES.items() for x in pair]
    return F.coalesce(category, F.create_map(*pairs)[kind])


def quality_defaults(df: DataFrame) -> DataFrame:
    """Defaults for missing quality fields, from conformity and severity."""
    return df.withColumns(
        {
            "quality_score": F.coalesce(
                F.col("quality_score"), F.when(F.col("is_conforming"), F.lit(95.0)).otherwise(F.lit(70.0))
            ),
            "rework_required": F.coalesce(
                F.col("rework_required"), _is(F.col("defect_severity").isin("major", "critical"))
            ),
            "vision_defect_detected": F.coalesce(F.col("vision_defect_detected"), F.lit(False)),
            "operator_validation": F.coalesce(F.col("operator_validation"), F.lit(False)),
        }
    )


def quantity_identity(df: DataFrame) -> DataFrame:
    """actual = good + scrap, applied in order: fill good, fill scrap, floor scrap, cap good."""
    actual = F.col("actual_production_qty")
    good = F.coalesce(F.col("good_qty"), actual - F.col("scrap_qty"))
    scrap = F.coalesce(F.col("scrap_qty"), actual - good)
    scrap = F.when(scrap < 0, F.lit(0).cast("double")).otherwise(scrap.cast("double"))
    capped = F.when(good > actual, actual - scrap).otherwise(good)
    return df.withColumns(
        {"good_qty": capped.cast("double"), "scrap_qty": F.coalesce(scrap, F.lit(0.0))}
    )


def speed_fallback(speed: Column, actual: Column, cycle: Column) -> Column:
    return F.coalesce(
        speed.cast("double"), actual.cast("double") / F.nullif(cycle.cast("double"), F.lit(0.0))
    )


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna("unknown", subset=columns)
