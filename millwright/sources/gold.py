"""Reading gold tables: list, filter, look up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_FILTERS = {
    "fact_production": ["plant_id", "production_line_id", "machine_id", "date_id"],
    "fact_quality": ["machine_id", "product_id", "defect_id", "date_id"],
    "fact_maintenance": ["machine_id", "date_id"],
    "fact_energy": ["machine_id", "date_id"],
    "fact_alerts": ["machine_id", "is_active", "alert_severity"],
}
DIM_FILTERS = {
    "dim_line": ["plant_id"],
    "dim_machine": ["production_line_id"],
    "dim_date": ["year", "month"],
}
DIM_KEYS = {
    "dim_date": "date_id",
    "dim_plant": "plant_id",
    "dim_line": "production_line_id",
    "dim_shift": "shift_id",
    "dim_product": "product_id",
    "dim_defect": "defect_id",
    "dim_machine": "machine_id",
}


def filter_table(name: str, table: DataFrame, **wanted) -> DataFrame:
    """Rows matching every given value; a filter left out or None does not apply."""
    allowed = FACT_FILTERS.get(name) or DIM_FILTERS.get(name, [])
    unknown = set(wanted) - set(allowed)
    if unknown:
        raise ValueError(f"{name} cannot be filtered by {sorted(unknown)}")
    given = [F.col(c) == F.lit(v) for c, v in wanted.items() if v is not None]
    return table.filter(reduce(lambda a, b: a & b, given)) if given else table


def lookup(name: str, table: DataFrame, key) -> DataFrame:
    """The one row of a dimension with this key; absent is an error."""
    row = table.filter(F.col(DIM_KEYS[name]) == F.lit(key)).limit(1)
    if row.isEmpty():
        raise LookupError(f"{name} has no {key!r}")
    return row


def active_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter("is_active")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
