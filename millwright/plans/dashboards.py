"""The group and site dashboards as bundles of DataFrames."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions.health import reading_defaults
from millwright.operators import analytics as A
from millwright.operators.ordered import latest_by

GROUP_KPIS = ["trs", "availability", "performance", "quality", "scrap", "good", "sites", "active_alerts"]
SITE_KPIS = ["trs", "availability", "performance", "quality", "scrap", "cycle_time", "good", "active_alerts"]


def group_dashboard(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All sites: KPIs, figures per site, newest alerts."""
    production, alerts, plants = gold["fact_production"], gold["fact_alerts"], gold["dim_plant"]
    active = A.active_alert_count(alerts).scalar()
    kpis = A.group_kpis(production).withColumn("active_alerts", active)
    return {
        "kpis": A.kpi_rows(kpis, GROUP_KPIS),
        "rates_by_site": A.site_rates(production),
        "energy_by_site": A.energy_by_site(gold["fact_energy"], production),
        "alerts_by_site": A.alerts_by_site(alerts, production),
        "alerts": A.recent_alerts(alerts, production, plants),
        "site_count": A.group_kpis(production).select("sites"),
    }


def latest_site_readings(silver: DataFrame, production: DataFrame) -> DataFrame:
    """Newest reading per machine of the site, with the serving defaults."""
    return reading_defaults(latest_by(A.on_site(silver, production), "machine_id", "event_ts", "bronze_event_id"))


def site_dashboard(
    gold: dict[str, DataFrame],
    silver: DataFrame,
    plant_id: str,
    today: date,
    predict=None,
) -> dict[str, DataFrame]:
    """One site. ``predict`` turns the newest readings into predictions; without it, or
    without any reading, the figures fall back to incidents."""
    production = gold["fact_production"].filter(F.col("plant_id") == plant_id)
    if production.isEmpty():
        raise LookupError(f"unknown site {plant_id!r}")
    alerts, shown_day = gold["fact_alerts"], today.strftime("%d/%m/%Y")
    header = A.sites_trs(production, gold["dim_plant"])
    factory = header.first()["plant_name"]
    readings = latest_site_readings(silver, production)
    predictions = predict(readings) if predict is not None and not readings.isEmpty() else None

    active = A.active_alert_count(alerts, production)
    kpis = A.site_kpis(production).withColumn("active_alerts", active.scalar())
    stats = A.machine_stats(production, alerts, gold["fact_maintenance"])
    recorded = A.recent_site_alerts(alerts, production, factory)
    out = {
        "factory": header,
        "kpis": A.kpi_rows(kpis, SITE_KPIS),
        "trs_series": A.trs_series(production),
        "energy_series": A.energy_series(gold["fact_energy"], production),
        "lines": A.line_performance(production),
        "risk_machines": A.risk_machines(stats, predictions),
    }
    if predictions is None:
        return out | {
            "alerts": recorded,
            "indicators": A.offline_indicators(A.site_kpis(production), active, readings),
        }
    predicted = A.predictive_alerts(predictions, factory, shown_day)
    return out | {
        "maintenance_plan": A.maintenance_plan(predictions, today),
        "alerts": A.merged_alerts(predicted, recorded),
        "indicators": A.ia_indicators(predictions),
    }


def as_rows(bundle: dict[str, DataFrame]) -> DataFrame:
    """The bundle as (section, position-free JSON row) lines."""
    parts = [
        df.select(F.lit(section).alias("section"), F.to_json(F.struct(*df.columns)).alias("row"))
        for section, df in bundle.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def as_table(bundle: dict[str, DataFrame], texts: int = 8, numbers: int = 6) -> DataFrame:
    """The bundle as one table: section, then its text columns and its numbers in their order."""
    parts = []
    for section, df in bundle.items():
        kinds = dict(df.dtypes)
        told = [c for c in df.columns if kinds[c] in ("string", "date")]
        counted = [c for c in df.columns if c not in told]
        if len(told) > texts or len(counted) > numbers:
            raise ValueError(f"{section} has more columns than the table")
        columns = {f"t{i}": F.col(c).cast("string") for i, c in enumerate(told)} | {f"n{i}": F.col(c).cast("double") for i, c in enumerate(counted)}
        empty = {f"t{i}": F.lit(None).cast("string") for i in range(texts)} | {f"n{i}": F.lit(None).cast("double") for i in range(numbers)}
        parts.append(df.select(F.lit(section).alias("section"), *[(columns.get(n) if n in columns else e).alias(n) for n, e in empty.items()]))
    return reduce(DataFrame.unionByName, parts)
