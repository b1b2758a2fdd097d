"""Dashboard figures from the gold tables.

Facts are aggregated before they are joined, so a plant or machine that holds a large
share of the rows moves as one partial row per task. Means divide an exact decimal sum by
its count. Dimensions are joined without a hint: Spark broadcasts a side only while its
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by
shuffle, splitting skewed partitions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions import status as D
from millwright.session import materialise

ALERT_LIMIT = 8
SERIES_DAYS = 14
RISK_LIMIT = 6


def mean(c: str, factor: int = 1) -> Column:
    return F.expr(f"CAST(sum({c} * {factor}) AS DOUBLE) / nullif(count({c}), 0)")


def pooled_mean() -> Column:
    """Mean from partial sums and counts."""
    return F.expr("CAST(sum(_sum) AS DOUBLE) / nullif(sum(_n), 0)")


def shown(e: str, name: str, digits: int = 1) -> str:
    return f"{D.half_even_sql(e, digits)} AS {name}"


def _same(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on a key that may be null on both sides."""
    other = right.withColumnRenamed(key, f"_{key}")
    return left.join(other, left[key].eqNullSafe(other[f"_{key}"]), how).drop(f"_{key}")


def with_plant_name(df: DataFrame, plants: DataFrame) -> DataFrame:
    names = plants.select("plant_id", F.col("plant_name").alias("_name"), "country")
    return (
        df.join(names, "plant_id", "left")
        .withColumn("plant_name", F.coalesce("_name", "plant_id"))
        .drop("_name")
    )


def machine_plants(production: DataFrame) -> DataFrame:
    return production.select("machine_id", "plant_id").distinct()


def stored_bridge(production: DataFrame) -> DataFrame:
    """``machine_plants``, worked out once for the figures that read it several times."""
    return materialise(machine_plants(production), "machine-plants")


# ---------------------------------------------------------------- all sites
def sites_trs(production: DataFrame, plants: DataFrame) -> DataFrame:
    per_site = production.groupBy("plant_id").agg(mean("trs", 100).alias("_v"))
    return with_plant_name(per_site, plants).select(
        "plant_id", "plant_name", "country",
        D.half_even("_v").alias("trs"), D.status_trs("_v").alias("status"),
    )


RATES = {"trs": "trs", "availability": "availability_rate", "performance": "performance_rate", "quality": "quality_rate"}


def _kpi_aggregates(extra: dict[str, str]) -> list[Column]:
    means = [mean(c, 100).alias(f"_{n}") for n, c in {**RATES, "scrap": "scrap_rate"}.items()]
    return means + [mean(c).alias(f"_{n}") for n, c in extra.items()]


def _kpi_columns(extra: dict[str, str]) -> list[str]:
    return [shown(f"_{n}", n) for n in RATES] + [shown("_scrap", "scrap", 2)] + [shown(f"_{n}", n) for n in extra]


def group_kpis(production: DataFrame) -> DataFrame:
    totals = production.agg(
        *_kpi_aggregates({}),
        F.expr("CAST(coalesce(sum(good_qty), 0) AS BIGINT) AS good"),
        F.count_distinct("plant_id").alias("sites"),
        F.count_distinct("machine_id").alias("machines"),
    )
    return totals.selectExpr(*_kpi_columns({}), "good", "sites", "machines")


def site_rates(production: DataFrame) -> DataFrame:
    per_site = production.groupBy("plant_id").agg(
        mean("trs", 100).alias("_t"), mean("scrap_rate", 100).alias("_s")
    )
    return per_site.select(
        "plant_id",
        D.half_even("_t").alias("trs"), D.status_trs("_t").alias("trs_status"),
        D.half_even("_s", 2).alias("scrap"), D.status_scrap("_s").alias("scrap_status"),
    )


def energy_by_site(energy: DataFrame, production: DataFrame) -> DataFrame:
    """Mean consumption per site; above the mean of the site means is a warning.

    A machine seen in two plants counts in both. The one row per site is stored, because
    both the comparison and the report read it.
    """
    bridge = stored_bridge(production)
    per_machine = energy.groupBy("machine_id").agg(
        F.sum("energy_consumption_kwh").alias("_sum"), F.count("energy_consumption_kwh").alias("_n")
    )
    per_site = (
        per_machine.join(bridge, "machine_id")
        .groupBy("plant_id")
        .agg(pooled_mean().alias("kwh"))
    )
    per_site = materialise(per_site, "site-energy")
    overall = F.coalesce(per_site.agg(F.avg("kwh")).scalar(), F.lit(0.0))
    sites = bridge.select("plant_id").distinct()
    return _same(sites, per_site, "plant_id").select(
        "plant_id",
        D.half_even("kwh", 0).alias("energy"),
        F.when(F.coalesce("kwh", F.lit(0.0)) > overall, "warn").otherwise("good").alias("status"),
    )


def alerts_by_site(alerts: DataFrame, production: DataFrame) -> DataFrame:
    bridge = stored_bridge(production)
    per_machine = alerts.filter("is_active").groupBy("machine_id").agg(F.count(F.lit(1)).alias("_n"))
    per_site = (
        per_machine.join(bridge, "machine_id").groupBy("plant_id").agg(F.sum("_n").alias("_n"))
    )
    per_site = materialise(per_site, "site-alerts")
    top = F.greatest(F.coalesce(per_site.agg(F.max("_n")).scalar(), F.lit(1)), F.lit(1))
    n = F.coalesce("_n", F.lit(0))
    return _same(bridge.select("plant_id").distinct(), per_site, "plant_id").select(
        "plant_id",
        n.alias("alerts"),
        F.when(n >= top * 0.8, "crit").when(n >= top * 0.4, "warn").otherwise("good").alias("status"),
    )


def _alert_view(df: DataFrame) -> DataFrame:
    reason = F.coalesce(F.nullif("alert_reason", F.lit("")), "alert_type")
    return df.select(
        F.col("bronze_event_id").cast("string").alias("alert_id"),
        D.alert_title("alert_type").alias("title"),
        D.severity_label("alert_severity").alias("severity"),
        F.concat("machine_id", F.lit(" — "), reason).alias("description"),
        F.col("plant_name").alias("factory"),
        D.date_label("date_id").alias("date"),
        F.lit("active").alias("status"),
    )


def recent_alerts(
    alerts: DataFrame, production: DataFrame, plants: DataFrame, limit: int = ALERT_LIMIT
) -> DataFrame:
    """Newest active alerts of known machines.

    Matching an alert to its plants only adds rows next to it, so the newest alerts are
    chosen before the join.
    """
    bridge = stored_bridge(production)
    newest = (
        alerts.filter("is_active")
        .join(bridge, "machine_id", "left_semi")
        .orderBy(F.desc_nulls_first("date_id"), "bronze_event_id")
        .limit(limit)
    )
    shown = (
        newest.join(bridge, "machine_id")
        .orderBy(F.desc_nulls_first("date_id"), "bronze_event_id", "plant_id")
        .limit(limit)
    )
    return _alert_view(with_plant_name(shown, plants))


# ---------------------------------------------------------------- one site, or each
def site_kpis(production: DataFrame) -> DataFrame:
    """KPIs of every plant in ``production``."""
    extra = {"cycle_time": "cycle_time_sec", "downtime": "downtime_minutes"}
    totals = production.groupBy("plant_id").agg(
        *_kpi_aggregates(extra),
        F.expr("CAST(coalesce(sum(good_qty), 0) AS BIGINT) AS good"),
        F.expr("CAST(coalesce(sum(actual_production_qty), 0) AS BIGINT) AS actual"),
    )
    return totals.selectExpr("plant_id", *_kpi_columns(extra), "good", "actual")


def kpi_rows(kpis: DataFrame, columns: list[str], key: list[str] | None = None) -> DataFrame:
    """KPIs in long form without the ones that have no value."""
    key = key or []
    as_double = kpis.select(*key, *[F.col(c).cast("double").alias(c) for c in columns])
    return as_double.unpivot(key, columns, "kpi", "value").filter("value is not null")


def site_machines(production: DataFrame) -> DataFrame:
    return production.select("machine_id").distinct()


def on_site(df: DataFrame, production: DataFrame) -> DataFrame:
    """Rows of machines that appear in ``production``."""
    return df.join(site_machines(production), "machine_id", "left_semi")


def active_alert_count(alerts: DataFrame, production: DataFrame | None = None) -> DataFrame:
    active = alerts.filter("is_active")
    if production is not None:
        active = on_site(active, production)
    return active.agg(F.count(F.lit(1)).alias("active_alerts"))


def _last_days(per_day: DataFrame, digits: int, days: int) -> DataFrame:
    newest = per_day.orderBy(F.desc_nulls_first("date_id")).limit(days)
    return newest.orderBy(F.asc_nulls_last("date_id")).select(
        "date_id", D.day_label("date_id").alias("label"), D.half_even("_v", digits).alias("value")
    )


def trs_series(production: DataFrame, days: int = SERIES_DAYS) -> DataFrame:
    return _last_days(production.groupBy("date_id").agg(mean("trs", 100).alias("_v")), 1, days)


def energy_series(energy: DataFrame, production: DataFrame, days: int = SERIES_DAYS) -> DataFrame:
    """Daily mean consumption of the site's machines, summed per machine before the join."""
    per_machine = energy.groupBy("date_id", "machine_id").agg(
        F.sum("energy_consumption_kwh").alias("_sum"), F.count("energy_consumption_kwh").alias("_n")
    )
    per_day = on_site(per_machine, production).groupBy("date_id").agg(
        pooled_mean().alias("_v")
    )
    return _last_days(per_day, 0, days)


def line_performance(production: DataFrame) -> DataFrame:
    per_line = production.groupBy("plant_id", "production_line_id").agg(
        mean("trs", 100).alias("_t"),
        F.coalesce(F.sum("good_qty"), F.lit(0)).cast("long").alias("production"),
        F.coalesce(F.sum("actual_production_qty"), F.lit(0)).cast("long").alias("target"),
    )
    per_line = per_line.withColumn("_r", F.expr("CAST(production AS DOUBLE) / nullif(target, 0) * 100"))
    return per_line.select(
        "plant_id", "production_line_id", D.half_even("_t").alias("trs"),
        "production", "target", D.half_even("_r").alias("reach"), D.status_reach("_r").alias("status"),
    )


def machine_stats(production: DataFrame, alerts: DataFrame, maintenance: DataFrame) -> DataFrame:
    incidents = alerts.filter("is_active").groupBy("machine_id").agg(F.count(F.lit(1)).alias("incidents"))
    last = maintenance.groupBy("machine_id").agg(F.max("date_id").alias("last_maint"))
    return (
        site_machines(production)
        .join(incidents, "machine_id", "left")
        .join(last, "machine_id", "left")
        .withColumn("incidents", F.coalesce("incidents", F.lit(0)))
    )


def recent_site_alerts(alerts: DataFrame, production: DataFrame, factory: str, limit: int = ALERT_LIMIT) -> DataFrame:
    newest = (
        on_site(alerts.filter("is_active"), production)
        .orderBy(F.desc_nulls_first("date_id"), "bronze_event_id")
        .limit(limit)
    )
    return _alert_view(newest.withColumn("plant_name", F.lit(factory)))


def recent_alerts_per_site(alerts: DataFrame, production: DataFrame, limit: int = ALERT_LIMIT) -> DataFrame:
    """Newest alerts of every plant; each task passes on at most ``limit`` rows per plant."""
    rank = F.row_number().over(
        Window.partitionBy("plant_id").orderBy(F.desc_nulls_first("date_id"), "bronze_event_id")
    )
    return (
        alerts.filter("is_active")
        .join(machine_plants(production), "machine_id")
        .withColumn("position", rank)
        .filter(F.col("position") <= limit)
        .select("plant_id", "position", "bronze_event_id", "machine_id", "date_id", "alert_severity", "alert_reason")
    )


# ---------------------------------------------------------------- predictions
# Predictions: machine_id, state, risk_score, rul_days; empty when no model answered.
def join_predictions(states: DataFrame, ruls: DataFrame) -> DataFrame:
    return states.select(
        "machine_id",
        F.coalesce("state", F.lit("normal")).alias("state"),
        F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"),
    ).join(ruls.select("machine_id", F.col("remaining_useful_life_days").alias("rul_days")), "machine_id", "left")


def first_model_label(responses: DataFrame, order: str) -> DataFrame:
    """Label of the first response that names a model."""
    named = F.when(F.nullif("model_name", F.lit("")).isNotNull(), F.col(order))
    first = F.min_by(F.struct("model_name", "model_version"), named)
    picked = responses.agg(F.when(F.count(named) > 0, first).alias("m"))
    label = D.model_label("m.model_name", "m.model_version")
    return picked.select(F.coalesce(label, F.lit("—")).alias("model"))


def ia_indicators(predictions: DataFrame) -> DataFrame:
    risky = F.sum((F.col("state") == "at_risk").cast("long"))
    agg = predictions.agg(
        F.coalesce(risky, F.lit(0)).alias("at_risk"),
        F.count(F.lit(1)).alias("machines"),
        F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("_risk"),
        F.avg("rul_days").alias("_rul"),
    )
    return agg.select(
        F.concat("at_risk", F.lit("/"), "machines").alias("at_risk_machines"),
        F.when(F.col("at_risk") > 0, "crit").otherwise("good").alias("at_risk_tone"),
        F.concat(D.whole("_risk * 100"), F.lit("%")).alias("mean_risk"),
        D.mean_risk_tone("_risk").alias("mean_risk_tone"),
        F.coalesce(F.concat(D.whole("_rul"), F.lit(" j")), F.lit("—")).alias("mean_rul"),
        D.mean_rul_tone("_rul").alias("mean_rul_tone"),
    )


def offline_indicators(kpis: DataFrame, active: DataFrame, machines: DataFrame) -> DataFrame:
    """Indicators without a model: performance, quality, machines followed, active alerts."""
    alerts = active.select("active_alerts").scalar()
    followed = machines.agg(F.count(F.lit(1))).scalar()
    shown = kpis.select(
        F.col("performance").alias("stability"),
        F.col("quality"),
        F.when(F.coalesce("quality", F.lit(0.0)) >= 90, "good").otherwise("warn").alias("quality_tone"),
        followed.alias("machines"),
        alerts.alias("active_alerts"),
    )
    return shown.withColumn("alert_tone", D.alert_count_tone("active_alerts"))


def risk_machines(stats: DataFrame, predictions: DataFrame | None = None, limit: int = RISK_LIMIT) -> DataFrame:
    """Riskiest machines: by predicted score and RUL, or by incidents when no model answered."""
    if predictions is None:
        stats = materialise(stats, "machine-stats")
    base = stats.withColumn("last_intervention", F.coalesce(F.nullif(D.date_label("last_maint"), F.lit("")), F.lit("—")))
    if predictions is None:
        top = F.greatest(F.coalesce(stats.agg(F.max("incidents")).scalar(), F.lit(1)), F.lit(1))
        scored = base.withColumn("_top", top).selectExpr(
            "machine_id", "incidents", "last_intervention", "CAST(NULL AS STRING) AS state",
            f"least(98, {D.whole_sql('30 + 68 * incidents / _top')}) AS risk_score", "CAST(NULL AS BIGINT) AS rul_days",
        )
        return scored.orderBy(F.desc("incidents"), "machine_id").limit(limit)
    known = predictions.select("machine_id", "state", F.col("risk_score").alias("_p"), F.col("rul_days").alias("_r"))
    scored = base.join(known, "machine_id", "left").select(
        "machine_id", "incidents", "last_intervention", "state",
        F.when(F.col("state").isNotNull(), D.risk_score("_p", "_r")).alias("risk_score"),
        D.whole("_r").alias("rul_days"),
    )
    order = [F.desc(F.coalesce("risk_score", F.lit(0))), F.asc_nulls_last("rul_days"), F.asc("machine_id")]
    return scored.orderBy(*order).limit(limit)


def maintenance_plan(predictions: DataFrame, today: date) -> DataFrame:
    """Machines with a predicted RUL, soonest first, with their due date."""
    days = D.whole("rul_days")
    return (
        predictions.filter("rul_days is not null")
        .select(
            "machine_id", "state", days.alias("rul_whole_days"),
            F.date_add(F.lit(today), days.cast("int")).alias("due"),
            D.status_rul("rul_days").alias("status"),
        )
        .withColumn("due", F.date_format("due", "dd/MM/yyyy"))
        .orderBy("rul_whole_days", "machine_id")
    )


def predictive_alerts(predictions: DataFrame, factory: str, today: str, threshold: int = 90) -> DataFrame:
    """Alerts for machines at risk or close to their end of life."""
    risky = F.col("state") == "at_risk"
    close = F.coalesce(F.col("rul_days") < threshold, F.lit(False))
    severity = F.when(risky & (F.col("rul_days") < 30), "critique").when(risky, "majeur").otherwise("mineur")
    left = F.concat(F.lit("durée de vie restante "), D.whole("rul_days"), F.lit(" j"))
    reasons = F.concat_ws(", ", F.when(risky, F.lit("panne probable sous 7 j")), left)
    rank = F.when(F.col("severity") == "critique", 0).when(F.col("severity") == "majeur", 1).otherwise(2)
    return (
        predictions.filter(risky | close)
        .select(
            F.concat(F.lit("ia-"), "machine_id").alias("alert_id"),
            F.lit("Risque de panne prédit (IA)").alias("title"),
            severity.alias("severity"),
            F.concat("machine_id", F.lit(" — "), reasons).alias("description"),
            F.lit(factory).alias("factory"),
            F.lit(today).alias("date"),
            F.lit("active").alias("status"),
        )
        .orderBy(rank, "alert_id")
    )


def merged_alerts(predicted: DataFrame, recorded: DataFrame, limit: int = ALERT_LIMIT) -> DataFrame:
    """Predicted alerts first, by severity, then the recorded ones, newest first; capped for display."""
    rank = F.when(F.col("severity") == "critique", 0).when(F.col("severity") == "majeur", 1).otherwise(2)
    none = F.lit(None).cast("long")
    first = predicted.withColumns({"_part": F.lit(0), "_rank": rank, "_day": none, "_id": none})
    day = F.concat(F.substring("date", 7, 4), F.substring("date", 4, 2), F.substring("date", 1, 2))
    second = recorded.withColumns(
        {
            "_part": F.lit(1),
            "_rank": F.lit(0),
            "_day": day.try_cast("long"),
            "_id": F.col("alert_id").try_cast("long"),
        }
    )
    return (
        first.unionByName(second)
        .orderBy("_part", "_rank", F.desc_nulls_first("_day"), "_id", "alert_id")
        .limit(limit)
        .drop("_part", "_rank", "_day", "_id")
    )
