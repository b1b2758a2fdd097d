"""Dashboard builders on hand-made tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from millwright.operators import analytics as A
from millwright.plans import dashboards as B

PRED = "machine_id string, state string, risk_score double, rul_days double"


def predictions(spark, **rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], PRED)


def test_indicators(spark):
    p = predictions(spark, A=("at_risk", 1.0, 73.0), B=("normal", 0.0, 200.0), C=("at_risk", 1.0, None), D=("normal", 0.0, 150.0))
    r = A.ia_indicators(p).first()
    assert (r["at_risk_machines"], r["mean_risk"], r["mean_rul"]) == ("2/4", "50%", "141 j")
    assert (r["at_risk_tone"], r["mean_risk_tone"], r["mean_rul_tone"]) == ("crit", "crit", "good")


def stats(spark, **rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], "machine_id string, incidents long, last_maint int")


def test_risk_ranking(spark):
    s = stats(spark, CNC=(37, 20260328), LAS=(294, 20260329), QLT=(4372, 20260329), FOU=(61, None))
    p = predictions(spark, CNC=("normal", 0.0, 241.0), FOU=("normal", 0.0, 187.0), LAS=("at_risk", 1.0, 73.0), QLT=("at_risk", 1.0, 80.0))
    out = A.risk_machines(s, p).collect()
    assert [r["machine_id"] for r in out] == ["LAS", "QLT", "FOU", "CNC"]
    assert (out[0]["risk_score"], out[0]["rul_days"], out[0]["last_intervention"]) == (90, 73, "29/03/2026")
    assert out[2]["last_intervention"] == "—"
    offline = A.risk_machines(s).collect()
    assert [r["machine_id"] for r in offline] == ["QLT", "LAS", "FOU", "CNC"]
    assert [r["risk_score"] for r in offline] == [98, 35, 31, 31] and offline[0]["state"] is None


def test_plan(spark):
    p = predictions(spark, A=("normal", 0.0, 200.0), B=("at_risk", 1.0, 30.0), C=("normal", 0.0, None))
    out = A.maintenance_plan(p, date(2026, 7, 1)).collect()
    assert [(r["machine_id"], r["due"], r["status"]) for r in out] == [("B", "31/07/2026", "warn"), ("A", "17/01/2027", "good")]


def test_predictive_alerts(spark):
    p = predictions(spark, A=("at_risk", 1.0, 20.0), B=("at_risk", 1.0, 100.0), C=("normal", 0.0, 45.0), D=("normal", 0.0, 200.0), E=("at_risk", 1.0, None))
    out = A.predictive_alerts(p, "Usine", "01/07/2026").collect()
    assert {r["alert_id"]: r["severity"] for r in out} == {"ia-A": "critique", "ia-B": "majeur", "ia-C": "mineur", "ia-E": "majeur"}
    assert out[0]["description"] == "A — panne probable sous 7 j, durée de vie restante 20 j"
    assert [r["description"] for r in out if r["alert_id"] == "ia-E"] == ["E — panne probable sous 7 j"]


def gold(spark):
    production = spark.createDataFrame(
        [(20260101 + i % 20, f"P{i % 2}", f"L{i % 3}", f"M{i % 4}", 90, 100, i / 100, 0.9, 0.8, 0.95, 0.04, None, 5.0) for i in range(60)]
        + [(20260101, "P9", "L9", "M1", 1, 1, None, None, None, None, None, None, None)],
        "date_id int, plant_id string, production_line_id string, machine_id string, good_qty int, actual_production_qty int, trs double, "
        "availability_rate double, performance_rate double, quality_rate double, scrap_rate double, cycle_time_sec double, downtime_minutes double",
    )
    for c in ("trs", "availability_rate", "performance_rate", "quality_rate", "scrap_rate", "cycle_time_sec", "downtime_minutes"):
        production = production.withColumn(c, F.col(c).cast("decimal(18,6)"))
    alerts = spark.createDataFrame(
        [(i, None if i == 5 else 20260100 + i, f"M{i % 3}", "sensor_health", "critical", "oil_low", i != 7) for i in range(12)],
        "bronze_event_id long, date_id int, machine_id string, alert_type string, alert_severity string, alert_reason string, is_active boolean",
    )
    energy = spark.createDataFrame([(20260101 + i, f"M{i % 4}", float(i)) for i in range(20)], "date_id int, machine_id string, energy_consumption_kwh double")
    energy = energy.withColumn("energy_consumption_kwh", F.col("energy_consumption_kwh").cast("decimal(18,6)"))
    maintenance = spark.createDataFrame([("M1", 20260110)], "machine_id string, date_id int")
    plants = spark.createDataFrame([("P0", "Lyon", "France")], "plant_id string, plant_name string, country string")
    return {"fact_production": production, "fact_alerts": alerts, "fact_energy": energy, "fact_maintenance": maintenance, "dim_plant": plants}


def test_machine_in_two_plants_counts_in_both(spark):
    g = gold(spark)
    got = {r["plant_id"]: r["energy"] for r in A.energy_by_site(g["fact_energy"], g["fact_production"]).collect()}
    assert got["P9"] == round(sum(range(1, 20, 4)) / 5) and set(got) == {"P0", "P1", "P9"}
    alerts = {r["plant_id"]: r["alerts"] for r in A.alerts_by_site(g["fact_alerts"], g["fact_production"]).collect()}
    assert alerts == {"P0": 8, "P1": 3, "P9": 3}


def test_alert_without_date_comes_first(spark):
    g = gold(spark)
    out = A.recent_alerts(g["fact_alerts"], g["fact_production"], g["dim_plant"]).collect()
    assert len(out) == 8 and out[0]["alert_id"] == "5" and out[0]["date"] == ""
    assert "7" not in {r["alert_id"] for r in out}


def test_series_keep_the_last_days_in_order(spark):
    g = gold(spark)
    days = [r["date_id"] for r in A.trs_series(g["fact_production"].filter("plant_id = 'P0'"), 5).collect()]
    assert days == sorted(days) and len(days) == 5 and days[-1] == 20260119


def test_group_dashboard(spark):
    out = B.group_dashboard(gold(spark))
    kpis = {r["kpi"]: r["value"] for r in out["kpis"].collect()}
    assert kpis["sites"] == 3 and kpis["active_alerts"] == 11 and kpis["good"] == 5401
    assert B.as_rows(out).count() > 10


def silver(spark):
    from millwright import schemas as S

    base = spark.createDataFrame([("M0", 1, 5), ("M0", 2, 6), ("M2", 1, 7)], "machine_id string, t int, bronze_event_id long")
    ts = F.timestamp_seconds(F.col("t").cast("long")).cast("timestamp_ntz")
    extra = {c: F.lit(None).cast("decimal(18,6)") for c in S.SENSOR_FLOATS} | {c: F.lit(None).cast("int") for c in S.SENSOR_INTS}
    return base.withColumns({"event_ts": ts, "quality_status": F.lit(""), **extra}).drop("t")


def test_site_dashboard_with_and_without_model(spark):
    g, s = gold(spark), silver(spark)
    offline = B.site_dashboard(g, s, "P0", date(2026, 7, 1))
    assert "maintenance_plan" not in offline and offline["risk_machines"].first()["state"] is None
    kpis = {r["kpi"] for r in offline["kpis"].collect()}
    assert "cycle_time" not in kpis and "trs" in kpis

    def predict(readings):
        assert {r["quality_status"] for r in readings.collect()} == {"valid_sensor_event"}
        return readings.selectExpr("machine_id", "'at_risk' AS state", "1D AS risk_score", "10D AS rul_days")

    online = B.site_dashboard(g, s, "P0", date(2026, 7, 1), predict)
    assert online["alerts"].first()["alert_id"] == "ia-M0" and online["maintenance_plan"].count() == 2
    with pytest.raises(LookupError):
        B.site_dashboard(g, s, "nowhere", date(2026, 7, 1))


def test_merged_alerts_put_predictions_of_all_severities_before_recorded_ones(spark):
    columns = "alert_id string, severity string, date string"
    predicted = spark.createDataFrame([("ia-b", "mineur", "01/07/2026"), ("ia-a", "critique", "01/07/2026")], columns)
    recorded = spark.createDataFrame([("7", "critique", "01/06/2026"), ("8", "mineur", "02/06/2026")], columns)
    assert [r["alert_id"] for r in A.merged_alerts(predicted, recorded).collect()] == ["ia-a", "ia-b", "8", "7"]
    assert [r["alert_id"] for r in A.merged_alerts(predicted, recorded, limit=3).collect()] == ["ia-a", "ia-b", "8"]
