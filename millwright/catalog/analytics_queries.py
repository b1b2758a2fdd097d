"""Dashboard figures over the gold tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from millwright.catalog import oracle as Q
from millwright.catalog.registry import ORACLES, query
from millwright.operators import analytics as A
from millwright.plans import dashboards as B
from millwright.session import materialise

SITE = "PL1"
TODAY = date(2026, 7, 1)


def pct(c):
    return Q.mean(c, 100)


# ------------------------------------------------------------------ joins
@query(
    "fact_left_dim",
    Q.sql(
        """SELECT f.plant_id, coalesce(p.plant_name, f.plant_id) AS plant_name, p.country, f.n FROM
        (SELECT plant_id, count(*) AS n FROM fact_production GROUP BY plant_id) f LEFT JOIN dim_plant p ON p.plant_id = f.plant_id"""
    ),
)
def _left_dim(t):
    counts = t.production().groupBy("plant_id").agg(F.count(F.lit(1)).alias("n"))
    return A.with_plant_name(counts, t.plants()).select("plant_id", "plant_name", "country", "n")


@query("machine_plant_bridge", Q.sql("SELECT b.plant_id, count(*) AS n FROM fact_energy_base e JOIN bridge b ON b.machine_id = e.machine_id GROUP BY 1"))
def _bridge(t):
    per_machine = t.energy().groupBy("machine_id").agg(F.count(F.lit(1)).alias("n"))
    joined = per_machine.join(A.machine_plants(t.production()), "machine_id")
    return joined.groupBy("plant_id").agg(F.sum("n").alias("n"))


@query("distinct_machine_plant", Q.sql("SELECT machine_id, plant_id FROM bridge"))
def _distinct(t):
    return A.machine_plants(t.production())


@query(
    "site_semi_join",
    Q.sql(f"SELECT bronze_event_id, machine_id FROM fact_alerts WHERE machine_id IN (SELECT machine_id FROM fact_production WHERE plant_id = '{SITE}')"),
)
def _semi(t):
    return A.on_site(t.alerts(), site(t)).select("bronze_event_id", "machine_id")


@query("machine_stats", Q.sql("SELECT machine_id, incidents, last_maint FROM stats"))
def _stats(t):
    return A.machine_stats(t.production(), t.alerts(), t.maintenance())


@query(
    "prediction_lookup",
    Q.sql("SELECT machine_id, state, risk_score, CASE WHEN risk_score > 0.3 THEN rul_days END AS rul_days FROM predictions"),
)
def _lookup(t):
    scored = materialise(t.predictions(), "predictions")
    ruls = scored.filter("risk_score > 0.3").select("machine_id", F.col("rul_days").alias("remaining_useful_life_days"))
    return A.join_predictions(scored, ruls)


# ------------------------------------------------------------------ all sites
@query(
    "sites_trs",
    Q.sql(
        f"""SELECT f.plant_id, coalesce(p.plant_name, f.plant_id) AS plant_name, p.country, {Q.half_even('v')} AS trs, {Q.status_trs('v')} AS status
        FROM (SELECT plant_id, {pct('trs')} AS v FROM fact_production GROUP BY plant_id) f LEFT JOIN dim_plant p ON p.plant_id = f.plant_id"""
    ),
)
def _sites(t):
    return A.sites_trs(t.production(), t.plants())


@query(
    "group_kpis",
    Q.sql(
        f"""SELECT {Q.half_even(pct('trs'))} AS trs, {Q.half_even(pct('availability_rate'))} AS availability,
        {Q.half_even(pct('performance_rate'))} AS performance, {Q.half_even(pct('quality_rate'))} AS quality,
        {Q.half_even(pct('scrap_rate'), 2)} AS scrap, CAST(coalesce(sum(good_qty), 0) AS BIGINT) AS good,
        count(DISTINCT plant_id) AS sites, count(DISTINCT machine_id) AS machines FROM fact_production"""
    ),
)
def _group(t):
    return A.group_kpis(t.production())


@query(
    "site_rates",
    Q.sql(
        f"""SELECT plant_id, {Q.half_even('t')} AS trs, {Q.status_trs('t')} AS trs_status, {Q.half_even('s', 2)} AS scrap, {Q.status_scrap('s')} AS scrap_status
        FROM (SELECT plant_id, {pct('trs')} AS t, {pct('scrap_rate')} AS s FROM fact_production GROUP BY plant_id)"""
    ),
)
def _rates(t):
    return A.site_rates(t.production())


KWH = {"site_kwh": f"SELECT b.plant_id, {Q.mean('e.energy_consumption_kwh')} AS kwh FROM fact_energy_base e JOIN bridge b ON b.machine_id = e.machine_id GROUP BY 1"}


@query(
    "energy_by_site",
    Q.sql(
        f"""SELECT s.plant_id, {Q.half_even('k.kwh', 0)} AS energy,
        CASE WHEN coalesce(k.kwh, 0) > (SELECT coalesce(avg(kwh), 0) FROM site_kwh) THEN 'warn' ELSE 'good' END AS status
        FROM (SELECT DISTINCT plant_id FROM fact_production) s LEFT JOIN site_kwh k ON s.plant_id IS NOT DISTINCT FROM k.plant_id""",
        **KWH,
    ),
)
def _energy_site(t):
    return A.energy_by_site(t.energy(), t.production())


@query(
    "alerts_by_site",
    Q.sql(
        """SELECT s.plant_id, coalesce(k.n, 0) AS alerts, CASE WHEN coalesce(k.n, 0) >= 0.8 * m THEN 'crit'
        WHEN coalesce(k.n, 0) >= 0.4 * m THEN 'warn' ELSE 'good' END AS status
        FROM (SELECT DISTINCT plant_id FROM fact_production) s LEFT JOIN site_alerts k ON s.plant_id IS NOT DISTINCT FROM k.plant_id,
        (SELECT greatest(coalesce(max(n), 1), 1) AS m FROM site_alerts)""",
        site_alerts="SELECT b.plant_id, count(*) AS n FROM fact_alerts a JOIN bridge b ON b.machine_id = a.machine_id WHERE a.is_active GROUP BY 1",
    ),
)
def _alerts_site(t):
    return A.alerts_by_site(t.alerts(), t.production())


def alert_view(plant):
    return f"""CAST(bronze_event_id AS VARCHAR) AS alert_id, {Q.title('alert_type')} AS title, {Q.severity('alert_severity')} AS severity,
      machine_id || ' — ' || coalesce(nullif(alert_reason, ''), alert_type) AS description, {plant} AS factory,
      {Q.date_label('date_id')} AS date, 'active' AS status"""


@query(
    "recent_alerts",
    Q.sql(
        f"""SELECT {alert_view('plant_name')} FROM (SELECT a.*, coalesce(p.plant_name, b.plant_id) AS plant_name FROM fact_alerts a
        JOIN bridge b ON b.machine_id = a.machine_id LEFT JOIN dim_plant p ON p.plant_id = b.plant_id
        WHERE a.is_active ORDER BY a.date_id DESC NULLS FIRST, a.bronze_event_id, b.plant_id LIMIT 8)"""
    ),
)
def _recent(t):
    return A.recent_alerts(t.alerts(), t.production(), t.plants())


# ------------------------------------------------------------------ one site
def site(t):
    return t.production().filter(F.col("plant_id") == SITE)


SITE_SQL = f"""SELECT plant_id, {Q.half_even(pct('trs'))} AS trs, {Q.half_even(pct('availability_rate'))} AS availability,
  {Q.half_even(pct('performance_rate'))} AS performance, {Q.half_even(pct('quality_rate'))} AS quality, {Q.half_even(pct('scrap_rate'), 2)} AS scrap,
  {Q.half_even(Q.mean('cycle_time_sec'))} AS cycle_time, {Q.half_even(Q.mean('downtime_minutes'))} AS downtime,
  CAST(coalesce(sum(good_qty), 0) AS BIGINT) AS good, CAST(coalesce(sum(actual_production_qty), 0) AS BIGINT) AS actual
FROM fact_production GROUP BY plant_id"""


@query("site_kpis", Q.sql(SITE_SQL))
def _kpis(t):
    return A.site_kpis(t.production())


@query(
    "kpi_non_null",
    Q.sql(
        """UNPIVOT (SELECT plant_id, CAST(trs AS DOUBLE) AS trs, CAST(scrap AS DOUBLE) AS scrap, CAST(cycle_time AS DOUBLE) AS cycle_time,
        CAST(CASE WHEN plant_id > 'PL2' THEN good END AS DOUBLE) AS good FROM kpis) ON trs, scrap, cycle_time, good INTO NAME kpi VALUE value""",
        kpis=SITE_SQL,
    ).replace("UNPIVOT (", "SELECT * FROM (UNPIVOT (") + ")",
)
def _non_null(t):
    kpis = A.site_kpis(t.production()).withColumn("good", F.when(F.col("plant_id") > "PL2", F.col("good")))
    return A.kpi_rows(kpis, ["trs", "scrap", "cycle_time", "good"], ["plant_id"])


@query(
    "active_alert_count",
    Q.sql(
        f"""SELECT 'all' AS scope, count(*) AS active_alerts FROM fact_alerts WHERE is_active UNION ALL
        SELECT '{SITE}', count(*) FROM fact_alerts WHERE is_active AND machine_id IN (SELECT machine_id FROM fact_production WHERE plant_id = '{SITE}')"""
    ),
)
def _count(t):
    everywhere = A.active_alert_count(t.alerts()).select(F.lit("all").alias("scope"), "active_alerts")
    return everywhere.unionByName(A.active_alert_count(t.alerts(), site(t)).select(F.lit(SITE).alias("scope"), "active_alerts"))


@query(
    "trs_series",
    Q.sql(
        f"""SELECT date_id, {Q.day_label('date_id')} AS label, {Q.half_even('v')} AS value FROM (SELECT date_id, {pct('trs')} AS v
        FROM fact_production WHERE plant_id = '{SITE}' GROUP BY date_id ORDER BY date_id DESC NULLS FIRST LIMIT 14)"""
    ),
)
def _trs_series(t):
    return A.trs_series(site(t))


@query(
    "energy_series",
    Q.sql(
        f"""SELECT date_id, {Q.day_label('date_id')} AS label, {Q.half_even('v', 0)} AS value FROM (SELECT date_id, {Q.mean('energy_consumption_kwh')} AS v
        FROM fact_energy_base WHERE machine_id IN (SELECT machine_id FROM fact_production WHERE plant_id = '{SITE}')
        GROUP BY date_id ORDER BY date_id DESC NULLS FIRST LIMIT 14)"""
    ),
)
def _energy_series(t):
    return A.energy_series(t.energy(), site(t))


@query(
    "line_performance",
    Q.sql(
        f"""SELECT plant_id, production_line_id, {Q.half_even('t')} AS trs, good AS production, actual AS target,
        {Q.half_even('r')} AS reach, {Q.status_reach('r')} AS status FROM (SELECT *, CAST(good AS DOUBLE) / nullif(actual, 0) * 100 AS r FROM
        (SELECT plant_id, production_line_id, {pct('trs')} AS t, CAST(coalesce(sum(good_qty), 0) AS BIGINT) AS good,
         CAST(coalesce(sum(actual_production_qty), 0) AS BIGINT) AS actual FROM fact_production GROUP BY 1, 2))"""
    ),
)
def _lines(t):
    return A.line_performance(t.production())


@query(
    "recent_alerts_per_site",
    Q.sql(
        """SELECT plant_id, CAST(position AS INTEGER) AS position, bronze_event_id, machine_id, date_id, alert_severity, alert_reason FROM (
        SELECT b.plant_id, a.*, row_number() OVER (PARTITION BY b.plant_id ORDER BY a.date_id DESC NULLS FIRST, a.bronze_event_id) AS position
        FROM fact_alerts a JOIN bridge b ON b.machine_id = a.machine_id WHERE a.is_active) WHERE position <= 8"""
    ),
)
def _per_site(t):
    return A.recent_alerts_per_site(t.alerts(), t.production())


SITE_ALERTS = f"""SELECT * FROM fact_alerts WHERE is_active AND machine_id IN (SELECT machine_id FROM fact_production WHERE plant_id = '{SITE}')
  ORDER BY date_id DESC NULLS FIRST, bronze_event_id LIMIT 8"""


@query("recent_site_alerts", Q.sql(f"SELECT {alert_view(chr(39) + 'AMERICA' + chr(39))} FROM recorded", recorded=SITE_ALERTS))
def _site_alerts(t):
    return A.recent_site_alerts(t.alerts(), site(t), "AMERICA")


# ------------------------------------------------------------------ predictions
IND = """SELECT (sum(CASE WHEN state = 'at_risk' THEN 1 ELSE 0 END))::BIGINT || '/' || count(*) AS at_risk_machines,
  CASE WHEN sum(CASE WHEN state = 'at_risk' THEN 1 ELSE 0 END) > 0 THEN 'crit' ELSE 'good' END AS at_risk_tone,
  {risk} || '%' AS mean_risk, CASE WHEN avg(risk_score) >= 0.5 THEN 'crit' WHEN avg(risk_score) >= 0.25 THEN 'warn' ELSE 'good' END AS mean_risk_tone,
  coalesce({rul} || ' j', '—') AS mean_rul, CASE WHEN avg(rul_days) < 90 THEN 'warn' ELSE 'good' END AS mean_rul_tone FROM predictions"""


@query("ia_indicators", Q.sql(IND.format(risk=Q.whole("avg(risk_score) * 100"), rul=Q.whole("avg(rul_days)"))))
def _indicators(t):
    return A.ia_indicators(t.predictions())


@query(
    "ia_indicators_offline",
    Q.sql(
        f"""SELECT performance AS stability, quality, CASE WHEN quality >= 90 THEN 'good' ELSE 'warn' END AS quality_tone, (SELECT count(*) FROM predictions) AS machines,
        (SELECT count(*) FROM fact_alerts WHERE is_active) AS active_alerts,
        CASE WHEN (SELECT count(*) FROM fact_alerts WHERE is_active) > 100 THEN 'crit' ELSE 'warn' END AS alert_tone
        FROM (SELECT {Q.half_even(pct('performance_rate'))} AS performance, {Q.half_even(pct('quality_rate'))} AS quality FROM fact_production)"""
    ),
)
def _offline(t):
    return A.offline_indicators(A.group_kpis(t.production()), A.active_alert_count(t.alerts()), t.predictions())


SCORED = f"""SELECT s.machine_id, s.incidents, coalesce(nullif({Q.date_label('s.last_maint')}, ''), '—') AS last_intervention, p.state,
  CASE WHEN p.state IS NOT NULL THEN {Q.risk('p.risk_score', 'p.rul_days')} END AS risk_score, {Q.whole('p.rul_days')} AS rul_days
FROM stats s LEFT JOIN predictions p ON p.machine_id = s.machine_id
ORDER BY coalesce(CASE WHEN p.state IS NOT NULL THEN {Q.risk('p.risk_score', 'p.rul_days')} END, 0) DESC, {Q.whole('p.rul_days')} ASC NULLS LAST, s.machine_id LIMIT 6"""


@query("risk_machines", Q.sql(SCORED))
def _risk(t):
    return A.risk_machines(A.machine_stats(t.production(), t.alerts(), t.maintenance()), t.predictions())


OFFLINE_RISK = "30 + 68 * incidents / CAST((SELECT greatest(coalesce(max(incidents), 1), 1) FROM stats) AS DOUBLE)"


@query(
    "fallback_when_no_model",
    Q.sql(
        f"""SELECT machine_id, incidents, coalesce(nullif({Q.date_label('last_maint')}, ''), '—') AS last_intervention, CAST(NULL AS VARCHAR) AS state,
        least(98, {Q.whole(OFFLINE_RISK)}) AS risk_score, CAST(NULL AS BIGINT) AS rul_days FROM stats ORDER BY incidents DESC, machine_id LIMIT 6"""
    ),
)
def _fallback(t):
    return A.risk_machines(A.machine_stats(t.production(), t.alerts(), t.maintenance()))


PLAN = f"""SELECT machine_id, state, {Q.whole('rul_days')} AS rul_whole_days,
  strftime(DATE '2026-07-01' + CAST({Q.whole('rul_days')} AS INTEGER), '%d/%m/%Y') AS due, {Q.status_rul('rul_days')} AS status
FROM predictions WHERE rul_days IS NOT NULL"""


@query("maintenance_plan", Q.sql(PLAN))
def _plan(t):
    return A.maintenance_plan(t.predictions(), TODAY)


PREDICTED = f"""SELECT 'ia-' || machine_id AS alert_id, 'Risque de panne prédit (IA)' AS title,
  CASE WHEN state = 'at_risk' AND rul_days < 30 THEN 'critique' WHEN state = 'at_risk' THEN 'majeur' ELSE 'mineur' END AS severity,
  machine_id || ' — ' || concat_ws(', ', CASE WHEN state = 'at_risk' THEN 'panne probable sous 7 j' END,
    'durée de vie restante ' || {Q.whole('rul_days')} || ' j') AS description,
  'AMERICA' AS factory, '01/07/2026' AS date, 'active' AS status FROM predictions WHERE state = 'at_risk' OR coalesce(rul_days < 90, FALSE)"""


@query("predictive_alerts", Q.sql(PREDICTED))
def _predictive(t):
    return A.predictive_alerts(t.predictions(), "AMERICA", "01/07/2026")


MERGED = f"""SELECT alert_id, title, severity, description, factory, date, status FROM (
  SELECT *, 0 AS part, CASE severity WHEN 'critique' THEN 0 WHEN 'majeur' THEN 1 ELSE 2 END AS rank, NULL::INTEGER AS day, NULL::BIGINT AS n FROM predicted
  UNION ALL SELECT {alert_view("'AMERICA'")}, 1, 0, date_id, bronze_event_id FROM recorded)
ORDER BY part, rank, day DESC NULLS FIRST, n, alert_id LIMIT 8"""


@query("merged_alerts", Q.sql(MERGED, predicted=PREDICTED, recorded=SITE_ALERTS))
def _merged(t):
    predicted = A.predictive_alerts(t.predictions(), "AMERICA", "01/07/2026")
    return A.merged_alerts(predicted, A.recent_site_alerts(t.alerts(), site(t), "AMERICA"))


@query("union_alerts", Q.sql(f"SELECT * FROM predicted UNION ALL SELECT {alert_view(chr(39) + 'AMERICA' + chr(39))} FROM fact_alerts WHERE is_active", predicted=PREDICTED))
def _union(t):
    recorded = A._alert_view(t.alerts().filter("is_active").withColumn("plant_name", F.lit("AMERICA")))
    return A.predictive_alerts(t.predictions(), "AMERICA", "01/07/2026").unionByName(recorded)


@query("latest_reading", Q.sql(f"SELECT machine_id, {Q.ts_text('event_ts')} AS event_ts, bronze_event_id, {Q.dbl('s_temperature_c')} AS temperature_c FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY event_ts DESC NULLS LAST, bronze_event_id) AS rn FROM silver) WHERE rn = 1"))
def _latest(t):
    from millwright.operators.ordered import latest_by

    return latest_by(t.silver().select("machine_id", "event_ts", "bronze_event_id", "temperature_c"), "machine_id", "event_ts", "bronze_event_id")


# ------------------------------------------------------------------ bundles
def section(name, body, texts=(), numbers=()):
    """One section of a dashboard as a row of the table that ``as_table`` gives."""
    told = [f"CAST({texts[i]} AS VARCHAR) AS t{i}" if i < len(texts) else f"NULL::VARCHAR AS t{i}" for i in range(8)]
    counted = [f"CAST({numbers[i]} AS DOUBLE) AS n{i}" if i < len(numbers) else f"NULL::DOUBLE AS n{i}" for i in range(6)]
    return f"SELECT '{name}' AS section, {', '.join(told + counted)} FROM ({body})"


def long_kpis(kpis, one_row):
    return " UNION ALL ".join(f"SELECT '{k}' AS kpi, CAST({k} AS DOUBLE) AS value FROM ({one_row}) WHERE {k} IS NOT NULL" for k in kpis)


ALERT_TEXTS = ("alert_id", "title", "severity", "description", "factory", "date", "status")
GROUP_SQL = " UNION ALL ".join([
    section("kpis", long_kpis(B.GROUP_KPIS, f"SELECT *, (SELECT count(*) FROM fact_alerts WHERE is_active) AS active_alerts FROM ({ORACLES['group_kpis']})"), ["kpi"], ["value"]),
    section("rates_by_site", ORACLES["site_rates"], ["plant_id", "trs_status", "scrap_status"], ["trs", "scrap"]),
    section("energy_by_site", ORACLES["energy_by_site"], ["plant_id", "status"], ["energy"]),
    section("alerts_by_site", ORACLES["alerts_by_site"], ["plant_id", "status"], ["alerts"]),
    section("alerts", ORACLES["recent_alerts"], ALERT_TEXTS),
    section("site_count", ORACLES["group_kpis"], (), ["sites"]),
])


@query("group_dashboard", Q.sql(GROUP_SQL))
def _group_bundle(t):
    gold = t.gold()
    for name in ("fact_production", "fact_alerts", "fact_energy"):
        gold[name] = materialise(gold[name], name)
    return B.as_table(B.group_dashboard(gold))


ON_SITE = f"machine_id IN (SELECT machine_id FROM fact_production WHERE plant_id = '{SITE}')"
HERE = {name: f"SELECT * FROM ({Q.CTES[name]}) WHERE {ON_SITE}" for name in ("predictions", "stats")}
INDICATORS = ("at_risk_machines", "at_risk_tone", "mean_risk", "mean_risk_tone", "mean_rul", "mean_rul_tone")
SITE_BUNDLE_SQL = " UNION ALL ".join([
    section("factory", f"SELECT * FROM ({ORACLES['sites_trs']}) WHERE plant_id = '{SITE}'", ["plant_id", "plant_name", "country", "status"], ["trs"]),
    section("kpis", long_kpis(B.SITE_KPIS, f"SELECT *, (SELECT count(*) FROM fact_alerts WHERE is_active AND {ON_SITE}) AS active_alerts FROM ({SITE_SQL}) WHERE plant_id = '{SITE}'"), ["kpi"], ["value"]),
    section("trs_series", ORACLES["trs_series"], ["label"], ["date_id", "value"]),
    section("energy_series", ORACLES["energy_series"], ["label"], ["date_id", "value"]),
    section("lines", f"SELECT * FROM ({ORACLES['line_performance']}) WHERE plant_id = '{SITE}'", ["plant_id", "production_line_id", "status"], ["trs", "production", "target", "reach"]),
    section("risk_machines", SCORED, ["machine_id", "last_intervention", "state"], ["incidents", "risk_score", "rul_days"]),
    section("maintenance_plan", PLAN, ["machine_id", "state", "due", "status"], ["rul_whole_days"]),
    section("alerts", MERGED, ALERT_TEXTS),
    section("indicators", IND.format(risk=Q.whole("avg(risk_score) * 100"), rul=Q.whole("avg(rul_days)")), INDICATORS),
])


@query("site_dashboard", Q.sql(SITE_BUNDLE_SQL, predicted=PREDICTED, recorded=SITE_ALERTS, **HERE))
def _site_bundle(t):
    gold = t.gold()
    for name in ("fact_production", "fact_alerts", "fact_energy", "fact_maintenance"):
        gold[name] = materialise(gold[name], name)
    silver = materialise(t.silver(), "silver")
    answers = materialise(t.predictions(), "predictions")
    predict = lambda readings: answers.join(readings.select("machine_id"), "machine_id", "left_semi")
    return B.as_table(B.site_dashboard(gold, silver, SITE, TODAY, predict))
