"""SQL texts the registered queries are checked against, built from shared CTEs.

They are written for the checking engine from the meaning of each operator, not derived
from the Spark plans. Rounding is done on integers so that exact halves agree.
"""

from __future__ import annotations

import re

NUM_RE = r"-?[0-9]+(\.[0-9]+)?"
TRUE_LIST = "('1','true','t','yes','y','oui')"
DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def num(t: str, trim: bool = True) -> str:
    v = f"trim({t}, ' ')" if trim else t
    return f"CASE WHEN regexp_full_match({v}, '{NUM_RE}') THEN TRY_CAST({v} AS DECIMAL(38,18)) END"


def integer(t: str, trim: bool = True) -> str:
    return f"TRY_CAST(round({num(t, trim)}, 0) AS INTEGER)"


def dbl(e: str) -> str:
    return f"CAST({e} AS DOUBLE)"


def txt(t: str) -> str:
    return f"nullif(trim({t}, ' '), '')"


def boolean(t: str) -> str:
    return f"CASE WHEN {txt(t)} IS NULL THEN NULL ELSE lower(trim({t}, ' ')) IN {TRUE_LIST} END"


def ts(t: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '{DATE_RE}') THEN TRY_CAST(replace(trim({t}, ' '), 'T', ' ') AS TIMESTAMP) END"


def clip(e: str, lo, hi) -> str:
    return f"CASE WHEN {e} BETWEEN {lo} AND {hi} THEN {e} END"


def half_up(top: str, bottom: str, digits: int) -> str:
    """Exact half-away rounding of top/bottom for integer expressions, as a double."""
    p = 10**digits
    return (
        f"CASE WHEN ({bottom}) IS NOT NULL AND ({bottom}) <> 0 THEN "
        f"CAST(sign({top}) * sign({bottom}) * ((2 * abs(CAST({top} AS HUGEINT)) * {p} + abs({bottom})) // (2 * abs({bottom}))) AS DOUBLE) / {p} END"
    )


def mean(c: str, factor: int = 1, where: str = "") -> str:
    w = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(sum({c} * {factor}){w} AS DOUBLE) / nullif(count({c}){w}, 0)"


def half_even(e: str, digits: int = 1) -> str:
    """Rounding of a double as a decimal of its binary value, halves to even."""
    p = 10**digits
    prod = f"(({e}) * {p}.0::DOUBLE)"
    hi = f"((({e}) * 134217729.0::DOUBLE) - ((({e}) * 134217729.0::DOUBLE) - ({e})))"
    err = f"(({hi} * {p}.0::DOUBLE - {prod}) + (({e}) - {hi}) * {p}.0::DOUBLE)"
    return (
        f"(CASE WHEN abs({prod} - floor({prod})) = 0.5 AND {err} > 0 THEN ceil({prod}) "
        f"WHEN abs({prod} - floor({prod})) = 0.5 AND {err} < 0 THEN floor({prod}) "
        f"ELSE round_even({prod}, 0) END / {p}.0::DOUBLE)"
    )


def whole(e: str) -> str:
    return f"CAST(round_even({dbl(e)}, 0) AS BIGINT)"


def status_trs(e: str) -> str:
    return f"CASE WHEN {e} >= 85 THEN 'good' WHEN {e} >= 70 THEN 'warn' ELSE 'crit' END"


def status_reach(e: str) -> str:
    return f"CASE WHEN {e} >= 90 THEN 'good' WHEN {e} >= 80 THEN 'warn' ELSE 'crit' END"


def status_scrap(e: str) -> str:
    return f"CASE WHEN {e} IS NULL OR {e} < 3 THEN 'good' WHEN {e} < 5 THEN 'warn' ELSE 'crit' END"


def status_rul(e: str) -> str:
    return f"CASE WHEN {e} IS NULL THEN 'good' WHEN {e} < 30 THEN 'crit' WHEN {e} < 90 THEN 'warn' ELSE 'good' END"


def severity(e: str) -> str:
    return (
        f"CASE WHEN lower({e}) IN ('critical','high') THEN 'critique' "
        f"WHEN lower({e}) IN ('major','warning','medium') THEN 'majeur' ELSE 'mineur' END"
    )


def day_label(e: str) -> str:
    return (
        f"CASE WHEN {e} IS NULL THEN '' WHEN length({e}::VARCHAR) = 8 THEN "
        f"substr({e}::VARCHAR, 7, 2) || '/' || substr({e}::VARCHAR, 5, 2) ELSE {e}::VARCHAR END"
    )


def date_label(e: str) -> str:
    return (
        f"CASE WHEN {e} IS NULL THEN '' WHEN length({e}::VARCHAR) = 8 THEN substr({e}::VARCHAR, 7, 2) || '/' || "
        f"substr({e}::VARCHAR, 5, 2) || '/' || substr({e}::VARCHAR, 1, 4) ELSE {e}::VARCHAR END"
    )


def title(e: str) -> str:
    t = f"replace(coalesce(nullif({e}, ''), 'Alerte'), '_', ' ')"
    return f"upper(substr({t}, 1, 1)) || lower(substr({t}, 2))"


def risk(p: str, r: str) -> str:
    clf = f"(coalesce({dbl(p)}, 0.0::DOUBLE) * 100)"
    urg = f"greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100.0::DOUBLE * (1.0::DOUBLE - {dbl(r)} / 365)))"
    return f"CASE WHEN {r} IS NULL THEN {whole(clf)} ELSE {whole(f'0.5::DOUBLE * {clf} + 0.5::DOUBLE * {urg}')} END"


def ts_text(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d %H:%M:%S.%f')"


SCADA_COLUMNS = [
    "cycle_time_sec", "Temperature_C", "Vibration_mms", "Sound_dB", "Oil_Level_pct", "Coolant_Level_pct",
    "Hydraulic_Pressure_bar", "Coolant_Flow_L_min", "Heat_Index", "Power_Consumption_kW", "Operational_Hours",
]

CTES: dict[str, str] = {}

CTES["ev"] = "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"

CTES["scada_raw"] = """
SELECT event_id AS bronze_event_id, event_type, k, value,
  CASE event_type WHEN 'purchase' THEN 'erp_business.csv' WHEN 'signup' THEN 'crm_sale.csv'
       WHEN 'view' THEN CASE WHEN k < 50 THEN 'scada_capteurs_sale.csv' ELSE 'scada_capteurs_business.csv' END
       ELSE 'industrial_realtime_stream' END AS source_file,
  CASE event_type WHEN 'purchase' THEN 'erp' WHEN 'signup' THEN 'crm' ELSE 'scada_capteurs' END AS source_system,
  CASE WHEN k < 1 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS timestamp_txt,
  CASE WHEN k > 98 THEN '' ELSE 'S' || user_id END AS machine_txt,
  CAST(k + 15 AS VARCHAR) AS cycle_time_sec,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS Temperature_C,
  CAST(CAST(k AS DECIMAL(10,1)) * 0.1 AS VARCHAR) AS Vibration_mms,
  CAST(k + 30 AS VARCHAR) AS Sound_dB,
  CAST(100 - k AS VARCHAR) AS Oil_Level_pct,
  CASE WHEN event_type = 'view' THEN ' ' || k || ' ' ELSE CAST(k AS VARCHAR) END AS Coolant_Level_pct,
  CAST(2 * k + 30 AS VARCHAR) AS Hydraulic_Pressure_bar,
  CAST(k AS VARCHAR) AS Coolant_Flow_L_min,
  CAST(k + 25 AS VARCHAR) AS Heat_Index,
  CASE WHEN k < 95 THEN CAST(CAST(k AS DECIMAL(10,1)) * 1.5 AS VARCHAR) END AS Power_Consumption_kW,
  CAST(event_id AS VARCHAR) AS Operational_Hours,
  CAST(CAST(k AS DECIMAL(10,1)) * 0.1 AS VARCHAR) AS Error_Codes,
  CASE WHEN event_type = 'click' THEN 'n/a' ELSE CAST(k // 25 AS VARCHAR) END AS Overrides,
  CASE WHEN k >= 93 THEN '1' ELSE '0' END AS Fail7,
  CAST(380 - 4 * k AS VARCHAR) AS Rul,
  CAST(CAST(k AS DECIMAL(10,2)) * 0.01 AS VARCHAR) AS Pfp,
  CAST(CAST(110 - k AS DECIMAL(10,2)) * 0.01 AS VARCHAR) AS Score
FROM ev"""


def _silver() -> str:
    from millwright.schemas import SILVER_NUMBERS

    names = {
        "Remaining_Useful_Life_days": "Rul", "predicted_failure_probability": "Pfp", "sensor_anomaly_score": "Score"
    }
    cols = []
    for key, name, limits in SILVER_NUMBERS:
        v = f"({num(names.get(key, key), trim=False)})"
        cols.append(f"{clip(v, *limits) if limits else v} AS s_{name}")
    body = ",\n  ".join(cols)
    return f"""
SELECT bronze_event_id, {ts('timestamp_txt')} AS event_ts, nullif(machine_txt, '') AS machine_id,
  {body},
  coalesce({integer('Error_Codes', False)}, 0) AS error_codes_last_30_days,
  coalesce({integer('Overrides', False)}, 0) AS ai_override_events,
  coalesce({integer('Fail7', False)}, 0) AS failure_within_7_days,
  CASE WHEN Power_Consumption_kW IS NOT NULL THEN 'valid_sensor_event' ELSE 'partial_sensor_event' END AS quality_status
FROM scada_raw WHERE source_system = 'scada_capteurs'"""


CTES["silver"] = _silver()

CTES["machines"] = """
SELECT s_suppkey, s_name, s_acctbal, n_nationkey, n_regionkey FROM supplier
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CTES["mes_raw"] = """
SELECT CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_extendedprice AS DECIMAL(18,2)))), 1, 15) AS BIGINT) AS bronze_event_id,
  strftime(l_shipdate + to_hours(l_linenumber * 3), '%Y-%m-%d %H:%M:%S') AS timestamp_txt,
  CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'O' THEN ' Matin ' ELSE 'après-midi' END
       WHEN l_returnflag = 'N' THEN 'week end' END AS shift_txt,
  'PL' || n_regionkey AS plant_id, 'LN' || n_nationkey AS production_line_id, 'S' || l_suppkey AS machine_id,
  'P' || l_partkey AS product_id,
  '60' AS planned, ' ' || CAST(l_quantity AS INTEGER) AS actual,
  CAST(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) - CAST(floor(l_quantity / 10) AS INTEGER)
       ELSE CAST(l_quantity AS INTEGER) END AS VARCHAR) AS good,
  CASE WHEN l_linenumber = 7 THEN 'n/a'
       ELSE CAST(CASE WHEN l_returnflag = 'R' THEN CAST(floor(l_quantity / 10) AS INTEGER) ELSE 0 END AS VARCHAR) END AS scrap,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.001 AS VARCHAR) AS cycle_time,
  CAST(CAST(round(l_tax * 100) AS INTEGER) + 80 AS VARCHAR) AS speed,
  CASE WHEN l_discount = 0 THEN '' ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) * 10 AS VARCHAR) END AS downtime,
  CAST(l_linenumber * 5 AS VARCHAR) AS setup,
  CASE WHEN l_returnflag = 'R' THEN 'Rayure' WHEN l_returnflag = 'A' THEN ' ' END AS defect_type,
  CASE WHEN l_linestatus = 'F' THEN 'esthetique' END AS defect_category,
  CASE WHEN l_returnflag = 'R' THEN 'major' END AS defect_severity,
  CASE WHEN l_returnflag = 'N' THEN 'True' WHEN l_returnflag = 'A' THEN ' oui ' ELSE '0' END AS is_conforming,
  CASE WHEN l_returnflag = 'R' THEN 'YES' ELSE '' END AS scrap_flag,
  CASE WHEN l_returnflag = 'R' THEN 't' END AS rework_required,
  CAST(CAST(9 AS DECIMAL(4,2)) + CAST(l_quantity AS DECIMAL(4,0)) * 0.04 AS VARCHAR) AS dimension,
  CAST(100 - CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) AS quality_score
FROM lineitem LEFT JOIN machines ON l_suppkey = s_suppkey"""

SHIFT_ID = """CASE WHEN {s} IN ('matin','morning') THEN 'SHIFT_MATIN'
  WHEN {s} IN ('apres-midi','après-midi','afternoon') THEN 'SHIFT_APRES_MIDI'
  WHEN {s} IN ('nuit','night') THEN 'SHIFT_NUIT'
  WHEN {s} IS NOT NULL THEN 'SHIFT_' || upper(replace({s}, ' ', '_'))
  WHEN hour({t}) >= 6 AND hour({t}) < 14 THEN 'SHIFT_MATIN'
  WHEN hour({t}) >= 14 AND hour({t}) < 22 THEN 'SHIFT_APRES_MIDI' ELSE 'SHIFT_NUIT' END"""


def shift_id(text: str, stamp: str) -> str:
    return SHIFT_ID.format(s=f"lower({txt(text)})", t=stamp)


def date_id(t: str) -> str:
    return f"CAST(strftime({t}, '%Y%m%d') AS INTEGER)"


DEFECT = (
    "trim(regexp_replace(lower(coalesce(nullif(trim({a}, ' '), ''), 'no_defect') || '_' || "
    "coalesce(nullif(trim({b}, ' '), ''), 'none') || '_' || coalesce(nullif(trim({c}, ' '), ''), 'minor')), "
    "'[^a-z0-9]+', '_', 'g'), '_')"
)

CTES["mes"] = f"""
SELECT *, {ts('timestamp_txt')} AS ts, {date_id(ts('timestamp_txt'))} AS date_id,
  {shift_id('shift_txt', ts('timestamp_txt'))} AS shift_id,
  {DEFECT.format(a='defect_type', b='defect_category', c='defect_severity')} AS defect_id
FROM mes_raw"""

CTES["prod_base"] = f"""
SELECT bronze_event_id, date_id, plant_id, production_line_id, machine_id, product_id, shift_id,
  {integer('planned')} AS planned_production_qty, {integer('actual')} AS actual_production_qty,
  {integer('good')} AS good_qty, {integer('scrap')} AS scrap_qty,
  {num('cycle_time')} AS cycle_time_sec, CAST(NULL AS DECIMAL(18,6)) AS target_cycle_time_sec,
  {num('speed')} AS production_speed,
  coalesce({num('downtime')}, 0) AS downtime_minutes, coalesce({num('setup')}, 0) AS setup_time_minutes
FROM mes"""


def _i(e: str) -> str:
    """A decimal(18,6) as an integer number of millionths."""
    return f"CAST(({e}) * 1000000 AS HUGEINT)"


CTES["prod_rates"] = f"""
SELECT *,
  {half_up(f"greatest(480000000 - {_i('downtime_minutes')} - {_i('setup_time_minutes')}, 0)", '480000000', 4)} AS availability,
  {half_up(_i('production_speed'), '100000000', 4)} AS performance,
  {half_up('good_qty', 'actual_production_qty', 4)} AS quality,
  {half_up('scrap_qty', 'actual_production_qty', 4)} AS scrap
FROM prod_base"""


def _w(e: str) -> str:
    return f"CAST(round({e} * 10000) AS HUGEINT)"


CTES["fact_production"] = f"""
SELECT bronze_event_id, date_id, plant_id, production_line_id, machine_id, product_id, shift_id,
  planned_production_qty, actual_production_qty, good_qty, scrap_qty, cycle_time_sec, target_cycle_time_sec,
  production_speed, downtime_minutes, setup_time_minutes,
  CAST(availability AS DECIMAL(18,4)) AS availability_rate, CAST(performance AS DECIMAL(18,4)) AS performance_rate,
  CAST(quality AS DECIMAL(18,4)) AS quality_rate,
  CAST({half_up(f"{_w('availability')} * {_w('quality')} * {_w('performance')}", '1000000000000', 4)} AS DECIMAL(18,4)) AS trs,
  CAST(scrap AS DECIMAL(18,4)) AS scrap_rate
FROM prod_rates"""

CTES["fact_quality"] = f"""
SELECT bronze_event_id, date_id, machine_id, product_id, defect_id,
  {num('dimension')} AS dimension_measurement, CAST(9.5 AS DECIMAL(18,6)) AS tolerance_min,
  CAST(10.5 AS DECIMAL(18,6)) AS tolerance_max, {boolean('is_conforming')} AS is_conforming,
  {boolean('scrap_flag')} AS scrap_flag, {boolean('rework_required')} AS rework_required,
  {num('quality_score')} AS quality_score
FROM mes"""

CTES["energy_raw"] = """
SELECT o_orderkey AS bronze_event_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS timestamp_txt,
  'S' || o_custkey AS machine_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderpriority AS level,
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '12.5' END AS water,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '1e3' ELSE substr(o_orderpriority, 1, 1) || '00' END AS peak
FROM orders WHERE o_orderstatus <> 'P'"""

CTES["fact_energy_base"] = f"""
SELECT bronze_event_id, {date_id(ts('timestamp_txt'))} AS date_id, machine_id,
  CAST(price AS DECIMAL(18,6)) AS energy_consumption_kwh,
  CAST(price * 0.001 AS DECIMAL(18,6)) AS compressed_air_usage, {num('water')} AS cooling_water_usage,
  {num('peak')} AS power_peak_kw, CAST(price * 0.1 AS DECIMAL(18,6)) AS energy_cost
FROM energy_raw"""

CTES["good_first"] = """
SELECT date_id, machine_id, arg_min(good_qty, bronze_event_id) AS good FROM fact_production
WHERE good_qty > 0 GROUP BY date_id, machine_id"""

CTES["fact_energy"] = f"""
SELECT e.*, {half_up(_i('e.energy_consumption_kwh'), 'g.good * 1000000', 4)} AS energy_per_good_piece
FROM fact_energy_base e LEFT JOIN good_first g ON e.date_id = g.date_id AND e.machine_id = g.machine_id"""

CTES["maint_raw"] = """
SELECT o_orderkey AS bronze_event_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS timestamp_txt,
  'S' || o_custkey AS machine_id, 'MEV' || o_orderkey AS maintenance_event_id,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'corrective' ELSE ' preventive' END AS maintenance_type,
  lower(substr(o_orderpriority, 3)) AS failure_type, 'F00' || substr(o_orderpriority, 1, 1) AS failure_code,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'major' ELSE '' END AS failure_severity,
  CAST(o_totalprice AS DECIMAL(18,2)) AS price,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE substr(o_orderpriority, 1, 1) || '5' END AS downtime,
  '0.' || substr(o_orderpriority, 1, 1) AS pfp
FROM orders WHERE o_orderstatus = 'P'"""

CTES["fact_maintenance"] = f"""
SELECT bronze_event_id, {date_id(ts('timestamp_txt'))} AS date_id, machine_id, maintenance_event_id,
  {txt('maintenance_type')} AS maintenance_type, {txt('failure_type')} AS failure_type,
  {txt('failure_code')} AS failure_code, {txt('failure_severity')} AS failure_severity,
  CAST(price * 0.001 AS DECIMAL(18,6)) AS repair_time_minutes, {num('downtime')} AS downtime_minutes,
  CAST(price AS DECIMAL(18,6)) AS maintenance_cost, {num('pfp')} AS predicted_failure_probability,
  CAST(NULL AS DECIMAL(18,6)) AS sensor_anomaly_score
FROM maint_raw"""

CTES["alert_base"] = f"""
SELECT bronze_event_id, {date_id(ts('timestamp_txt'))} AS date_id, {txt('machine_txt')} AS machine_id,
  nullif(concat_ws(',', CASE WHEN k >= 88 THEN 'oil_low' END, CASE WHEN value > 72 THEN 'temperature_high' END,
    CASE WHEN k >= 80 THEN 'vibration_high' END), '') AS flags, coalesce({num('Pfp')}, 0) >= 0.7 AS high
FROM scada_raw WHERE source_system = 'scada_capteurs' AND
  (right(source_file, 13) = '_business.csv' OR source_file = 'industrial_realtime_stream')"""

CTES["fact_alerts"] = """
SELECT bronze_event_id, date_id, machine_id, 'sensor_health' AS alert_type,
  CASE WHEN high THEN 'critical' ELSE 'warning' END AS alert_severity,
  coalesce(flags, 'predicted_failure_probability_high') AS alert_reason, TRUE AS is_active
FROM alert_base WHERE flags IS NOT NULL OR high"""

CTES["dim_plant"] = "SELECT 'PL' || r_regionkey AS plant_id, r_name AS plant_name, lower(r_name) AS country FROM region"

CTES["bridge"] = "SELECT DISTINCT machine_id, plant_id FROM fact_production"

CTES["predictions"] = """
SELECT machine_id, CASE WHEN p >= 0.5 THEN 'at_risk' ELSE 'normal' END AS state, p AS risk_score, r AS rul_days
FROM (SELECT machine_id, CAST(s_predicted_failure_probability AS DOUBLE) AS p,
        CAST(s_remaining_useful_life_days AS DOUBLE) AS r,
        row_number() OVER (PARTITION BY machine_id ORDER BY event_ts DESC NULLS LAST, bronze_event_id) AS rn
      FROM silver WHERE machine_id IS NOT NULL) WHERE rn = 1"""

CTES["incident_counts"] = "SELECT machine_id, count(*) AS n FROM fact_alerts WHERE is_active GROUP BY machine_id"
CTES["last_maint"] = "SELECT machine_id, max(date_id) AS d FROM fact_maintenance GROUP BY machine_id"
CTES["stats"] = """
SELECT m.machine_id, coalesce(i.n, 0) AS incidents, l.d AS last_maint
FROM (SELECT DISTINCT machine_id FROM fact_production) m
LEFT JOIN incident_counts i ON i.machine_id = m.machine_id LEFT JOIN last_maint l ON l.machine_id = m.machine_id"""


def _needs(body: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", body))
    return [n for n in CTES if n in words]


def sql(body: str, **extra: str) -> str:
    """``body`` preceded by the CTEs it refers to, directly or not."""
    local = dict(extra)
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        text = local.get(name) or CTES[name]
        for other in [*_needs(text), *[n for n in local if re.search(rf"\b{n}\b", text)]]:
            if other != name:
                visit(other)
        order.append(name)

    for name in [*_needs(body), *[n for n in local if re.search(rf"\b{n}\b", body)]]:
        visit(name)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({(local.get(n) or CTES[n]).strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"
