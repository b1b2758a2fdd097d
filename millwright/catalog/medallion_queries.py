"""Bronze to silver to gold over the bound tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.catalog import oracle as Q
from millwright.catalog.registry import ORACLES, query
from millwright.operators import merge as G
from millwright.plans import medallion as M
from millwright.plans.business import publish
from millwright.plans.incremental import Warehouse
from millwright.session import materialise, scratch_path, scratch_scope
from millwright.sources import gold
from millwright.sources.stored import Store

SILVER_NAMES = [n for _, n, _ in S.SILVER_NUMBERS]
SILVER_SQL = ", ".join(f"{Q.dbl('s_' + n)} AS {n}" for n in SILVER_NAMES)


@query(
    "bronze_to_silver",
    Q.sql(
        f"""SELECT bronze_event_id, {Q.ts_text('event_ts')} AS event_ts, machine_id, {SILVER_SQL}, error_codes_last_30_days,
        ai_override_events, failure_within_7_days, quality_status FROM silver"""
    ),
)
def _silver(t):
    return t.silver()


@query(
    "silver_insert_new",
    Q.sql("SELECT bronze_event_id, machine_id FROM silver WHERE bronze_event_id IN (SELECT event_id FROM events WHERE event_type <> 'view')"),
)
def _silver_new(t):
    """Only readings whose bronze event is not in silver yet."""
    silver = t.silver()
    views = t.read("events").filter("event_type = 'view'").select(F.col("event_id").alias("bronze_event_id"))
    known = silver.join(views, "bronze_event_id", "left_semi")
    return G.insert_if_absent(known, silver, ["bronze_event_id"]).select("bronze_event_id", "machine_id")


@query(
    "silver_rejects",
    Q.sql("SELECT count(*) AS n_events, CAST(sum(CASE WHEN timestamp_txt <> '' AND NOT regexp_matches(timestamp_txt, '^[0-9]{4}') THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected FROM scada_raw WHERE source_system = 'scada_capteurs'"),
)
def _rejects(t):
    return M.silver_rejects(t.bronze_events())


@query("valid_health_rows", Q.sql("SELECT bronze_event_id FROM silver WHERE event_ts IS NOT NULL AND machine_id IS NOT NULL"))
def _valid(t):
    return M.valid_health_rows(t.silver()).select("bronze_event_id")


def avg_sql(c, digits):
    return Q.half_up(f"sum(CAST({c} * 1000000 AS HUGEINT))", f"nullif(count({c}) * 1000000, 0)", digits)


HEALTH_SQL = f"""SELECT strftime(event_ts, '%Y-%m-%d') AS snapshot_date, machine_id, CAST(count(*) AS INTEGER) AS event_count,
  {avg_sql('s_temperature_c', 2)} AS avg_temperature_c, {avg_sql('s_vibration_mms', 2)} AS avg_vibration_mms,
  {avg_sql('s_power_consumption_kw', 2)} AS avg_power_consumption_kw, {avg_sql('s_sensor_anomaly_score', 3)} AS avg_sensor_anomaly_score,
  CAST(sum(CASE WHEN failure_within_7_days = 1 THEN 1 ELSE 0 END) AS INTEGER) AS failure_alerts,
  CAST(sum(CASE WHEN coalesce(s_sensor_anomaly_score, 0) >= 0.7 OR coalesce(s_predicted_failure_probability, 0) >= 0.7 THEN 1 ELSE 0 END) AS INTEGER) AS high_risk_events
FROM silver WHERE event_ts IS NOT NULL AND machine_id IS NOT NULL GROUP BY 1, 2"""


@query("machine_health_daily", Q.sql(HEALTH_SQL))
def _health(t):
    return M.machine_health_daily(t.silver())


# ------------------------------------------------------------------ staging and dimensions
@query("filter_source_in", Q.sql("SELECT bronze_event_id, source_system FROM scada_raw WHERE source_system IN ('mes','gmao','energie','scada_capteurs','erp','machine_mapping','factories','production_lines','parts')"))
def _filter(t):
    return M.filter_sources(t.bronze_events()).select("bronze_event_id", "source_system")


@query("is_business_event", Q.sql("SELECT bronze_event_id, right(source_file, 13) = '_business.csv' OR source_file = 'industrial_realtime_stream' AS is_biz FROM scada_raw"))
def _is_biz(t):
    from millwright.functions.parse import is_business_event

    return t.bronze_events().select("bronze_event_id", is_business_event("source_file").alias("is_biz"))


@query(
    "staging_keys",
    Q.sql(
        """SELECT bronze_event_id, date_id, plant_id, production_line_id AS line_id, product_id, machine_id, shift_id, defect_id,
        TRUE AS is_biz FROM mes"""
    ),
)
def _staging(t):
    return M.staging(t.bronze_mes()).select(
        "bronze_event_id", "date_id", "plant_id", "line_id", "product_id", "machine_id", "shift_id", "defect_id", "is_biz"
    )


def shift_names(sid, text):
    known = f"CASE {sid} WHEN 'SHIFT_MATIN' THEN '{{}}' WHEN 'SHIFT_APRES_MIDI' THEN '{{}}' WHEN 'SHIFT_NUIT' THEN '{{}}' ELSE {{}} END"
    return (
        known.format("matin", "apres-midi", "nuit", text),
        known.format("06:00", "14:00", "22:00", "'00:00'"),
        known.format("14:00", "22:00", "06:00", "'23:59'"),
    )


SN, SS, SE = shift_names("shift_id", f"lower({Q.txt('shift_txt')})")
HOUR_SHIFT = Q.shift_id("NULL::VARCHAR", "ts")
STG = {
    "scada_stg": f"SELECT {Q.ts('timestamp_txt')} AS ts, {Q.txt('machine_txt')} AS machine_id FROM scada_raw WHERE source_system IN ('scada_capteurs','erp')",
    "order_days": "SELECT o_orderdate AS ts, 'S' || o_custkey AS machine_id FROM orders",
    "stamps": "SELECT ts FROM scada_stg UNION ALL SELECT ts FROM order_days UNION ALL SELECT ts FROM mes",
    "hour_shifts": f"SELECT {HOUR_SHIFT} AS shift_id FROM (SELECT ts FROM scada_stg UNION ALL SELECT ts FROM order_days UNION ALL SELECT NULL::TIMESTAMP)",
    "shift_rows": f"""SELECT shift_id, {SN} AS a, {SS} AS b, {SE} AS c FROM mes
        UNION ALL SELECT shift_id, {shift_names('shift_id', 'NULL')[0]}, {SS}, {SE} FROM hour_shifts""",
}
DIM_SQL = f"""
SELECT 'dim_date' AS dim, strftime(ts, '%Y%m%d') AS key, strftime(ts, '%Y-%m-%d') AS a, CAST(year(ts) AS VARCHAR) AS b,
  CAST(month(ts) AS VARCHAR) AS c, CAST(day(ts) AS VARCHAR) AS d, CAST(weekofyear(ts) AS VARCHAR) AS e
FROM (SELECT DISTINCT date_trunc('day', ts) AS ts FROM stamps WHERE ts IS NOT NULL)
UNION ALL SELECT 'dim_plant', plant_id, plant_name, country, NULL, NULL, NULL FROM dim_plant
UNION ALL SELECT 'dim_line', 'LN' || n_nationkey, 'PL' || n_regionkey, n_name, NULL, NULL, NULL FROM nation
UNION ALL SELECT 'dim_shift', shift_id, max(a), max(b), max(c), NULL, NULL FROM shift_rows GROUP BY shift_id
UNION ALL SELECT 'dim_product', 'P' || p_partkey, p_name, p_type, NULL, NULL, NULL FROM part
UNION ALL SELECT 'dim_machine', m, max(l), max(n), CAST(max(y) AS VARCHAR), NULL, NULL FROM (
  SELECT 'S' || s_suppkey AS m, 'LN' || n_nationkey AS l, s_name AS n, CASE WHEN s_acctbal > 0 THEN 2016 END AS y FROM machines
  UNION ALL SELECT machine_id, NULL, NULL, NULL FROM scada_stg WHERE machine_id IS NOT NULL
  UNION ALL SELECT machine_id, NULL, NULL, NULL FROM order_days) GROUP BY m
UNION ALL SELECT 'dim_defect', defect_id, max(coalesce({Q.txt('defect_type')}, 'no_defect')), max(coalesce({Q.txt('defect_category')}, 'none')),
  max(coalesce({Q.txt('defect_severity')}, 'minor')), NULL, NULL FROM
  (SELECT defect_id, defect_type, defect_category, defect_severity FROM mes UNION ALL SELECT 'no_defect_none_minor', NULL, NULL, NULL) GROUP BY defect_id"""


@query("dim_build", Q.sql(DIM_SQL, **STG))
def _dims(t):
    """All seven dimensions as (dim, key, attributes) text rows."""
    return dimension_text(M.dimensions(M.staging(t.bronze())))


def dimension_text(dims):
    out = []
    for name, df in dims.items():
        text = [F.col(c).cast("string") for c in df.columns] + [F.lit(None).cast("string")] * (6 - len(df.columns))
        out.append(df.select(F.lit(name).alias("dim"), *[c.alias(n) for c, n in zip(text, ["key", *"abcde"])]))
    return reduce(DataFrame.unionByName, out)


# ------------------------------------------------------------------ facts
def as_double(*names):
    return ", ".join(f"{Q.dbl(n)} AS {n}" for n in names)


RATES = ["availability_rate", "performance_rate", "quality_rate", "trs", "scrap_rate"]


@query(
    "fact_production",
    Q.sql(
        f"""SELECT bronze_event_id, date_id, plant_id, production_line_id, machine_id, product_id, shift_id, planned_production_qty,
        actual_production_qty, good_qty, scrap_qty,
        {as_double('cycle_time_sec', 'target_cycle_time_sec', 'production_speed', 'downtime_minutes', 'setup_time_minutes', *RATES)} FROM fact_production"""
    ),
)
def _production(t):
    return t.production()


@query("lateral_calc", Q.sql(f"SELECT bronze_event_id, {as_double(*RATES)} FROM fact_production"))
def _rates(t):
    return t.production().select("bronze_event_id", *RATES)


@query(
    "fact_quality",
    Q.sql(
        f"""SELECT bronze_event_id, date_id, machine_id, product_id, defect_id, {as_double('dimension_measurement', 'tolerance_min', 'tolerance_max')},
        is_conforming, scrap_flag, rework_required, {as_double('quality_score')} FROM fact_quality"""
    ),
)
def _quality(t):
    return t.quality()


@query(
    "fact_maintenance",
    Q.sql(
        f"""SELECT bronze_event_id, date_id, machine_id, maintenance_event_id, maintenance_type, failure_type, failure_code, failure_severity,
        {as_double('repair_time_minutes', 'downtime_minutes', 'maintenance_cost', 'predicted_failure_probability', 'sensor_anomaly_score')} FROM fact_maintenance"""
    ),
)
def _maintenance(t):
    return t.maintenance()


ENERGY = ["energy_consumption_kwh", "compressed_air_usage", "cooling_water_usage", "power_peak_kw", "energy_cost"]


@query("fact_energy", Q.sql(f"SELECT bronze_event_id, date_id, machine_id, {as_double(*ENERGY)}, energy_per_good_piece FROM fact_energy"))
def _energy(t):
    return G.energy_per_good_piece(t.energy(), t.production())


@query("energy_per_good_piece", Q.sql("SELECT bronze_event_id, energy_per_good_piece FROM fact_energy WHERE energy_per_good_piece IS NOT NULL"))
def _per_piece(t):
    out = G.energy_per_good_piece(t.energy(), t.production())
    return out.filter("energy_per_good_piece is not null").select("bronze_event_id", "energy_per_good_piece")


@query("fact_alerts", Q.sql("SELECT bronze_event_id, date_id, machine_id, alert_type, alert_severity, alert_reason, is_active FROM fact_alerts"))
def _alerts(t):
    return t.alerts()


@query("alert_rule", Q.sql("SELECT alert_severity, alert_reason, count(*) AS n FROM fact_alerts GROUP BY 1, 2"))
def _alert_rule(t):
    return t.alerts().groupBy("alert_severity", "alert_reason").agg(F.count(F.lit(1)).alias("n"))


@query("flag_string_agg", Q.sql("SELECT bronze_event_id, flags AS active_flags FROM alert_base"))
def _flags(t):
    from millwright.functions.parse import active_flags, is_business_event

    sensor = t.bronze_events().filter((F.col("source_system") == "scada_capteurs") & is_business_event("source_file"))
    return sensor.select("bronze_event_id", active_flags("payload").alias("active_flags"))


# ------------------------------------------------------------------ merges
@query("insert_if_absent", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _absent(t):
    orders = t.read("orders").select("o_custkey", "o_orderpriority")
    old = orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return G.insert_if_absent(old, orders.select("o_custkey"), ["o_custkey"])


@query(
    "dim_upsert_coalesce",
    """SELECT coalesce(s_suppkey, k) AS s_suppkey, coalesce(nn, s_name) AS s_name, coalesce(nk, s_nationkey) AS s_nationkey
       FROM supplier FULL JOIN (SELECT n_nationkey AS k, CASE WHEN n_regionkey < 3 THEN n_name END AS nn, n_regionkey AS nk FROM nation) ON s_suppkey = k""",
)
def _coalesce(t):
    old = t.read("supplier").select("s_suppkey", "s_name", "s_nationkey")
    new = t.read("nation").select(
        F.col("n_nationkey").cast("long").alias("s_suppkey"), F.when(F.col("n_regionkey") < 3, F.col("n_name")).alias("s_name"),
        F.col("n_regionkey").alias("s_nationkey"),
    )
    return G.merge(old, new, ["s_suppkey"], ["s_name", "s_nationkey"], keep_old_when_null=True)


@query(
    "fact_upsert_partial",
    Q.sql(
        f"""SELECT bronze_event_id, {Q.dbl("CASE WHEN date_id IS NOT NULL AND failure_code <> 'F001' THEN maintenance_cost + 1 ELSE maintenance_cost END")} AS maintenance_cost,
        {Q.dbl('predicted_failure_probability')} AS predicted_failure_probability, failure_type FROM fact_maintenance"""
    ),
)
def _partial(t):
    """A second load changes cost and probability; only the cost may change."""
    old = t.maintenance()
    new = old.filter("failure_code <> 'F001'").withColumns(
        {"maintenance_cost": (F.col("maintenance_cost") + 1).cast(S.NUM), "predicted_failure_probability": F.lit(None).cast(S.NUM)}
    )
    return M.upsert_fact("fact_maintenance", old, new).select(
        "bronze_event_id", "maintenance_cost", "predicted_failure_probability", "failure_type"
    )


# ------------------------------------------------------------------ loads
def keyed(bronze):
    """Envelopes with the hash that tells them from others."""
    return bronze.withColumn("payload_hash", F.sha2(F.to_json(F.struct("bronze_event_id", "source_system", "source_file", "payload")), 256))


def two_loads(t, bronze, early, *steps):
    """A warehouse after the ``early`` events, then all events, went through the steps.

    Nothing reads an earlier commit or a load's scratch tables once the load is done, so they are deleted.
    """
    house = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), buckets=8)
    with scratch_scope(t.spark):
        events = materialise(keyed(bronze), "events")
        for part in (events.where(early), events):
            with scratch_scope(t.spark):
                fresh = house.load_bronze(part)
                for step in steps:
                    step(house, fresh)
                house.store.commit()
                house.store.sweep()
    return house


#: Events of the first load: a timestamp text before this year, or none.
EARLY = "coalesce(payload['timestamp'], '') < '{}'"


def fact_steps(*names):
    return [lambda house, fresh, n=n: house.load_fact(n, M.staging(fresh)) for n in names]


@query("load_twice_production", ORACLES["fact_production"])
def _load_production(t):
    """Production after two loads, the second of which repeats the first."""
    house = two_loads(t, t.bronze_mes(), EARLY.format("1998"), *fact_steps("fact_production"))
    return house.read("fact_production")


@query("load_twice_energy", ORACLES["fact_energy"])
def _load_energy(t):
    """Energy per good piece, when energy comes first and most production with the second load."""
    steps = fact_steps("fact_production", "fact_energy")
    bronze = t.bronze_mes().unionByName(t.bronze_energy())
    early = f"source_system = 'energie' OR {EARLY.format('1996')}"
    house = two_loads(t, bronze, early, *steps, lambda house, _: house.load_energy_per_piece())
    return house.read("fact_energy")


@query("load_twice_health", ORACLES["machine_health_daily"])
def _load_health(t):
    """Daily health after two loads that share days: the second adds the erroneous and the late half of them."""
    house = two_loads(
        t, t.bronze_events(), "coalesce(payload['Temperature_C'], '0') < '5'", lambda house, fresh: house.load_health(house.load_silver(fresh))
    )
    return house.read("machine_health_daily")


@query("load_twice_dimensions", ORACLES["dim_build"])
def _load_dimensions(t):
    """All dimensions after two loads, by the rule of each."""
    house = two_loads(t, t.bronze(), EARLY.format("1998"), lambda house, fresh: house.load_dimensions(M.staging(fresh)))
    return dimension_text({name: house.read(name) for name in M.DIMENSIONS})


@query(
    "load_twice_counts",
    Q.sql("""SELECT 1 AS load, count(*) FILTER (early) AS inserted FROM b UNION ALL SELECT 2, count(*) FILTER (NOT early) FROM b""",
          b="SELECT coalesce(timestamp_txt, '') < '2024-01-15' AS early FROM scada_raw"),
)
def _load_counts(t):
    """New bronze events of each load; the second brings the first ones again."""
    events = materialise(keyed(t.bronze_events()), "events")
    house = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), buckets=8)
    rows = None
    for number, part in enumerate((events.where(EARLY.format("2024-01-15")), events), 1):
        one = house.load_bronze(part).agg(F.lit(number).alias("load"), F.count(F.lit(1)).alias("inserted"))
        rows = one if rows is None else rows.unionByName(one)
        house.store.commit()
    return rows


def _rule(name, sql):
    """Registers the rule of one dimension over nations that come twice, changed the second time."""

    @query(name, sql)
    def run(t):
        nation = t.read("nation").withColumn("n_nationkey", F.col("n_nationkey").cast("long"))
        old = nation.where("n_regionkey < 3").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("a"), F.col("n_regionkey").alias("b"))
        new = nation.where("n_regionkey > 0").select(
            F.col("n_nationkey").alias("key"), F.when(F.col("n_regionkey") != 1, F.lower("n_name")).alias("a"), (F.col("n_regionkey") + 10).alias("b")
        )
        return M.upsert_dimension({"insert": "dim_defect", "overwrite": "dim_shift"}[name.rsplit("_", 1)[1]], old, new)


KNOWN = "SELECT n_nationkey AS key, CASE WHEN n_regionkey < 3 THEN {} ELSE {} END AS a, CASE WHEN n_regionkey < 3 THEN {} ELSE {} END AS b FROM nation"
_rule("dim_upsert_insert", KNOWN.format("n_name", "lower(n_name)", "n_regionkey", "n_regionkey + 10"))
_rule(
    "dim_upsert_overwrite",
    """SELECT n_nationkey AS key, CASE WHEN n_regionkey = 0 THEN n_name WHEN n_regionkey <> 1 THEN lower(n_name) END AS a,
       CASE WHEN n_regionkey = 0 THEN n_regionkey ELSE n_regionkey + 10 END AS b FROM nation""",
)


# ------------------------------------------------------------------ lists and lookups
def stored_gold(t, tables, keys):
    """The tables as one published set, read back."""
    store = Store(t.spark, scratch_path(t.spark, "gold"), 4)
    publish(store, tables, keys)
    return {name: store.read(name) for name in tables}


def stored_dimensions(t):
    return stored_gold(t, M.dimensions(M.staging(t.bronze())), {n: [k] for n, k in gold.DIM_KEYS.items()})


@query("list_dimensions", ORACLES["dim_build"])
def _list_dimensions(t):
    """Every row of all seven stored dimensions."""
    return dimension_text({name: gold.filter_table(name, df) for name, df in stored_dimensions(t).items()})


WANTED = {
    "dim_date": 19970528, "dim_plant": "PL2", "dim_line": "LN7", "dim_shift": "SHIFT_NUIT", "dim_product": "P42", "dim_machine": "S5",
    "dim_defect": "no_defect_none_minor",
}


@query(
    "lookup_dimensions",
    Q.sql(f"SELECT * FROM ({DIM_SQL}) WHERE (dim, key) IN ({', '.join(f'''('{n}', '{k}')''' for n, k in WANTED.items())})", **STG),
)
def _lookup_dimensions(t):
    """One row of each stored dimension by its key."""
    return dimension_text({name: gold.lookup(name, df, WANTED[name]) for name, df in stored_dimensions(t).items()})


MEASURES = {"fact_production": "trs", "fact_quality": "quality_score", "fact_maintenance": "maintenance_cost", "fact_energy": "energy_per_good_piece"}
LISTED = " UNION ALL ".join(
    [f"SELECT '{n}' AS fact, bronze_event_id, date_id, machine_id, {Q.dbl(m)} AS measure FROM {n}" for n, m in MEASURES.items()]
    + ["SELECT 'fact_alerts', bronze_event_id, date_id, machine_id, NULL FROM fact_alerts"]
)


def listed_facts(t, **wanted):
    # Production is stored and read by energy too, so its payloads are parsed once.
    production = materialise(t.production(), "fact_production")
    facts = {**t.gold(), "fact_production": production, "fact_energy": G.energy_per_good_piece(t.energy(), production)}
    stored = stored_gold(t, {n: facts[n] for n in M.FACTS}, {n: ["date_id"] for n in M.FACTS})
    rows = []
    for name, df in stored.items():
        measure = F.col(MEASURES[name]) if name in MEASURES else F.lit(None)
        found = gold.filter_table(name, df, **wanted)
        rows.append(found.select(F.lit(name).alias("fact"), "bronze_event_id", "date_id", "machine_id", measure.cast("double").alias("measure")))
    return reduce(DataFrame.unionByName, rows)


@query("list_facts", Q.sql(LISTED))
def _list_facts(t):
    """Every row of all five stored facts."""
    return listed_facts(t)


@query("filter_facts", Q.sql(f"SELECT * FROM ({LISTED}) WHERE machine_id = 'S7'"))
def _filter_facts(t):
    """The rows of one machine in all five stored facts."""
    return listed_facts(t, machine_id="S7")
