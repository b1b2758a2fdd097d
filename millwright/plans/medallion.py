"""Bronze to silver to gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.functions import parse as P
from millwright.functions.rules import within_sql
from millwright.operators.merge import energy_per_good_piece, merge
from millwright.session import materialise


# ---------------------------------------------------------------- silver
def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Typed sensor events; values outside their plausible range are null.

    Ranges are checked on the parsed columns, so no text is parsed twice.
    """
    parsed = bronze.filter("source_system = 'scada_capteurs'").selectExpr(
        "bronze_event_id",
        f"{P.timestamp_sql(_raw('timestamp'))} AS event_ts",
        f"nullif({_raw('machine_id')}, '') AS machine_id",
        *[f"{P.number_sql(_raw(key), trim=False)} AS {name}" for key, name, _ in S.SILVER_NUMBERS],
        *[f"coalesce({P.int_sql(_raw(key), trim=False)}, 0) AS {name}" for key, name in S.SILVER_COUNTS],
        f"CASE WHEN {P.has_keys_sql('payload', S.SENSOR_KEYS_REQUIRED)} THEN 'valid_sensor_event' "
        "ELSE 'partial_sensor_event' END AS quality_status",
    )
    plausible = {name: within_sql(name, *limits) for _, name, limits in S.SILVER_NUMBERS if limits}
    return parsed.selectExpr(*[f"{plausible.get(c, c)} AS {c}" for c in parsed.columns])


def _raw(key: str) -> str:
    return f"payload['{key}']"


def silver_rejects(bronze: DataFrame) -> DataFrame:
    """How many sensor events carry timestamp text that is not a timestamp."""
    text = _raw("timestamp")
    bad = F.expr(f"nullif({text}, '') IS NOT NULL AND {P.timestamp_sql(text)} IS NULL")
    return bronze.filter("source_system = 'scada_capteurs'").agg(
        F.count(F.lit(1)).alias("n_events"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("n_rejected")
    )


def unread_numbers(bronze: DataFrame) -> DataFrame:
    """Per source system, payload texts that are plain numbers but have more whole digits than a measure."""
    number = F.regexp_extract(F.btrim(F.col("value")), S.NUMBER_PATTERN, 0)
    lost = (number != "") & number.try_cast(S.MEASURE).isNull()
    pairs = bronze.select("source_system", F.explode("payload").alias("key", "value"))
    return pairs.where(lost).groupBy("source_system", "key").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- health
def health_measures() -> list[Column]:
    """Aggregates of one machine and day; a missing score counts as no risk."""
    risky = " OR ".join(
        f"coalesce({c}, 0) >= {S.HIGH_RISK}" for c in ("sensor_anomaly_score", "predicted_failure_probability")
    )
    means = {"temperature_c": 2, "vibration_mms": 2, "power_consumption_kw": 2, "sensor_anomaly_score": 3}
    return [
        F.expr("CAST(count(1) AS int) AS event_count"),
        *[F.expr(f"round(avg({c}), {digits}) AS avg_{c}") for c, digits in means.items()],
        F.expr("CAST(count_if(failure_within_7_days = 1) AS int) AS failure_alerts"),
        F.expr(f"CAST(count_if({risky}) AS int) AS high_risk_events"),
    ]


def machine_health_daily(silver: DataFrame) -> DataFrame:
    """Daily health per machine. The aggregate combines on the map side, so one machine
    with a large share of the events moves as one row per task and day."""
    day = F.to_date("event_ts").alias("snapshot_date")
    return valid_health_rows(silver).groupBy(day, "machine_id").agg(*health_measures())


def valid_health_rows(silver: DataFrame) -> DataFrame:
    return silver.filter("event_ts is not null and machine_id is not null")


# ---------------------------------------------------------------- staging
#: Payload keys that staging and the facts parse, and the columns of their texts.
TEXTS = {
    key: f"raw_{key}"
    for key in (
        "timestamp", "shift", "factory_id", "plant_id", "production_line_id", "product_id", "machine_id",
        "defect_type", "defect_category", "defect_severity", "factory_name", "country", "production_line_name",
        "part_name", "product_family", "machine_type", "installation_year",
        "planned_production_qty", "actual_production_qty", "good_qty", "scrap_qty",
        "cycle_time_sec", "target_cycle_time_sec", "production_speed", "downtime_minutes", "setup_time_minutes",
        "dimension_measurement", "tolerance_min", "tolerance_max", "is_conforming", "scrap_flag", "rework_required", "quality_score",
        "maintenance_event_id", "maintenance_type", "failure_type", "failure_code", "failure_severity",
        "repair_time_minutes", "maintenance_cost", "predicted_failure_probability", "sensor_anomaly_score",
        "energy_consumption_kwh", "compressed_air_usage", "cooling_water_usage", "power_peak_kw", "energy_cost",
    )
    # Column names do not tell upper case from lower case, keys do.
} | {"Installation_Year": "raw_title_installation_year"}


def filter_sources(bronze: DataFrame, systems: list[str] = S.SOURCE_SYSTEMS) -> DataFrame:
    return bronze.filter(F.col("source_system").isin(systems))


def staging(bronze: DataFrame, business_only: bool = False) -> DataFrame:
    """Every dimension key and attribute of an event, derived from its payload.

    Columns a consumer does not use are never computed. Every key is looked up once, before the
    steps that parse: its text goes on as a column (``TEXTS``), and a consumer that does not ask
    for ``payload`` itself does not carry it through them. Where several dimensions are built,
    store the result without ``payload`` and the texts (``narrow``): each of them reads its columns.
    """
    year = f"coalesce({P.int_sql(_key('Installation_Year'))}, {P.int_sql(_key('installation_year'))})"
    defect = (_key("defect_type"), _key("defect_category"), _key("defect_severity"))
    kind, category, severity = P.defect_parts_sql(*defect)
    texts = filter_sources(bronze).selectExpr(
        "bronze_event_id", "source_system", "source_file", "payload", *[f"{_raw(key)} AS {name}" for key, name in TEXTS.items()]
    )
    keyed = texts.selectExpr(
        "bronze_event_id",
        "source_system",
        "source_file",
        "payload",
        *TEXTS.values(),
        f"{P.business_sql('source_file')} AS is_biz",
        f"{P.timestamp_sql(_key('timestamp'))} AS ts",
        f"coalesce({_text('factory_id')}, {_text('plant_id')}) AS plant_id",
        f"{_text('production_line_id')} AS line_id",
        f"{_text('product_id')} AS product_id",
        f"{_text('machine_id')} AS machine_id",
        f"{P.defect_slug_sql(*defect)} AS defect_id",
        f"{kind} AS defect_type",
        f"{category} AS defect_category",
        f"{severity} AS defect_severity",
        f"{_text('factory_name')} AS plant_name",
        f"{_text('country')} AS country",
        f"{_text('production_line_name')} AS line_name",
        f"{_text('part_name')} AS product_name",
        f"{_text('product_family')} AS product_family",
        f"{_text('machine_type')} AS machine_type",
        f"{year} AS installation_year",
    )
    if business_only:
        keyed = keyed.filter("is_biz")
    return P.with_shift(keyed, _key("shift"), "ts").selectExpr("*", f"{P.date_key_sql('ts')} AS date_id")


def narrow(stg: DataFrame) -> DataFrame:
    """The staged columns without the payload and its texts: all that dimensions read."""
    return stg.drop("payload", *TEXTS.values())


def _key(key: str) -> str:
    return TEXTS[key]


def _text(key: str) -> str:
    return P.clean_sql(_key(key))


# ---------------------------------------------------------------- dimensions
def _one_per_key(stg: DataFrame, name: str, key: str, **attributes: str) -> DataFrame:
    """The largest non-null value of each attribute per key; a map-side combined aggregate."""
    return (
        stg.selectExpr(f"{key} AS {name}", *[f"{e} AS {n}" for n, e in attributes.items()])
        .filter(f"{name} IS NOT NULL")
        .groupBy(name)
        .agg(*[F.max(n).alias(n) for n in attributes])
    )


def dim_date(stg: DataFrame) -> DataFrame:
    days = stg.selectExpr("date_id", "to_date(ts) AS day")
    return _one_per_key(
        days, "date_id", "date_id",
        date="day", year="year(day)", month="month(day)", day="dayofmonth(day)", week="weekofyear(day)",
    )


def dim_plant(stg: DataFrame) -> DataFrame:
    return _one_per_key(stg, "plant_id", "plant_id", plant_name="plant_name", country="country")


def dim_line(stg: DataFrame) -> DataFrame:
    return _one_per_key(stg, "production_line_id", "line_id", plant_id="plant_id", line_name="line_name")


def dim_shift(stg: DataFrame) -> DataFrame:
    return _one_per_key(
        stg, "shift_id", "shift_id", shift_name="shift_name", start_hour="start_hour", end_hour="end_hour"
    )


def dim_product(stg: DataFrame) -> DataFrame:
    return _one_per_key(
        stg, "product_id", "product_id", product_name="product_name", product_family="product_family"
    )


def dim_machine(stg: DataFrame) -> DataFrame:
    return _one_per_key(
        stg, "machine_id", "machine_id",
        production_line_id="line_id", machine_type="machine_type", installation_year="installation_year",
    )


def dim_defect(stg: DataFrame) -> DataFrame:
    same = {c: c for c in ("defect_type", "defect_category", "defect_severity")}
    return _one_per_key(stg, "defect_id", "defect_id", **same)


DIMENSIONS = {
    "dim_date": dim_date, "dim_plant": dim_plant, "dim_line": dim_line, "dim_shift": dim_shift,
    "dim_product": dim_product, "dim_machine": dim_machine, "dim_defect": dim_defect,
}


#: Of every dimension: its key, and its attributes among the shared text, number and day columns.
_DIM_ROWS = {
    "dim_date": ("date_id", "date_id", {}, {}, "to_date(ts)"),
    "dim_plant": ("plant_id", "plant_id", {"plant_name": "plant_name", "country": "country"}, {}, None),
    "dim_line": ("production_line_id", "line_id", {"plant_id": "plant_id", "line_name": "line_name"}, {}, None),
    "dim_shift": ("shift_id", "shift_id", {c: c for c in ("shift_name", "start_hour", "end_hour")}, {}, None),
    "dim_product": ("product_id", "product_id", {"product_name": "product_name", "product_family": "product_family"}, {}, None),
    "dim_machine": (
        "machine_id", "machine_id", {"production_line_id": "line_id", "machine_type": "machine_type"},
        {"installation_year": "installation_year"}, None,
    ),
    "dim_defect": ("defect_id", "defect_id", {c: c for c in ("defect_type", "defect_category", "defect_severity")}, {}, None),
}


def dimension_rows(stg: DataFrame) -> DataFrame:
    """(dim, key, text attributes a, b, c, number, day) of all dimensions from one scan.

    Every event emits its row of each dimension. Equal rows are first joined by a hash
    aggregate, on the map side too, so that a shift or defect with a large share of the
    events moves as one row per task; only then is the largest value of each attribute taken.
    """
    rows = []
    for name, (_, key, texts, numbers, day) in _DIM_ROWS.items():
        a, b, c = [*texts.values(), *["CAST(NULL AS string)"] * (3 - len(texts))]
        number = next(iter(numbers.values()), "CAST(NULL AS int)")
        rows.append(
            f"named_struct('dim', '{name}', 'key', CAST({key} AS string), 'a', {a}, 'b', {b}, 'c', {c}, 'number', {number}, "
            f"'day', {day or 'CAST(NULL AS date)'})"
        )
    every = stg.selectExpr(f"inline(array({', '.join(rows)}))").filter("key IS NOT NULL").distinct()
    return every.groupBy("dim", "key").agg(*[F.max(c).alias(c) for c in ("a", "b", "c", "number", "day")])


def dimensions(stg: DataFrame) -> dict[str, DataFrame]:
    """All dimensions, from one stored pass over the staged events."""
    rows = materialise(dimension_rows(stg), "dimensions")
    out = {}
    for name, (key, source, texts, numbers, _) in _DIM_ROWS.items():
        attributes = [f"{c} AS {n}" for c, n in zip("abc", texts)] + [f"number AS {n}" for n in numbers]
        if name == "dim_date":
            attributes = ["day AS date", "year(day) AS year", "month(day) AS month", "dayofmonth(day) AS day", "weekofyear(day) AS week"]
        kind = stg.schema[source].dataType.simpleString()
        out[name] = rows.filter(F.col("dim") == name).selectExpr(f"CAST(key AS {kind}) AS {key}", *attributes)
    return out


# ---------------------------------------------------------------- facts
def _events(stg: DataFrame, system: str) -> DataFrame:
    return stg.filter(f"source_system = '{system}' AND is_biz")


def _num(key: str) -> str:
    """A measure: rounded to eight decimals, so that sums of the widest values have room."""
    return f"try_cast({P.number_sql(_key(key))} AS {S.MEASURE.simpleString()})"


def _numbers(*keys: str) -> list[str]:
    return [f"{_num(k)} AS {k}" for k in keys]


def oee_rates(df: DataFrame) -> DataFrame:
    """Availability, performance, quality and their product; each rate is rounded first."""
    shift, kind = S.SHIFT_MINUTES, S.NUM.simpleString()

    def ratio(part: str) -> str:
        return f"round(CAST({part} AS {kind}) / nullif(CAST(actual_production_qty AS {kind}), 0), 4)"

    four = "decimal(18,4)"
    rates = df.selectExpr(
        "*",
        f"CAST(round(greatest({shift} - downtime_minutes - setup_time_minutes, 0) / {shift}, 4) AS {four}) AS availability_rate",
        f"CAST(round(production_speed / 100, 4) AS {four}) AS performance_rate",
        f"CAST({ratio('good_qty')} AS {four}) AS quality_rate",
        f"CAST({ratio('scrap_qty')} AS {four}) AS scrap_rate",
    )
    product = (
        "CAST(availability_rate AS decimal(5,4)) * CAST(quality_rate AS decimal(15,4)) "
        "* CAST(performance_rate AS decimal(15,4))"
    )
    return rates.selectExpr("*", f"CAST(round({product}, 4) AS {four}) AS trs")


def fact_production(stg: DataFrame) -> DataFrame:
    quantities = ("planned_production_qty", "actual_production_qty", "good_qty", "scrap_qty")
    measures = _events(stg, "mes").selectExpr(
        "bronze_event_id", "date_id", "plant_id", "line_id AS production_line_id", "machine_id", "product_id", "shift_id",
        *[f"{P.int_sql(_key(c))} AS {c}" for c in quantities],
        *_numbers("cycle_time_sec", "target_cycle_time_sec", "production_speed"),
        *[f"coalesce({_num(c)}, CAST(0 AS {S.NUM.simpleString()})) AS {c}" for c in ("downtime_minutes", "setup_time_minutes")],
    )
    rates = ["availability_rate", "performance_rate", "quality_rate", "trs", "scrap_rate"]
    return oee_rates(measures).select(*measures.columns, *rates)


def fact_quality(stg: DataFrame) -> DataFrame:
    return _events(stg, "mes").selectExpr(
        "bronze_event_id", "date_id", "machine_id", "product_id", "defect_id",
        *_numbers("dimension_measurement", "tolerance_min", "tolerance_max"),
        *[f"{P.bool_sql(_key(c))} AS {c}" for c in ("is_conforming", "scrap_flag", "rework_required")],
        *_numbers("quality_score"),
    )


def fact_maintenance(stg: DataFrame) -> DataFrame:
    texts = ("maintenance_event_id", "maintenance_type", "failure_type", "failure_code", "failure_severity")
    return _events(stg, "gmao").selectExpr(
        "bronze_event_id", "date_id", "machine_id",
        *[f"{_text(c)} AS {c}" for c in texts],
        *_numbers(
            "repair_time_minutes", "downtime_minutes", "maintenance_cost",
            "predicted_failure_probability", "sensor_anomaly_score",
        ),
    )


def fact_energy(stg: DataFrame) -> DataFrame:
    """Energy measures; the per-piece value is filled in afterwards from production."""
    return _events(stg, "energie").selectExpr(
        "bronze_event_id", "date_id", "machine_id",
        *_numbers(
            "energy_consumption_kwh", "compressed_air_usage", "cooling_water_usage", "power_peak_kw", "energy_cost"
        ),
        f"CAST(NULL AS {S.NUM.simpleString()}) AS energy_per_good_piece",
    )


def alert_rows(events: DataFrame) -> DataFrame:
    """Alerts of sensor events: any active flag, or a failure probability of at least 0.7.

    The rule is a generator that yields one row or none. As a filter it would be pushed
    below the projection and work out the flags of every event again.
    """
    judged = events.select(
        "bronze_event_id", "date_id", "machine_id", P.active_flags("payload").alias("_flags"),
        F.expr(f"coalesce({P.number_sql(_raw('predicted_failure_probability'))}, 0) >= {S.HIGH_RISK} AS _high"),
    )
    alert = """array(named_struct('alert_type', 'sensor_health',
        'alert_severity', CASE WHEN _high THEN 'critical' ELSE 'warning' END,
        'alert_reason', coalesce(_flags, 'predicted_failure_probability_high'), 'is_active', true))"""
    return judged.selectExpr(
        "bronze_event_id", "date_id", "machine_id", f"inline(CASE WHEN _flags IS NOT NULL OR _high THEN {alert} END)"
    )


def fact_alerts(stg: DataFrame) -> DataFrame:
    return alert_rows(_events(stg, "scada_capteurs"))


FACTS = {
    "fact_production": fact_production, "fact_quality": fact_quality,
    "fact_maintenance": fact_maintenance, "fact_energy": fact_energy, "fact_alerts": fact_alerts,
}

DIM_RULES = {
    "dim_date": "insert", "dim_defect": "insert", "dim_shift": "overwrite",
    "dim_plant": "coalesce", "dim_line": "coalesce", "dim_product": "coalesce", "dim_machine": "coalesce",
}


def upsert_dimension(name: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """New keys are added; known keys keep, replace or complete their attributes."""
    key, *attributes = old.columns
    rule = DIM_RULES[name]
    return merge(
        old, new, [key], [] if rule == "insert" else attributes, keep_old_when_null=rule == "coalesce"
    )


def upsert_fact(name: str, old: DataFrame, new: DataFrame) -> DataFrame:
    return merge(old, new, ["bronze_event_id"], S.FACT_UPDATE_COLUMNS[name])


def build_gold(bronze: DataFrame, existing: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All dimensions and facts, upserted over ``existing`` tables when given.

    The dimensions come from one pass over ``bronze``, which should be a stored table; each
    fact reads the payloads of its own source.
    """
    existing = existing or {}
    stg = staging(bronze)
    gold = {}
    for name, new in dimensions(stg).items():
        gold[name] = upsert_dimension(name, existing[name], new) if name in existing else new
    for name, build in FACTS.items():
        new = build(stg)
        gold[name] = upsert_fact(name, existing[name], new) if name in existing else new
    gold["fact_energy"] = energy_per_good_piece(gold["fact_energy"], gold["fact_production"])
    return gold


def orphan_count(fact: DataFrame, dim: DataFrame, key: str) -> int:
    """Fact rows whose key has no dimension row; 0 on a consistent load."""
    return fact.filter(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti").count()
