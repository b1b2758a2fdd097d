"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.catalog import oracle as Q
from millwright.catalog.registry import query
from millwright.functions import health as H
from millwright.functions import parse as P
from millwright.functions import rules as R
from millwright.functions import status as D
from millwright.operators import quality as A

# ------------------------------------------------------------------ parsing
# One messy text column per event: padding, words, exponents, blanks and plain numbers.
MESSY = """CASE WHEN k < 10 THEN ' ' || k || ' ' WHEN k < 20 THEN k || 'e1' WHEN k < 30 THEN ''
  WHEN k < 40 THEN '.' || k WHEN k < 50 THEN '-' || k || '.50' WHEN k < 60 THEN 'n/a'
  WHEN k < 70 THEN '+' || k WHEN k < 80 THEN k || '.5' WHEN k = 80 THEN '0.6999996' WHEN k = 81 THEN '100.0000004'
  WHEN k = 82 THEN '2.4999999' WHEN k = 83 THEN '1234567890123.5' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END"""


def messy():
    k = F.col("k")
    return (
        F.when(k < 10, F.concat(F.lit(" "), k, F.lit(" ")))
        .when(k < 20, F.concat(k, F.lit("e1")))
        .when(k < 30, "")
        .when(k < 40, F.concat(F.lit("."), k))
        .when(k < 50, F.concat(F.lit("-"), k, F.lit(".50")))
        .when(k < 60, "n/a")
        .when(k < 70, F.concat(F.lit("+"), k))
        .when(k < 80, F.concat(k, F.lit(".5")))
        .when(k == 80, "0.6999996").when(k == 81, "100.0000004").when(k == 82, "2.4999999").when(k == 83, "1234567890123.5")
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    )


def over_messy(name, expr, sql):
    @query(name, Q.sql(f"SELECT event_id, {sql.format(m='m')} AS result FROM (SELECT event_id, k, {MESSY} AS m FROM ev)"))
    def run(t):
        return t.events().withColumn("m", messy()).select("event_id", expr("m").alias("result"))


over_messy("clean_text", P.clean_text, Q.txt("{m}"))
over_messy("parse_number", P.parse_number, Q.dbl(Q.num("m")))
over_messy("parse_number_strict", lambda c: P.parse_number(c, trim=False), Q.dbl(Q.num("m", trim=False)))
over_messy("parse_int", P.parse_int, Q.integer("m"))
over_messy(
    "coerce_numeric", lambda c: P.coerce_number(F.col(c)),
    "CASE WHEN regexp_full_match(trim(m), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(trim(m) AS DOUBLE) END",
)

WORDS = """CASE WHEN k < 10 THEN ' Oui ' WHEN k < 20 THEN 'TRUE' WHEN k < 30 THEN '0' WHEN k < 40 THEN ''
  WHEN k < 50 THEN 'y' WHEN k < 60 THEN 'non' WHEN k < 70 THEN '1' ELSE event_type END"""


def words():
    k = F.col("k")
    return (
        F.when(k < 10, " Oui ").when(k < 20, "TRUE").when(k < 30, "0").when(k < 40, "").when(k < 50, "y")
        .when(k < 60, "non").when(k < 70, "1").otherwise(F.col("event_type"))
    )


@query("parse_bool", Q.sql(f"SELECT event_id, {Q.boolean('w')} AS result FROM (SELECT event_id, {WORDS} AS w FROM ev)"))
def _parse_bool(t):
    return t.events().withColumn("w", words()).select("event_id", P.parse_bool("w").alias("result"))


STAMP = """CASE WHEN k < 10 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' WHEN k < 20 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
  WHEN k < 30 THEN 'bad' WHEN k < 40 THEN '' WHEN k < 50 THEN strftime(ts, '%Y-%m-%d') WHEN k < 60 THEN strftime(ts, '%d/%m/%Y')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""


def stamp():
    k, iso = F.col("k"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return (
        F.when(k < 10, F.concat(iso, F.lit("Z"))).when(k < 20, F.concat(iso, F.lit("+02:00"))).when(k < 30, "bad")
        .when(k < 40, "").when(k < 50, F.date_format("ts", "yyyy-MM-dd")).when(k < 60, F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )


PARSED = "CASE WHEN regexp_matches(s, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN CAST(regexp_replace(replace(s, 'T', ' '), '(Z|[+]02:00)$', '') AS TIMESTAMP) END"


@query("parse_timestamp", Q.sql(f"SELECT event_id, {Q.ts_text(PARSED)} AS result FROM (SELECT event_id, {STAMP} AS s FROM ev)"))
def _parse_timestamp(t):
    return t.events().withColumn("s", stamp()).select("event_id", P.parse_timestamp("s").alias("result"))


@query(
    "date_key",
    f"SELECT o_orderkey, {Q.date_id('o_orderdate')} AS date_id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def _date_key(t):
    return t.read("orders").select(
        "o_orderkey", P.date_key("o_orderdate").alias("date_id"), F.to_date("o_orderdate").alias("day")
    )


SHIFT = "CASE WHEN k < 15 THEN 'Matin' WHEN k < 30 THEN 'après-midi' WHEN k < 45 THEN ' NIGHT ' WHEN k < 60 THEN 'week end' WHEN k < 75 THEN '' END"
NAME = "CASE sid WHEN 'SHIFT_MATIN' THEN 'matin' WHEN 'SHIFT_APRES_MIDI' THEN 'apres-midi' WHEN 'SHIFT_NUIT' THEN 'nuit' ELSE lower(trim(s)) END"


@query(
    "shift_bucket",
    Q.sql(
        f"""SELECT event_id, sid AS shift_id, {NAME} AS shift_name,
        CASE sid WHEN 'SHIFT_MATIN' THEN '06:00' WHEN 'SHIFT_APRES_MIDI' THEN '14:00' WHEN 'SHIFT_NUIT' THEN '22:00' ELSE '00:00' END AS start_hour,
        CASE sid WHEN 'SHIFT_MATIN' THEN '14:00' WHEN 'SHIFT_APRES_MIDI' THEN '22:00' WHEN 'SHIFT_NUIT' THEN '06:00' ELSE '23:59' END AS end_hour
        FROM (SELECT event_id, s, {Q.shift_id('s', 'x')} AS sid
              FROM (SELECT event_id, {SHIFT} AS s, CASE WHEN k < 95 THEN ts END AS x FROM ev))"""
    ),
)
def _shift_bucket(t):
    k = F.col("k")
    text = F.when(k < 15, "Matin").when(k < 30, "après-midi").when(k < 45, " NIGHT ").when(k < 60, "week end").when(k < 75, "")
    events = t.events().select("event_id", text.alias("s"), F.when(k < 95, F.col("ts")).alias("at"))
    out = P.with_shift(events, "s", "at")
    return out.select("event_id", "shift_id", "shift_name", "start_hour", "end_hour")


@query(
    "shift_from_hour",
    """SELECT event_id, CASE WHEN hour(ts) >= 6 AND hour(ts) < 14 THEN 'matin'
       WHEN hour(ts) >= 14 AND hour(ts) < 22 THEN 'apres_midi' ELSE 'nuit' END AS shift FROM events""",
)
def _shift_from_hour(t):
    return t.read("events").select("event_id", P.shift_from_hour("ts").alias("shift"))


@query("defect_slug", f"SELECT p_partkey, {Q.DEFECT.format(a='p_name', b='nullif(p_brand, chr(66))', c='p_type')} AS defect_id FROM part")
def _defect_slug(t):
    return t.read("part").select(
        "p_partkey", P.defect_slug("p_name", "nullif(p_brand, 'B')", "p_type").alias("defect_id")
    )


@query(
    "safe_rate",
    Q.sql(f"SELECT event_id, {Q.half_up('event_id', 'nullif(k - 10, 0)', 4)} AS rate FROM ev"),
)
def _safe_rate(t):
    return t.events().select("event_id", P.safe_rate("event_id", "k - 10").alias("rate"))


@query(
    "plausible_range",
    Q.sql(f"SELECT event_id, {Q.clip('value', 0, 100)} AS temperature, {Q.clip('k', 40, 80)} AS level FROM ev"),
)
def _plausible_range(t):
    return t.events().select(
        "event_id", R.within("value", 0, 100).alias("temperature"), R.within("k", 40, 80).alias("level")
    )


@query(
    "json_field",
    Q.sql(
        f"""SELECT bronze_event_id, {Q.dbl(Q.num('Temperature_C'))} AS temperature, Coolant_Level_pct AS coolant,
        {Q.dbl(Q.num('Power_Consumption_kW'))} AS power, timestamp_txt AS stamp FROM scada_raw"""
    ),
)
def _json_field(t):
    p = F.col("payload")
    return t.bronze_events().select(
        "bronze_event_id", P.parse_number("payload['Temperature_C']").alias("temperature"),
        p["Coolant_Level_pct"].alias("coolant"), P.parse_number("payload['Power_Consumption_kW']").alias("power"),
        p["timestamp"].alias("stamp"),
    )


@query("json_has_keys", Q.sql("SELECT bronze_event_id, Power_Consumption_kW IS NOT NULL AS complete FROM scada_raw"))
def _json_has_keys(t):
    keys = P.json_has_keys("payload", S.SENSOR_KEYS_REQUIRED)
    return t.bronze_events().select("bronze_event_id", keys.alias("complete"))


@query(
    "payload_hash",
    Q.sql(
        """SELECT event_id, sha256('{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":{"k":' || k ||
        '},"stamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","user_id":' || user_id || '}') AS payload_hash FROM ev"""
    ),
)
def _payload_hash(t):
    line = F.to_json(
        F.struct(
            "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"), F.struct("k").alias("props"),
            "event_type", "event_id",
        )
    )
    return t.events().select("event_id", P.payload_hash(line).alias("payload_hash"))


FILES = "event_type || CASE WHEN k < 30 THEN '_sale.csv' WHEN k < 60 THEN '_propre.csv' WHEN k < 90 THEN '_business.csv' ELSE '.csv' END"


@query(
    "source_system_from_file",
    Q.sql(f"SELECT event_id, replace(replace(replace(replace({FILES}, '.csv', ''), '_sale', ''), '_propre', ''), '_business', '') AS source_system FROM ev"),
)
def _source_system(t):
    k = F.col("k")
    suffix = F.when(k < 30, "_sale.csv").when(k < 60, "_propre.csv").when(k < 90, "_business.csv").otherwise(".csv")
    return t.events().select("event_id", P.source_system_of(F.concat("event_type", suffix)).alias("source_system"))


# ------------------------------------------------------------------ status and labels
def over_events(name, sql, build):
    """``build`` makes the columns when the query runs: ``given`` inputs and results by name."""
    columns = ", ".join(f"{v} AS {n}" for n, v in sql.items())

    @query(name, Q.sql(f"SELECT event_id, {columns} FROM ev"))
    def run(t):
        exprs = build()
        given = exprs.pop("given", None)
        inputs = t.events().withColumns(given) if given else t.events()
        return inputs.select("event_id", *[e.alias(n) for n, e in exprs.items()])


PCT = "CASE WHEN k < 90 THEN CAST(value AS DOUBLE) / 4 END"
def pct():
    return F.when(F.col("k") < 90, F.col("value") / 4)


over_events("status_trs", {"status": Q.status_trs(f"({PCT})")}, lambda: dict(given={"p": pct()}, status=D.status_trs("p")))
over_events("status_reach", {"status": Q.status_reach(f"({PCT})")}, lambda: dict(given={"p": pct()}, status=D.status_reach("p")))
over_events("status_scrap", {"status": Q.status_scrap(f"({PCT})")}, lambda: dict(given={"p": pct()}, status=D.status_scrap("p")))
over_events("status_rul", {"status": Q.status_rul(f"({PCT})")}, lambda: dict(given={"p": pct()}, status=D.status_rul("p")))
over_events(
    "status_risk",
    {"status": f"CASE WHEN ({PCT}) >= 75 THEN 'crit' WHEN ({PCT}) >= 50 THEN 'warn' ELSE 'good' END"},
    lambda: dict(given={"p": pct()}, status=D.status_risk("p")),
)
SEV = "CASE WHEN k < 20 THEN 'CRITICAL' WHEN k < 40 THEN 'High' WHEN k < 60 THEN 'warning' WHEN k < 80 THEN event_type END"
def sev():
    return F.when(F.col("k") < 20, "CRITICAL").when(F.col("k") < 40, "High").when(F.col("k") < 60, "warning").when(F.col("k") < 80, F.col("event_type"))


over_events("severity_map", {"severity": Q.severity(f"({SEV})")}, lambda: dict(given={"s": sev()}, severity=D.severity_label("s")))
over_events(
    "risk_score",
    {"score": Q.risk("CASE WHEN k < 95 THEN k / 100.0::DOUBLE END", "(CASE WHEN k > 20 THEN value END)")},
    lambda: dict(given={"p": F.when(F.col("k") < 95, F.col("k") / 100.0), "r": F.when(F.col("k") > 20, F.col("value"))},
    score=D.risk_score("p", "r")),
)
over_events(
    "null_round",
    {"one": Q.half_even("value / 7"), "two": Q.half_even("value", 2), "quarter": Q.half_even("(CASE WHEN k > 5 THEN k / 4.0::DOUBLE END)")},
    lambda: dict(given={"quarters": F.when(F.col("k") > 5, F.col("k") / 4.0)},
    one=D.half_even("value / 7"), two=D.half_even("value", 2), quarter=D.half_even("quarters")),
)
DID = "(CASE WHEN k < 90 THEN CAST(strftime(ts, '%Y%m%d') AS INTEGER) WHEN k < 95 THEN 123 END)"
def did():
    return F.when(F.col("k") < 90, P.date_key("ts")).when(F.col("k") < 95, 123)


over_events(
    "fmt_date", {"day": Q.day_label(DID), "full_date": Q.date_label(DID)},
    lambda: dict(given={"d": did()}, day=D.day_label("d"), full_date=D.date_label("d")),
)
KIND = "(CASE WHEN k < 50 THEN 'sensor_HEALTH_' || event_type WHEN k < 75 THEN '' END)"
over_events(
    "alert_title", {"title": Q.title(KIND)},
    lambda: dict(given={"t": F.when(F.col("k") < 50, F.concat(F.lit("sensor_HEALTH_"), "event_type")).when(F.col("k") < 75, "")},
    title=D.alert_title("t")),
)
over_events("state_threshold", {"state": "CASE WHEN k / 100.0 >= 0.5 THEN 'at_risk' ELSE 'normal' END"}, lambda: dict(state=D.state_of("k / 100")))
over_events(
    "rul_clamp", {"rul": "CASE WHEN k < 90 THEN greatest(CAST(value - 50 AS DOUBLE), 0.0::DOUBLE) END"},
    lambda: dict(given={"r": F.when(F.col("k") < 90, F.col("value") - 50)}, rul=D.clamp_rul("r")),
)


@query(
    "mean_tone",
    Q.sql(
        """SELECT user_id, CASE WHEN r >= 0.5 THEN 'crit' WHEN r >= 0.25 THEN 'warn' ELSE 'good' END AS risk_tone,
        CASE WHEN v < 90 THEN 'warn' ELSE 'good' END AS rul_tone, CASE WHEN n > 100 THEN 'crit' ELSE 'warn' END AS alert_tone
        FROM (SELECT user_id, CAST(sum(k) AS DOUBLE) / count(*) / 100 AS r,
              CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS v, count(*) AS n FROM ev GROUP BY user_id)"""
    ),
)
def _mean_tone(t):
    g = t.events().groupBy("user_id").agg(
        (F.sum("k").cast("double") / F.count(F.lit(1)) / 100).alias("r"),
        (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("v"),
        F.count(F.lit(1)).alias("n"),
    )
    return g.select(
        "user_id",
        D.mean_risk_tone("r").alias("risk_tone"),
        D.mean_rul_tone("v").alias("rul_tone"),
        D.alert_count_tone("n").alias("alert_tone"),
    )


# ------------------------------------------------------------------ cleaning rules
MARK = "CASE WHEN k < 20 THEN 'None' WHEN k < 40 THEN 'nan' WHEN k < 50 THEN ' ' ELSE event_type END"


@query(
    "missing_markers",
    Q.sql(
        f"""SELECT event_id, CASE WHEN m NOT IN ('None','none','NULL','null','nan','') THEN m END AS cleaned,
        CASE WHEN m NOT IN ('None','none','NULL','null','nan','',' ','NaN') THEN m END AS audited
        FROM (SELECT event_id, {MARK} AS m FROM ev)"""
    ),
)
def _missing_markers(t):
    k = F.col("k")
    m = F.when(k < 20, "None").when(k < 40, "nan").when(k < 50, " ").otherwise(F.col("event_type"))
    return t.events().select(
        "event_id", P.missing_to_null(m).alias("cleaned"), P.missing_to_null(m, S.AUDIT_MISSING_MARKERS).alias("audited")
    )


MEASURE_SQL = {
    "Temperature_C": "CAST(value AS DECIMAL(18,2))", "Vibration_mms": "CAST(k AS DECIMAL(10,2)) * 0.08", "Sound_dB": "k + 20",
    "Oil_Level_pct": "k", "Coolant_Level_pct": "100 - k", "Hydraulic_Pressure_bar": "50 + k * 2", "Coolant_Flow_L_min": "k",
    "Heat_Index": "k + 20", "Power_Consumption_kW": "k", "Error_Codes_Last_30_Days": "k // 10",
    "sensor_anomaly_score": "CAST(k AS DECIMAL(10,2)) * 0.01", "Operational_Hours": "CASE WHEN k > 5 THEN k * 25 END",
    "stress": "CAST(k AS DECIMAL(10,2)) * 0.02",
}


def measures(t):
    k = F.col("k")
    dec = k.cast("decimal(10,2)")
    return t.events().select(
        "event_id", "user_id", "ts", "k", F.col("value").cast("decimal(18,2)").alias("Temperature_C"),
        (dec * F.lit("0.08").cast("decimal(2,2)")).alias("Vibration_mms"), (k + 20).alias("Sound_dB"),
        k.alias("Oil_Level_pct"), (100 - k).alias("Coolant_Level_pct"), (k * 2 + 50).alias("Hydraulic_Pressure_bar"),
        k.alias("Coolant_Flow_L_min"), (k + 20).alias("Heat_Index"), k.alias("Power_Consumption_kW"),
        F.floor(k / 10).cast("int").alias("Error_Codes_Last_30_Days"),
        (dec * F.lit("0.01").cast("decimal(2,2)")).alias("sensor_anomaly_score"),
        F.when(k > 5, k * 25).alias("Operational_Hours"), (dec * F.lit("0.02").cast("decimal(2,2)")).alias("stress"),
    )


def flag_sql(flag_set):
    return ", ".join(
        f"CASE WHEN ({MEASURE_SQL[m]}) {op} {v} THEN 1 ELSE 0 END AS {n}" for n, (m, op, v) in S.FLAG_SETS[flag_set].items()
    )


for _set in S.FLAG_SETS:
    _name = "degradation_flags" if _set == "clean" else f"degradation_flags_{_set}"

    @query(_name, Q.sql(f"SELECT event_id, {flag_sql(_set)} FROM ev"))
    def _flags(t, _set=_set):
        flags = H.degradation_flags(_set)
        return measures(t).select("event_id", *[c.alias(n) for n, c in flags.items()])


def scored(t, flag_set="clean"):
    flagged = measures(t).withColumns(H.degradation_flags(flag_set))
    score, share = H.degradation_score(flag_set)
    return flagged.withColumns({"degradation_score": score, "degradation_rate_pct": share})


def score_ctes(flag_set="clean"):
    names = list(S.FLAG_SETS[flag_set])
    tenths = " + ".join(f"{n} * {round(float(S.FLAG_WEIGHTS[n]) * 10)}" for n in names)
    top = sum(round(float(S.FLAG_WEIGHTS[n]) * 10) for n in names)
    return {
        "flagged": f"SELECT event_id, user_id, ts, k, {MEASURE_SQL['Operational_Hours']} AS hours, {flag_sql(flag_set)} FROM ev",
        "scored": f"""SELECT *, CAST({tenths} AS DOUBLE) / 10 AS degradation_score,
            {Q.half_up(f'(({tenths}) * 100)', str(top), 1)} AS degradation_rate_pct FROM flagged""",
    }


@query("degradation_score", Q.sql("SELECT event_id, degradation_score, degradation_rate_pct FROM scored", **score_ctes()))
def _score(t):
    return scored(t).select("event_id", "degradation_score", "degradation_rate_pct")


@query(
    "failure_labels",
    Q.sql(
        """SELECT event_id, CASE WHEN 365 - k * 4 <= 7 OR (k * 0.01 >= 0.72 AND degradation_rate_pct >= 65) THEN 1 ELSE 0 END AS fail7,
        CASE WHEN 365 - k * 4 <= 45 OR (k * 0.01 >= 0.55 AND degradation_rate_pct >= 45) THEN 1 ELSE 0 END AS maint45 FROM scored""",
        **score_ctes(),
    ),
)
def _labels(t):
    rul, p, d = 365 - F.col("k") * 4, F.col("sensor_anomaly_score"), F.col("degradation_rate_pct")
    return scored(t).select(
        "event_id", H.failure_within_7(rul, p, d).alias("fail7"), H.maintenance_within_45(rul, p, d).alias("maint45")
    )


@query(
    "engineered_rul",
    Q.sql(
        """SELECT event_id, CASE WHEN hours IS NOT NULL THEN round(CASE WHEN k >= 93 THEN least(45.0::DOUBLE, r) ELSE r END, 1) END AS engineered_rul_days
        FROM (SELECT event_id, k, hours, greatest(1.0::DOUBLE, least(365.0::DOUBLE, 365.0::DOUBLE - degradation_rate_pct / 100 * 330
          - (CAST(hours AS DOUBLE) - lo) / (hi - lo) * 35)) AS r
          FROM scored, (SELECT CAST(min(hours) AS DOUBLE) AS lo, CAST(max(hours) AS DOUBLE) AS hi FROM scored))""",
        **score_ctes("experiment"),
    ),
)
def _engineered(t):
    df = scored(t, "experiment").withColumn("failing", (F.col("k") >= 93).cast("int"))
    return H.with_engineered_rul(df, failing="failing").select("event_id", "engineered_rul_days")


BANDS = "CASE WHEN {r} > {lo} AND {r} <= 7 THEN 'urgent' WHEN {r} > 7 AND {r} <= 30 THEN 'high' WHEN {r} > 30 AND {r} <= 90 THEN 'medium' WHEN {r} > 90 AND {r} <= 365 THEN 'low' END"
over_events(
    "maintenance_priority",
    {"priority": BANDS.format(r="(k * 4 - 4)", lo=-1), "experiment": BANDS.format(r="(k * 4 - 4)", lo=0)},
    lambda: dict(priority=H.maintenance_priority(F.col("k") * 4 - 4), experiment=H.maintenance_priority(F.col("k") * 4 - 4, 0)),
)
over_events(
    "maintenance_date",
    {
        "due": Q.ts_text("ts + to_days(CAST(ceil(value) AS INTEGER))"),
        "degradation_pct": Q.half_up("greatest(0, least(36500, 36500 - CAST(round(value * 100) AS BIGINT))) * 100", "36500", 1),
    },
    lambda: dict(due=H.maintenance_due(F.col("ts"), F.col("value")), degradation_pct=H.degradation_from_rul(F.col("value"))),
)

CONF = "coalesce(l_quantity BETWEEN 10 AND 40, FALSE)"


def measured(t):
    qty, line = F.col("l_quantity"), F.col("l_linenumber")
    return t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(line < 7, qty).alias("dimension_measurement"),
        F.lit(10.0).alias("tolerance_min"), F.lit(40.0).alias("tolerance_max"),
        F.when(F.col("l_returnflag") == "R", "fissure").when(F.col("l_returnflag") == "A", "rayure").alias("defect_type"),
        F.when(F.col("l_linestatus") == "O", "visuel").alias("defect_category"),
        F.when(F.col("l_returnflag") != "N", F.when(line < 3, "major").otherwise("minor")).alias("defect_severity"),
        F.when(F.col("l_discount") > 0.05, F.lit(88.0)).alias("quality_score"),
        F.when(line < 2, F.lit(True)).alias("rework_required"),
        F.when(line < 4, F.lit(True)).alias("vision_defect_detected"),
        F.when(line < 5, F.lit(False)).alias("operator_validation"),
    )


MEASURED = {
    "measured": """SELECT l_orderkey, l_linenumber, l_partkey, coalesce(CASE WHEN l_linenumber < 7 THEN l_quantity END BETWEEN 10 AND 40, FALSE) AS ok,
    CASE l_returnflag WHEN 'R' THEN 'fissure' WHEN 'A' THEN 'rayure' END AS defect_type,
    CASE WHEN l_linestatus = 'O' THEN 'visuel' END AS defect_category,
    CASE WHEN l_returnflag <> 'N' THEN CASE WHEN l_linenumber < 3 THEN 'major' ELSE 'minor' END END AS defect_severity,
    CASE WHEN l_discount > 0.05 THEN 88.0::DOUBLE END AS quality_score, CASE WHEN l_linenumber < 2 THEN TRUE END AS rework
    FROM lineitem"""
}
KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


@query(
    "conformity",
    Q.sql(f"SELECT {', '.join(KEYS)}, ok AS is_conforming, NOT ok AS scrap_flag, CASE WHEN ok THEN 'no_defect' ELSE defect_type END AS defect_type FROM measured", **MEASURED),
)
def _conformity(t):
    return R.conformity(measured(t)).select(*KEYS, "is_conforming", "scrap_flag", "defect_type")


@query(
    "defect_category_map",
    Q.sql(
        f"""SELECT {', '.join(KEYS)}, coalesce(defect_category, CASE CASE WHEN ok THEN 'no_defect' ELSE defect_type END
        WHEN 'rayure' THEN 'esthetique' WHEN 'fissure' THEN 'fonctionnel' WHEN 'deformation' THEN 'dimensionnel' WHEN 'no_defect' THEN 'none' END) AS category
        FROM measured""",
        **MEASURED,
    ),
)
def _category(t):
    df = R.conformity(measured(t))
    return df.select(*KEYS, R.defect_category(F.col("defect_category"), F.col("defect_type")).alias("category"))


@query(
    "quality_defaults",
    Q.sql(
        f"""SELECT {', '.join(KEYS)}, coalesce(quality_score, CASE WHEN ok THEN 95.0::DOUBLE ELSE 70.0::DOUBLE END) AS quality_score,
        coalesce(rework, coalesce(defect_severity IN ('major','critical'), FALSE)) AS rework_required,
        l_linenumber < 4 AS vision_defect_detected, FALSE AS operator_validation FROM measured""",
        **MEASURED,
    ),
)
def _defaults(t):
    df = R.quality_defaults(R.conformity(measured(t)))
    return df.select(*KEYS, "quality_score", "rework_required", "vision_defect_detected", "operator_validation")


@query(
    "qty_identity",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN g > a THEN a - s ELSE g END AS good_qty, coalesce(s, 0.0::DOUBLE) AS scrap_qty
    FROM (SELECT *, CASE WHEN s0 < 0 THEN 0.0::DOUBLE ELSE s0 END AS s FROM (
      SELECT *, coalesce(x, a - g) AS s0 FROM (SELECT *, coalesce(y, a - x) AS g FROM (
        SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber < 7 THEN l_quantity END AS a,
          CASE WHEN l_returnflag <> 'N' THEN CAST(l_partkey % 60 AS DOUBLE) END AS y,
          CASE WHEN l_linestatus = 'O' THEN CAST(l_suppkey - 20 AS DOUBLE) END AS x FROM lineitem))))""",
)
def _identity(t):
    df = t.read("lineitem").select(
        *KEYS, F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("actual_production_qty"),
        F.when(F.col("l_returnflag") != "N", (F.col("l_partkey") % 60).cast("double")).alias("good_qty"),
        F.when(F.col("l_linestatus") == "O", (F.col("l_suppkey") - 20).cast("double")).alias("scrap_qty"),
    )
    return R.quantity_identity(df).select(*KEYS, "good_qty", "scrap_qty")


over_events(
    "speed_fallback", {"speed": "coalesce(CASE WHEN k > 50 THEN value END, value / nullif(CAST(k AS DOUBLE), 0))"},
    lambda: dict(speed=R.speed_fallback(F.when(F.col("k") > 50, F.col("value")), F.col("value"), F.col("k"))),
)


@query("value_remap", "SELECT n_nationkey, CASE n_name WHEN 'NATION_2' THEN 'NATION_1' ELSE n_name END AS n_name, o.n AS orders FROM nation JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) o ON n_nationkey = c_nationkey")
def _remap(t):
    from millwright.operators.enrich import remap_values

    per = t.read("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("orders"))
    named = t.read("nation").join(per, F.col("n_nationkey") == F.col("c_nationkey"))
    return remap_values(named, "n_name", {"NATION_2": "NATION_1"}).select("n_nationkey", "n_name", "orders")


@query(
    "sensor_feature_defaults",
    Q.sql(
        f"""SELECT bronze_event_id, coalesce({Q.dbl('s_temperature_c')}, 0.0::DOUBLE) AS temperature_c,
        coalesce({Q.dbl('s_coolant_level_pct')}, 0.0::DOUBLE) AS coolant_level_pct, error_codes_last_30_days,
        quality_status, {Q.ts_text("coalesce(event_ts, TIMESTAMP '2026-01-01 00:00:00')")} AS event_ts FROM silver"""
    ),
)
def _reading_defaults(t):
    df = H.reading_defaults(t.silver())
    return df.select("bronze_event_id", "temperature_c", "coolant_level_pct", "error_codes_last_30_days", "quality_status", "event_ts")


@query(
    "timestamp_repair",
    """SELECT event_id, strftime(CASE WHEN (SELECT median(year(c)) FROM (SELECT ts - INTERVAL 50 YEAR AS c, value FROM events)) < 2000
       THEN coalesce(CASE WHEN value > 20 THEN ts END, ts - INTERVAL 50 YEAR) ELSE ts - INTERVAL 50 YEAR END, '%Y-%m-%d %H:%M:%S.%f') AS stamp FROM events""",
)
def _repair(t):
    df = t.read("events").select(
        "event_id", (F.col("ts") - F.expr("interval 50 year")).alias("stamp"), F.when(F.col("value") > 20, F.col("ts")).alias("raw")
    )
    return A.repair_timestamps(df, "stamp", "raw").select("event_id", "stamp")


@query(
    "model_label",
    Q.sql(
        """SELECT coalesce((SELECT CASE WHEN v <> '' THEN 'model-' || event_type || ' v' || v ELSE 'model-' || event_type END
        FROM (SELECT event_id, event_type, CASE WHEN k < 50 THEN CAST(k AS VARCHAR) ELSE '' END AS v FROM ev WHERE k > 60)
        ORDER BY event_id LIMIT 1), '—') AS model"""
    ),
)
def _model_label(t):
    from millwright.operators.analytics import first_model_label

    named = t.events().select(
        "event_id", F.when(F.col("k") > 60, F.concat(F.lit("model-"), "event_type")).alias("model_name"),
        F.when(F.col("k") < 50, F.col("k").cast("string")).otherwise("").alias("model_version"),
    )
    return first_model_label(named, "event_id")


@query("fill_unknown", "SELECT d.doc_id, coalesce(CASE quality WHEN 1 THEN 'kept' WHEN 0 THEN 'dropped' END, 'unknown') AS verdict FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _fill_unknown(t):
    df = t.read("documents").select("doc_id").join(t.read("labels"), "doc_id", "left")
    verdict = F.when(F.col("quality") == 1, "kept").when(F.col("quality") == 0, "dropped")
    return R.fill_unknown(df.select("doc_id", verdict.alias("verdict")), ["verdict"])
