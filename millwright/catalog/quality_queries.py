"""Audits, distributions and the full cleaning of one source."""

from __future__ import annotations

from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.catalog import oracle as Q
from millwright.catalog.registry import query
from millwright.catalog.scalar_queries import flag_sql, measures
from millwright.functions import health as H
from millwright.operators import quality as A
from millwright.plans.cleaning import clean_with_business_rules

# Raw and cleaned sides of three sources.
RAW = {
    "energie": "SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 2000 END AS energy_consumption_kwh, nullif(o_orderstatus, 'P') AS machine_id FROM orders",
    "scada": "SELECT event_id AS id, CASE WHEN k < 90 THEN value END AS cycle_time_sec, CASE WHEN k > 10 THEN user_id END AS machine_id FROM ev",
    "docs": "SELECT d.doc_id AS id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
}
CLEAN = {
    "energie_clean": "SELECT id, CASE WHEN energy_consumption_kwh <= 150 THEN energy_consumption_kwh ELSE 75.0 END AS energy_consumption_kwh, coalesce(machine_id, '?') AS machine_id FROM energie",
    "scada_clean": "SELECT id, greatest(20, least(120, cycle_time_sec)) AS cycle_time_sec, machine_id FROM scada",
    "docs_clean": "SELECT id, coalesce(quality, 0) AS quality, toxic FROM docs",
}
SIDES = {**RAW, **CLEAN}


def pairs(t):
    orders, k = t.read("orders"), F.col("k")
    energy = orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") / 2000).alias("energy_consumption_kwh"),
        F.nullif("o_orderstatus", F.lit("P")).alias("machine_id"),
    )
    scada = t.events().select(
        F.col("event_id").alias("id"), F.when(k < 90, F.col("value")).alias("cycle_time_sec"), F.when(k > 10, F.col("user_id")).alias("machine_id")
    )
    docs = t.read("documents").select(F.col("doc_id").alias("id")).join(t.read("labels").withColumnRenamed("doc_id", "id"), "id", "left")
    kwh, cycle = F.col("energy_consumption_kwh"), F.col("cycle_time_sec")
    return {
        "energie": (
            energy,
            energy.withColumns({"energy_consumption_kwh": F.when(kwh <= 150, kwh).otherwise(75.0), "machine_id": F.coalesce("machine_id", F.lit("?"))}),
        ),
        "scada": (scada, scada.withColumn("cycle_time_sec", F.when(cycle.isNotNull(), F.greatest(F.lit(20.0), F.least(F.lit(120.0), cycle))))),
        "docs": (docs, docs.withColumn("quality", F.coalesce("quality", F.lit(0)))),
    }


CLEAN["scada_clean"] = SIDES["scada_clean"] = "SELECT id, CASE WHEN cycle_time_sec IS NOT NULL THEN greatest(20.0, least(120.0, cycle_time_sec)) END AS cycle_time_sec, machine_id FROM scada"
COLUMNS = {"energie": ["id", "energy_consumption_kwh", "machine_id"], "scada": ["id", "cycle_time_sec", "machine_id"], "docs": ["id", "quality", "toxic"]}


def missing_sql(name, columns):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) AS missing_pct FROM {name}"
        for c in columns
    )


ALL_MISSING = " UNION ALL ".join(missing_sql(n, c) for n, c in COLUMNS.items())


@query("missing_by_column", Q.sql(missing_sql("scada", COLUMNS["scada"]), **RAW))
def _missing(t):
    return A.missing_by_column(pairs(t)["scada"][0], "scada")


@query("union_missing", Q.sql(ALL_MISSING, **RAW))
def _union(t):
    return A.union_missing({n: raw for n, (raw, _) in pairs(t).items()})


@query("top_missing", Q.sql("SELECT * FROM missing WHERE missing_count > 0 ORDER BY dataset, missing_count DESC, column_name LIMIT 20", missing=ALL_MISSING, **RAW))
def _top(t):
    return A.top_missing(A.union_missing({n: raw for n, (raw, _) in pairs(t).items()}))


def cells(name):
    return " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in COLUMNS[name])


SUMMARY = " UNION ALL ".join(
    f"""SELECT '{n}' AS source, r.n AS raw_rows, r.m AS raw_missing, r.n * {len(c)} AS raw_cells, k.n AS clean_rows, k.m AS clean_missing, k.n * {len(c)} AS clean_cells,
    CAST(r.m AS DOUBLE) / (r.n * {len(c)}) AS raw_missing_pct, CAST(k.m AS DOUBLE) / (k.n * {len(c)}) AS clean_missing_pct
    FROM (SELECT count(*) AS n, {cells(n)} AS m FROM {n}) r, (SELECT count(*) AS n, {cells(n)} AS m FROM {n}_clean) k"""
    for n, c in COLUMNS.items()
)


@query("completeness_summary", Q.sql(SUMMARY, **SIDES))
def _summary(t):
    return A.completeness_summary(pairs(t))


TOTALS = """SELECT CAST(sum(raw_missing) AS BIGINT) AS raw_missing, CAST(sum(clean_missing) AS BIGINT) AS clean_missing,
  CAST(sum(raw_missing) AS DOUBLE) / sum(raw_cells) AS raw_missing_pct, CAST(sum(clean_missing) AS DOUBLE) / sum(clean_cells) AS clean_missing_pct,
  CAST(sum(raw_missing) - sum(clean_missing) AS DOUBLE) / sum(raw_missing) AS improvement_rate FROM summary"""


@query("completeness_totals", Q.sql(TOTALS, summary=SUMMARY, **SIDES))
def _totals(t):
    return A.completeness_totals(A.completeness_summary(pairs(t)))


RULES = {
    "Énergie hors seuil": ("energie", "energy_consumption_kwh", 0, 150, True),
    "Cycle hors seuil": ("scada", "cycle_time_sec", 20, 120, True),
}
ANOMALIES = " UNION ALL ".join(
    f"""SELECT '{label}' AS anomaly_type, '{c}' AS column_name, (SELECT count(*) FROM {d} WHERE {c} < {lo} OR {c} > {hi}) AS raw_anomalies,
    (SELECT count(*) FROM {d}_clean WHERE {c} < {lo} OR {c} > {hi}) AS clean_anomalies"""
    for label, (d, c, lo, hi, _) in RULES.items()
)


@query("anomaly_counts", Q.sql(ANOMALIES, **SIDES))
def _anomalies(t):
    p = pairs(t)
    return A.anomaly_counts({n: r for n, (r, _) in p.items()}, {n: c for n, (_, c) in p.items()}, RULES)


@query("anomaly_out_of_range", Q.sql("SELECT id, coalesce(cycle_time_sec < 20 OR cycle_time_sec > 120, FALSE) AS odd, coalesce(machine_id <= 0 OR machine_id > 100, FALSE) AS odd_open FROM scada", **RAW))
def _odd(t):
    return pairs(t)["scada"][0].select(
        "id", A.out_of_range(F.col("cycle_time_sec"), 20, 120).alias("odd"), A.out_of_range(F.col("machine_id"), 0, 100, False).alias("odd_open")
    )


SCORES = f"""SELECT completeness, coherence, 8.0::DOUBLE AS traceability, reliability,
  greatest(0.0::DOUBLE, least(10.0::DOUBLE, {Q.half_even('(completeness + coherence + 8.0::DOUBLE + reliability) / 4 - 1')})) AS ai_readiness FROM (
  SELECT *, {Q.half_even('(completeness + coherence) / 2')} AS reliability FROM (
  SELECT greatest(0.0::DOUBLE, least(10.0::DOUBLE, {Q.half_even('(1.0::DOUBLE - clean_missing_pct) * 10')})) AS completeness,
    CASE WHEN c = 0 THEN 10.0::DOUBLE ELSE greatest(0.0::DOUBLE, {Q.half_even('10.0::DOUBLE - CAST(c AS DOUBLE) / greatest(r, 1) * 10')}) END AS coherence
  FROM totals, (SELECT sum(raw_anomalies) AS r, sum(clean_anomalies) AS c FROM anomalies)))"""


@query("maturity_score", Q.sql(SCORES, totals=TOTALS, summary=SUMMARY, anomalies=ANOMALIES, **SIDES))
def _maturity(t):
    p = pairs(t)
    anomalies = A.anomaly_counts({n: r for n, (r, _) in p.items()}, {n: c for n, (_, c) in p.items()}, RULES)
    return A.maturity_score(A.completeness_totals(A.completeness_summary(p)), anomalies)


@query("normalise_for_audit", Q.sql("SELECT event_id, CASE WHEN m NOT IN ('', ' ', 'None', 'none', 'NULL', 'null', 'nan', 'NaN') THEN m END AS status, CASE WHEN k > 20 THEN CAST(k AS DOUBLE) END AS cycle_time_sec FROM (SELECT event_id, k, CASE WHEN k < 10 THEN 'NaN' WHEN k < 20 THEN ' ' ELSE event_type END AS m FROM ev)"))
def _normalise(t):
    k = F.col("k")
    df = t.events().select(
        "event_id", F.when(k < 10, "NaN").when(k < 20, " ").otherwise(F.col("event_type")).alias("status"),
        F.when(k > 20, k.cast("string")).otherwise("NULL").alias("cycle_time_sec"),
    )
    return A.normalise_for_audit(df, ["cycle_time_sec"])


@query(
    "production_kpis",
    Q.sql(
        f"""SELECT CAST(sum(p.actual_production_qty) AS BIGINT) AS actual_total, CAST(sum(p.good_qty) AS BIGINT) AS good_total, CAST(sum(p.scrap_qty) AS BIGINT) AS scrap_total,
        CAST(sum(p.scrap_qty) AS DOUBLE) / CAST(sum(p.actual_production_qty) AS DOUBLE) AS scrap_rate, {Q.mean('q.quality_score')} AS quality_mean
        FROM fact_production p JOIN fact_quality q ON p.bronze_event_id = q.bronze_event_id"""
    ),
)
def _production(t):
    return A.production_kpis(t.production().join(t.quality().select("bronze_event_id", "quality_score"), "bronze_event_id"))


@query(
    "production_by_machine",
    Q.sql(
        """SELECT CASE WHEN plant_id <> 'PL0' THEN machine_id END AS machine_id, CAST(sum(actual_production_qty) AS BIGINT) AS actual,
        CAST(sum(good_qty) AS BIGINT) AS good, CAST(sum(scrap_qty) AS BIGINT) AS scrap FROM fact_production GROUP BY 1"""
    ),
)
def _by_machine(t):
    machine = F.when(F.col("plant_id") != "PL0", F.col("machine_id"))
    return A.production_by_machine(t.production().withColumn("machine_id", machine))


def histogram_sql(source, column, bins):
    return f"""SELECT CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins} - 1) AS INTEGER) AS bin, count(*) AS n
    FROM (SELECT {column} AS v FROM {source}), (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) WHERE v IS NOT NULL GROUP BY 1"""


@query("histogram", histogram_sql("orders", "o_totalprice", 20))
def _histogram(t):
    return A.histogram(t.read("orders"), "o_totalprice", 20)


@query("histogram_cycle", histogram_sql("events", "value", 25))
def _histogram_cycle(t):
    return A.histogram(t.read("events"), "value", 25)


@query("class_distribution", "SELECT quality, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM labels) AS share FROM labels GROUP BY quality")
def _classes(t):
    return A.class_distribution(t.read("labels"), "quality")


FLAGS = list(S.FLAG_SETS["experiment"])


@query(
    "flag_prevalence",
    Q.sql(" UNION ALL ".join(f"SELECT '{f}' AS flag, CAST(sum({f}) AS DOUBLE) / count(*) AS prevalence FROM flagged" for f in FLAGS),
          flagged=f"SELECT {flag_sql('experiment')} FROM ev"),
)
def _prevalence(t):
    return A.flag_prevalence(measures(t).select(*[c.alias(n) for n, c in H.degradation_flags("experiment").items()]), FLAGS)


# ------------------------------------------------------------------ cleaning
UP, DOWN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


def _windows(group):
    part = f"PARTITION BY {', '.join(group)} " if group else ""
    return f"WINDOW a AS ({part}ORDER BY event_id {UP}), b AS ({part}ORDER BY event_id {DOWN})"


def _known(group, value):
    return f"CASE WHEN {' AND '.join(f'{g} IS NOT NULL' for g in group)} THEN {value} END" if group else value


def carried_sql(source, columns, group=()):
    """The last value before, else the first after; rows without a group lose theirs."""
    told = [f"{_known(group, f'coalesce(last_value({c} IGNORE NULLS) OVER a, first_value({c} IGNORE NULLS) OVER b)')} AS {c}" for c in columns]
    return f"SELECT * REPLACE ({', '.join(told)}) FROM {source} {_windows(group)}"


def between_sql(source, columns, group=()):
    """On the line between the neighbours by row position, else the nearest value."""
    part = f"PARTITION BY {', '.join(group)} " if group else ""
    told = []
    for c in columns:
        p0, p1 = (f"{f}_value(CASE WHEN {c} IS NOT NULL THEN pos_ END IGNORE NULLS) OVER {w}" for f, w in (("last", "a"), ("first", "b")))
        v0, v1 = f"last_value({c} IGNORE NULLS) OVER a", f"first_value({c} IGNORE NULLS) OVER b"
        line = f"({v1} - {v0}) / CAST({p1} - {p0} AS DOUBLE) * CAST(pos_ - {p0} AS DOUBLE) + {v0}"
        value = f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {p0} IS NOT NULL AND {p1} IS NOT NULL THEN {line} ELSE coalesce({v0}, {v1}) END"
        told.append(f"{_known(group, value)} AS {c}")
    placed = f"SELECT *, row_number() OVER ({part}ORDER BY event_id) AS pos_ FROM {source}"
    return f"SELECT * EXCLUDE (pos_) REPLACE ({', '.join(told)}) FROM ({placed}) {_windows(group)}"


def _gap(low, value):
    return f"CASE WHEN NOT (k >= {low} AND k < {low + 5}) THEN {value} END"


def _inside(low, high, value, above=">="):
    return f"CASE WHEN {value} {above} {low} AND {value} <= {high} THEN {value} END"


NUMBERS = ["actual_production_qty", "good_qty", "scrap_qty", "cycle_time_sec", "production_speed", "dimension_measurement", "tolerance_min",
           "tolerance_max", "quality_score", "Temperature_C", "repair_time_minutes", "Failure_Within_7_Days"]
WORDS = ["timestamp", "machine_id", "work_order_id", "batch_id", "product_id", "machine_status", "shift", "defect_type", "defect_category",
         "defect_severity", "scrap_flag", "rework_required", "failure_type"]
QUOTED = {c: f'"{c}"' for c in (*NUMBERS, *WORDS)}
RAW_CLEANING = f"""SELECT event_id, CAST(epoch_us({_gap(0, "date_trunc('second', ts)")}) AS DOUBLE) AS "timestamp",
  {_gap(5, "'M' || user_id")} AS machine_id, {_gap(10, "'WO' || user_id")} AS work_order_id, {_gap(15, "'B' || user_id")} AS batch_id,
  {_gap(20, "'P' || user_id")} AS product_id, {_inside(0, 2500, f"CAST({_gap(25, 'floor(value) + 100')} AS DOUBLE)", '>')} AS actual_production_qty,
  {_inside(0, 2500, f"CAST({_gap(30, 'floor(value) + 90')} AS DOUBLE)")} AS good_qty, {_inside(0, 500, f"CAST({_gap(35, 'k')} AS DOUBLE)")} AS scrap_qty,
  {_inside(20, 120, f"CAST({_gap(40, 'k')} AS DOUBLE)")} AS cycle_time_sec, {_gap(45, 'value / 10')} AS production_speed, {_gap(50, 'event_type')} AS machine_status,
  '?' AS shift, {_inside(8, 12, _gap(55, 'value / 20'))} AS dimension_measurement, CAST({_gap(60, '9.5')} AS DOUBLE) AS tolerance_min,
  CAST({_gap(65, '10.5')} AS DOUBLE) AS tolerance_max, {_gap(70, "CASE WHEN k < 85 THEN 'rayure' ELSE 'fissure' END")} AS defect_type,
  {_gap(72, "'visuel'")} AS defect_category, {_gap(74, "CASE WHEN k < 80 THEN 'major' ELSE 'minor' END")} AS defect_severity, NULL::BOOLEAN AS scrap_flag,
  {_gap(76, 'TRUE')} AS rework_required, {_gap(80, 'value / 5')} AS quality_score, {_inside(0, 100, _gap(85, 'value'))} AS "Temperature_C",
  {_inside(0, 500, _gap(90, 'value / 2'))} AS repair_time_minutes, {_gap(92, 'event_type')} AS failure_type,
  CAST({_gap(95, 'CAST(k > 90 AS INTEGER)')} AS DOUBLE) AS "Failure_Within_7_Days" FROM ev"""
MIDDLE = """SELECT failure_type AS ft, (l[(n + 1) // 2] + l[n // 2 + 1]) / 2 AS middle FROM (
  SELECT failure_type, list(repair_time_minutes ORDER BY repair_time_minutes) AS l, count(*) AS n FROM c1 WHERE failure_type IS NOT NULL AND repair_time_minutes IS NOT NULL GROUP BY 1)"""
CLEANING = {
    "c0": RAW_CLEANING, "c1": between_sql("c0", ['"timestamp"']), "middles": MIDDLE,
    "c2": "SELECT c1.* REPLACE (CASE WHEN failure_type IS NOT NULL THEN coalesce(repair_time_minutes, middle) END AS repair_time_minutes) FROM c1 LEFT JOIN middles ON failure_type = ft",
    "c3": carried_sql("c2", ["machine_id", "machine_status", "tolerance_min", "tolerance_max", "defect_severity", '"Failure_Within_7_Days"', "failure_type"]),
    "c4": carried_sql("c3", ["product_id"], ["work_order_id"]), "c5": carried_sql("c4", ["product_id"], ["batch_id"]),
    "c6": carried_sql("c5", ["batch_id"], ["machine_id", "work_order_id"]), "c7": carried_sql("c6", ["product_id", "batch_id"]),
    "c8": carried_sql("c7", ["work_order_id"], ["batch_id"]), "c9": carried_sql("c8", ["work_order_id"]),
    "d0": between_sql("c9", ["cycle_time_sec", '"Temperature_C"'], ["machine_id"]),
    "d1": between_sql("d0", ["actual_production_qty", "good_qty", "dimension_measurement", "repair_time_minutes"]),
    "d2": "SELECT *, coalesce(good_qty, actual_production_qty - scrap_qty) AS g_ FROM d1",
    "d3": "SELECT *, coalesce(scrap_qty, actual_production_qty - g_) AS s_ FROM d2",
    "d4": "SELECT * REPLACE (CASE WHEN s_ < 0 THEN 0::DOUBLE ELSE s_ END AS s_) FROM d3",
    "d5": """SELECT * EXCLUDE (g_, s_) REPLACE (CASE WHEN g_ > actual_production_qty THEN actual_production_qty - s_ ELSE g_ END AS good_qty, coalesce(s_, 0::DOUBLE) AS scrap_qty,
      coalesce(production_speed, actual_production_qty / nullif(cycle_time_sec, 0)) AS production_speed, make_timestamp(CAST(floor("timestamp") AS BIGINT)) AS "timestamp") FROM d4""",
    "d6": """SELECT * REPLACE (coalesce(CASE WHEN hour("timestamp") BETWEEN 6 AND 13 THEN 'matin' WHEN hour("timestamp") BETWEEN 14 AND 21 THEN 'apres_midi'
      WHEN "timestamp" IS NOT NULL THEN 'nuit' END, shift) AS shift), coalesce(dimension_measurement BETWEEN tolerance_min AND tolerance_max, FALSE) AS ok_ FROM d5""",
    "d7": "SELECT * REPLACE (CASE WHEN ok_ THEN 'no_defect' ELSE defect_type END AS defect_type) FROM d6", "d8": carried_sql("d7", ["defect_type"]),
    "d9": """SELECT * REPLACE (coalesce(defect_category, CASE defect_type WHEN 'rayure' THEN 'esthetique' WHEN 'fissure' THEN 'fonctionnel' WHEN 'deformation' THEN 'dimensionnel'
      WHEN 'no_defect' THEN 'none' END) AS defect_category) FROM d8""",
    "e0": carried_sql("d9", ["defect_category"]),
    "e1": """SELECT * EXCLUDE (ok_) REPLACE (NOT ok_ AS scrap_flag, coalesce(rework_required, coalesce(defect_severity IN ('major', 'critical'), FALSE)) AS rework_required,
      coalesce(quality_score, CASE WHEN ok_ THEN 95.0::DOUBLE ELSE 70.0::DOUBLE END) AS quality_score) FROM e0""",
    "e2": between_sql("e1", [QUOTED[c] for c in NUMBERS]), "e3": carried_sql("e2", [QUOTED[c] for c in WORDS]),
}
CLEANED = """SELECT * REPLACE (strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS "timestamp", CAST(coalesce("Failure_Within_7_Days", 0) AS INTEGER) AS "Failure_Within_7_Days") FROM e3"""


@query("clean_with_business_rules", Q.sql(CLEANED, **CLEANING))
def _clean(t):
    """A raw production source with gaps, markers and outliers, fully cleaned."""
    k = F.col("k")

    def gap(low, value, marker="nan"):
        return F.when((k >= low) & (k < low + 5), marker).otherwise(value.cast("string"))

    raw = t.events().select(
        "event_id",
        gap(0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "bad").alias("timestamp"),
        gap(5, F.concat(F.lit("M"), F.col("user_id"))).alias("machine_id"),
        gap(10, F.concat(F.lit("WO"), F.col("user_id"))).alias("work_order_id"),
        gap(15, F.concat(F.lit("B"), F.col("user_id")), "None").alias("batch_id"),
        gap(20, F.concat(F.lit("P"), F.col("user_id"))).alias("product_id"),
        gap(25, F.floor("value") + 100).alias("actual_production_qty"),
        gap(30, F.floor("value") + 90, "").alias("good_qty"),
        gap(35, k).alias("scrap_qty"),
        gap(40, k).alias("cycle_time_sec"),
        gap(45, F.col("value") / 10, "NULL").alias("production_speed"),
        gap(50, F.col("event_type")).alias("machine_status"),
        F.lit("?").alias("shift"),
        gap(55, F.col("value") / 20).alias("dimension_measurement"),
        gap(60, F.lit(9.5)).alias("tolerance_min"),
        gap(65, F.lit(10.5)).alias("tolerance_max"),
        gap(70, F.when(k < 85, "rayure").otherwise("fissure")).alias("defect_type"),
        gap(72, F.lit("visuel"), "null").alias("defect_category"),
        gap(74, F.when(k < 80, "major").otherwise("minor")).alias("defect_severity"),
        F.lit(None).cast("boolean").alias("scrap_flag"),
        gap(76, F.lit("true"), "None").alias("rework_required"),
        gap(80, F.col("value") / 5).alias("quality_score"),
        gap(85, F.col("value")).alias("Temperature_C"),
        gap(90, F.col("value") / 2).alias("repair_time_minutes"),
        gap(92, F.col("event_type")).alias("failure_type"),
        gap(95, (k > 90).cast("int")).alias("Failure_Within_7_Days"),
    )
    return clean_with_business_rules(raw, "event_id")


@query(
    "clean_sensor_source",
    Q.sql(
        """SELECT event_id, machine AS machine_id, i_t AS "Temperature_C" FROM (
        SELECT *, CASE WHEN t IS NOT NULL THEN t WHEN p0 IS NOT NULL AND p1 IS NOT NULL THEN (v1 - v0) / CAST(p1 - p0 AS DOUBLE) * CAST(pos - p0 AS DOUBLE) + v0 ELSE coalesce(v0, v1) END AS i_t FROM (
        SELECT *, last_value(CASE WHEN t IS NOT NULL THEN pos END IGNORE NULLS) OVER a AS p0, last_value(t IGNORE NULLS) OVER a AS v0,
          first_value(CASE WHEN t IS NOT NULL THEN pos END IGNORE NULLS) OVER b AS p1, first_value(t IGNORE NULLS) OVER b AS v1 FROM (
        SELECT *, row_number() OVER (PARTITION BY machine ORDER BY event_id) AS pos FROM carried)
        WINDOW a AS (PARTITION BY machine ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               b AS (PARTITION BY machine ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))""",
        carried="""SELECT event_id, t, coalesce(last_value(m IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          first_value(m IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS machine
          FROM (SELECT event_id, CASE WHEN k > 5 THEN event_type END AS m, CASE WHEN value BETWEEN 0 AND 100 THEN value END AS t FROM ev)""",
    ),
)
def _clean_sensor(t):
    """Machine ids carried forward, implausible temperatures interpolated per machine."""
    raw = t.events().select(
        "event_id", F.when(F.col("k") > 5, F.col("event_type")).otherwise("nan").alias("machine_id"),
        F.col("value").cast("string").alias("Temperature_C"),
    )
    return clean_with_business_rules(raw, "event_id")
