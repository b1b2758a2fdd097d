"""Sources and sinks: each query writes derived rows, reads them back and reports them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.catalog import oracle as Q
from millwright.catalog.registry import query
from millwright.session import scratch_path
from millwright.sources import csv_folder, gold, kafka, lake, sinks


def customer_csv(t) -> str:
    """The customers as two CSV sources, in key order."""
    folder = scratch_path(t.spark, "csv")
    rows = t.read("customer").select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    # A quoted line break, a quote and a comma inside a record.
    rows = rows.withColumn("segment", F.when(F.col("segment") == "MACHINERY", "MACHI\nNERY, \"heavy\"").otherwise(F.col("segment")))
    rows.orderBy("c_custkey").write.option("header", True).option("escape", '"').csv(f"{folder}/customer_sale.csv")
    wide = t.read("supplier").select("s_suppkey", "s_name", "s_nationkey").orderBy("s_suppkey")
    wide.write.option("header", True).csv(f"{folder}/supplier_business.csv")
    return folder


@query(
    "ingest_csv_dir",
    """SELECT 'customer_sale.csv' AS source_file, 'customer' AS source_system, row_number() OVER (ORDER BY c_custkey) AS row_number,
         'kafka_to_datalake_raw' AS ingestion_mode, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN 'MACHI' || chr(10) || 'NERY, "heavy"' ELSE coalesce(c_mktsegment, '') END AS extra FROM customer
       UNION ALL SELECT 'supplier_business.csv', 'supplier', row_number() OVER (ORDER BY s_suppkey), 'kafka_to_datalake_raw',
         CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier""",
)
def _ingest(t):
    p = F.col("payload")
    return csv_folder.ingest_csv_dir(t.spark, [customer_csv(t)]).select(
        "source_file", "source_system", "row_number", "ingestion_mode",
        F.coalesce(p["c_custkey"], p["s_suppkey"]).alias("id"), F.coalesce(p["c_name"], p["s_name"]).alias("name"),
        F.coalesce(p["segment"], p["s_nationkey"]).alias("extra"),
    )


@query(
    "load_csv_folder",
    """SELECT 'customer_sale' AS dataset, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns FROM customer
       UNION ALL SELECT 'supplier_business', count(*), 3 FROM supplier""",
)
def _folder(t):
    return csv_folder.folder_profile(csv_folder.load_csv_folder(t.spark, customer_csv(t)))


def envelopes(t):
    """Event envelopes of the events table."""
    raw = t.raw_events()
    return raw.select(
        "source_file", "source_system", F.col("bronze_event_id").alias("row_number"),
        F.lit("test").alias("ingestion_mode"), F.from_json("payload_json", "map<string,string>").alias("payload"),
    )


@query("stamp_ingest_time", "SELECT event_id AS row_number, TRUE AS stamped FROM events")
def _stamp(t):
    stamped = F.col("datalake_ingested_at").try_cast("timestamp").isNotNull()
    return lake.stamp_ingest_time(envelopes(t)).select("row_number", stamped.alias("stamped"))


@query("kafka_sink", Q.sql("SELECT source_system AS key, source_file, bronze_event_id AS row_number, 'test' AS ingestion_mode, machine_txt AS machine, Rul AS rul FROM scada_raw"))
def _sink(t):
    """Topic records: their key and the fields of their JSON value."""
    field = lambda path: F.get_json_object("value", f"$.{path}")
    return kafka.encode(envelopes(t)).select(
        "key", field("source_file").alias("source_file"), field("row_number").cast("long").alias("row_number"), field("ingestion_mode").alias("ingestion_mode"),
        field("payload.machine_id").alias("machine"), field("payload.Remaining_Useful_Life_days").alias("rul"),
    )


@query(
    "stream_kafka_source",
    Q.sql("SELECT bronze_event_id AS row_number, source_file, source_system, timestamp_txt AS stamp, Sound_dB AS sound FROM scada_raw"),
)
def _decode(t):
    """Topic records decoded; the transport itself needs a broker."""
    events = kafka.decode(kafka.encode(envelopes(t)))
    p = F.col("payload")
    return events.select("row_number", "source_file", "source_system", p["timestamp"].alias("stamp"), p["Sound_dB"].alias("sound"))


def write_lake(t) -> str:
    folder = scratch_path(t.spark, "lake")
    stamped = envelopes(t).withColumn("datalake_ingested_at", F.lit("2024-02-01T00:00:00+00:00"))
    lines = stamped.select(F.to_json(F.struct(*stamped.columns)).alias("value"))
    lines.write.text(f"{folder}/industrial_raw.jsonl")
    return folder


@query(
    "read_datalake_jsonl",
    Q.sql(
        """SELECT source_file, source_system, count(*) AS n, count(DISTINCT bronze_event_id) AS n_hashes,
        CAST(sum(CASE WHEN Power_Consumption_kW IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_complete FROM scada_raw GROUP BY 1, 2"""
    ),
)
def _lake(t):
    full = F.map_contains_key("payload", "Power_Consumption_kW").cast("long")
    return lake.read_lake(t.spark, write_lake(t), "*.jsonl").groupBy("source_file", "source_system").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("payload_hash").alias("n_hashes"), F.sum(full).alias("n_complete")
    )


def hashed(t):
    from millwright.functions.parse import payload_hash

    # As the column of a generator the hash is made once; a filter on it would make it again.
    raw = t.raw_events()
    return raw.select("*", F.explode(F.array(payload_hash(F.col("payload_json")))).alias("payload_hash"))


@query("bronze_insert_new", Q.sql("SELECT event_id AS bronze_event_id FROM ev WHERE event_type <> 'click'"))
def _insert(t):
    """The clicks are loaded already; every other event arrives twice."""
    rows = hashed(t)
    loaded = rows.join(t.read("events").filter("event_type = 'click'").select("event_id"), F.col("bronze_event_id") == F.col("event_id"), "left_semi")
    return lake.new_bronze_rows(loaded, rows.unionByName(rows)).select("bronze_event_id")


@query("bronze_append_count", Q.sql("SELECT count(*) AS inserted, count(*) AS stored FROM ev WHERE event_type <> 'click'"))
def _append(t):
    rows = hashed(t)
    loaded = rows.join(t.read("events").filter("event_type = 'click'").select("event_id"), F.col("bronze_event_id") == F.col("event_id"), "left_semi")
    path = scratch_path(t.spark, "bronze")
    inserted = lake.append_bronze(lake.new_bronze_rows(loaded, rows), path, "load1")
    return t.spark.read.parquet(path).agg(F.lit(inserted).cast("long").alias("inserted"), F.count(F.lit(1)).alias("stored"))


EXTRACT_SQL = ", ".join(
    {
        "event_ts": f"{Q.ts_text('event_ts')} AS event_ts", "machine_id": "machine_id", "quality_status": "quality_status",
        "error_codes_last_30_days": "error_codes_last_30_days", "ai_override_events": "ai_override_events",
        "failure_within_7_days": "failure_within_7_days",
    }.get(c, f"{Q.dbl('s_' + c)} AS {c}")
    for c in S.EXTRACT_COLUMNS
)


@query("ml_extract", Q.sql(f"SELECT {EXTRACT_SQL} FROM silver"))
def _extract(t):
    return sinks.ml_extract(t.silver())


@query(
    "load_ml_dataset",
    Q.sql(f"SELECT {Q.ts_text('event_ts')} AS event_ts, machine_id, {Q.dbl('s_temperature_c')} AS temperature_c, failure_within_7_days FROM silver"),
)
def _load(t):
    """The extract written as CSV and read back typed, in time order."""
    path = scratch_path(t.spark, "extract")
    extract = t.silver().select(*S.EXTRACT_COLUMNS)
    extract.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    df = csv_folder.load_learning_table(t.spark, path, extract.schema)
    return df.select("event_ts", "machine_id", "temperature_c", "failure_within_7_days")


@query(
    "write_business_tables",
    "SELECT 'factories' AS table_name, count(*) AS n_rows FROM region UNION ALL SELECT 'production_lines', count(*) FROM nation "
    "UNION ALL SELECT 'parts', count(*) FROM part UNION ALL SELECT 'machine_mapping', count(*) FROM supplier "
    "UNION ALL SELECT 'energie_business', count(*) FROM orders",
)
def _write_tables(t):
    folder = scratch_path(t.spark, "business")
    tables = {
        "factories": t.read("region"), "production_lines": t.read("nation"), "parts": t.read("part"),
        "machine_mapping": t.read("supplier"), "energie_business": t.read("orders"),
    }
    sinks.write_tables(tables, folder, {"energie_business": "o_orderstatus"})
    return gold.table_counts({n: t.spark.read.parquet(f"{folder}/{n}") for n in tables})


@query(
    "prediction_log_append",
    Q.sql(
        """SELECT machine_id, 'state' AS action, 'clf' AS model_name, '3' AS model_version, state, count(*) AS n FROM predictions GROUP BY ALL
        UNION ALL SELECT machine_id, 'rul', 'reg', '1', NULL, count(*) FROM predictions GROUP BY machine_id"""
    ),
)
def _log(t):
    path = scratch_path(t.spark, "log")
    scored = t.predictions()
    sinks.append_prediction_log(sinks.prediction_log(scored, "state", "clf", "3", "champion", ["machine_id"], ["state", "risk_score"]), path)
    sinks.append_prediction_log(sinks.prediction_log(scored, "rul", "reg", "1", None, ["machine_id"], ["rul_days"]), path)
    log = t.spark.read.parquet(path).withColumn("state", F.get_json_object("output", "$.state"))
    return log.groupBy("machine_id", "action", "model_name", F.col("model_version").cast("string"), "state").agg(F.count(F.lit(1)).alias("n"))


CUT = """SELECT 'threshold_{c}' AS model, sum(CASE WHEN hit AND yes THEN 1 ELSE 0 END)::DOUBLE AS tp, sum(CASE WHEN hit AND NOT yes THEN 1 ELSE 0 END)::DOUBLE AS fp,
  sum(CASE WHEN yes AND NOT hit THEN 1 ELSE 0 END)::DOUBLE AS fn, sum(CASE WHEN hit = yes THEN 1 ELSE 0 END)::DOUBLE AS ok, count(*) AS n
  FROM (SELECT k / 100.0::DOUBLE >= {c} AS hit, event_type = 'error' AS yes FROM ev)"""
COMPARED = f"""SELECT model, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
  round(ok / n, 9) AS accuracy, 'f1' AS selection_metric FROM ({CUT.format(c=0.25)} UNION ALL {CUT.format(c=0.75)})"""


@query("write_model_comparison", Q.sql(COMPARED))
def _comparison(t):
    """Metrics of two thresholds, written as CSV with metadata and read back."""
    from millwright.operators.curves import threshold_metrics

    df = t.events().select((F.col("event_type") == "error").cast("int").alias("label"), (F.col("k") / 100).alias("score"))
    rows = [threshold_metrics(df, "label", "score", c).select(F.lit(f"threshold_{c}").alias("model"), "*") for c in (0.25, 0.75)]
    path = scratch_path(t.spark, "comparison")
    sinks.write_model_comparison(rows[0].unionByName(rows[1]).orderBy(F.desc("f1")), path, selection_metric="f1")
    back = t.spark.read.option("header", True).option("inferSchema", True).csv(f"{path}/metrics")
    noted = t.spark.read.schema("metadata map<string,string>").json(f"{path}/metadata").select(F.col("metadata")["selection_metric"]).scalar()
    measured = [F.round(c, 9).alias(c) for c in ("f1", "precision", "recall", "accuracy")]
    return back.select("model", *measured, noted.alias("selection_metric"))


# ------------------------------------------------------------------ gold tables
@query("list_fact_alerts", Q.sql("SELECT bronze_event_id, date_id, machine_id, alert_type, alert_severity, alert_reason, is_active FROM fact_alerts"))
def _list(t):
    path = scratch_path(t.spark, "gold")
    sinks.write_tables({"fact_alerts": t.alerts()}, path)
    return t.spark.read.parquet(f"{path}/fact_alerts")


@query(
    "list_dim_machine",
    """SELECT 'S' || s_suppkey AS machine_id, 'LN' || s_nationkey AS production_line_id, s_name AS machine_type,
       CASE WHEN s_acctbal > 0 THEN 2016 END AS installation_year FROM supplier""",
)
def _list_dim(t):
    from millwright.plans import medallion as M

    return M.dim_machine(M.staging(t.bronze_reference()))


@query(
    "fact_filter",
    Q.sql(
        """SELECT 'production' AS fact, count(*) AS n_rows FROM fact_production WHERE plant_id = 'PL1' AND production_line_id IS NOT NULL
        UNION ALL SELECT 'quality', count(*) FROM fact_quality WHERE defect_id = 'rayure_none_major'
        UNION ALL SELECT 'maintenance', count(*) FROM fact_maintenance WHERE machine_id = 'S5'
        UNION ALL SELECT 'energy', count(*) FROM fact_energy_base WHERE date_id = 19970528
        UNION ALL SELECT 'alerts', count(*) FROM fact_alerts WHERE is_active AND alert_severity = 'critical'"""
    ),
)
def _fact_filter(t):
    return gold.table_counts(
        {
            "production": gold.filter_table("fact_production", t.production(), plant_id="PL1", machine_id=None),
            "quality": gold.filter_table("fact_quality", t.quality(), defect_id="rayure_none_major"),
            "maintenance": gold.filter_table("fact_maintenance", t.maintenance(), machine_id="S5"),
            "energy": gold.filter_table("fact_energy", t.energy(), date_id=19970528),
            "alerts": gold.filter_table("fact_alerts", t.alerts(), is_active=True, alert_severity="critical"),
        }
    ).withColumnRenamed("table_name", "fact")


@query(
    "dim_filter",
    """SELECT 'line' AS dim, 'LN' || n_nationkey AS key FROM nation WHERE n_regionkey = 1
       UNION ALL SELECT 'machine', 'S' || s_suppkey FROM supplier WHERE s_nationkey = 3
       UNION ALL SELECT DISTINCT 'date', strftime(o_orderdate, '%Y%m%d') FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5""",
)
def _dim_filter(t):
    from millwright.plans import medallion as M

    ref = M.staging(t.bronze_reference())
    days = M.dim_date(M.staging(t.bronze_energy().unionByName(t.bronze_maintenance())))
    found = {
        "line": gold.filter_table("dim_line", M.dim_line(ref), plant_id="PL1").select("production_line_id"),
        "machine": gold.filter_table("dim_machine", M.dim_machine(ref), production_line_id="LN3").select("machine_id"),
        "date": gold.filter_table("dim_date", days, year=1997, month=5).select(F.col("date_id").cast("string")),
    }
    out = None
    for name, df in found.items():
        one = df.toDF("key").select(F.lit(name).alias("dim"), "key")
        out = one if out is None else out.unionByName(one)
    return out


@query("dim_lookup", "SELECT 'P' || p_partkey AS product_id, p_name AS product_name, p_type AS product_family FROM part WHERE p_partkey = 42")
def _lookup(t):
    from millwright.plans import medallion as M

    return gold.lookup("dim_product", M.dim_product(M.staging(t.bronze_reference())), "P42")


@query("active_alerts", Q.sql("SELECT bronze_event_id, alert_severity FROM fact_alerts WHERE is_active"))
def _active(t):
    return gold.active_alerts(t.alerts()).select("bronze_event_id", "alert_severity")


@query(
    "table_counts",
    Q.sql(
        """SELECT 'bronze' AS table_name, count(*) AS n_rows FROM scada_raw UNION ALL SELECT 'silver', count(*) FROM silver
        UNION ALL SELECT 'fact_production', count(*) FROM fact_production UNION ALL SELECT 'fact_quality', count(*) FROM fact_quality
        UNION ALL SELECT 'fact_maintenance', count(*) FROM fact_maintenance UNION ALL SELECT 'fact_energy', count(*) FROM fact_energy_base
        UNION ALL SELECT 'fact_alerts', count(*) FROM fact_alerts"""
    ),
)
def _counts(t):
    return gold.table_counts(
        {
            "bronze": t.bronze_events(), "silver": t.silver(), "fact_production": t.production(), "fact_quality": t.quality(),
            "fact_maintenance": t.maintenance(), "fact_energy": t.energy(), "fact_alerts": t.alerts(),
        }
    )
