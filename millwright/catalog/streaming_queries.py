"""Streaming jobs replayed over the tables as file streams and run until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from millwright.catalog import oracle as Q
from millwright.catalog.bind import K, dealt
from millwright.catalog.medallion_queries import HEALTH_SQL
from millwright.catalog.registry import query
from millwright.catalog.source_queries import write_lake
from millwright.operators.ordered import latest_by
from millwright.plans import medallion as M
from millwright.session import materialise, scratch_path
from millwright.sources.lake import stamp_ingest_time, with_payload
from millwright.sources.stored import Store
from millwright.streaming import jobs as J


#: Days after which files of the events land; errors arrive eight days late.
LANDINGS = ["2024-01-12", "2024-01-22"]
ARRIVAL = "ts + CASE WHEN event_type = 'error' THEN INTERVAL 8 DAYS ELSE INTERVAL 0 DAYS END"


def landed(t, name, order, cuts):
    """The table as files that landed one after the other, cut along ``order``."""
    df, path = t.read(name), scratch_path(t.spark, f"{name}-files")
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = df if low is None else df.where(F.expr(order) >= F.lit(low))
        part = part if high is None else part.where(F.expr(order) < F.lit(high))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(t, name, key, path=None):
    """The table as a stream, or its landed files, one in each micro-batch.

    One file is read by one or two tasks, so its rows are dealt to the cores as ``Tables.source`` does.
    """
    if path is None:
        return dealt(J.read_table(t.spark, t.folder, f"{name}.parquet", t.read(name).schema), key)
    return dealt(J.read_table(t.spark, path, "*.parquet", t.read(name).schema, 1), key)


def raw_stream(t, path=None):
    return t.as_raw(stream(t, "events", "event_id", path).withColumn("k", F.expr(K)))


def bronze_stream(t, path=None):
    return with_payload(raw_stream(t, path))


def landed_events(t):
    return landed(t, "events", ARRIVAL, LANDINGS)


def done(started) -> None:
    started.awaitTermination()


def places(t, name):
    return scratch_path(t.spark, name), scratch_path(t.spark, f"{name}-checkpoint")


CONTENT = "source_file, source_system, Operational_Hours AS row, machine_txt AS machine, CAST(Temperature_C AS DOUBLE) AS temperature, Rul AS rul"


@query("stream_ingest_bronze", Q.sql(f"SELECT {CONTENT} FROM scada_raw"))
def _ingest(t):
    """The lake's JSON lines into a bronze table."""
    out, checkpoint = places(t, "bronze")
    lines = J.read_lines(t.spark, f"{write_lake(t)}/industrial_raw.jsonl", "*")
    done(J.append_to(J.ingest(lines), out, checkpoint))
    return shown(t.spark.read.parquet(out))


def shown(bronze, *more):
    p = F.col("payload")
    return bronze.select(
        "source_file", "source_system", p["Operational_Hours"].alias("row"), p["machine_id"].alias("machine"),
        p["Temperature_C"].cast("double").alias("temperature"), p["Remaining_Useful_Life_days"].alias("rul"), *more,
    )


@query("stream_jsonl_sink", Q.sql(f"SELECT {CONTENT}, TRUE AS stamped FROM scada_raw"))
def _jsonl(t):
    """Envelopes stamped with their ingest time as JSON lines, read back with their content."""
    out, checkpoint = places(t, "jsonl")
    envelopes = stamp_ingest_time(bronze_stream(t).select("source_file", "source_system", "payload"))
    done(J.append_to(envelopes, out, checkpoint, "json"))
    stamped = F.col("datalake_ingested_at").try_cast("timestamp").isNotNull().alias("stamped")
    return shown(t.spark.read.schema(envelopes.schema).json(out), stamped)


@query("stream_dedup", Q.sql("SELECT event_type, k, user_id FROM ev GROUP BY ALL"))
def _dedup(t):
    """Events that repeat type, user and content are kept once.

    The stream's state covers two days; older repeats meet the stored table, and rows that
    came too late for the stream are added from the raw rows afterwards.
    """
    from millwright.functions.parse import payload_hash

    path = landed_events(t)
    events = stream(t, "events", "event_id", path).select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id", F.expr(K).alias("k")
    )
    hashed = events.withColumn("payload_hash", payload_hash(F.to_json(F.struct("event_type", "user_id", "k"))))
    raw, raw_checkpoint = places(t, "raw")
    done(J.append_to(hashed, raw, raw_checkpoint))
    store = Store(t.spark, scratch_path(t.spark, "store"), 8)
    unique = J.deduplicated(hashed, "ts", "2 days")
    done(J.store_new(unique, store, "events", ["payload_hash"], ["payload_hash"], scratch_path(t.spark, "checkpoint")))
    store.append("events", t.spark.read.parquet(raw), ["payload_hash"])
    store.commit()
    return store.read("events").select("event_type", "k", "user_id")


@query(
    "stream_bronze_to_silver",
    Q.sql(f"SELECT bronze_event_id, machine_id, {Q.ts_text('event_ts')} AS event_ts, {Q.dbl('s_temperature_c')} AS temperature_c, quality_status FROM silver"),
)
def _silver(t):
    out, checkpoint = places(t, "silver")
    done(J.append_to(J.silver(bronze_stream(t)), out, checkpoint))
    return t.spark.read.parquet(out).select("bronze_event_id", "machine_id", "event_ts", "temperature_c", "quality_status")


@query("stream_machine_health", Q.sql(HEALTH_SQL))
def _health(t):
    """Daily health as a stream whose state expires after two days; errors come a week late.

    The readings are stored by day as well, and the groups that lack late ones are
    recomputed from there.
    """
    path = landed_events(t)
    out, checkpoint = places(t, "health")
    done(J.log_changes(J.machine_health(J.silver(bronze_stream(t, path)), "2 days"), out, checkpoint, "update"))
    store = Store(t.spark, scratch_path(t.spark, "store"), 8)
    readings = J.silver(bronze_stream(t, path)).withColumn("event_date", F.to_date("event_ts"))
    done(J.store_new(readings, store, "silver", ["bronze_event_id"], ["event_date"], scratch_path(t.spark, "checkpoint")))
    log = J.read_log(t.spark, out)
    measures = [c for c in log.columns if c not in ("snapshot_date", "machine_id", "batch_id")]
    health = J.resolve(log, ["snapshot_date", "machine_id"], measures)
    return J.with_late_rows(materialise(health, "health"), store.read("silver"))


@query("stream_alerts", Q.sql("SELECT bronze_event_id, machine_id, alert_severity, alert_reason FROM fact_alerts"))
def _alerts(t):
    out, checkpoint = places(t, "alerts")
    done(J.log_changes(J.alerts(M.staging(bronze_stream(t))), out, checkpoint))
    return J.read_log(t.spark, out).select("bronze_event_id", "machine_id", "alert_severity", "alert_reason")


@query(
    "stream_latest_reading",
    Q.sql(f"SELECT machine_id, {Q.ts_text('event_ts')} AS event_ts, bronze_event_id FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY event_ts DESC NULLS LAST, bronze_event_id) AS rn FROM silver) WHERE rn = 1"),
)
def _latest(t):
    out, checkpoint = places(t, "latest")
    readings = J.silver(bronze_stream(t, landed_events(t))).select("machine_id", "event_ts", "bronze_event_id")
    done(J.latest_readings(readings, out, checkpoint, "machine_id", "event_ts", "bronze_event_id"))
    return latest_by(J.read_log(t.spark, out).drop("batch_id"), "machine_id", "event_ts", "bronze_event_id")


@query(
    "stream_upsert",
    "SELECT o_custkey, max(o_orderkey) AS last_order, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey",
)
def _upsert(t):
    """Per-customer upserts in five micro-batches: the last order is updated, the first is kept.

    The log is compacted into a base table after the third batch and its folders are deleted.
    """
    out, checkpoint = places(t, "upsert")
    per_customer = lambda batch: batch.groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("last_order"), F.min("o_orderkey").alias("first_order")
    )
    most = t.read("orders").agg(F.max("o_orderkey")).first()[0]
    path = landed(t, "orders", "o_orderkey", [most * k // 5 for k in range(1, 5)])
    done(J.log_changes(stream(t, "orders", "o_orderkey", path), out, checkpoint, prepare=per_customer))
    store, keys = Store(t.spark, scratch_path(t.spark, "store"), 8), ["o_custkey"]
    J.compact_log(store, "customers", out, keys, ["last_order"], until=2)
    J.drop_compacted(store, "customers", out)
    return J.read_merged(store, "customers", out, keys, ["last_order"])
