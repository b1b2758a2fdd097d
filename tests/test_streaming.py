"""Streams replayed in several micro-batches equal the batch operators and may be repeated."""

from pyspark.sql import functions as F

from millwright.operators.ordered import latest_by
from millwright.plans import medallion as M
from millwright.session import scratch_path
from millwright.sources.stored import Store
from millwright.streaming import jobs as J


def readings(spark):
    payload = F.create_map(
        F.lit("timestamp"), F.date_format(F.timestamp_seconds(F.col("id") * 5000), "yyyy-MM-dd HH:mm:ss"),
        F.lit("machine_id"), F.concat(F.lit("M"), F.col("id") % 3), F.lit("Temperature_C"), (F.col("id") % 120).cast("string"),
        F.lit("predicted_failure_probability"), F.format_string("0.%d", F.col("id") % 10),
    )
    return spark.range(200).select(
        F.col("id").alias("bronze_event_id"), F.lit("scada_capteurs").alias("source_system"),
        F.lit("industrial_realtime_stream").alias("source_file"), payload.alias("payload"),
    )


def as_stream(spark, df):
    """One file per micro-batch."""
    path = scratch_path(spark, "stream-source")
    df.repartition(4).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def places(spark):
    return scratch_path(spark, "out"), scratch_path(spark, "checkpoint")


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert sorted(map(str, a.select(*columns).collect())) == sorted(map(str, b.select(*columns).collect()))


def test_health_in_batches(spark):
    df = readings(spark)
    out, checkpoint = places(spark)
    stream = J.machine_health(J.silver(as_stream(spark, df)), "30 days")
    J.log_changes(stream, out, checkpoint, "update").awaitTermination()
    log = J.read_log(spark, out)
    assert log.select("batch_id").distinct().count() > 1
    keys = ["snapshot_date", "machine_id"]
    got = J.resolve(log, keys, [c for c in log.columns if c not in (*keys, "batch_id")])
    same(got, M.machine_health_daily(M.bronze_to_silver(df)))


def test_latest_and_repeat(spark):
    df = readings(spark)
    source = as_stream(spark, df)
    out, checkpoint = places(spark)
    for _ in range(2):  # the second run finds nothing new
        J.latest_readings(J.silver(source), out, checkpoint, "machine_id", "event_ts", "bronze_event_id").awaitTermination()
    got = latest_by(J.read_log(spark, out).drop("batch_id"), "machine_id", "event_ts", "bronze_event_id")
    same(got, latest_by(M.bronze_to_silver(df), "machine_id", "event_ts", "bronze_event_id"))


def test_alerts(spark):
    df = readings(spark)
    out, checkpoint = places(spark)
    J.log_changes(J.alerts(M.staging(as_stream(spark, df))), out, checkpoint).awaitTermination()
    same(J.read_log(spark, out).drop("batch_id"), M.fact_alerts(M.staging(df)))


def test_dedup(spark):
    df = spark.range(40).select(F.timestamp_seconds(F.col("id")).alias("ts"), (F.col("id") % 10).cast("string").alias("payload_hash"))
    out, checkpoint = places(spark)
    J.append_to(J.deduplicated(as_stream(spark, df), "ts", "1 day"), out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 10


def test_resolve_change_log(spark):
    log = spark.createDataFrame([(0, 1, "a", "x"), (1, 1, None, "y"), (1, 2, "c", None), (2, 1, "d", None)], "batch_id int, k int, u string, v string")
    got = {r["k"]: (r["u"], r["v"]) for r in J.resolve(log, ["k"], ["v"]).collect()}
    assert got == {1: ("a", None), 2: ("c", None)}
    kept = {r["k"]: (r["u"], r["v"]) for r in J.resolve(log, ["k"], ["u", "v"], keep_old_when_null=True).collect()}
    assert kept == {1: ("d", "y"), 2: ("c", None)}


def test_lake_lines_as_stream(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"source_file":"f","source_system":"mes","payload":{"a":"1"}}\n\n')
    out, checkpoint = places(spark)
    J.append_to(J.ingest(J.read_lines(spark, str(tmp_path))), out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).first()["payload"] == {"a": "1"}


def late_stream(spark, df, late):
    """One file per micro-batch, in order; the rows of ``late`` land last."""
    path = scratch_path(spark, "late-source")
    for low in range(0, 200, 50):
        df.where(F.col("bronze_event_id").between(low, low + 49)).where(~late).coalesce(1).write.mode("append").parquet(path)
    df.where(late).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_rows_are_dropped_and_merged(spark):
    df = readings(spark)
    source = late_stream(spark, df, F.col("bronze_event_id").isin(1, 2, 30, 31, 100))
    out, checkpoint = places(spark)
    query = J.log_changes(J.machine_health(J.silver(source), "1 day"), out, checkpoint, "update")
    query.awaitTermination()
    operators = [o for p in query.recentProgress for o in p.stateOperators]
    assert sum(o.numRowsDroppedByWatermark for o in operators) > 0
    # State of passed days expires: less is held than there are groups.
    want = M.machine_health_daily(M.bronze_to_silver(df))
    assert operators[-1].numRowsTotal < want.count()
    log = J.read_log(spark, out)
    assert log.select("batch_id").distinct().count() > 3
    keys = ["snapshot_date", "machine_id"]
    health = J.resolve(log, keys, [c for c in log.columns if c not in (*keys, "batch_id")])
    store = Store(spark, scratch_path(spark, "store"), 4)
    stored = J.silver(source).withColumn("event_date", F.to_date("event_ts"))
    for _ in range(2):  # a replay under a new checkpoint stores nothing twice
        J.store_new(stored, store, "silver", ["bronze_event_id"], ["event_date"], scratch_path(spark, "checkpoint")).awaitTermination()
    assert store.read("silver").count() == 200
    assert sorted(map(str, health.collect())) != sorted(map(str, want.select(health.columns).collect()))
    same(J.with_late_rows(health, store.read("silver")), want)


def test_compacted_log_resolves_as_before(spark):
    path, store = scratch_path(spark, "log"), Store(spark, scratch_path(spark, "store"), 4)
    keys, updated = ["k"], ["u"]
    for b in range(6):
        rows = [(k, f"u{b}" if (b + k) % 4 else None, f"v{b}") for k in range(b, 20, 3)]
        spark.createDataFrame(rows, "k int, u string, v string").write.parquet(f"{path}/batch_id={b}")
    want = {keep: J.resolve(J.read_log(spark, path), keys, updated, keep).collect() for keep in (False, True)}
    for keep in (False, True):
        name = f"t{keep}"
        assert sorted(J.read_merged(store, name, path, keys, updated, keep).collect(), key=str) == sorted(want[keep], key=str)
        for until in (1, 3, 3):
            assert J.compact_log(store, name, path, keys, updated, until, keep) == until
            assert sorted(J.read_merged(store, name, path, keys, updated, keep).collect(), key=str) == sorted(want[keep], key=str)
    assert J.drop_compacted(store, "tFalse", path) == 4 and J.log_batches(spark, path) == [4, 5]
    assert J.compact_log(store, "tFalse", path, keys, updated) == 5
    J.drop_compacted(store, "tFalse", path)
    assert J.log_batches(spark, path) == []
    assert sorted(J.read_merged(store, "tFalse", path, keys, updated).collect(), key=str) == sorted(want[False], key=str)
