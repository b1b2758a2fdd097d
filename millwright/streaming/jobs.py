"""The ingestion, health and alert jobs as Structured Streaming queries.

Every job takes a streaming DataFrame and leaves trigger and sink to the caller. Tables
that need updates are kept as a change log: each micro-batch overwrites its own
``batch_id`` folder, so a replayed batch changes nothing, and readers resolve the log
with one aggregate instead of rewriting the table per batch. ``compact_log`` moves old
batches into a stored base table, so that the log stays short.

State expires with the watermark, which drops rows that come later than the delay. Such rows
are not lost: the raw rows are stored as well (``store_new``), and ``with_late_rows`` or a
second ``append`` brings in by a batch job what the stream left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwright.operators.ordered import latest_by
from millwright.plans import medallion as M
from millwright.session import materialise
from millwright.sources.csv_folder import list_files
from millwright.sources.lake import parse_lines
from millwright.sources.stored import Store


def read_lines(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    return spark.readStream.option("pathGlobFilter", pattern).text(folder)


def read_table(spark: SparkSession, folder: str, pattern: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def ingest(lines: DataFrame) -> DataFrame:
    """JSON lines to bronze rows."""
    return parse_lines(lines)


def deduplicated(events: DataFrame, time: str, delay: str, key: str = "payload_hash") -> DataFrame:
    """Drops repeats that arrive within ``delay``; the state is bounded by the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def silver(bronze: DataFrame) -> DataFrame:
    return M.bronze_to_silver(bronze)


def alerts(staged: DataFrame) -> DataFrame:
    return M.fact_alerts(staged)


def machine_health(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Health per machine and day, updated as events arrive.

    A day's state is dropped once the watermark has passed it; an event that comes later
    still is left to ``with_late_rows``.
    """
    timed = M.valid_health_rows(events).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    return (
        timed.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", "1 day").alias("w"), "machine_id")
        .agg(*M.health_measures())
        .select(F.to_date("w.start").alias("snapshot_date"), "*")
        .drop("w")
    )


# ---------------------------------------------------------------- sinks
def append_to(stream: DataFrame, path: str, checkpoint: str, kind: str = "parquet") -> StreamingQuery:
    """Exactly-once file sink over everything available."""
    return (
        stream.writeStream.format(kind)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def log_changes(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", prepare=None) -> StreamingQuery:
    """Each micro-batch becomes one folder of the change log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def store_new(stream: DataFrame, store: Store, name: str, keys: list[str], by: list[str], checkpoint: str) -> StreamingQuery:
    """Each micro-batch adds the rows whose key the stored table lacks; a replayed batch adds none."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # An append reads its rows twice, which would run the stream's state twice.
        store.append(name, materialise(batch, "incoming") if name in store else batch, keys, by)
        store.commit()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_late_rows(health: DataFrame, silver: DataFrame) -> DataFrame:
    """Daily health with the groups recomputed that lack readings of ``silver``.

    ``silver`` holds all readings of its days: the days that got rows since the last run are
    enough, and groups of other days stay as they are. A group is behind when its number of
    events is not that of its readings.
    """
    keys = ["snapshot_date", "machine_id"]
    rows = M.valid_health_rows(silver).withColumn("snapshot_date", F.to_date("event_ts"))
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    known = health.select(*keys, "event_count")
    behind = counted.join(known, keys, "left").where("event_count IS NULL OR event_count != _n").select(*keys)
    behind = materialise(behind, "behind")
    fixed = M.machine_health_daily(rows.join(behind, keys, "left_semi").drop("snapshot_date"))
    return health.join(behind, keys, "left_anti").unionByName(fixed)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def resolve(log: DataFrame, keys: list[str], update_columns: list[str], keep_old_when_null: bool = False) -> DataFrame:
    """Table a change log stands for: updated columns from the last batch, others from the first."""
    order = F.col("batch_id")
    others = [c for c in log.columns if c not in (*keys, "batch_id")]
    picks = []
    for c in others:
        if c not in update_columns:
            picks.append(F.min_by(c, order).alias(c))
        elif keep_old_when_null:
            picks.append(F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c))
        else:
            picks.append(F.max_by(c, order).alias(c))
    return log.groupBy(*keys).agg(*picks).select(*[c for c in log.columns if c != "batch_id"])


def _compacted(store: Store, name: str) -> int:
    """Last batch of the log that the base table holds; -1 before the first compaction."""
    return store.read(f"{name}_compacted").first()[0] if f"{name}_compacted" in store else -1


def compact_log(
    store: Store, name: str, path: str, keys: list[str], update_columns: list[str], until: int | None = None, keep_old_when_null: bool = False
) -> int:
    """Move the batches of the log up to ``until`` (all, if not given) into the stored table ``name``.

    The table and the number of its last batch change with one commit, so a reader of
    ``read_merged`` counts every batch once. Only the buckets of the changed keys are
    rewritten. Returns the last batch moved; its folders and those before it are no longer
    read and can be deleted with ``drop_compacted``.
    """
    spark, done = store.spark, _compacted(store, name)
    batches = [b for b in log_batches(spark, path) if b > done and (until is None or b <= until)]
    if not batches:
        return done
    log = read_log(spark, path).where(F.col("batch_id").between(batches[0], batches[-1]))
    store.upsert(name, resolve(log, keys, update_columns, keep_old_when_null), keys, update_columns, keep_old_when_null=keep_old_when_null)
    store.replace(f"{name}_compacted", spark.createDataFrame([(batches[-1],)], "batch_id int"), ["batch_id"])
    store.commit()
    return batches[-1]


def log_batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(f.rsplit("=", 1)[1]) for f in list_files(spark, path, "batch_id=*"))


def drop_compacted(store: Store, name: str, path: str) -> int:
    """Delete the batches that the base table holds; returns how many."""
    done, gone = _compacted(store, name), 0
    for batch in log_batches(store.spark, path):
        if batch <= done:
            place = store.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch}")
            gone += bool(place.getFileSystem(store.spark._jsc.hadoopConfiguration()).delete(place, True))
    return gone


def read_merged(store: Store, name: str, path: str, keys: list[str], update_columns: list[str], keep_old_when_null: bool = False) -> DataFrame:
    """The base table with the batches of the log that came after it."""
    done = _compacted(store, name)
    fresh = [b for b in log_batches(store.spark, path) if b > done]
    base = store.read(name).withColumn("batch_id", F.lit(-1)) if name in store else None
    if not fresh:
        return base.drop("batch_id")
    log = read_log(store.spark, path).where(F.col("batch_id") > done)
    return resolve(log if base is None else log.unionByName(base), keys, update_columns, keep_old_when_null)


def latest_readings(stream: DataFrame, path: str, checkpoint: str, key: str, ts: str, tie: str) -> StreamingQuery:
    """Newest reading per key of each micro-batch, to be resolved with ``latest_by``."""
    return log_changes(stream, path, checkpoint, prepare=lambda batch: latest_by(batch, key, ts, tie))
