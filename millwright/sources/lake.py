"""The JSON-lines lake and the bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.functions.parse import payload_map, variant_hash
from millwright.operators.merge import insert_if_absent
from millwright.sources.csv_folder import list_files


def stamp_ingest_time(events: DataFrame) -> DataFrame:
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return events.withColumn("datalake_ingested_at", now)


def read_lake(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """Bronze-shaped rows of every JSON line of the files in ``folder``.

    Blank lines are skipped. No file, a line that is not JSON, or an envelope without
    one of its required keys is an error.
    """
    if not list_files(spark, folder, pattern):
        raise FileNotFoundError(f"no {pattern} file in {folder}")
    return parse_lines(spark.read.text(f"{folder.rstrip('/')}/{pattern}"))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text lines to typed envelopes with their hash.

    The check is a filter on the column of a generator: it is neither pruned nor moved, so
    any action on the rows, a count too, fails on a bad line.
    """
    line = F.col(column)
    read = lines.filter(F.btrim(line) != "").select(F.explode(F.array(F.try_parse_json(line))).alias("_v"))
    # The payload is needed by the check and by the row; as a generator's column it is read once.
    both = F.struct(F.col("_v").alias("v"), F.try_variant_get("_v", "$.payload", "map<string,string>").alias("body"))
    parsed = read.select(F.explode(F.array(both)).alias("_r")).select(F.col("_r.v").alias("_v"), F.col("_r.body").alias("_body"))

    def text(key: str):
        return F.try_variant_get("_v", f"$.{key}", "string")

    body = F.col("_body")
    fault = F.when(F.col("_v").isNull(), "line is not JSON")
    for key in S.REQUIRED_ENVELOPE:
        fault = fault.when((body if key == "payload" else text(key)).isNull(), f"envelope without {key}")
    parsed = parsed.filter(F.when(fault.isNotNull(), F.raise_error(fault).cast("boolean")).otherwise(F.lit(True)))
    return parsed.select(
        text("source_file").alias("source_file"),
        text("source_system").alias("source_system"),
        text("datalake_ingested_at").alias("ingested_at"),
        body.alias("payload"),
        variant_hash(F.col("_v")).alias("payload_hash"),
        variant_hash(F.variant_get("_v", "$.payload", "variant")).alias("content_hash"),
    )


def new_bronze_rows(bronze: DataFrame, incoming: DataFrame, dedup_on: str = "envelope") -> DataFrame:
    """Incoming events not loaded yet.

    The default compares whole envelopes, ingest time included; ``payload`` compares the
    payload alone, so a message consumed twice is kept once.
    """
    return insert_if_absent(bronze, incoming, ["payload_hash" if dedup_on == "envelope" else "content_hash"])


def with_event_ids(new: DataFrame, after: int = 0) -> DataFrame:
    """Unique ``bronze_event_id`` values above ``after``, fixed once the rows are written."""
    return new.withColumn("bronze_event_id", F.monotonically_increasing_id() + F.lit(after + 1))


def append_bronze(new: DataFrame, path: str, load_id: str) -> int:
    """Append one load by source system and return its number of rows.

    Each load has its own partitions: repeating a load replaces them, and counting it
    reads only the footers of its own files.
    """
    rows = new.withColumn("load_id", F.lit(load_id))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_system", "load_id")
        .parquet(path)
    )
    return new.sparkSession.read.parquet(path).filter(F.col("load_id") == load_id).count()


def with_payload(raw: DataFrame, column: str = "payload_json") -> DataFrame:
    """Parse JSON text into the payload map, once per row.

    A filter on a parsed field would otherwise be pushed below the projection and parse
    the text again; filters do not move below the column of a generator.
    """
    others = [c for c in raw.columns if c != column]
    return raw.select(*others, F.explode(F.array(payload_map(F.col(column)))).alias("payload"))
