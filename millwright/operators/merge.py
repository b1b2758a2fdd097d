"""Idempotent loads: insert-if-absent and upserts as joins on the unique key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.session import materialise


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` whose key is not in ``old``, one per key.

    Only the key columns of ``old`` are read. Copies inside ``new`` are reduced on the
    map side before the shuffle, so a heavily repeated key moves as one row per task.
    """
    return new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")


def merge(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    update_columns: list[str],
    keep_old_when_null: bool = False,
    combine=None,
) -> DataFrame:
    """Table after ``new`` (unique on ``keys``) has been upserted into ``old``.

    Matched rows take ``update_columns`` from ``new`` and everything else from ``old``;
    with ``keep_old_when_null`` a null in ``new`` does not erase an old value, and with
    ``combine(old, new)`` an updated column is made of both.
    """
    o = old.withColumn("_in_old", F.lit(True)).alias("o")
    n = new.withColumn("_in_new", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    matched = F.col("o._in_old").isNotNull() & F.col("n._in_new").isNotNull()
    is_new = F.col("o._in_old").isNull()

    def pick(c: str):
        before, after = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in keys:
            return F.coalesce(before, after)
        if c in update_columns:
            value = combine(before, after) if combine else F.coalesce(after, before) if keep_old_when_null else after
            return F.when(matched, value).when(is_new, after).otherwise(before)
        return F.when(is_new, after).otherwise(before)

    return o.join(n, on, "full").select(*[pick(c).alias(c) for c in old.columns])


def upsert_partitions(
    path: str,
    new: DataFrame,
    partition: str,
    keys: list[str],
    update_columns: list[str],
    keep_old_when_null: bool = False,
) -> None:
    """Upsert into a stored table, reading and rewriting only the partitions ``new`` touches.

    A key must always fall into the same partition, as an event does with its date. The
    partition values of the batch (at most one per partition of the table) become a
    constant filter, so other partitions are not listed or read. The merged rows are
    written aside first, because they replace the files they come from.
    """
    values = [r[0] for r in new.select(partition).distinct().collect()]
    touched = F.col(partition).isin([v for v in values if v is not None])
    if None in values:
        touched = touched | F.col(partition).isNull()
    affected = new.sparkSession.read.parquet(path).filter(touched)
    merged = merge(affected.select(*new.columns), new, keys, update_columns, keep_old_when_null)
    (
        materialise(merged, "upsert")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def energy_per_good_piece(energy: DataFrame, production: DataFrame) -> DataFrame:
    """Energy rows with kWh per good piece of the same machine and day.

    Several production rows can match; the one with the lowest event id is taken. That
    choice is an aggregate, so no (date, machine) group is gathered in one place, and
    the join side holds one row per group.
    """
    good = (
        production.filter(F.col("good_qty") > 0)
        .groupBy("date_id", "machine_id")
        .agg(F.min_by("good_qty", "bronze_event_id").alias("_good"))
    )
    # Rows without a day or machine match nothing; each takes a key of its own, so that they
    # do not meet in one task.
    own = F.concat(F.lit("\0"), F.col("bronze_event_id").cast("string"))
    known = F.col("date_id").isNotNull() & F.col("machine_id").isNotNull()
    keyed = energy.withColumn("_key", F.when(known, F.concat_ws("\t", "date_id", "machine_id")).otherwise(own))
    good = good.where("date_id IS NOT NULL AND machine_id IS NOT NULL").select(F.concat_ws("\t", "date_id", "machine_id").alias("_key"), "_good")
    rate = F.round(F.col("energy_consumption_kwh") / F.col("_good"), 4)
    return (
        keyed.join(good, "_key", "left")
        .withColumn("energy_per_good_piece", rate.cast("decimal(18,6)"))
        .select(*energy.columns)
    )
