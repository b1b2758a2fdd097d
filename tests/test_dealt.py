"""Parsing and hashing run on all the cores, not in the few tasks of a scan."""

import re

import pytest
from pyspark.sql import functions as F

from millwright.catalog import source_queries as Q
from millwright.catalog.bind import Tables, dealt

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(i, "2024-01-01 00:00:00", i % 3, "view" if i % 2 else "click", float(i), f'{{"k": {i}}}') for i in range(20)]
    events = spark.createDataFrame([(*r[:1], None, *r[2:]) for r in rows], EVENT)
    events.withColumn("ts", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))).write.parquet(f"{tmp_path}/events.parquet")
    return Tables(spark, str(tmp_path))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def below(plan):
    """What runs before rows are dealt to the cores."""
    return plan[plan.index("RepartitionByExpression") :]


def test_hashes_are_not_made_by_the_scan(tables):
    """A join on a hash asks that it is not null; that is asked after the rows are dealt."""
    rows = Q.hashed(tables)
    joined = rows.join(rows.select("payload_hash").distinct(), "payload_hash", "left_semi")
    for part in re.split(r"(?=RepartitionByExpression)", plan_of(joined))[1:]:
        assert "sha2" not in part.split("Join")[0].split("Aggregate")[0]
    assert joined.count() == 20


def test_parsing_is_done_after_dealing(spark):
    df = dealt(spark.range(50).selectExpr("id", "CAST(id AS string) AS text"), "id")
    parsed = df.selectExpr("id", "regexp_extract(text, '[0-9]+', 0) AS n").where("n > '2'")
    assert "regexp_extract" not in below(plan_of(parsed))
    assert df.count() == 50


def test_streamed_files_are_dealt(tables):
    """A micro-batch's one file is parsed by all the cores."""
    from millwright.catalog import streaming_queries as T

    plan = T.bronze_stream(tables)._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression" in plan
