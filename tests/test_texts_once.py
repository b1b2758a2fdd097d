"""Texts of an event are looked up once, in as many tasks as the table needs, and facts that feed others are stored."""

import pytest
from pyspark.sql import functions as F

from millwright.catalog import bind
from millwright.catalog import medallion_queries as Q
from millwright.catalog.bind import Tables
from millwright.plans import medallion as M

DAY = "TIMESTAMP_NTZ '1997-05-28 10:00:00'"


@pytest.fixture
def tables(spark, tmp_path):
    def table(name, rows, **columns):
        spark.range(rows).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()]).write.parquet(f"{tmp_path}/{name}.parquet")

    table("region", 1, r_regionkey="0", r_name="'ASIA'")
    table("nation", 1, n_nationkey="0", n_regionkey="0", n_name="'CHINA'")
    table("supplier", 3, s_suppkey="id", s_nationkey="0", s_name="'M'", s_acctbal="1.0D")
    table("part", 3, p_partkey="id", p_name="'P'", p_type="'T'")
    # Two rows share a key, one has none, and energy finds a machine and day twice.
    table(
        "lineitem", 20, l_orderkey="nullif(id div 2, 9)", l_partkey="id % 3", l_suppkey="id % 3", l_linenumber="CAST(1 + id % 7 AS int)",
        l_quantity="CAST(id AS double)", l_extendedprice="id * 1000.0D", l_discount="0.01D", l_tax="0.02D",
        l_returnflag="element_at(array('A', 'N', 'R'), CAST(1 + id % 3 AS int))", l_linestatus="'O'", l_shipdate=DAY,
    )
    table(
        "orders", 20, o_orderkey="id", o_custkey="id % 4", o_orderstatus="IF(id % 5 = 0, 'P', 'F')", o_totalprice="id * 100.5D",
        o_orderdate=DAY, o_orderpriority="element_at(array('1-URGENT', '5-LOW'), CAST(1 + id % 2 AS int))",
    )
    table("events", 20, event_id="id", ts=DAY, user_id="id % 3", event_type="'error'", value="id * 1.5D", props="concat('{\"k\": ', id, '}')")
    return Tables(spark, str(tmp_path))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("fact", ["energy", "maintenance", "quality"])
def test_facts_of_bound_tables_build_no_map(tables, fact):
    assert "map(" not in plan_of(getattr(tables, fact)())


def test_dimensions_build_no_map_of_an_event(tables):
    assert "map(timestamp" not in plan_of(M.dimension_rows(M.staging(tables.bronze_mes())))


def test_a_stored_payload_is_read_by_one_step(tables, tmp_path):
    """The payload is not copied through the steps that parse."""
    tables.bronze_mes().write.parquet(f"{tmp_path}/bronze")
    stored = tables.spark.read.parquet(f"{tmp_path}/bronze")
    fact = M.fact_production(M.staging(stored))
    steps = [line for line in plan_of(fact).splitlines() if "payload#" in line and "Relation" not in line]
    assert len(steps) == 1
    assert rows(fact) == rows(tables.production())
    assert rows(M.fact_quality(M.staging(stored))) == rows(tables.quality())


def test_keys_that_differ_by_case_stay_apart(spark):
    payload = F.expr("map('Installation_Year', 'unknown', 'installation_year', '2015.5', 'machine_id', ' S1 ')")
    bronze = spark.range(1).select(
        F.col("id").alias("bronze_event_id"), F.lit("machine_mapping").alias("source_system"), F.lit("m.csv").alias("source_file"), payload.alias("payload")
    )
    assert M.dim_machine(M.staging(bronze)).first().asDict() == {
        "machine_id": "S1", "production_line_id": None, "machine_type": None, "installation_year": 2016
    }


def test_narrow_staging_has_no_texts(tables):
    names = M.narrow(M.staging(tables.bronze_energy())).columns
    assert "date_id" in names and not [n for n in names if n == "payload" or n.startswith("raw_")]


def test_a_large_source_is_dealt_to_more_tasks(tables, monkeypatch):
    monkeypatch.setattr(bind, "TASK_ROWS", 1)
    cores = tables.spark.sparkContext.defaultParallelism
    assert tables.source("events", "event_id").rdd.getNumPartitions() == max(20, cores)
    assert tables.source("events", "event_id").count() == 20


def test_listed_energy_reads_stored_production(tables, monkeypatch):
    seen = []
    real = Q.G.energy_per_good_piece
    monkeypatch.setattr(Q.G, "energy_per_good_piece", lambda energy, production: seen.append(plan_of(production)) or real(energy, production))
    listed = Q.listed_facts(tables)
    assert "regexp" not in seen[0] and "Relation" in seen[0]
    counts = {r["fact"]: r["count"] for r in listed.groupBy("fact").count().collect()}
    assert counts["fact_production"] == counts["fact_quality"] == 20 and counts["fact_energy"] == 16 and counts["fact_maintenance"] == 4
