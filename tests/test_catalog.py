"""The driver contract, and a sample of registered queries beside their SQL."""

import os
import subprocess
import sys

import pytest

from compare import check, connect

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "ingest_csv_dir", "read_datalake_jsonl", "bronze_insert_new", "machine_health_daily", "fact_production", "fact_energy", "fact_alerts",
    "fact_upsert_partial", "energy_by_site", "recent_alerts", "line_performance", "risk_machines", "fill_by_group_chunked",
    "interpolate_by_machine_chunked", "temporal_split_chunked", "group_median_fill_chunked", "completeness_summary", "enrich_mes",
    "stream_machine_health", "clf_metrics", "stratified_split",
]
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def test_contract():
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(oracles) > 140
    assert set(SAMPLE) <= set(oracles)


def test_registry_loads_without_a_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


@needs_data
def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    import __spark_entry__ as entry

    ok, note = check(spark, connect(FOLDER), name, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert ok, note
