"""Merges, gold builds, sources and sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.operators import enrich as E
from millwright.operators import merge as G
from millwright.plans import medallion as M
from millwright.session import scratch_path
from millwright.sources import csv_folder, gold, kafka, lake, sinks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ------------------------------------------------------------------ merges
def test_merge_modes(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, u string, v string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", None)], "k int, u string, v string")
    assert rows(G.merge(old, new, ["k"], ["u", "v"]), "k") == [(1, "a", "x"), (2, None, "z"), (3, "c", None)]
    assert rows(G.merge(old, new, ["k"], ["u", "v"], True), "k") == [(1, "a", "x"), (2, "b", "z"), (3, "c", None)]
    assert rows(G.merge(old, new, ["k"], ["v"]), "k") == [(1, "a", "x"), (2, "b", "z"), (3, "c", None)]
    assert rows(G.merge(old, new, ["k"], []), "k") == [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]


def test_stored_upsert_rewrites_only_touched_days(spark):
    path = scratch_path(spark, "fact")
    first = spark.createDataFrame([(1, 10, "a", "x"), (2, 20, "b", "x"), (3, None, "c", "x")], "k int, day int, u string, v string")
    sinks.write_tables({"t": first}, path, {"t": "day"})

    def files():
        kept = spark.read.parquet(f"{path}/t").filter("day = 20").select("_metadata.file_path")
        return {r[0] for r in kept.collect()}

    before = files()
    new = spark.createDataFrame([(1, 10, "A", "y"), (4, 10, "d", "y"), (3, None, "C", "y")], first.schema)
    for _ in range(2):
        G.upsert_partitions(f"{path}/t", new, "day", ["k"], ["u"])
    out = spark.read.parquet(f"{path}/t")
    assert rows(out.select("k", "day", "u", "v"), "k") == [(1, 10, "A", "x"), (2, 20, "b", "x"), (3, None, "C", "x"), (4, 10, "d", "y")]
    assert files() == before


def test_event_ids_are_unique_and_above_the_last(spark):
    df = lake.with_event_ids(spark.range(100).repartition(4), after=500)
    ids = [r["bronze_event_id"] for r in df.collect()]
    assert len(set(ids)) == 100 and min(ids) == 501


def test_insert_if_absent_keeps_one_per_key(spark):
    old = spark.createDataFrame([(1,)], "k int")
    new = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    assert rows(G.insert_if_absent(old, new, ["k"]), "k") == [(2,), (3,)]


def events(spark):
    def e(i, system, file, **payload):
        return (i, system, file, {k: None if v is None else str(v) for k, v in payload.items()})

    mes = dict(plant_id="P1", production_line_id="L1", product_id="X", timestamp="2026-03-29 07:00:00")
    data = [
        e(1, "mes", "mes_business.csv", machine_id="M1", actual_production_qty=100, good_qty=90, scrap_qty=10,
          production_speed=120, downtime_minutes=48, setup_time_minutes="", **mes),
        e(2, "mes", "mes_business.csv", machine_id="M1", actual_production_qty=0, good_qty=5, scrap_qty="bad",
          production_speed=None, downtime_minutes=600, **mes),
        e(3, "mes", "mes_sale.csv", machine_id="M9", actual_production_qty=1, good_qty=1, **{**mes, "plant_id": "FR02"}),
        e(4, "energie", S.REALTIME_SOURCE_FILE, machine_id="M1", timestamp="2026-03-29T20:00:00+00:00", energy_consumption_kwh="45"),
        e(5, "energie", "energie_business.csv", machine_id="M2", timestamp="2026-03-29", energy_consumption_kwh="45"),
        e(6, "gmao", "gmao_business.csv", machine_id="M1", timestamp="x", maintenance_cost="12.5", failure_type=" pump "),
        e(7, "scada_capteurs", S.REALTIME_SOURCE_FILE, machine_id="M1", timestamp=None, flag_oil_low="1", predicted_failure_probability="0.2"),
        e(8, "scada_capteurs", S.REALTIME_SOURCE_FILE, machine_id="M1", timestamp="2026-03-29", predicted_failure_probability="0.7"),
        e(9, "factories", "factories.csv", factory_id="P1", factory_name="Usine", country="France"),
    ]
    return spark.createDataFrame(data, "bronze_event_id long, source_system string, source_file string, payload map<string,string>")


def test_gold_build(spark):
    gold_tables = M.build_gold(events(spark))
    p = {r["bronze_event_id"]: r.asDict() for r in gold_tables["fact_production"].collect()}
    assert set(p) == {1, 2}
    assert [float(p[1][c]) for c in ("availability_rate", "performance_rate", "quality_rate", "trs", "scrap_rate")] == [0.9, 1.2, 0.9, 0.972, 0.1]
    assert float(p[2]["availability_rate"]) == 0 and p[2]["quality_rate"] is None and p[2]["trs"] is None and p[2]["scrap_qty"] is None
    energy = {r["bronze_event_id"]: r["energy_per_good_piece"] for r in gold_tables["fact_energy"].collect()}
    assert float(energy[4]) == 0.5 and energy[5] is None
    alerts = {r["bronze_event_id"]: (r["alert_severity"], r["alert_reason"], r["date_id"]) for r in gold_tables["fact_alerts"].collect()}
    assert alerts == {7: ("warning", "oil_low", None), 8: ("critical", "predicted_failure_probability_high", 20260329)}
    assert rows(gold_tables["dim_plant"], "plant_id") == [("FR02", None, None), ("P1", "Usine", "France")]
    assert rows(gold_tables["fact_maintenance"].select("failure_type", "date_id"), "failure_type") == [("pump", None)]
    for fact, dim, key in (("fact_production", "dim_machine", "machine_id"), ("fact_energy", "dim_date", "date_id")):
        assert M.orphan_count(gold_tables[fact], gold_tables[dim], key) == 0


def test_second_load_changes_nothing(spark):
    first = M.build_gold(events(spark))
    again = M.build_gold(events(spark), first)
    for name, table in first.items():
        assert rows(table, *table.columns[:1]) == rows(again[name], *table.columns[:1]), name


def test_partial_update_keeps_first_values(spark):
    first = M.build_gold(events(spark))["fact_production"]
    later = first.withColumns({"good_qty": F.lit(1), "planned_production_qty": F.lit(77), "downtime_minutes": F.lit(1).cast(S.NUM)})
    out = M.upsert_fact("fact_production", first, later).filter("bronze_event_id = 1").first()
    assert out["good_qty"] == 1 and out["planned_production_qty"] is None and float(out["downtime_minutes"]) == 48


def test_silver_ranges_and_padding(spark):
    payload = {"timestamp": "2026-03-29 01:00:00", "machine_id": "M1", "Temperature_C": "100.5", "Vibration_mms": "8", "Oil_Level_pct": " 12 ", "Error_Codes_Last_30_Days": "2.5"}
    df = spark.createDataFrame([(1, "scada_capteurs", payload), (2, "mes", payload)], "bronze_event_id long, source_system string, payload map<string,string>")
    got = M.bronze_to_silver(df).collect()
    assert len(got) == 1 and got[0]["temperature_c"] is None and float(got[0]["vibration_mms"]) == 8
    assert got[0]["oil_level_pct"] is None and got[0]["error_codes_last_30_days"] == 3 and got[0]["quality_status"] == "partial_sensor_event"


# ------------------------------------------------------------------ CSV
def test_row_numbers_over_many_splits(spark, tmp_path):
    path = tmp_path / "mes_sale.csv"
    path.write_text("id,note\n" + "".join(f"{i},{'x' * (i % 50)}\n" for i in range(1, 4001)))
    (tmp_path / "gmao_business.csv").write_text("id,cost\n1,\n2,5\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = csv_folder.ingest_csv_dir(spark, [str(tmp_path)], multi_line=False).filter("source_system = 'mes'")
        assert df.count() == 4000
        assert df.filter(F.col("row_number") != F.col("payload")["id"].cast("long")).count() == 0
        other = csv_folder.ingest_csv_dir(spark, [str(tmp_path)], "gmao*.csv")
        assert [(r["row_number"], r["payload"]) for r in other.orderBy("row_number").collect()] == [(1, {"id": "1", "cost": ""}), (2, {"id": "2", "cost": "5"})]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(FileNotFoundError):
        csv_folder.ingest_csv_dir(spark, [str(tmp_path)], "*.tsv")


def test_many_files_and_odd_records(spark, tmp_path):
    import time

    for i in range(1000):
        (tmp_path / f"machine {i}+a_sale.csv").write_text(f'id,"no\nte"\n{i},"two\nlines, ""quoted"""\n{i + 1},\n')
    (tmp_path / "été%20_business.csv").write_text("\ufeffid\n7\n")
    (tmp_path / "none.csv").write_text("")
    started = time.time()
    df = csv_folder.ingest_csv_dir(spark, [str(tmp_path)])
    assert time.time() - started < 60
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # One scan for each of the two headers, on both sides of the join that numbers rows.
    assert plan.count("Relation") == 4
    rows = df.collect()
    assert len(rows) == 2001 and {r.row_number for r in rows} == {1, 2}
    by_file = {r.source_file: r.payload for r in rows if r.row_number == 1}
    assert by_file["machine 3+a_sale.csv"] == {"id": "3", "no\nte": 'two\nlines, "quoted"'} and by_file["été%20_business.csv"] == {"id": "7"}
    assert [r.payload for r in rows if r.source_file == "machine 9+a_sale.csv" and r.row_number == 2] == [{"id": "10", "no\nte": ""}]


# ------------------------------------------------------------------ lake
def write_lines(tmp_path, lines):
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


ENVELOPE = {"source_file": "f", "source_system": "s", "row_number": 1, "payload": {"b": 1, "a": None}, "datalake_ingested_at": "t1"}


def test_lake_hash_and_blank_lines(spark, tmp_path):
    shuffled = {k: ENVELOPE[k] for k in reversed(ENVELOPE)}
    again = {**ENVELOPE, "datalake_ingested_at": "t2"}
    folder = write_lines(tmp_path, [json.dumps(ENVELOPE), "", "   ", json.dumps(shuffled), json.dumps(again)])
    df = lake.read_lake(spark, folder)
    assert df.count() == 3
    empty = df.limit(0)
    assert lake.new_bronze_rows(empty, df).count() == 2
    assert lake.new_bronze_rows(empty, df, dedup_on="payload").count() == 1
    assert lake.new_bronze_rows(df, df).count() == 0
    assert df.first()["payload"] == {"a": None, "b": "1"}


@pytest.mark.parametrize("line", ["not json", json.dumps({k: v for k, v in ENVELOPE.items() if k != "payload"})])
def test_lake_rejects_bad_lines(spark, tmp_path, line):
    with pytest.raises(Exception):
        lake.read_lake(spark, write_lines(tmp_path, [json.dumps(ENVELOPE), line])).collect()
    with pytest.raises(Exception):
        lake.read_lake(spark, str(tmp_path)).count()


def test_lake_without_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        lake.read_lake(spark, str(tmp_path))


def test_bronze_load_can_be_repeated(spark, tmp_path):
    df = lake.read_lake(spark, write_lines(tmp_path, [json.dumps(ENVELOPE)]))
    path = scratch_path(spark, "bronze")
    assert [lake.append_bronze(df, path, load) for load in ("l1", "l1", "l2")] == [1, 1, 1]
    assert spark.read.parquet(path).count() == 2


def test_kafka_records_round_trip(spark):
    df = spark.createDataFrame([("f", "mes", 1, "m", {"x": "é"}, None)], S.ENVELOPE)
    record = kafka.encode(df)
    assert record.first()["key"] == "mes"
    assert kafka.decode(record).first()["payload"] == {"x": "é"}


# ------------------------------------------------------------------ gold access, sinks
def test_filters_and_lookup(spark):
    alerts = spark.createDataFrame([("M1", True, "critical"), ("M1", False, "warning")], "machine_id string, is_active boolean, alert_severity string")
    assert gold.filter_table("fact_alerts", alerts, machine_id="M1", is_active=True).count() == 1
    assert gold.filter_table("fact_alerts", alerts).count() == 2
    with pytest.raises(ValueError):
        gold.filter_table("fact_alerts", alerts, plant_id="x")
    plants = spark.createDataFrame([("P1", "n")], "plant_id string, plant_name string")
    assert gold.lookup("dim_plant", plants, "P1").first()["plant_name"] == "n"
    with pytest.raises(LookupError):
        gold.lookup("dim_plant", plants, "P2")


def test_partition_overwrite_keeps_other_days(spark):
    path = scratch_path(spark, "health")
    sinks.overwrite_partitions(spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int"), path, "day")
    sinks.overwrite_partitions(spark.createDataFrame([("d2", 9)], "day string, v int"), path, "day")
    assert rows(spark.read.parquet(path).select("day", "v"), "v") == [("d1", 1), ("d2", 9)]


def test_prediction_log_schema(spark):
    df = spark.createDataFrame([("M1", "P1", 0.9, "at_risk")], "machine_id string, site string, risk double, state string")
    r = sinks.prediction_log(df, "state", "clf", "3", "champion", ["machine_id"], ["state", "risk"]).first()
    assert json.loads(r["output"]) == {"state": "at_risk", "risk": 0.9} and r["site"] == "P1" and r["model_alias"] == "champion"


# ------------------------------------------------------------------ enrichment
def test_unmapped_machines_are_named(spark):
    mapping = spark.createDataFrame([("M1",)], "old_machine_id string")
    df = spark.createDataFrame([("M3",), ("M1",), ("M2",), (None,)], "machine_id string")
    with pytest.raises(ValueError, match=r"\['M2', 'M3'\]"):
        E.assert_mapped(df, mapping, "mes")
    E.assert_mapped(df.filter("machine_id = 'M1'"), mapping, "mes")


def test_readme_names_every_package_folder():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    text = open(os.path.join(root, "README.md"), encoding="utf-8").read()
    for folder in ("functions", "sources", "operators", "plans", "streaming", "ml", "catalog"):
        assert f"`{folder}/`" in text


def test_business_tables_are_published_together(spark, tmp_path):
    from millwright.plans import business as B
    from millwright.sources.stored import Store

    old, new = (spark.createDataFrame([(i, v) for i in range(5)], "id int, v string") for v in ("old", "new"))
    store = Store(spark, str(tmp_path / "set"), 2)
    B.publish(store, {"a": old, "b": old}, {})
    reader = Store(spark, str(tmp_path / "set"), 2)
    # A set that fails half-way is never seen.
    broken = new.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        B.publish(store, {"a": new, "b": broken}, {})
    assert {r.v for n in "ab" for r in reader.read(n).collect()} == {"old"}
    B.publish(Store(spark, str(tmp_path / "set"), 2), {"a": new, "b": new}, {})
    assert {r.v for n in "ab" for r in reader.read(n).collect()} == {"new"}
