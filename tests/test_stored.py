"""Stored tables in buckets and the load that changes only what it touches."""

import pytest
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.plans import medallion as M
from millwright.plans.incremental import Warehouse
from millwright.sources.stored import Store

ROW = "id long, day string, value int, note string"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), 8)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def make(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def test_upsert_finds_a_key_that_moved(spark, store):
    first = [(i, f"2024-01-{i % 9 + 1:02d}", i, "old") for i in range(40)]
    store.upsert("t", make(spark, *first), ["id"], ["value"], ["day"])
    store.commit()
    # Other days, one null: the rows keep the day they were loaded with, and are not doubled.
    store.upsert("t", make(spark, (3, "2024-02-20", 300, "new"), (4, None, 400, "new"), (99, None, 9, "new")), ["id"], ["value"], ["day"])
    store.commit()
    want = [(i, d, {3: 300, 4: 400}.get(i, v), n) for i, d, v, n in first] + [(99, None, 9, "new")]
    assert sorted(rows_of(store.read("t")), key=repr) == sorted(want, key=repr)
    # When the day itself is updated the row changes its bucket.
    store.upsert("t", make(spark, (5, "2030-01-01", 1, "x")), ["id"], ["value", "day"], ["day"])
    store.upsert("t", make(spark, (5, "2031-01-01", 2, "x")), ["id"], ["value", "day"], ["day"])
    store.commit()
    assert rows_of(store.read("t").where("id = 5")) == [(5, "2031-01-01", 2, "old")]


def test_only_touched_buckets_are_read_and_written(spark, store):
    store.upsert("t", make(spark, *[(i, f"d{i % 30}", i, "") for i in range(300)]), ["id"], ["value"], ["day"])
    store.commit()
    before = store.entries()["t"].buckets
    new = make(spark, (1, "d1", -1, ""))
    touched = store.touched(new, ["day"])
    rows = store.read("t", touched)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len(touched) == 1 and "PartitionFilters: [isnotnull(_bucket" in plan
    assert len({f.split("_bucket=")[1].split("/")[0] for f in rows.inputFiles()}) == 1
    store.upsert("t", new, ["id"], ["value"], ["day"])
    after = store.entries()["t"].buckets
    assert {b for b in before if before[b] != after[b]} == {str(b) for b in touched}
    assert store.read("t").count() == 300 and store.read("t").where("value = -1").count() == 1


def test_nothing_is_seen_before_the_commit(spark, store):
    store.upsert("a", make(spark, (1, "d", 1, "")), ["id"], ["value"])
    store.commit()
    other = Store(spark, store.root, 8)
    store.upsert("a", make(spark, (1, "d", 2, "")), ["id"], ["value"])
    store.append("b", make(spark, (7, "d", 7, "")), ["id"])
    assert rows_of(other.read("a")) == [(1, "d", 1, "")] and "b" not in other
    assert rows_of(store.read("a")) == [(1, "d", 2, "")]
    # A writer that commits in between makes this one fail instead of losing its change.
    draft = store.number
    store.number = lambda: 0
    with pytest.raises(RuntimeError):
        store.commit()
    store.number = draft
    store.commit()
    assert rows_of(other.read("a")) == [(1, "d", 2, "")] and rows_of(other.read("b")) == [(7, "d", 7, "")]
    assert store.sweep() == 1 and rows_of(other.read("a")) == [(1, "d", 2, "")]


def test_append_compact_and_repeated_keys(spark, store):
    for k in range(4):
        added = store.append("t", make(spark, *[(i, "d", i, "") for i in range(k * 5 + 10)] * 2), ["id"], ["day"])
        assert added.count() == (10 if k == 0 else 5)
        store.commit()
    assert {len(fs) for fs in store.entries()["t"].buckets.values()} == {4}
    assert store.compact("t", ["day"], most=3) == 1 and store.compact("t", ["day"], most=3) == 0
    store.commit()
    assert store.read("t").count() == 25
    with pytest.raises(ValueError, match="more than once"):
        store.upsert("t", make(spark, (1, "d", 1, ""), (1, "d", 2, "")), ["id"], ["value"], ["day"])
    none = make(spark, (1, "d", 1, "")).limit(0)
    assert store.append("t", none, ["id"], ["day"]).count() == 0
    store.upsert("t", none, ["id"], ["value"], ["day"])
    assert store.read("t").count() == 25


def test_loads_equal_one_build(spark, tmp_path):
    def event(i, system, day, **payload):
        return (i, f"{system}_business.csv", system, {"timestamp": f"2024-03-{day:02d} 05:00:00", "machine_id": f"M{i % 3}", **payload})

    events = [event(i, "mes", i % 4 + 1, good_qty=str(i), actual_production_qty=str(i + 1), plant_id="P1", defect_type="Scratch" if i % 2 else "scratch")
              for i in range(30)]
    events += [event(100 + i, "energie", i % 6 + 1, energy_consumption_kwh=f"{i}.5") for i in range(30)]
    events += [event(200 + i, "scada_capteurs", i % 5 + 1, Temperature_C=str(40 + i), predicted_failure_probability="0.9") for i in range(30)]
    events += [event(300, "factories", 1, factory_id="P1", factory_name="Alpha"), event(301, "factories", 9, factory_id="P1", factory_name="Beta")]
    events += [(400, "scada_capteurs_business.csv", "scada_capteurs", {"timestamp": "", "machine_id": "M1"})]
    bronze = spark.createDataFrame(events, "bronze_event_id long, source_file string, source_system string, payload map<string,string>")
    hashed = bronze.withColumn("payload_hash", F.md5(F.col("bronze_event_id").cast("string")))
    house = Warehouse(spark, str(tmp_path / "house"), 2)
    # The second load holds rows of the first again, and the energy of days whose production came before.
    counts = [house.load(hashed.where(p)) for p in ("bronze_event_id % 2 = 0 OR bronze_event_id >= 300", "true")]
    assert [c["bronze"] for c in counts] == [48, 45]
    gold = M.build_gold(bronze)
    for name, want in gold.items():
        if name == "dim_defect":
            # Insert-only: the first load's spelling stays.
            assert house.read(name).count() == want.count()
            continue
        assert sorted(map(repr, map(tuple, house.read(name).select(want.columns).collect()))) == sorted(map(repr, map(tuple, want.collect()))), name
    health = M.machine_health_daily(M.bronze_to_silver(bronze))
    assert sorted(map(repr, house.read("machine_health_daily").collect())) == sorted(map(repr, health.collect()))
    assert house.read("fact_energy").where("energy_per_good_piece IS NOT NULL").count() > 0
    assert set(S.FACT_UPDATE_COLUMNS) <= set(house.store.entries())
