"""A load leaves on disk what its tables hold, and nothing of the way there."""

import glob
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.catalog import medallion_queries as Q
from millwright.plans import medallion as M
from millwright.session import materialise, scratch_scope, shared_dir, tune
from millwright.sources.stored import Store


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_statement(spark, tmp_path):
    tune(spark)
    before = shuffle_files(spark)
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(f"{tmp_path}/out")
    assert not shuffle_files(spark) - before


def test_an_append_moves_whole_rows_once(spark, tmp_path, monkeypatch):
    hints = []
    keep = DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, name, *rest: hints.append(name) or keep(df, name, *rest))
    store = Store(spark, f"{tmp_path}/store", 4)
    make = lambda *ids: spark.createDataFrame([(i, f"d{i % 3}", i) for i in ids], "id long, day string, value int")
    store.append("a", make(1, 2, 2, 5), ["id"], ["day"])
    again = store.append("a", make(2, 3, 3, 5), ["id"], ["day"])
    assert hints == [] and [r.id for r in again.collect()] == [3]
    assert sorted(r.id for r in store.read("a").collect()) == [1, 2, 3, 5]


def test_stored_tables_are_packed_tightly(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store", 2)
    store.append("a", spark.range(5).withColumn("h", F.sha2(F.col("id").cast("string"), 256)), ["h"])
    assert all(f.endswith(".zstd.parquet") for f in glob.glob(f"{tmp_path}/store/a/**/*.parquet", recursive=True))


def test_two_loads_leave_the_warehouse_alone(spark):
    class Source:
        pass

    t = Source()
    t.spark = spark
    rows = [(i, "mes_business.csv", "mes", {"timestamp": f"199{7 + i % 2}-03-0{i % 4 + 1} 05:00:00", "machine_id": "M1", "good_qty": str(i)}) for i in range(20)]
    bronze = spark.createDataFrame(rows, "bronze_event_id long, source_file string, source_system string, payload map<string,string>")
    folder = f"{shared_dir(spark)}/millwright"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    house = Q.two_loads(t, bronze, Q.EARLY.format("1998"), *Q.fact_steps("fact_production"))
    assert house.read("fact_production").count() == 20
    assert {n.split("-")[0] for n in set(os.listdir(folder)) - before} == {"warehouse"}
    assert house.store.sweep() == 0
    want = M.fact_production(M.staging(bronze))
    assert sorted(map(repr, house.read("fact_production").collect())) == sorted(map(repr, want.collect()))


def test_the_inner_of_two_empty_scopes_ends(spark):
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as inner:
            pass
        materialise(spark.range(2), "kept")
        assert len(outer) == 1 and inner == []
