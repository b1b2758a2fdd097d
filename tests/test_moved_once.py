"""Whole rows move and are written once in stored tables."""

from pyspark.sql import functions as F

from millwright.sources import stored
from millwright.sources.stored import Store


def test_rows_are_not_written_aside(spark, tmp_path, monkeypatch):
    """An append writes its rows once, and an upsert of stored rows too."""
    aside = []
    keep = stored.materialise
    monkeypatch.setattr(stored, "materialise", lambda df, name: aside.append(name) or keep(df, name))
    store = Store(spark, f"{tmp_path}/store", 4)
    make = lambda *ids: spark.createDataFrame([(i, f"d{i % 3}", i) for i in ids], "id long, day string, value int")
    store.append("a", make(1, 2, 2), ["id"], ["day"])
    again = store.append("a", make(2, 3, 3), ["id"], ["day"])
    assert [r.id for r in again.collect()] == [3] and aside == []
    store.upsert("u", make(1, 2), ["id"], ["value"], stored=True)
    store.upsert("u", make(2, 3).withColumn("value", F.lit(9)), ["id"], ["value"], stored=True)
    assert sorted(map(tuple, store.read("u").collect())) == [(1, "d1", 1), (2, "d2", 9), (3, "d0", 9)] and aside == []
