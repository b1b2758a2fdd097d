"""Learning queries store only what their models read, measures as doubles."""

import pytest
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.catalog import ml_queries as M
from millwright.catalog.bind import Tables
from millwright.ml import features as L


@pytest.fixture
def tables(spark, tmp_path):
    spark.range(120).selectExpr(
        "id AS event_id", "timestamp_ntz '1997-05-28 10:00:00' + make_dt_interval(0, 0, CAST(id AS int)) AS ts", "id % 12 AS user_id",
        "element_at(array('error', 'view', 'click'), CAST(1 + id % 3 AS int)) AS event_type", "CAST(id % 95 AS double) AS value",
        "concat('{\"k\": ', id % 100, '}') AS props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    return Tables(spark, str(tmp_path))


def test_learning_stores_doubles_equal_to_the_measures(tables):
    stored = dict(M.learning(tables).dtypes)
    assert {stored[c] for c in [*M.NUMERIC, S.TARGET_REG]} == {"double"} and "quality_status" in stored
    measures = [F.col(c).cast("double").alias(c) for c in dict.fromkeys([*M.NUMERIC, S.TARGET_REG])]
    plain = tables.silver().select("bronze_event_id", *measures)
    assert sorted(map(str, M.learning(tables).select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_only_asked_vectors_and_splits_are_stored(tables, monkeypatch):
    real = L.preprocessor
    monkeypatch.setattr(L, "preprocessor", lambda *given: real(*given, onehot=4))
    whole = M.prepared(tables)
    train, test = M.prepared(tables, vectors=["narrow"], splits=["train", "test"])
    assert "features" not in train.columns and "narrow" not in M.prepared(tables, vectors=["features"])[0].columns
    for few, every in ((train, whole[0]), (test, whole[2])):
        assert sorted(map(str, few.collect())) == sorted(map(str, every.select(*few.columns).collect())) != []


def test_without_a_narrow_vector_the_features_take_its_place(tables):
    assert "features" in M.prepared(tables, vectors=["narrow"], splits=["train"])[0].columns
