"""Independent models are fitted side by side."""

import threading

import pytest
from pyspark.ml.feature import VectorAssembler

from millwright.ml import train as R


def test_models_are_fitted_side_by_side(spark, monkeypatch):
    rows = spark.createDataFrame([(float(i % 5), float(i % 2)) for i in range(40)], "x double, label double")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    together = threading.Barrier(2)

    def slow(df, size):
        together.wait(60)  # breaks unless both fits are under way at once
        return R.ridge(df, 0.0 if size is None else size)

    monkeypatch.setattr(R, "REGRESSORS", {"one": slow, "two": slow})
    ranked, fitted = R.compare_models(rows, rows, "reg")
    assert list(fitted) == ["one", "two"] and [r["model"] for r in ranked.collect()] == ["one", "two"]


def test_a_failing_fit_is_an_error(spark, monkeypatch):
    def broken(df, size):
        raise ValueError("no fit")

    monkeypatch.setattr(R, "REGRESSORS", {"one": broken})
    with pytest.raises(ValueError, match="no fit"):
        R.compare_models(spark.range(1), spark.range(1), "reg")
