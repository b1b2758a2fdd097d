"""A category of many values costs trees and the perceptron a column a bit, not a column a value."""

import pytest
from pyspark.ml.functions import vector_to_array

from millwright.ml import features as L
from millwright.ml import train as R


def rows_of(spark, machines=40):
    rows = [(f"S{i % machines}", i % 2 * "x" or None, float(i), float(i % 3 == 0)) for i in range(4 * machines)]
    return spark.createDataFrame([*rows, (None, "y", None, 1.0)], "machine string, status string, level double, label double")


def test_every_value_has_a_code_of_its_own(spark):
    train = rows_of(spark)
    ready = L.preprocessor(train, ["level"], ["machine", "status"], onehot=8)(rows_of(spark, 41))
    assert len(ready.first()["features"]) == 1 + 40 + 2
    # 40 values in 6 bits; the status has few and keeps a column a value.
    assert len(ready.first()["narrow"]) == 1 + 6 + 2
    codes = {(r["machine"], tuple(r["v"][1:7])) for r in ready.select("machine", vector_to_array("narrow").alias("v")).collect()}
    assert len(codes) == len({c for _, c in codes}) == 41
    assert ("S40", (0.0,) * 6) in codes and all(any(c) for m, c in codes if m != "S40")


def test_few_values_keep_a_column_each(spark):
    ready = L.preprocessor(rows_of(spark), ["level"], ["machine", "status"])(rows_of(spark))
    assert "narrow" not in ready.columns and L.narrow_column(ready) == "features"


@pytest.mark.parametrize("fit", [
    R.decision_tree, lambda df: R.forest_classifier(df, 2, 3), lambda df: R.forest_regressor(df, 2, 3),
    lambda df: R.boosted_classifier(df, 2), lambda df: R.boosted_regressor(df, 2), lambda df: R.perceptron(df, (2,), 2, balanced=True),
])
def test_width_of_learners_grows_with_bits(spark, fit):
    train = rows_of(spark)
    ready = L.preprocessor(train, ["level"], ["machine", "status"], onehot=8)(train).select("label", "features", "narrow")
    model = fit(ready)
    assert model.numFeatures == 9
    assert model.transform(ready).select("prediction").where("prediction is null").count() == 0


@pytest.mark.parametrize("fit", [R.forest_classifier, R.forest_regressor])
def test_forests_keep_the_node_of_every_row(spark, fit):
    train = rows_of(spark)
    ready = L.preprocessor(train, ["level"], ["machine", "status"], onehot=8)(train)
    assert fit(ready, 2, 3).getOrDefault("cacheNodeIds")


def test_a_model_runs_once_for_all_metrics(spark):
    runs = spark.sparkContext.accumulator(0)

    def score(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    scored = spark.createDataFrame([(1.0, 0.9), (0.0, 0.2), (1.0, 0.4)], "label double, risk_score double")
    once = R.scored_once(scored.mapInPandas(score, scored.schema), "risk_score")
    assert R.classification_metrics(once, "label", "risk_score").first()["precision"] == 1.0
    assert runs.value == 3
