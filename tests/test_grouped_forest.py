"""A forest of more nodes than the driver takes is fitted and kept a group of trees at a time."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from millwright.ml import train as R


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    label = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(c)) for r, c in zip(x, label)], "a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).select("features", "label").cache()


@pytest.mark.parametrize("fit, column", [(R.forest_classifier, "probability"), (R.forest_regressor, "prediction")])
def test_a_large_forest_is_fitted_in_groups(rows, monkeypatch, fit, column):
    whole = fit(rows, 10, 5)
    nodes = [t.numNodes for t in whole.trees]
    monkeypatch.setattr(R, "FOREST_NODES", 3 * max(nodes))
    model = fit(rows, 10, 5)
    assert isinstance(model, R.GroupedForest) and model.trees == 10 and len(model.groups) >= 3 and model.numFeatures == 3
    groups = [model.kind.load(path) for path, _, _ in model.groups]
    assert [g.getNumTrees for g in groups] == [n for _, n, _ in model.groups]
    assert [R._nodes(g) for g in groups] == [n for _, _, n in model.groups]
    # The groups that are fitted or held at a time stay near the bound, which the size of the first trees sets.
    assert all(len(some) * max(g[2] for g in model.groups[1:]) <= 1.5 * R.FOREST_NODES for some in model._rounds() if len(some) > 1)
    # No group repeats the trees of another.
    assert len({t.toDebugString.split("\n", 1)[1] for g in groups for t in g.trees}) == 10
    # The answer is that of all trees together.
    got = model.transform(rows).select("features", "label", column, "prediction").collect()
    each = [t for g in groups for t in g.trees]
    for r in got[:25]:
        if column == "probability":
            votes = np.mean([t.predictProbability(r["features"]).toArray() for t in each], axis=0)
            assert np.allclose(r["probability"].toArray(), votes) and r["prediction"] == float(votes[1] > votes[0])
        else:
            assert np.isclose(r["prediction"], np.mean([t.predict(r["features"]) for t in each]))
    assert len(got) == 400


def test_a_forest_that_fits_is_fitted_whole(rows, monkeypatch):
    whole = R.forest_classifier(rows, 8, 4)
    monkeypatch.setattr(R, "FOREST_NODES", R._nodes(whole) * 2)
    again = R.forest_classifier(rows, 8, 4)
    assert not isinstance(again, R.GroupedForest) and again.toDebugString.split("\n", 1)[1] == whole.toDebugString.split("\n", 1)[1]


def test_no_more_fits_side_by_side_than_told(spark):
    import threading
    import time

    running, most, lock = [0], [0], threading.Lock()

    def step():
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.05)
        with lock:
            running[0] -= 1
        return most[0]

    assert len(R.at_once(spark, [step] * 9, 3)) == 9 and most[0] <= 3
