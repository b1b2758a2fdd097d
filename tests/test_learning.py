"""The learning queries run the whole job: all features, full sizes, windows that give rows."""

import os

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from millwright import schemas as S
from millwright.catalog import ml_queries as M
from millwright.catalog.bind import Tables
from millwright.ml import train as R

FOLDER = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def blobs_of(spark, seed=0, noise=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(200, 2))
    y = x[:, 0] + noise * rng.normal(size=200) > 0
    rows = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


@needs_data
def test_all_features_are_used(spark):
    t = Tables(spark, FOLDER)
    train, _, _ = M.prepared(t)
    machines = train.where("machine_id is not null").select("machine_id").distinct().count()
    assert len(train.first()["features"]) == 13 + machines + 2
    assert M.learning(t).where("machine_id is null").count() == sum(p.where("machine_id is null").count() for p in M.prepared(t))


@needs_data
def test_sequences_give_rows(spark, monkeypatch):
    seen = {}

    def linear(train, rounds=100):
        seen.update(width=len(train.first()["features"]), rounds=rounds)
        return R.ridge(train)

    monkeypatch.setattr(R, "boosted_regressor", linear)
    assert M._score_sequence(Tables(spark, FOLDER)).count() > 0
    assert seen == {"width": 3 * 13, "rounds": 100}


@needs_data
def test_business_columns_are_all_known(spark):
    context = M.business_context(Tables(spark, FOLDER))
    assert context.columns == ["machine_id", *S.BUSINESS_CATEGORICALS]
    assert context.count() == context.select("machine_id").distinct().count() > 0
    assert all(context.where(f"{c} is not null").count() > 0 for c in S.BUSINESS_CATEGORICALS)


def test_sizes_are_the_references(spark, monkeypatch):
    calls = {}
    for name in ("forest_classifier", "boosted_classifier", "forest_regressor", "boosted_regressor"):
        monkeypatch.setattr(R, name, lambda df, _name=name, **size: calls.update({_name: size}) or R.ridge(df))
    for trainer in [*R.CLASSIFIERS.values(), *R.REGRESSORS.values()][2:]:
        trainer(blobs_of(spark), None)
    assert calls == {
        "forest_classifier": {"trees": 200}, "boosted_classifier": {"rounds": 100},
        "forest_regressor": {"trees": 300}, "boosted_regressor": {"rounds": 100},
    }


def test_patience_returns_the_best_round(spark):
    held = blobs_of(spark, 1, noise=1.5)
    train = blobs_of(spark, 0, noise=1.5)
    full = R.boosted_classifier(train, 12, 3, 0.5, positive_weight=2.0)
    losses = full.evaluateEachIteration(held.selectExpr("*", "if(label = 1, 2.0D, 1.0D) AS weight"))
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= 3:
            break
    got = R.boosted_classifier(train, 12, 3, 0.5, held, 2.0, patience=3)
    assert got.getNumTrees == best + 1 < 12
    assert [t.toDebugString.split("\n", 1)[1] for t in got.trees] == [t.toDebugString.split("\n", 1)[1] for t in full.trees[: best + 1]]


def test_pr_auc_of_every_round(spark):
    held = blobs_of(spark, 1, noise=1.5).selectExpr("*", "if(label = 1, 2.0D, 1.0D) AS weight")
    model = R.boosted_classifier(blobs_of(spark, 0, noise=1.5), 8, 3, 0.5, rows=0.8, columns=0.8, least=5)
    got = R.pr_auc_by_round(model, held)
    want = []
    for n in range(1, 9):
        short = R.first_rounds(model, n)
        assert short.getNumTrees == n
        rows = [(r.risk_score, r.label, r.weight) for r in R.risk_scores(short, held).collect()]
        # Scores of one bin tie, as they do in the operator.
        levels = sorted({int(4096 * s) for s, *_ in rows}, reverse=True)
        found = seen = area = 0.0
        for level in levels:
            here = [(y, w) for s, y, w in rows if int(4096 * s) == level]
            hits = sum(w for y, w in here if y == 1)
            found, seen = found + hits, seen + sum(w for _, w in here)
            area += hits * found / seen
        want.append(area / sum(w for _, y, w in rows if y == 1))
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_patience_watches_pr_auc(spark):
    held, train = blobs_of(spark, 1, noise=1.5), blobs_of(spark, 0, noise=1.5)
    full = R.boosted_classifier(train, 20, 3, 0.5, rows=0.8)
    areas = R.pr_auc_by_round(full, held.selectExpr("*", "1.0D AS weight"))
    best = 0
    for i, area in enumerate(areas):
        if area > areas[best]:
            best = i
        elif i - best >= 4:
            break
    got = R.boosted_classifier(train, 20, 3, 0.5, held, patience=4, watch="pr_auc", rows=0.8)
    assert got.getNumTrees == best + 1


def rare_of(spark, seed):
    """One row in ten is positive, and the classes overlap."""
    rng = np.random.default_rng(seed)
    rows = [(float(rng.normal() + (1.2 if k % 10 == 0 else 0)), float(rng.normal()), float(k % 10 == 0)) for k in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_balanced_rows_change_the_network(spark):
    train = rare_of(spark, 3)
    counts = {r["label"]: r["count"] for r in R.balanced_rows(train).groupBy("label").count().collect()}
    assert counts == {0.0: 360, 1.0: 360}
    odd = train.where("label = 0").limit(100).unionByName(train.where("label = 1"))
    counts = {r["label"]: r["count"] for r in R.balanced_rows(odd).groupBy("label").count().collect()}
    assert counts[0.0] == 100 and 80 <= counts[1.0] <= 120
    assert R.balanced_rows(train.where("label = 0")).count() == 360
    plain, even = (R.perceptron(train, (4,), 30, balanced=b) for b in (False, True))
    found = [R.risk_scores(m, train).where("label = 1 AND risk_score >= 0.5").count() for m in (plain, even)]
    assert found[1] > found[0] + 10


def test_network_stops_on_validation(spark, monkeypatch):
    train, held = rare_of(spark, 4), rare_of(spark, 5)
    areas = iter([0.2, 0.5, 0.4, 0.45, 0.9])
    seen = []

    class Fixed:
        def first(self):
            return {"pr_auc": next(areas)}

    monkeypatch.setattr(R, "rank_metrics", lambda df, *a: seen.append(df) or Fixed())
    model = R.perceptron(train, (4,), 50, held, step=5, patience=10, balanced=True)
    assert len(seen) == 4
    # The second step's weights: five rounds from scratch, then five more from there.
    one = R.perceptron(train, (4,), 5, balanced=True)
    assert not np.allclose(model.weights.toArray(), one.weights.toArray())
