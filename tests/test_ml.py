"""Metrics against direct computation, splits, preparation and trainers on small data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from millwright.ml import features as L
from millwright.ml import scoring as C
from millwright.ml import train as R
from millwright.operators import curves as K


def scored(seed, n=80):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({"label": rng.integers(0, 2, n), "score": rng.integers(0, 12, n) / 12})


def at(pdf, cut):
    hit, true = pdf["score"] >= cut, pdf["label"] == 1
    tp, fp, fn = (hit & true).sum(), (hit & ~true).sum(), (~hit & true).sum()
    return tp / max(tp + fp, 1), tp / max(tp + fn, 1)


@pytest.mark.parametrize("rows", [None, 5])
@pytest.mark.parametrize("seed", [0, 1])
def test_rank_metrics(spark, seed, rows):
    pdf = scored(seed)
    df = spark.createDataFrame(pdf)
    got = K.rank_metrics(df, "label", "score", rows).first()
    pos, neg = pdf.loc[pdf["label"] == 1, "score"], pdf.loc[pdf["label"] == 0, "score"]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert got["roc_auc"] == pytest.approx(wins / len(pos) / len(neg))
    cuts = sorted(pdf["score"].unique(), reverse=True)
    recall, area = 0.0, 0.0
    for c in cuts:
        p, r = at(pdf, c)
        area, recall = area + (r - recall) * p, r
    assert got["pr_auc"] == pytest.approx(area)
    f1 = {c: 2 * p * r / (p + r + 1e-12) for c in cuts for p, r in [at(pdf, c)]}
    best = min(c for c in cuts if f1[c] == max(f1.values()))
    assert K.best_threshold(df, "label", "score", rows).first()["threshold"] == best


def test_threshold_metrics_without_hits(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2)], "label int, score double")
    assert tuple(K.threshold_metrics(df, "label", "score", 0.9).first()) == (0, 0, 0, 0.5)
    assert K.best_threshold(df.limit(0), "label", "score").first()["threshold"] == 0.5


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 3.0)], "y double, p double")
    r = K.regression_metrics(df, "y", "p").first()
    assert (r["mae"], r["rmse"], r["r2"]) == pytest.approx((4 / 3, (10 / 3) ** 0.5, 1 - 10 / 14))


@pytest.mark.parametrize("rows", [None, 6])
def test_profile_and_scaling(spark, rows):
    pdf = pd.DataFrame({"a": [1.0, np.nan, 4, 9, np.nan, 2], "b": [5.0] * 6})
    df = spark.createDataFrame([tuple(None if np.isnan(x) else float(x) for x in r) for r in pdf.values], "a double, b double")
    profile = L.numeric_profile(df, ["a", "b"], rows)
    got = {r["feature"]: r for r in profile.collect()}
    filled = pdf["a"].fillna(pdf["a"].median())
    assert (got["a"]["median"], got["a"]["mean"], got["a"]["deviation"]) == pytest.approx((3.0, filled.mean(), filled.std(ddof=0)))
    out = L.impute_scale(df, profile).toPandas()
    np.testing.assert_allclose(sorted(out["a"]), sorted((filled - filled.mean()) / filled.std(ddof=0)))
    assert set(out["b"]) == {0.0}


def test_unknown_category_encodes_to_zeros(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([("b",), ("a",)], "c string")
    model = Pipeline(stages=L.onehot_stages(["c"])).fit(train)
    got = [r["c_onehot"].toArray().tolist() for r in model.transform(spark.createDataFrame([("a",), ("b",), ("z",)], "c string")).collect()]
    assert got == [[1, 0], [0, 1], [0, 0]]


def test_most_frequent_prefers_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert L.most_frequent(df, "c").first()["value"] == "a"


@pytest.mark.parametrize("rows", [None, 30])
def test_stratified_split_is_exact_per_class(spark, rows):
    df = spark.range(200).select("id", (F.col("id") < 190).cast("int").alias("label"))
    out = L.stratified_split(df, "id", "label", rows=rows)
    got = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert got == {(1, "test"): 38, (1, "train"): 152, (0, "test"): 2, (0, "train"): 8}


def test_build_xy(spark):
    from millwright import schemas as S

    row = {c: F.lit(1.0) for c in [*S.NUMERIC_FEATURES, *S.LEAKY_FEATURES]} | {c: F.lit("x") for c in S.CATEGORICAL_FEATURES}
    df = spark.range(2).withColumns(row).withColumns({S.TARGET_CLF: F.lit(1), S.TARGET_REG: F.when(F.col("id") == 0, 5.0)})
    assert L.build_xy(df, "reg").count() == 1 and L.build_xy(df, "clf").count() == 2
    assert not set(S.LEAKY_FEATURES) & set(L.build_xy(df, "clf").columns)
    assert "machine_id" not in L.build_xy(df, "clf", include_machine_id=False).columns
    with pytest.raises(ValueError):
        L.build_xy(df, "other")
    with pytest.raises(ValueError):
        L.check_contract(df, ["nope"])


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0.6).astype(float)
    rul = 100 + 20 * x[:, 0] - 10 * x[:, 2]
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y, "rul": rul, "machine_id": "M1"})
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(spark.createDataFrame(pdf))
    return df.withColumn("id", F.monotonically_increasing_id()).cache()


def test_classifiers_learn(spark, blobs):
    ranked, models = R.compare_models(blobs, blobs, "clf", 10)
    rows = ranked.collect()
    assert {r["model"] for r in rows} == set(R.CLASSIFIERS) and min(r["roc_auc"] for r in rows) > 0.9
    assert [r["f1"] for r in rows] == sorted((r["f1"] for r in rows), reverse=True)
    states = C.score_state(models["LogisticRegression"], blobs)
    assert {r["state"] for r in states.collect()} == {"normal", "at_risk"}


def test_ridge_penalty_matches_the_closed_form(spark, blobs):
    pdf = blobs.toPandas()
    x = pdf[["a", "b", "c"]].to_numpy()
    y = pdf["rul"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(3), xc.T @ yc)
    model = R.ridge(blobs.withColumn("label", F.col("rul")), alpha=5.0)
    np.testing.assert_allclose(model.coefficients.toArray(), want, rtol=1e-6)


def test_logistic_penalty_is_stationary(spark, blobs):
    """At the fit, the weighted log-loss gradient times C equals minus the coefficients."""
    c = 0.5
    model = R.logistic(blobs, c)
    pdf = blobs.toPandas()
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["label"].to_numpy()
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    np.testing.assert_allclose(c * (weight * (p - y)) @ x, -w, atol=1e-2)


def test_rul_scores_are_clamped_and_null_safe(spark, blobs):
    df = blobs.withColumn("label", F.col("rul") - 100)
    out = C.score_rul(R.ridge(df, 0.0), df.withColumn("machine_id", F.when(F.col("id") > 0, F.col("machine_id"))), ["machine_id"])
    values = [r["remaining_useful_life_days"] for r in out.collect()]
    assert min(v for v in values if v is not None) == 0 and values.count(None) == 1


def test_anomalies_stand_out(spark, blobs):
    medians = {"a": 0.0, "b": 0.0, "c": 0.0}
    model = R.fit_anomaly_model(blobs.filter("label = 0"), ["a", "b", "c"], medians, parts=2)
    odd = blobs.limit(1).withColumns({"a": F.lit(50.0), "b": F.lit(-50.0), "c": F.lit(50.0)})
    assert model.score(odd).first()["is_anomaly"]
    share = model.score(blobs.filter("label = 0")).agg(F.avg(F.col("is_anomaly").cast("int"))).first()[0]
    assert 0.03 < share < 0.08


def test_sequence_features(spark):
    df = spark.createDataFrame([([[1.0], [3.0], [5.0]],)], "sequence array<array<double>>")
    assert R.sequence_features(df, ["x"]).first()["features"].toArray().tolist() == [3.0, 5.0, 2.0]


def test_scoring_hook(spark):
    df = spark.createDataFrame([("M1", 0.2), ("M2", 0.9)], "machine_id string, x double")
    out = C.score_with(df, lambda p: pd.DataFrame({"risk_score": p["x"] * 2}), ["machine_id"], "risk_score double")
    assert {r["machine_id"]: r["risk_score"] for r in out.collect()} == {"M1": 0.4, "M2": 1.8}


def test_medians_from_brackets(spark):
    """Few distinct values, a heavy one, gaps, values that are not numbers, one row, none."""
    import statistics

    rng = np.random.default_rng(11)
    columns = {
        "a": list(rng.normal(size=501)), "b": [1.0] * 400 + [2.0] * 101, "c": [None] * 450 + list(rng.normal(size=51)),
        "d": [float(x) for x in rng.integers(0, 2, 501)], "e": [3.5] + [None] * 500, "f": [None] * 501,
        "g": [float("nan")] * 240 + [float(x) for x in range(261)], "h": [-1e300] * 250 + [1e300] * 251,
    }
    df = spark.createDataFrame([tuple(float(v) if v is not None else None for v in r) for r in zip(*columns.values())], ", ".join(f"{c} double" for c in columns))
    for rows in (None, 5):
        got = {r.feature: r.median for r in L.numeric_profile(df, list(columns), rows).collect()}
        for c, values in columns.items():
            known = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
            assert got[c] == (statistics.median(known) if known else None), c
