"""Learning tables, metrics, trainers and scoring over the sensor readings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.catalog import enrich_queries as E
from millwright.catalog import oracle as Q
from millwright.catalog.registry import query
from millwright.functions import health as H
from millwright.ml import features as L
from millwright.ml import scoring as C
from millwright.ml import train as R
from millwright.operators import curves as K
from millwright.operators import ordered as O
from millwright.session import materialise

NUMERIC = S.NUMERIC_FEATURES
#: Machines of the reference; sequences fold the users onto as many, so that each has windows in every split.
MACHINES = 8
NINE = 9


# ------------------------------------------------------------------ tables
def scored_events(t):
    """A label and a score per event: errors against a mix of content and value."""
    return t.events().select(
        "event_id", (F.col("event_type") == "error").cast("int").alias("label"),
        (F.col("k") / 100).alias("score"), "k", "value", "ts", "user_id",
    )


SCORED = {"scored": "SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, k / 100.0::DOUBLE AS score, k, value, ts, user_id FROM ev"}
COUNTS = {
    **SCORED,
    "per_score": "SELECT score AS threshold, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM scored GROUP BY 1",
    "points": """SELECT threshold, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
      CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n FROM per_score WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)""",
}
AP = "sum(CAST(pos AS DOUBLE) / p * (CAST(tp AS DOUBLE) / (tp + fp)))"
AUC = "sum(neg * (tp - pos / 2.0::DOUBLE) / (CAST(p AS DOUBLE) * n))"


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, NINE) for c in columns})


@query(
    "curve_points",
    Q.sql("SELECT threshold, tp, fp, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / p AS recall, CAST(fp AS DOUBLE) / n AS fpr FROM points", **COUNTS),
)
def _points(t):
    return K.curve_points(scored_events(t), "label", "score").select("threshold", "tp", "fp", "precision", "recall", "fpr")


@query("curve_points_chunked", Q.sql("SELECT value AS threshold, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS tp, row_number() OVER w - CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS fp FROM one WINDOW w AS (ORDER BY value DESC)",
       one="SELECT value + event_id / 1000000.0::DOUBLE AS value, event_type FROM events"))
def _points_chunked(t):
    """Nearly every score is distinct here, and the running counts cross chunks."""
    df = t.read("events").select((F.col("event_type") == "error").cast("int").alias("label"), (F.col("value") + F.col("event_id") / F.lit(1000000.0)).alias("score"))
    return K.curve_points(df, "label", "score", rows=1500).select("threshold", "tp", "fp")


@query("average_precision", Q.sql(f"SELECT round({AP}, 9) AS pr_auc FROM points", **COUNTS))
def _ap(t):
    return rounded(K.rank_metrics(scored_events(t), "label", "score").select("pr_auc"), "pr_auc")


@query("roc_auc", Q.sql(f"SELECT round({AUC}, 9) AS roc_auc FROM points", **COUNTS))
def _auc(t):
    return rounded(K.rank_metrics(scored_events(t), "label", "score").select("roc_auc"), "roc_auc")


F1 = "2.0::DOUBLE * (CAST(tp AS DOUBLE) / (tp + fp)) * (CAST(tp AS DOUBLE) / p) / ((CAST(tp AS DOUBLE) / (tp + fp)) + (CAST(tp AS DOUBLE) / p) + 1e-12)"


@query("pr_curve_threshold", Q.sql(f"SELECT threshold, round({F1}, 9) AS f1 FROM points ORDER BY {F1} DESC, threshold LIMIT 1", **COUNTS))
def _threshold(t):
    return rounded(K.best_threshold(scored_events(t), "label", "score"), "f1")


AT = """SELECT CAST(sum(CASE WHEN score >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp, CAST(sum(CASE WHEN score >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN score < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn, CAST(sum(CASE WHEN (score >= 0.5) = (label = 1) THEN 1 ELSE 0 END) AS DOUBLE) AS ok, count(*) AS c FROM scored"""


@query(
    "clf_metrics",
    Q.sql(
        f"""SELECT round((SELECT {AP} FROM points), 9) AS pr_auc, round((SELECT {AUC} FROM points), 9) AS roc_auc, round(2 * tp / (2 * tp + fp + fn), 9) AS f1,
        round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(ok / c, 9) AS accuracy FROM cut""",
        cut=AT, **COUNTS,
    ),
)
def _clf(t):
    out = K.classification_metrics(scored_events(t), "label", "score")
    return rounded(out, *out.columns)


@query("confusion_matrix", Q.sql("SELECT label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM scored GROUP BY 1, 2", **SCORED))
def _confusion(t):
    return K.confusion_matrix(scored_events(t), "label", "score", 0.5)


@query(
    "reg_metrics",
    """SELECT round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2
       FROM (SELECT l_quantity AS y, l_quantity - l_extendedprice / 2000 AS e FROM lineitem)""",
)
def _reg(t):
    df = t.read("lineitem").select("l_quantity", (F.col("l_extendedprice") / 2000).alias("guess"))
    out = K.regression_metrics(df, "l_quantity", "guess")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("residuals", "SELECT o_orderkey, o_totalprice - 250000.0::DOUBLE AS residual FROM orders")
def _residuals(t):
    df = t.read("orders").select("o_orderkey", "o_totalprice", F.lit(250000.0).alias("guess"))
    return K.residuals(df, "o_totalprice", "guess").select("o_orderkey", "residual")


# ------------------------------------------------------------------ preparation
def numbers(t):
    k = F.col("k")
    return t.events().select("event_id", F.when(k > 20, F.col("value")).alias("value"), F.when(k < 70, k.cast("double")).alias("level"))


FEATURES = ["value", "level"]
MOMENTS = {
    "numbers": "SELECT event_id, CASE WHEN k > 20 THEN value END AS value, CASE WHEN k < 70 THEN CAST(k AS DOUBLE) END AS level FROM ev",
    "filled": "SELECT event_id, coalesce(value, (SELECT median(value) FROM numbers)) AS value, coalesce(level, (SELECT median(level) FROM numbers)) AS level FROM numbers",
}


@query(
    "numeric_profile",
    Q.sql(
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, (SELECT median({f}) FROM numbers) AS median, round(avg({f}), 6) AS mean, round(stddev_pop({f}), 6) AS deviation FROM filled" for f in FEATURES
        ),
        **MOMENTS,
    ),
)
def _profile(t):
    out = L.numeric_profile(numbers(t), FEATURES)
    return out.withColumns({"mean": F.round("mean", 6), "deviation": F.round("deviation", 6)})


@query(
    "impute_scale",
    Q.sql(
        "SELECT event_id, " + ", ".join(f"round(({f} - (SELECT avg({f}) FROM filled)) / (SELECT stddev_pop({f}) FROM filled), 6) AS {f}" for f in FEATURES) + " FROM filled",
        **MOMENTS,
    ),
)
def _scale(t):
    df = numbers(t)
    out = L.impute_scale(df, L.numeric_profile(df, FEATURES))
    return out.select("event_id", *[F.round(f, 6).alias(f) for f in FEATURES])


@query(
    "impute_onehot",
    Q.sql(
        """SELECT event_id, kind, CAST((SELECT count(DISTINCT c.kind) FROM cats c WHERE c.kind < f.kind) AS DOUBLE) AS kind_index, CAST(1 AS BIGINT) AS ones FROM full_cats f""",
        cats="SELECT event_id, CASE WHEN k > 30 THEN event_type END AS kind FROM ev",
        full_cats="SELECT event_id, coalesce(kind, (SELECT kind FROM cats WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)) AS kind FROM cats",
    ),
)
def _onehot(t):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    df = t.events().select("event_id", F.when(F.col("k") > 30, F.col("event_type")).alias("kind"))
    filled = L.impute_mode(df, L.fit_modes(df, ["kind"]))
    out = Pipeline(stages=L.onehot_stages(["kind"])).fit(filled).transform(filled)
    ones = F.aggregate(vector_to_array("kind_onehot"), F.lit(0.0), lambda a, v: a + v).cast("long")
    return out.select("event_id", "kind", "kind_index", ones.alias("ones"))


@query("class_weights", "SELECT toxic AS label, count(*) AS n, CAST((SELECT count(*) FROM labels) AS DOUBLE) / (count(*) * 2) AS weight, (SELECT CAST(sum(1 - toxic) AS DOUBLE) / greatest(sum(toxic), 1) FROM labels) AS scale_pos_weight FROM labels GROUP BY toxic")
def _weights(t):
    return L.class_weights(t.read("labels").withColumnRenamed("toxic", "label"))


LOT = "CAST('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 13) AS BIGINT)"


def split_sql(part):
    p = f"PARTITION BY {part} " if part else ""
    return f"""SELECT event_id, CASE WHEN r <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (
      SELECT event_id, row_number() OVER ({p}ORDER BY lot, event_id) AS r, CAST(count(*) OVER ({p.strip()}) AS DOUBLE) AS n
      FROM (SELECT event_id, event_type, {LOT.format(k='event_id')} AS lot FROM events))"""


@query("stratified_split", split_sql("event_type"))
def _stratified(t):
    return L.stratified_split(t.read("events"), "event_id", "event_type").select("event_id", "split")


@query("random_split", split_sql(""))
def _random(t):
    return L.stratified_split(t.read("events"), "event_id", rows=1500).select("event_id", "split")


@query(
    "split_profile",
    Q.sql(
        f"""SELECT split, count(*) AS n_rows, {Q.ts_text('min(ts)')} AS first_ts, {Q.ts_text('max(ts)')} AS last_ts, count(DISTINCT user_id) AS machines,
        CAST(sum(label) AS DOUBLE) / count(*) AS failure_rate FROM (SELECT *, CASE WHEN r < floor(n * 0.7) THEN 'train' WHEN r < floor(n * 0.85) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS r, CAST(count(*) OVER () AS DOUBLE) AS n FROM scored)) GROUP BY split""",
        **SCORED,
    ),
)
def _split_profile(t):
    return L.split_profile(O.temporal_split(scored_events(t), "ts", "event_id"), "ts", "user_id", "label")


@query("feature_contract", Q.sql(f"SELECT machine_id, {Q.dbl('s_cycle_time_sec')} AS cycle_time_sec, {Q.dbl('s_temperature_c')} AS temperature_c, quality_status FROM silver"))
def _contract(t):
    return L.check_contract(t.silver(), S.READING_FIELDS).select("machine_id", "cycle_time_sec", "temperature_c", "quality_status")


@query("anomaly_flag", Q.sql("SELECT event_id, -(k - 50.0::DOUBLE) AS anomaly_score, -(k - 50.0::DOUBLE) >= 30 AS is_anomaly FROM ev"))
def _anomaly_flag(t):
    df = t.events().select("event_id", (F.col("k") - F.lit(50.0)).alias("raw"))
    return C.anomaly_flag(df, "raw", -30.0).drop("raw")


@query(
    "predictions_sorted",
    Q.sql("SELECT machine_id, rul_days AS predicted_rul_days, CASE WHEN rul_days > -1 AND rul_days <= 7 THEN 'urgent' WHEN rul_days > 7 AND rul_days <= 30 THEN 'high' WHEN rul_days > 30 AND rul_days <= 90 THEN 'medium' WHEN rul_days > 90 AND rul_days <= 365 THEN 'low' END AS maintenance_priority FROM predictions"),
)
def _sorted(t):
    df = t.predictions().select("machine_id", F.col("rul_days").alias("predicted_rul_days"))
    return df.withColumn("maintenance_priority", H.maintenance_priority(F.col("predicted_rul_days"))).orderBy("predicted_rul_days", "machine_id")


@query("model_ranking", Q.sql("SELECT 'by_' || event_type AS model, round(avg(abs(value - k)), 6) AS mae FROM ev GROUP BY event_type"))
def _ranking(t):
    metrics = t.events().groupBy(F.concat(F.lit("by_"), "event_type").alias("model")).agg(F.round(F.avg(F.abs(F.col("value") - F.col("k"))), 6).alias("mae"))
    return K.rank_models(metrics, "mae", higher_is_better=False)


@query("score_hook", Q.sql("SELECT event_id, least(1.0::DOUBLE, k / 100.0::DOUBLE) AS risk_score FROM ev"))
def _hook(t):
    """A user model applied batch by batch."""
    def predict(batch):
        import pandas as pd

        return pd.DataFrame({"risk_score": (batch["k"] / 100.0).clip(upper=1.0)})

    return C.score_with(t.events().select("event_id", "k"), predict, ["event_id"], "risk_score double")


# ------------------------------------------------------------------ trainers
def learning(t):
    """Readings with a failure label that depends on two measures.

    Only what models read is stored, and measures as the doubles they learn from: decimals of 38
    digits would be written, read and converted anew by every pass over the rows.
    """
    failing = F.coalesce((F.col("vibration_mms") > 5) & (F.col("temperature_c") < 50), F.lit(False))
    doubles = {c: F.col(c).cast("double") for c in dict.fromkeys([*NUMERIC, S.TARGET_REG])}
    kept = dict.fromkeys(["bronze_event_id", "event_ts", "machine_id", *S.CATEGORICAL_FEATURES, S.TARGET_CLF, *doubles])
    return materialise(t.silver().withColumns({S.TARGET_CLF: failing.cast("int"), **doubles}).select(*kept), "learning")


SPLITS = ("train", "val", "test")


def prepared(t, task="clf", categorical=tuple(S.CATEGORICAL_FEATURES), vectors=("features", "narrow"), splits=SPLITS):
    """(train, val, test) with a feature vector and a label, split by time.

    ``vectors`` and ``splits`` are those the caller reads; no others are made and stored. Where
    there is no narrow vector, the features take its place.
    """
    target = S.TARGET_CLF if task == "clf" else S.TARGET_REG
    df = learning(t).filter("event_ts is not null")
    if task == "reg":
        df = df.filter(F.col(target).isNotNull())
    df = O.temporal_split(df, "event_ts", "bronze_event_id").withColumn("label", F.col(target).cast("double"))
    apply = L.preprocessor(df.filter("split = 'train'"), NUMERIC, list(categorical))
    # The encoder's input has its gaps filled; the machine of a row without one stays null.
    ready = apply(df.withColumn("_machine", F.col("machine_id"))).withColumn("machine_id", F.col("_machine"))
    kept = dict.fromkeys(L.narrow_column(ready) if v == "narrow" else v for v in vectors)
    ready = ready.filter(F.col("split").isin(*splits)).select("bronze_event_id", "machine_id", "split", "label", *kept)
    ready = materialise(ready, "prepared")
    return [ready.filter(F.col("split") == s) for s in splits]


def report(name, scored):
    scored = R.scored_once(scored, "risk_score")
    return rounded(K.classification_metrics(scored, "label", "risk_score").select(F.lit(name).alias("model"), "*"), "pr_auc", "roc_auc", "f1")


@query("train_logreg")
def _logreg(t):
    """Balanced logistic regression; the threshold is tuned on the validation rows."""
    train, val, test = prepared(t, vectors=["features"])
    model = R.logistic(train)
    threshold = K.best_threshold(R.risk_scores(model, val), "label", "risk_score").first()["threshold"]
    tuned = K.threshold_metrics(R.risk_scores(model, test), "label", "risk_score", threshold)
    return report("logreg", R.risk_scores(model, test)).withColumn("tuned_f1", tuned.select("f1").scalar())


def errors(name, model, test):
    return K.regression_metrics(R.predicted_rul(model, test), "label", "predicted_rul_days").select(F.lit(name).alias("model"), "*")


@query("train_ridge")
def _ridge(t):
    train, test = prepared(t, "reg", vectors=["features"], splits=["train", "test"])
    return errors("ridge", R.ridge(train), test).unionByName(errors("linear", R.ridge(train, 0.0), test))


@query("train_tree")
def _tree(t):
    train, test = prepared(t, vectors=["narrow"], splits=["train", "test"])
    return report("tree", R.risk_scores(R.decision_tree(train), test))


@query("train_forest")
def _forest(t):
    train, test = prepared(t, vectors=["narrow"], splits=["train", "test"])
    return report("forest", R.risk_scores(R.forest_classifier(train), test))


@query("train_gbt")
def _gbt(t):
    """Sampled boosting, stopped on the PR-AUC of the validation rows, with weighted positives."""
    train, val, test = prepared(t, vectors=["narrow"])
    weight = L.class_weights(train).first()["scale_pos_weight"]
    model = R.boosted_classifier(train, 800, 5, 0.05, val, weight, patience=50, watch="pr_auc", rows=0.8, columns=0.8, least=5)
    return report("gbt", R.risk_scores(model, test))


@query("train_mlp")
def _mlp(t):
    """A network with balanced classes, stopped on the PR-AUC of the validation rows."""
    train, val, test = prepared(t, vectors=["narrow"])
    return report("mlp", R.risk_scores(R.perceptron(train, (128, 64), 120, val, balanced=True), test))


@query("feature_importance_top")
def _importance(t):
    (train,) = prepared(t, vectors=["narrow"], splits=["train"])
    model = R.decision_tree(train)
    attributes = train.schema[L.narrow_column(train)].metadata["ml_attr"]["attrs"]
    names = [a["name"] for a in sorted(chain(*attributes.values()), key=lambda a: a["idx"])]
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return K.top_importances(t.spark.createDataFrame(rows, "feature string, importance double"))


@query("compare_models")
def _compare(t):
    train, test = prepared(t, splits=["train", "test"])
    return R.compare_models(train, test, "clf")[0]


@query("compare_regressors")
def _compare_reg(t):
    train, test = prepared(t, "reg", splits=["train", "test"])
    return R.compare_models(train, test, "reg")[0]


def business_context(t):
    """The business columns of every machine; those the tables lack come from suppliers and parts."""
    parts = E.parts(t).select(F.col("product_id").alias("default_product_id"), "product_family")
    made = t.machines().select(
        F.concat(F.lit("S"), "s_suppkey").alias("old_machine_id"), F.concat(F.lit("maker "), F.col("n_name")).alias("manufacturer"),
        F.when(F.col("s_acctbal") >= 5000, "high").otherwise("normal").alias("criticality_level"),
        F.concat(F.lit("G"), F.col("s_suppkey") % 3).alias("machine_generation"),
    )
    context = E.mapping(t).join(parts, "default_product_id", "left").join(made, "old_machine_id", "left")
    return context.select(F.col("old_machine_id").alias("machine_id"), *S.BUSINESS_CATEGORICALS)


@query("clean_vs_business")
def _business(t):
    """RUL error with and without the business columns of the machine."""
    df = learning(t).filter(F.col(S.TARGET_REG).isNotNull()).join(business_context(t), "machine_id", "left")
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMERIC})
    split = L.stratified_split(filled.withColumn("label", F.col(S.TARGET_REG).cast("double")), "bronze_event_id")
    split = materialise(split, "business")
    return R.clean_vs_business(split.filter("split = 'train'"), split.filter("split = 'test'"), NUMERIC, S.BUSINESS_CATEGORICALS)


@query("anomaly_reconstruction")
def _anomaly(t):
    """Fit on normal training rows; both thresholds judged on the test rows."""
    df = O.temporal_split(learning(t).filter("event_ts is not null"), "event_ts", "bronze_event_id").withColumn("label", F.col(S.TARGET_CLF))
    normal = df.filter("split = 'train' and label = 0")
    medians = {r["feature"]: r["median"] for r in L.numeric_profile(normal, NUMERIC).collect()}
    model = R.fit_anomaly_model(normal, NUMERIC, medians)
    val, test = model.score(df.filter("split = 'val'")), model.score(df.filter("split = 'test'"))
    best = K.best_threshold(val, "label", "anomaly_score").first()["threshold"]
    rows = [
        K.threshold_metrics(test, "label", "anomaly_score", cut).select(F.lit(name).alias("threshold"), "*")
        for name, cut in (("p95", model.threshold), ("best_f1", best))
    ]
    return rows[0].unionByName(rows[1])


@query("score_batch")
def _score_batch(t):
    train, test = prepared(t, vectors=["narrow"], splits=["train", "test"])
    return C.score_state(R.decision_tree(train), test, 0.5, "tree", "1")


@query("score_rul")
def _score_rul(t):
    train, test = prepared(t, "reg", vectors=["features"], splits=["train", "test"])
    return C.score_rul(R.ridge(train), test, ["machine_id"], "ridge", "1")


@query("score_sequence")
def _score_sequence(t):
    """RUL from windows of consecutive readings: mean, last value and slope of each measure."""
    usable = learning(t).filter("machine_id is not null and event_ts is not null").withColumn(
        "machine_id", F.concat(F.lit("M"), F.substring("machine_id", 2, 20).cast("long") % MACHINES)
    )
    filled = usable.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMERIC})
    split = O.temporal_split_per_key(filled, "machine_id", "event_ts", "bronze_event_id").drop("_pos", "_n")
    seq = O.sliding_sequences(split, ["machine_id", "split"], "event_ts", "bronze_event_id", NUMERIC, S.TARGET_REG, S.SEQUENCE_LENGTH)
    ready = R.sequence_features(seq.filter("label is not null").withColumn("label", F.col("label").cast("double")), NUMERIC)
    ready = materialise(ready.select("machine_id", "split", "bronze_event_id", "label", "features"), "sequences")
    model = R.boosted_regressor(ready.filter("split = 'train'"))
    return R.predicted_rul(model, ready.filter("split = 'test'")).select("machine_id", "bronze_event_id", "label", "predicted_rul_days")
