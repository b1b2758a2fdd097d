"""Trainers and model comparison with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millwright.ml.features import narrow_column, onehot_stages, with_class_weight
from millwright.operators.curves import classification_metrics, rank_metrics, rank_models, regression_metrics
from millwright.session import materialise, scratch_path

SEED = 42
#: Spark's deepest tree, for trees of unlimited depth.
DEEPEST = 30
#: Most nodes of a forest that the driver holds at a time.
FOREST_NODES = 400_000
#: Trees that tell how many nodes a tree has.
PROBE = 4
#: Rows that the fits side by side hold together, and rows of a task of one of them.
FOREST_ROWS, TASK_ROWS = 4_000_000, 250_000
#: Most columns the normal equations take.
NORMAL = 4096


def logistic(train: DataFrame, c: float = 1.0, balanced: bool = True):
    """L2 logistic regression with the penalty expressed per unit of total weight."""
    weighted = with_class_weight(train) if balanced else train.withColumn("weight", F.lit(1.0))
    total = weighted.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        weightCol="weight", regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False, maxIter=1000
    ).fit(weighted)


def ridge(train: DataFrame, alpha: float = 1.0):
    """Linear regression with an L2 penalty; ``alpha=0`` is ordinary least squares.

    Spark divides the penalty by the deviation of the label and takes it per row.
    """
    n, deviation = train.agg(F.count("label"), F.stddev_pop("label")).first()
    return LinearRegression(
        regParam=alpha * (deviation or 0.0) / n, elasticNetParam=0.0, standardization=False,
        solver="normal" if len(train.select("features").first()[0]) <= NORMAL else "l-bfgs",
    ).fit(train)


def decision_tree(train: DataFrame, depth: int = 5):
    return DecisionTreeClassifier(featuresCol=narrow_column(train), maxDepth=depth, seed=SEED).fit(train)


class GroupedForest:
    """A forest whose trees were fitted and stored a group at a time; one group at a time is in the driver.

    ``transform`` adds what Spark's forest of all the trees would: votes are summed group by
    group, and the rows with the sums so far are stored in between.
    """

    def __init__(self, kind, groups: list[tuple[str, int, int]], features: str, width: int):
        #: Of every group its path, its trees and their nodes.
        self.groups = groups
        self.kind, self.features, self.numFeatures = kind, features, width

    @property
    def trees(self) -> int:
        return sum(n for _, n, _ in self.groups)

    def _rounds(self) -> Iterator[list[tuple[str, int]]]:
        """Groups that are in the driver together."""
        held, size = [], 0
        for path, n, nodes in self.groups:
            if held and size + nodes > FOREST_NODES:
                yield held
                held, size = [], 0
            held, size = [*held, (path, n)], size + nodes
        yield held

    def transform(self, df: DataFrame) -> DataFrame:
        classes = self.kind is RandomForestClassificationModel
        zeros = F.array_repeat(F.lit(0.0), 2) if classes else F.lit(0.0)
        out = df.withColumn("_votes", zeros)
        for together in self._rounds():
            models = at_once(df.sparkSession, [partial(self.kind.load, path) for path, _ in together])
            for model, (_, n) in zip(models, together):
                votes = model.transform(out)
                if classes:
                    both = F.zip_with("_votes", vector_to_array("rawPrediction"), lambda a, b: a + b)
                else:
                    both = F.col("_votes") + F.col("prediction") * n
                out = votes.withColumn("_sum", both).select(*df.columns, F.col("_sum").alias("_votes"))
            out = materialise(out, "votes")
        if not classes:
            return out.withColumn("prediction", F.col("_votes") / self.trees).drop("_votes")
        share = F.transform("_votes", lambda v: v / self.trees)
        return out.withColumns({
            "rawPrediction": array_to_vector("_votes"), "probability": array_to_vector(share),
            "prediction": (F.col("_votes")[1] > F.col("_votes")[0]).cast("double"),
        }).drop("_votes")


def _nodes(model) -> int:
    return sum(tree.numNodes() for tree in model._java_obj.trees())


def _grown(forest, train: DataFrame, trees: int, depth: int, leaf: int = 1):
    """The forest of ``forest(trees, seed)``; whole, unless its nodes are more than ``FOREST_NODES``.

    Spark keeps every node of a fit in the driver. A few trees tell how many nodes a tree has
    on these rows; a larger forest is fitted in groups of trees, each with a seed of its own,
    and every group is stored and leaves the driver. Every task of a fit sends the statistics
    of all nodes of a level, so groups are fitted side by side, each in few tasks.
    """
    features = narrow_column(train)
    known = train.select(features, "label", *[c for c in ("weight",) if c in train.columns]).persist()
    cores = known.sparkSession.sparkContext.defaultParallelism
    try:
        rows = known.count()
        most = min(2 ** (depth + 1), 2 * max(rows // leaf, 1))
        if trees * most <= FOREST_NODES or trees <= PROBE:
            return forest(trees, SEED).fit(known)
        first = forest(PROBE, SEED).fit(known)
        kind, width, size = type(first), first.numFeatures, max(-(-_nodes(first) // PROBE), 1)
        if size * trees <= FOREST_NODES:
            return forest(trees, SEED).fit(known)
        side = max(min(cores, FOREST_NODES // size, FOREST_ROWS // rows), 1)
        few = known.coalesce(max(-(-cores // side), -(-rows // TASK_ROWS)))
        step = max(FOREST_NODES // (size * side), 1)

        def stored(model):
            path = scratch_path(known.sparkSession, "trees")
            model.save(path)
            return path, model.getNumTrees, _nodes(model)

        def group(done: int):
            return stored(forest(min(step, trees - done), SEED + done).fit(few))

        groups = [stored(first)]
        del first
        groups += at_once(known.sparkSession, [partial(group, done) for done in range(PROBE, trees, step)], side)
        return GroupedForest(kind, groups, features, width)
    finally:
        known.unpersist()


def forest_classifier(train: DataFrame, trees: int = 200, depth: int = DEEPEST):
    """The node of every row is kept between levels: finding it anew walks every deep tree from its root."""
    def forest(n: int, seed: int):
        return RandomForestClassifier(
            featuresCol=narrow_column(train), numTrees=n, maxDepth=depth, weightCol="weight", seed=seed, cacheNodeIds=True
        )

    return _grown(forest, with_class_weight(train), trees, depth)


def forest_regressor(train: DataFrame, trees: int = 300, depth: int = DEEPEST, leaf: int = 3):
    def forest(n: int, seed: int):
        return RandomForestRegressor(
            featuresCol=narrow_column(train), numTrees=n, maxDepth=depth, minInstancesPerNode=leaf, seed=seed, cacheNodeIds=True
        )

    return _grown(forest, train, trees, depth, leaf)


def first_rounds(model, n: int):
    """The model of the first ``n`` rounds of a fitted boosted classifier."""
    spark = SparkSession.getActiveSession()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for i, (tree, weight) in enumerate(zip(model._java_obj.trees()[:n], model.treeWeights[:n])):
        trees[i], weights[i] = tree, weight
    short = jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, trees, weights, model.numFeatures, 2)
    return model._copyValues(GBTClassificationModel(short))


def _leaf_values(tree) -> list[float]:
    """Predictions of a tree's leaves in the order of their numbers, left to right."""
    out, todo = [], [tree.rootNode()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "LeafNode":
            out.append(node.prediction())
        else:
            todo += [node.rightChild(), node.leftChild()]
    return out


def _score_counts(batches: Iterator[pa.RecordBatch], values: np.ndarray, bins: int) -> Iterator[pa.RecordBatch]:
    """Weight of either class per (round, score bin) of one batch of leaf numbers."""
    rounds = len(values)
    for batch in batches:
        if not batch.num_rows:
            continue
        leaves = batch["leaves"].values.to_numpy().reshape(batch.num_rows, rounds).astype(np.int64)
        margin = np.cumsum(values[np.arange(rounds), leaves], axis=1)
        place = np.minimum((bins / (1 + np.exp(-2 * margin))).astype(np.int64), bins - 1) + np.arange(rounds) * bins
        weight, positive = (batch[c].to_numpy(zero_copy_only=False) for c in ("weight", "label"))
        weight = np.repeat(weight.astype(float)[:, None], rounds, axis=1)
        counts = [np.bincount(place.ravel(), (weight * (positive == c)[:, None]).ravel(), rounds * bins) for c in (1, 0)]
        seen = np.flatnonzero(counts[0] + counts[1])
        columns = [seen // bins, seen % bins, counts[0][seen], counts[1][seen]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["round", "bin", "hits", "misses"])


def pr_auc_by_round(model, rows: DataFrame, bins: int = 4096) -> list[float]:
    """Average precision on ``rows`` (features, label, weight) after each round.

    Scores are counted in ``bins`` equal parts of the probability; scores of one part tie.
    """
    model = model.copy()
    model.setLeafCol("_leaf")
    values = [[w * v for v in _leaf_values(t)] for t, w in zip(model._java_obj.trees(), model.treeWeights)]
    table = np.zeros((len(values), max(map(len, values))))
    for i, row in enumerate(values):
        table[i, : len(row)] = row
    leaves = model.transform(rows).select(vector_to_array("_leaf").alias("leaves"), "label", "weight")
    counted = leaves.mapInArrow(partial(_score_counts, values=table, bins=bins), "round long, bin long, hits double, misses double")
    bin_sums = counted.groupBy("round", "bin").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
    down = Window.partitionBy("round").orderBy(F.desc("bin"))
    summed = bin_sums.select("round", "hits", F.sum("hits").over(down).alias("found"), F.sum(F.col("hits") + F.col("misses")).over(down).alias("seen"))
    area = summed.groupBy("round").agg((F.sum(F.col("hits") * F.col("found") / F.col("seen")) / F.sum("hits")).alias("area"))
    return [r["area"] for r in area.orderBy("round").collect()]


def _log_loss_by_round(model, rows: DataFrame) -> list[float]:
    return [-loss for loss in model.evaluateEachIteration(rows)]


#: What early stopping watches; greater is better.
WATCHED = {"log_loss": _log_loss_by_round, "pr_auc": pr_auc_by_round}


def _patient(fit, watched, rounds: int, patience: int):
    """The model of the best round before ``patience`` rounds without a better value.

    ``fit`` takes a number of rounds. Rounds do not depend on how many follow, so a short fit
    is the beginning of a long one: the number is doubled until the stop lies inside it, and
    the best model is the first rounds of the one that was fitted.
    """
    tried = min(rounds, 2 * patience)
    while True:
        model = fit(tried)
        best, most = 1, float("-inf")
        for n, value in enumerate(watched(model), 1):
            if value > most:
                best, most = n, value
            elif n - best >= patience:
                return first_rounds(model, best)
        if tried == rounds:
            return model if best == rounds else first_rounds(model, best)
        tried = min(rounds, 2 * tried)


def boosted_classifier(
    train: DataFrame, rounds: int = 100, depth: int = 3, rate: float = 0.1,
    validation: DataFrame | None = None, positive_weight: float | None = None, patience: int | None = None,
    watch: str = "log_loss", rows: float = 1.0, columns: float = 1.0, least: int = 1,
):
    """Gradient boosting; with ``validation`` rounds stop when its error no longer improves.

    With ``patience`` they stop when ``watch`` (``WATCHED``) has not improved on
    ``validation`` for so many rounds, and the model of the best round is returned. Every
    round draws a share of ``rows``, every split looks at a share of ``columns``, and a leaf
    has at least ``least`` rows.
    """
    weight = F.when(F.col("label") == 1, F.lit(positive_weight or 1.0)).otherwise(F.lit(1.0))
    if patience is not None:
        if validation is None:
            raise ValueError("patience needs validation rows")
        weighted = validation.withColumn("weight", weight).persist()
        known = train.persist()
        try:
            return _patient(
                lambda n: boosted_classifier(known, n, depth, rate, positive_weight=positive_weight, rows=rows, columns=columns, least=least),
                lambda model: WATCHED[watch](model, weighted), rounds, patience,
            )
        finally:
            weighted.unpersist()
            known.unpersist()
    df = train.withColumn("_held", F.lit(False))
    if validation is not None:
        df = df.unionByName(validation.withColumn("_held", F.lit(True)))
    booster = GBTClassifier(
        featuresCol=narrow_column(train), maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED,
        subsamplingRate=rows, minInstancesPerNode=least,
        featureSubsetStrategy="all" if columns == 1.0 else str(columns),
    )
    if positive_weight:
        df = df.withColumn("weight", weight)
        booster.setWeightCol("weight")
    if validation is not None:
        booster.setValidationIndicatorCol("_held")
    return booster.fit(df)


def boosted_regressor(
    train: DataFrame, rounds: int = 100, depth: int = 3, rate: float = 0.1, validation: DataFrame | None = None
):
    df = train.withColumn("_held", F.lit(False))
    booster = GBTRegressor(featuresCol=narrow_column(train), maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED)
    if validation is not None:
        df = df.unionByName(validation.withColumn("_held", F.lit(True)))
        booster.setValidationIndicatorCol("_held")
    return booster.fit(df)


def balanced_rows(df: DataFrame) -> DataFrame:
    """Rows of the rarer class repeated until both classes weigh the same, at most twice the rows.

    Where the ratio is not whole, a share of its rows, told by a hash of their features, is
    repeated once more.
    """
    counts = {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return df
    rare = min(counts, key=counts.get)
    ratio = max(counts.values()) / counts[rare]
    share = F.pmod(F.xxhash64(vector_to_array(narrow_column(df))), F.lit(1_000_000)) < int((ratio % 1) * 1_000_000)
    times = F.when(F.col("label") == rare, F.lit(int(ratio)) + share.cast("int")).otherwise(F.lit(1))
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).drop("_copy")


def perceptron(
    train: DataFrame, hidden: tuple[int, ...] = (128, 64), rounds: int = 100, validation: DataFrame | None = None,
    step: int = 10, patience: int = 20, balanced: bool = False,
):
    """Dense network for two classes.

    ``balanced`` weighs both classes alike. With ``validation`` the fit goes on from its own
    weights ``step`` rounds at a time, until the PR-AUC there has not improved for
    ``patience`` rounds; the weights of the best step are returned.
    """
    column = narrow_column(train)
    width = len(train.select(column).first()[0])
    known = (balanced_rows(train) if balanced else train).persist()
    held = validation.persist() if validation is not None else None

    def fit(n: int, before=None):
        network = MultilayerPerceptronClassifier(featuresCol=column, layers=[width, *hidden, 2], maxIter=n, seed=SEED)
        return (network.setInitialWeights(before.weights) if before else network).fit(known)

    try:
        if held is None:
            return fit(rounds)
        best, most, at, model = None, float("-inf"), 0, None
        for done in range(step, rounds + step, step):
            model = fit(min(step, rounds - done + step), model)
            area = rank_metrics(risk_scores(model, held), "label", "risk_score").first()["pr_auc"] or 0.0
            if area > most:
                best, most, at = model, area, done
            elif done - at >= patience:
                break
        return best
    finally:
        known.unpersist()
        if held is not None:
            held.unpersist()


def risk_scores(model, df: DataFrame) -> DataFrame:
    """Probability of the positive class as ``risk_score``."""
    return model.transform(df).withColumn("risk_score", vector_to_array("probability")[1])


def predicted_rul(model, df: DataFrame) -> DataFrame:
    out = model.transform(df).withColumn("predicted_rul_days", F.greatest("prediction", F.lit(0.0)))
    return out


def scored_once(scored: DataFrame, column: str) -> DataFrame:
    """Labels and scores, stored: metrics read them several times, and each would run the model again."""
    return materialise(scored.select("label", column), "scored")


class AnomalyModel:
    """Principal components of normal rows; the score is the mean squared reconstruction error."""

    def __init__(self, features: list[str], pipeline, medians: dict[str, float], threshold: float):
        self.features, self.pipeline, self.medians, self.threshold = features, pipeline, medians, threshold

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``anomaly_score`` (high = odd) and ``is_anomaly``."""
        loadings = self.pipeline.stages[-1].pc.toArray().tolist()
        filled = df.withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.medians.items()}
        )
        out = (
            self.pipeline.transform(filled)
            .withColumn("_x", vector_to_array("_scaled"))
            .withColumn("_z", vector_to_array("_parts"))
        )
        errors = []
        for i, row in enumerate(loadings):
            rebuilt = sum((F.col("_z")[j] * F.lit(float(w)) for j, w in enumerate(row)), F.lit(0.0))
            errors.append((F.col("_x")[i] - rebuilt) * (F.col("_x")[i] - rebuilt))
        score = sum(errors, F.lit(0.0)) / len(loadings)
        return (
            out.withColumn("anomaly_score", score)
            .withColumn("is_anomaly", F.col("anomaly_score") >= self.threshold)
            .drop("_raw", "_scaled", "_parts", "_x", "_z")
        )


def fit_anomaly_model(normal: DataFrame, features: list[str], medians: dict[str, float], parts: int = 4) -> AnomalyModel:
    """Fit on normal rows only; the threshold is the 95th percentile of their scores."""
    filled = normal.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    )
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            PCA(k=min(parts, len(features)), inputCol="_scaled", outputCol="_parts"),
        ]
    ).fit(filled)
    model = AnomalyModel(features, pipeline, medians, float("inf"))
    model.threshold = model.score(normal).approxQuantile("anomaly_score", [0.95], 0.001)[0]
    return model


def _pick(i: int):
    return lambda row: row[i]


def sequence_features(sequences: DataFrame, features: list[str], column: str = "sequence") -> DataFrame:
    """Mean, last value and slope of each feature over its window, as one vector."""
    steps = F.size(column)
    middle = (steps - 1) / 2
    spread = (steps.cast("double") * (steps * steps - 1)) / 12
    made = {}
    for i, f in enumerate(features):
        series = F.transform(F.col(column), _pick(i))
        total = F.aggregate(series, F.lit(0.0), lambda acc, v: acc + v)
        lean = F.aggregate(
            F.transform(series, lambda v, k: v * (k - middle)), F.lit(0.0), lambda acc, v: acc + v
        )
        made |= {
            f"{f}_mean": total / steps,
            f"{f}_last": F.element_at(series, -1),
            f"{f}_slope": lean / F.nullif(spread, F.lit(0.0)),
        }
    out = sequences.withColumns(made)
    return VectorAssembler(inputCols=list(made), outputCol="features").transform(out)


CLASSIFIERS = {
    "LogisticRegression": lambda df, size: logistic(df, balanced=False),
    "DecisionTreeClassifier": lambda df, size: decision_tree(df),
    "RandomForestClassifier": lambda df, size: forest_classifier(df, trees=size or 200),
    "GradientBoostingClassifier": lambda df, size: boosted_classifier(df, rounds=size or 100),
}
REGRESSORS = {
    "LinearRegression": lambda df, size: ridge(df, alpha=0.0),
    "RandomForestRegressor": lambda df, size: forest_regressor(df, trees=size or 300),
    "GradientBoostingRegressor": lambda df, size: boosted_regressor(df, rounds=size or 100),
}


def at_once(spark: SparkSession, steps: list[Callable], side: int | None = None) -> list:
    """Results of independent steps whose jobs run side by side, at most ``side`` of them at a time.

    A fit is hundreds of short jobs, one after the other; between them, and in the last tasks of
    each, the cores that it leaves free work for the other fits.
    """
    target = inheritable_thread_target(spark)
    with ThreadPoolExecutor(side or max(len(steps), 1)) as pool:
        return [r.result() for r in [pool.submit(target(step)) for step in steps]]


def compare_models(train: DataFrame, test: DataFrame, task: str, size: int | None = None, names: list[str] | None = None):
    """Metrics of each model on ``test``, best first, and the fitted models.

    ``size`` is the number of trees or rounds of every ensemble; without it each has its own.
    The models do not depend on each other and are fitted side by side.
    """
    trainers = CLASSIFIERS if task == "clf" else REGRESSORS

    def judged(name: str):
        model = trainers[name](train, size)
        if task == "clf":
            one = classification_metrics(scored_once(risk_scores(model, test), "risk_score"), "label", "risk_score")
        else:
            one = regression_metrics(scored_once(predicted_rul(model, test), "predicted_rul_days"), "label", "predicted_rul_days")
        return model, one.select(F.lit(name).alias("model"), "*")

    names = list(names or trainers)
    done = at_once(train.sparkSession, [partial(judged, name) for name in names])
    fitted = {name: model for name, (model, _) in zip(names, done)}
    rows = reduce(DataFrame.unionByName, [one for _, one in done])
    ranked = rank_models(rows, "f1" if task == "clf" else "mae", task == "clf")
    return ranked, fitted


def clean_vs_business(
    train: DataFrame, test: DataFrame, numeric: list[str], business: list[str], label: str = "label"
) -> DataFrame:
    """Error of a linear model with and without the business context columns."""
    def prepared(columns: list[str], extra: list[str]) -> Pipeline:
        stages = onehot_stages(extra) if extra else []
        stages += [
            VectorAssembler(inputCols=columns, outputCol="_raw", handleInvalid="skip"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True),
            VectorAssembler(inputCols=["_scaled", *[f"{c}_onehot" for c in extra]], outputCol="features"),
        ]
        return Pipeline(stages=stages)

    rows = None
    for kind, extra in (("clean", []), ("business", business)):
        base = {c: F.coalesce(F.col(c), F.lit("unknown")) for c in extra}
        model = prepared(numeric, extra).fit(train.withColumns(base) if base else train)

        def ready(df: DataFrame) -> DataFrame:
            return model.transform(df.withColumns(base) if base else df).withColumn("label", F.col(label).cast("double"))

        fitted = ridge(ready(train), alpha=0.0)
        scored = predicted_rul(fitted, ready(test))
        one = regression_metrics(scored, "label", "predicted_rul_days").select(F.lit(kind).alias("dataset_type"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows.orderBy("mae")


def mean_vector(df: DataFrame, column: str = "features"):
    """Column means of a vector column."""
    return df.select(Summarizer.mean(F.col(column)).alias("m")).first()["m"]
