"""URL verdicts: rules first, else logistic regression on hashed character n-grams.

DataFrame functions only; the model is fitted by Spark ML's logistic regression on a bounded
table of labelled urls and scored as one sum over the n-grams of host and path.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.session import materialise

FEATURES = 4096
GRAMS = (3, 4)
#: Distinct urls the model is fitted on at most: the first of each class in the order of a hash of the url.
SAMPLE = 4000
#: (verdict, host, path prefix)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next of ``/?#``, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null. A rule fits its host and all subdomains."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    cases = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in ordered
    ]
    return F.coalesce(*cases, F.lit(None).cast("struct<rule:string,verdict:string>"))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of ``^host`` and ``path$``, each marked with its side."""
    parts = []
    for mark, side in (("h", host), ("p", path)):
        text = F.concat(F.lit("^"), side, F.lit("$"))
        for n in GRAMS:
            places = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
            parts.append(F.transform(places, _cutter(mark, text, n)))
    return F.concat(*parts)


def _cutter(mark: str, text: Column, n: int):
    return lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n)))


def _features(rows: DataFrame, features: int) -> DataFrame:
    """``rows`` with the counts of their hashed n-grams in ``_features``."""
    rows = rows.withColumn("_grams", grams(F.col("host"), F.col("path")))
    return HashingTF(numFeatures=features, inputCol="_grams", outputCol="_features").transform(rows).drop("_grams")


def train(labelled: DataFrame, url: str = "url", label: str = "blocked", sample: int = SAMPLE, features: int = FEATURES):
    """A fitted model from (url, label 0/1); rows with null label are left out.

    Every url counts once. At most ``sample`` are used: of each class the first by hash and text
    of the url, half of ``sample`` or what the other class leaves, weighted so that the classes
    keep their shares. Returns None when there is no row of both classes.
    """
    rows = labelled.where(F.col(label).isNotNull()).select(F.col(url).alias("url"), F.col(label).cast("double").alias("label"))
    rows = materialise(rows.dropDuplicates(["url", "label"]), "labelled")
    held = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(held) < 2:
        return None
    parts = []
    for value, n in sorted(held.items()):
        taken = min(n, max(sample // 2, sample - sum(held.values()) + n))
        first = rows.where(F.col("label") == value).orderBy(F.xxhash64("url"), "url").limit(taken)
        parts.append(first.withColumn("_weight", F.lit(n / taken)))
    rows = parts[0].unionByName(parts[1])
    rows = rows.select("label", "_weight", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).coalesce(1)
    rows = _features(rows, features)
    return LogisticRegression(
        featuresCol="_features", predictionCol="_predicted", probabilityCol="_probability", rawPredictionCol="_raw",
        weightCol="_weight", maxIter=50, regParam=0.01,
    ).fit(rows)


def judge(pages: DataFrame, model, url: str = "url", rules=RULES, features: int = FEATURES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``p_block`` (the model's probability).

    The verdict is the rule's where one fits, else block when p_block >= 0.5. Null urls, and
    urls without ``://``, have empty host and path and are judged by the model. Without a
    model p_block is 0. Columns of ``pages`` with these names are replaced.
    """
    made = ("host", "path", "rule", "verdict", "p_block")
    rows = pages.drop(*made).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rows = rows.withColumn("_fits", rule_of(F.col("host"), F.col("path"), rules))
    if model is None:
        rows = rows.withColumn("p_block", F.lit(0.0))
    else:
        rows = model.transform(_features(rows, features))
        rows = rows.withColumn("p_block", F.element_at(vector_to_array("_probability"), 2))
        rows = rows.drop("_features", "_predicted", "_probability", "_raw")
    learned = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    rows = rows.withColumns({"rule": F.col("_fits.rule"), "verdict": F.coalesce(F.col("_fits.verdict"), learned)})
    return rows.drop("_fits")


def filter_urls(pages: DataFrame, url: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """``judge`` with a model trained on urls that the rules label."""
    rows = pages.select(F.col(url).alias("url"))
    fits = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    labelled = rows.withColumn("verdict", fits["verdict"]).where("verdict IS NOT NULL")
    labelled = labelled.select("url", (F.col("verdict") == "block").cast("int").alias("blocked"))
    return judge(pages, train(labelled, sample=sample), url, rules)
