"""Learning tables: column choice, imputation, scaling, encoding, weights and splits."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.operators.ordered import running_sum, with_positions
from millwright.session import materialise

#: Most values of a category that trees and the perceptron take as a column each.
ONEHOT = 256


def feature_columns(include_leaky: bool = False, include_machine_id: bool = True) -> tuple[list[str], list[str]]:
    numeric = S.NUMERIC_FEATURES + (S.LEAKY_FEATURES if include_leaky else [])
    categorical = [c for c in S.CATEGORICAL_FEATURES if include_machine_id or c != "machine_id"]
    return list(numeric), categorical


def build_xy(
    df: DataFrame, task: str, include_leaky: bool = False, include_machine_id: bool = True
) -> DataFrame:
    """Features and target; a regression row without target is dropped."""
    if task not in ("clf", "reg"):
        raise ValueError("task must be 'clf' or 'reg'")
    numeric, categorical = feature_columns(include_leaky, include_machine_id)
    if task == "reg":
        known = df.filter(F.col(S.TARGET_REG).isNotNull())
        return known.select(*numeric, *categorical, F.col(S.TARGET_REG).cast("double").alias("label"))
    return df.select(*numeric, *categorical, F.col(S.TARGET_CLF).cast("int").alias("label"))


def _brackets(wide: DataFrame, error: float) -> list[tuple[float, float]]:
    """Per column two values between which its median lies, from one approximate pass."""
    found = wide.approxQuantile(wide.columns, [0.5 - 2 * error, 0.5 + 2 * error], error)
    return [(q[0], q[1]) if q else (0.0, 0.0) for q in found]


def column_medians(wide: DataFrame, sizes: list[int], error: float = 0.001, rows: int | None = None) -> dict[int, float]:
    """{column number: exact median} of the columns of ``wide``, whose numbers of values are ``sizes``.

    Only the values between a column's two bounds leave the wide rows, a share of about four
    times ``error``; they are counted by value and ranked above the number of values below the
    bounds. A bound that turns out on the wrong side of the median (values that are not
    numbers, which sort last, can do that) is dropped and the column counted again.
    """
    bounds = dict(enumerate(_brackets(wide, error)))
    bounds = {i: b for i, b in bounds.items() if sizes[i]}
    medians: dict[int, float] = {}
    while bounds:
        column = {i: F.col(wide.columns[i]) for i in bounds}
        below = wide.agg(*[F.count_if(column[i] < F.lit(low)).alias(f"b{i}") for i, (low, _) in bounds.items()]).first()
        inside = [
            F.when((column[i] >= F.lit(low)) & (column[i] <= F.lit(high)), F.struct(F.lit(i).alias("i"), column[i].alias("v")))
            for i, (low, high) in bounds.items()
        ]
        near = wide.select(F.explode(F.array_compact(F.array(*inside))).alias("x")).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("_c"))
        ranked = running_sum(near, ["i"], "v", {"_c": "_upto"}, rows=rows)
        lows = F.create_map(*[F.lit(x) for i in bounds for x in (i, below[f"b{i}"])])
        counts = F.create_map(*[F.lit(x) for i in bounds for x in (i, sizes[i])])
        upto, n = F.col("_upto") + lows[F.col("i")], counts[F.col("i")]
        first, second = F.floor((n + 1) / 2), F.floor(n / 2 + 1)
        picks = ranked.groupBy("i").agg(
            F.min(F.when(upto >= first, F.col("v"))).alias("lo"), F.min(F.when(upto >= second, F.col("v"))).alias("hi")
        )
        for r in picks.collect():
            i, lows_ = r["i"], below[f"b{r['i']}"]
            if r["lo"] is not None and r["hi"] is not None and lows_ < (sizes[i] + 1) // 2:
                medians[i] = (r["lo"] + r["hi"]) / 2
        bounds = {
            i: (float("-inf") if below[f"b{i}"] >= (sizes[i] + 1) // 2 else low, float("nan") if below[f"b{i}"] < (sizes[i] + 1) // 2 else high)
            for i, (low, high) in bounds.items() if i not in medians
        }
    return medians


def numeric_profile(df: DataFrame, columns: list[str], rows: int | None = None) -> DataFrame:
    """Median, and mean and population deviation after filling gaps with it, per column.

    The rows stay wide: one pass sums all columns, and the medians are exact.
    """
    wide = materialise(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]), "wide")
    sums = [F.count(F.lit(1)).alias("n")]
    for c in wide.columns:
        sums += [
            F.count(c).alias(f"k_{c}"), F.coalesce(F.sum(c), F.lit(0.0)).alias(f"s_{c}"),
            F.coalesce(F.var_pop(c), F.lit(0.0)).alias(f"v_{c}"), F.coalesce(F.avg(c), F.lit(0.0)).alias(f"m_{c}"),
        ]
    r = wide.agg(*sums).first()
    medians_of = column_medians(wide, [r[f"k_{c}"] for c in wide.columns], rows=rows)
    told = [
        (name, r["n"], *(r[f"{x}_{c}"] for x in "ksvm"), medians_of.get(i)) for i, (name, c) in enumerate(zip(columns, wide.columns))
    ]
    stats = df.sparkSession.createDataFrame(told, "feature string, n long, k long, s double, v double, m double, median double")
    mean = (F.col("s") + (F.col("n") - F.col("k")) * F.col("median")) / F.col("n")
    square = (
        F.col("k") * (F.col("v") + (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean")))
        + (F.col("n") - F.col("k")) * (F.col("median") - F.col("mean")) * (F.col("median") - F.col("mean"))
    ) / F.col("n")
    return (
        stats.withColumn("mean", mean)
        .withColumn("deviation", F.sqrt(square))
        .select("feature", "median", "mean", "deviation")
    )


def impute_scale(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Numeric columns filled with their median and standardised.

    ``profile`` comes from the training rows; its one row per column becomes constants.
    A constant column is only centred.
    """
    known = {r["feature"]: r for r in profile.collect()}
    scaled = {}
    for c, r in known.items():
        filled = F.coalesce(F.col(c).cast("double"), F.lit(r["median"]))
        scaled[c] = (filled - F.lit(r["mean"])) / F.lit(r["deviation"] or 1.0)
    return df.withColumns(scaled)


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The commonest value; the smallest when several are equally common."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(1)


def fit_modes(df: DataFrame, columns: list[str]) -> dict:
    """The commonest value of every column; None for a column without values."""
    found = {c: most_frequent(df, c).first() for c in columns}
    return {c: row["value"] if row else None for c, row in found.items()}


def impute_mode(df: DataFrame, modes: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items()})


def onehot_stages(columns: list[str]) -> list:
    """Alphabetical categories; a value unseen in training encodes to zeros."""
    index = StringIndexer(
        inputCols=columns, outputCols=[f"{c}_index" for c in columns],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )
    encode = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_onehot" for c in columns], dropLast=True
    )
    return [index, encode]


def code_columns(column: str, labels: int) -> dict:
    """The number of a category in binary, a column a bit: 0 for a value unseen in training, 1 for the first label."""
    index = F.col(f"{column}_index").cast("long")
    code = F.when(index < labels, index + 1).otherwise(F.lit(0))
    return {f"{column}_bit{b}": F.shiftright(code, b).bitwiseAND(1).cast("double") for b in range(labels.bit_length())}


def preprocessor(train: DataFrame, numeric: list[str], categorical: list[str], onehot: int = ONEHOT):
    """Fitted preparation as a function DataFrame -> DataFrame with a ``features`` vector.

    Trees and the perceptron hold every column of every row, so with a column a value their
    work would grow with rows times values. Where a category has more than ``onehot`` values,
    there is a ``narrow`` vector for them too, which has the number of the value in binary:
    every value keeps a code of its own, in as many columns as the number has bits.
    """
    profile = numeric_profile(train, numeric)
    profile_rows = profile.sparkSession.createDataFrame(profile.collect(), profile.schema)
    modes = fit_modes(train, categorical)
    prepared = impute_mode(impute_scale(train, profile_rows), modes)
    stages = onehot_stages(categorical) if categorical else []
    stages.append(
        VectorAssembler(inputCols=[*numeric, *[f"{c}_onehot" for c in categorical]], outputCol="features")
    )
    model: PipelineModel = Pipeline(stages=stages).fit(prepared)
    labels = dict(zip(categorical, model.stages[0].labelsArray)) if categorical else {}
    codes = {c: code_columns(c, len(known)) for c, known in labels.items() if len(known) > onehot}
    coded = [name for c in categorical for name in codes.get(c, [f"{c}_onehot"])]
    narrow = VectorAssembler(inputCols=[*numeric, *coded], outputCol="narrow")

    def apply(df: DataFrame) -> DataFrame:
        out = model.transform(impute_mode(impute_scale(df, profile_rows), modes))
        for columns in codes.values():
            out = out.withColumns(columns)
        return narrow.transform(out) if codes else out

    return apply


def narrow_column(df: DataFrame) -> str:
    """The vector for learners that hold every column of every row."""
    return "narrow" if "narrow" in df.columns else "features"


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class, and negatives per positive."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    positives = counts.agg(F.sum(F.when(F.col(label) == 1, F.col("n")))).scalar()
    ratio = (total - positives) / F.greatest(positives, F.lit(1))
    return counts.select(
        label, "n", (total / (F.col("n") * 2)).alias("weight"), ratio.alias("scale_pos_weight")
    )


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """A ``weight`` column; the two class weights are looked up as constants."""
    weights = {r[label]: r["weight"] for r in class_weights(df, label).collect()}
    return df.withColumn(
        "weight", F.when(F.col(label) == 1, F.lit(weights.get(1, 1.0))).otherwise(F.lit(weights.get(0, 1.0)))
    )


def split_profile(df: DataFrame, ts: str, machine: str, label: str) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.count_distinct(machine).alias("machines"),
        (F.sum(F.col(label).cast("long")).cast("double") / F.count(label)).alias("failure_rate"),
    )


def stratified_split(
    df: DataFrame, key: str, label: str | None = None, test_share: float = 0.2, rows: int | None = None
) -> DataFrame:
    """Repeatable random split, exact inside each class; without ``label`` over all rows.

    Rows are ranked by a hash of their key. The rank is exact although one class may hold
    most rows.
    """
    lot = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 13), 16, 10).cast("long")
    ranked = with_positions(df.withColumn("_lot", lot), [label] if label else [], "_lot", key, rows)
    test = F.col("_pos") <= F.round(F.col("_n").cast("double") * test_share)
    return ranked.withColumn("split", F.when(test, "test").otherwise("train")).drop("_lot", "_pos", "_n")


def check_contract(df: DataFrame, expected: list[str]) -> DataFrame:
    """The columns a model was trained on, in order; anything missing is an error."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"missing model columns: {missing}")
    return df.select(*expected)
