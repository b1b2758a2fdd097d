"""Ordered operators against plain pandas, whole and cut into small chunks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millwright.operators import ordered as O

SIZES = [None, 7]


def table(seed=0, n=120):
    """Rows with inner, leading and trailing gaps; one machine holds most rows, one has no value."""
    rng = np.random.default_rng(seed)
    machine = rng.choice(["a", "a", "a", "b", "c", None], n)
    value = np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n).round(3))
    value[:4] = np.nan
    value[-3:] = np.nan
    value[machine == "c"] = np.nan
    word = [None if rng.random() < 0.5 else f"w{i}" for i in range(n)]
    return pd.DataFrame({"i": np.arange(n), "m": machine, "v": value, "w": word, "ts": rng.integers(0, 12, n)})


def to_spark(spark, pdf):
    rows = [tuple(None if pd.isna(x) else x for x in r) for r in pdf.astype(object).itertuples(index=False)]
    rows = [(int(r[0]), r[1], None if r[2] is None else float(r[2]), r[3], int(r[4])) for r in rows]
    return spark.createDataFrame(rows, "i long, m string, v double, w string, ts long").repartition(4)


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


def same(got, want):
    for g, w in zip(got, want, strict=True):
        missing = w is None or (isinstance(w, float) and np.isnan(w))
        assert (g is None) if missing else (g == pytest.approx(w, rel=1e-12) if isinstance(w, float) else g == w)


@pytest.mark.parametrize("rows", SIZES)
def test_fill(spark, rows):
    pdf = table()
    got = O.fill_forward_back(to_spark(spark, pdf), ["v", "w"], "i", rows=rows)
    same(column(got, "v"), pdf["v"].ffill().bfill())
    same(column(got, "w"), pdf["w"].ffill().bfill())


@pytest.mark.parametrize("rows", SIZES)
def test_fill_by_group_loses_rows_without_key(spark, rows):
    pdf = table(1)
    want = pdf.groupby("m")["v"].transform(lambda x: x.ffill().bfill())
    got = O.fill_forward_back(to_spark(spark, pdf), ["v"], "i", ["m"], rows=rows)
    same(column(got, "v"), want)


@pytest.mark.parametrize("rows", SIZES)
@pytest.mark.parametrize("seed", [2, 3])
def test_interpolate(spark, rows, seed):
    pdf = table(seed)
    got = O.interpolate_linear(to_spark(spark, pdf), ["v"], "i", rows=rows)
    same(column(got, "v"), pdf["v"].interpolate().ffill().bfill())


@pytest.mark.parametrize("rows", SIZES)
def test_interpolate_by_group(spark, rows):
    pdf = table(4)
    want = pdf.groupby("m")["v"].transform(lambda x: x.interpolate().ffill().bfill())
    got = O.interpolate_linear(to_spark(spark, pdf), ["v"], "i", ["m"], rows=rows)
    same(column(got, "v"), want)


@pytest.mark.parametrize("rows", SIZES)
def test_positions_with_heavy_ties_and_null_times(spark, rows):
    """A third of the rows share one timestamp and another third has none."""
    n = 90
    stamp = [5 if i % 3 == 0 else None if i % 3 == 1 else i % 11 for i in range(n)]
    df = spark.createDataFrame([(i, "g" if i % 2 else None, t) for i, t in enumerate(stamp)], "i long, g string, t long")
    got = {r["i"]: (r["_pos"], r["_n"]) for r in O.with_positions(df, ["g"], "t", "i", rows).collect()}
    for g in (0, 1):
        order = sorted((i for i in range(n) if i % 2 == g), key=lambda i: (stamp[i] is None, stamp[i] or 0, i))
        assert [got[i] for i in order] == [(p, len(order)) for p in range(1, len(order) + 1)]


@pytest.mark.parametrize("rows", SIZES)
def test_heavy_ties_are_split_over_chunks(spark, rows):
    df = spark.range(100).select(F.col("id").alias("i"), F.lit(1).alias("t"))
    cut = O.chunked(df, "t", "i", rows)
    largest = cut.df.groupBy(O.CHUNK).count().agg(F.max("count")).first()[0]
    assert largest <= 3 * (rows or 100)


@pytest.mark.parametrize("rows", SIZES)
def test_running_sum_both_ways(spark, rows):
    pdf = pd.DataFrame({"i": np.arange(60), "x": np.arange(60) % 7})
    df = spark.createDataFrame(pdf)
    up = O.running_sum(df, [], "i", {"x": "s"}, rows=rows)
    assert column(up, "s") == list(pdf["x"].cumsum())
    down = O.running_sum(df, [], "i", {"x": "s"}, descending=True, rows=rows)
    assert column(down, "s") == list(pdf["x"][::-1].cumsum()[::-1])
    assert set(column(down, "s_total")) == {int(pdf["x"].sum())}


@pytest.mark.parametrize("rows", SIZES)
@pytest.mark.parametrize("n", [50, 51])
def test_median(spark, rows, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"g": rng.choice(["a", "a", "b"], n), "x": rng.integers(0, 9, n).astype(float)})
    got = {r["g"]: r["median"] for r in O.group_median(spark.createDataFrame(pdf), ["g"], "x", rows).collect()}
    assert got == pdf.groupby("g")["x"].median().to_dict()


@pytest.mark.parametrize("rows", SIZES)
@pytest.mark.parametrize("n", [1, 3, 40, 101])
def test_temporal_split(spark, rows, n):
    df = spark.createDataFrame([(i, (i * 7) % 5) for i in range(n)], "i long, t long")
    got = {r["i"]: r["split"] for r in O.temporal_split(df, "t", "i", rows=rows).collect()}
    order = sorted(range(n), key=lambda i: ((i * 7) % 5, i))
    a, b = int(n * 0.7), int(n * (0.7 + 0.15))
    want = ["train"] * a + ["val"] * (b - a) + ["test"] * (n - b)
    assert [got[i] for i in order] == want


@pytest.mark.parametrize("rows, block", [(None, 100), (7, 5)])
def test_windows(spark, rows, block):
    """Every full window once; a group of exactly the window length gives none."""
    sizes = {"a": 23, "b": 4, "c": 5}
    data = [(g, t, t, float(t)) for g, n in sizes.items() for t in range(n)]
    df = spark.createDataFrame(data, "g string, t long, i long, x double")
    got = O.sliding_sequences(df, ["g"], "t", "i", ["x"], "x", length=4, block=block, rows=rows)
    found = {(r["g"], r["position"]): [s[0] for s in r["sequence"]] for r in got.collect()}
    want = {(g, p): [float(x) for x in range(p - 4, p)] for g, n in sizes.items() if n > 4 for p in range(4, n + 1)}
    assert found == want


def test_latest_prefers_time_then_lowest_id(spark):
    data = [("a", 1, 5), ("a", 2, 9), ("a", 2, 7), ("a", None, 1), ("b", None, 3), ("b", None, 2)]
    df = spark.createDataFrame(data, "m string, t int, i int")
    got = {r["m"]: (r["t"], r["i"]) for r in O.latest_by(df, "m", "t", "i").collect()}
    assert got == {"a": (2, 7), "b": (None, 2)}
