"""Full cleaning of one source, against values worked out by hand and in plain pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millwright.plans.cleaning import clean_with_business_rules


def cleaned(spark, columns, rows, chunk=None):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "i long, " + ", ".join(f"`{c}` string" for c in columns))
    return clean_with_business_rules(df, "i", chunk).orderBy("i").collect()


def test_production_row_by_row(spark):
    columns = ["timestamp", "machine_id", "actual_production_qty", "good_qty", "scrap_qty", "cycle_time_sec", "production_speed", "shift"]
    out = cleaned(
        spark, columns,
        [
            ["2026-01-01 06:00:00", "nan", "100", "90", "10", "30", None, "x"],
            ["bad", "M1", "-5", "90", "-3", "10", "4", "x"],
            ["2026-01-01 22:10:00", "", "200", "250", "600", "50", "NULL", "x"],
        ],
    )
    assert [r["machine_id"] for r in out] == ["M1", "M1", "M1"]
    assert out[1]["timestamp"].strftime("%H:%M") == "14:05"
    assert [r["shift"] for r in out] == ["matin", "apres_midi", "nuit"]
    assert [r["actual_production_qty"] for r in out] == [100, 150, 200]
    # row 2: scrap = 200 - 250 < 0 becomes 0, and good is capped at actual - scrap
    assert [r["scrap_qty"] for r in out] == [10, 60, 0]
    assert [r["good_qty"] for r in out] == [90, 90, 200]
    assert [r["cycle_time_sec"] for r in out] == [30, 40, 50]
    assert [round(r["production_speed"], 4) for r in out] == [round(100 / 30, 4), 4, 4]


def test_quality_columns(spark):
    columns = ["dimension_measurement", "tolerance_min", "tolerance_max", "defect_type", "defect_category", "defect_severity",
               "is_conforming", "scrap_flag", "rework_required", "quality_score"]
    out = cleaned(
        spark, columns,
        [
            ["10", "9.5", "10.5", None, None, "minor", None, None, None, None],
            ["11.5", None, None, "rayure", None, "major", None, None, "None", None],
            ["99", None, None, "fissure", "x", None, None, None, "false", "88"],
        ],
    )
    assert [r["is_conforming"] for r in out] == [True, False, False]
    assert [r["scrap_flag"] for r in out] == [False, True, True]
    assert [r["defect_type"] for r in out] == ["no_defect", "rayure", "fissure"]
    assert [r["defect_category"] for r in out] == ["none", "esthetique", "x"]
    assert [r["rework_required"] for r in out] == [False, True, False]
    assert [r["quality_score"] for r in out] == [95, 70, 88]
    assert out[2]["dimension_measurement"] == 11.5


def noisy(n=90):
    rng = np.random.default_rng(5)

    def gaps(values, share=0.3):
        return [None if rng.random() < share else str(v) for v in values]

    return pd.DataFrame(
        {
            "machine_id": gaps(rng.choice(["M1", "M1", "M1", "M2"], n)),
            "work_order_id": gaps(rng.choice(["W1", "W2"], n)),
            "batch_id": gaps(rng.choice(["B1", "B2", "B3"], n)),
            "product_id": gaps(rng.choice(["P1", "P2"], n)),
            "Temperature_C": gaps(rng.integers(-20, 130, n)),
            "repair_time_minutes": gaps(rng.integers(0, 600, n)),
            "failure_type": gaps(rng.choice(["a", "b"], n)),
            "energy_cost": gaps(rng.integers(1, 9, n)),
        }
    )


def carry(s):
    return s.ffill().bfill()


@pytest.mark.parametrize("chunk", [None, 20])
def test_groups_and_medians(spark, chunk):
    """Ids complete each other, sensors are interpolated per machine, repair times by median."""
    pdf = noisy()
    out = pd.DataFrame([r.asDict() for r in cleaned(spark, list(pdf.columns), pdf.values.tolist(), chunk)])

    def within(key, column):
        return pdf.groupby(key)[column].transform(carry)

    want = pdf.copy()
    want["machine_id"] = pdf["machine_id"] = carry(pdf["machine_id"])
    for key in ("work_order_id", "batch_id"):
        pdf["product_id"] = within(key, "product_id")
    pdf["product_id"] = carry(pdf["product_id"])
    pdf["batch_id"] = carry(within(["machine_id", "work_order_id"], "batch_id"))
    pdf["work_order_id"] = carry(within("batch_id", "work_order_id"))
    for c in ("machine_id", "product_id", "batch_id", "work_order_id"):
        assert list(out[c]) == list(pdf[c]), c
    t = pd.to_numeric(pdf["Temperature_C"])
    t = t.where(t.between(0, 100)).groupby(pdf["machine_id"]).transform(lambda s: carry(s.interpolate()))
    np.testing.assert_allclose(out["Temperature_C"], t)
    m = pd.to_numeric(pdf["repair_time_minutes"])
    m = m.where(m.between(0, 500)).groupby(pdf["failure_type"]).transform(lambda s: s.fillna(s.median()))
    np.testing.assert_allclose(out["repair_time_minutes"], carry(m.interpolate()))
    assert out.notna().all().all()


def test_missing_columns_are_fine(spark):
    out = cleaned(spark, ["note"], [[None], ["x"], ["none"]])
    assert [r["note"] for r in out] == ["x", "x", "x"]


def test_column_order_and_names_stay(spark):
    df = spark.createDataFrame([(1, "5", "a")], "i long, quality_score string, z string")
    assert clean_with_business_rules(df, "i").columns == ["i", "quality_score", "z"]
    assert clean_with_business_rules(df, "i").filter(F.col("quality_score") == 5).count() == 1
