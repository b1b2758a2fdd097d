"""Single-value rules against tables of inputs and expected results."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.functions import health as H
from millwright.functions import parse as P
from millwright.functions import status as D


def apply(spark, kind, rule, inputs):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(rule("v")).collect()]


@pytest.mark.parametrize(
    "rule, table",
    [
        (D.status_trs, {95: "good", 85: "good", 84.9: "warn", 70: "warn", 69: "crit", 0: "crit", None: "crit"}),
        (D.status_reach, {100: "good", 90: "good", 89: "warn", 80: "warn", 79: "crit", None: "crit"}),
        (D.status_scrap, {None: "good", 0: "good", 2.9: "good", 3: "warn", 4.9: "warn", 5: "crit", 10: "crit"}),
        (D.status_rul, {None: "good", 200: "good", 90: "good", 89: "warn", 30: "warn", 29: "crit", 0: "crit"}),
        (D.status_risk, {75: "crit", 74.9: "warn", 50: "warn", 49: "good", 0: "good"}),
        (D.state_of, {0.8: "at_risk", 0.1: "normal", 0.65: "at_risk", 0.5: "at_risk"}),
        (D.clamp_rul, {-12.5: 0.0, 3.0: 3.0, None: None}),
        (lambda c: H.maintenance_priority(F.col(c)),
         {0: "urgent", 7: "urgent", 7.1: "high", 30: "high", 90: "medium", 365: "low", 366: None, -1: None}),
    ],
)
def test_ladders(spark, rule, table):
    values = [None if v is None else float(v) for v in table]
    assert apply(spark, "double", rule, values) == list(table.values())


def test_severity(spark):
    table = {"critical": "critique", "HIGH": "critique", "major": "majeur", "Warning": "majeur", "x": "mineur", None: "mineur"}
    assert apply(spark, "string", D.severity_label, list(table)) == list(table.values())


def test_dates(spark):
    inputs = [20260329, None, 123]
    assert apply(spark, "int", D.day_label, inputs) == ["29/03", "", "123"]
    assert apply(spark, "int", D.date_label, inputs) == ["29/03/2026", "", "123"]


def test_risk_score(spark):
    table = {(1.0, 73.0): 90, (0.0, 187.0): 24, (1.0, None): 100, (0.0, None): 0, (0.0, 0.0): 50, (0.0, 400.0): 0}
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(table)], "i int, p double, r double")
    got = [r[0] for r in df.orderBy("i").select(D.risk_score("p", "r")).collect()]
    assert got == list(table.values())


def test_alert_title(spark):
    assert apply(spark, "string", D.alert_title, ["sensor_health", "", None]) == ["Sensor health", "Alerte", "Alerte"]


def test_numbers(spark):
    inputs = ["12", " 12 ", "1e3", ".5", "-3.50", "", None, "+4", "7.", "12\n", "1" * 30]
    got = apply(spark, "string", P.parse_number, inputs)
    assert [None if v is None else float(v) for v in got] == [12, 12, None, None, -3.5, None, None, None, None, None, None]
    strict = apply(spark, "string", lambda c: P.parse_number(c, trim=False), ["12", " 12 "])
    assert float(strict[0]) == 12 and strict[1] is None
    assert apply(spark, "string", P.parse_int, ["2.5", "-2.5", "1.49", "x"]) == [3, -3, 1, None]


def test_booleans(spark):
    table = {"Oui": True, "True": True, " y ": True, "0": False, "non": False, "": None, None: None}
    assert apply(spark, "string", P.parse_bool, list(table)) == list(table.values())


def test_timestamps(spark):
    inputs = ["2026-03-29T12:00:00+02:00", "2026-03-29T12:00:00Z", "2026-03-29", "bad", "", None, "2026-03-29 xx"]
    got = [None if v is None else v.strftime("%H:%M") for v in apply(spark, "string", P.parse_timestamp, inputs)]
    assert got == ["12:00", "12:00", "00:00", None, None, None, None]


def test_shifts(spark):
    rows = [
        ("Matin", None, "SHIFT_MATIN", "matin", "06:00", "14:00"),
        ("après-midi", None, "SHIFT_APRES_MIDI", "apres-midi", "14:00", "22:00"),
        ("apres_midi", None, "SHIFT_APRES_MIDI", "apres-midi", "14:00", "22:00"),
        ("night", None, "SHIFT_NUIT", "nuit", "22:00", "06:00"),
        ("week end", None, "SHIFT_WEEK_END", "week end", "00:00", "23:59"),
        (" ", "2026-01-01 05:59:00", "SHIFT_NUIT", "nuit", "22:00", "06:00"),
        (None, "2026-01-01 06:00:00", "SHIFT_MATIN", "matin", "06:00", "14:00"),
        (None, "2026-01-01 14:00:00", "SHIFT_APRES_MIDI", "apres-midi", "14:00", "22:00"),
        (None, "2026-01-01 22:00:00", "SHIFT_NUIT", "nuit", "22:00", "06:00"),
        (None, None, "SHIFT_NUIT", "nuit", "22:00", "06:00"),
    ]
    df = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "i int, s string, t string")
    out = P.with_shift(df.selectExpr("i", "s", "CAST(t AS timestamp_ntz) AS t"), "s", "t").orderBy("i").collect()
    assert [tuple(r)[3:] for r in out] == [r[2:] for r in rows]


def test_json_payload_keeps_digits_and_null_keys(spark):
    df = spark.createDataFrame([('{"a": 0.00001, "b": 12345678.5, "c": null, "d": "x"}',)], "j string")
    p = df.select(P.payload_map(F.col("j")).alias("p")).withColumn("n", P.parse_number("p['a']"))
    row = p.select("p", "n", P.json_has_keys("p", ["a", "c"]).alias("has"), P.json_has_keys("p", ["z"]).alias("not")).first()
    assert float(row["n"]) == 0.00001 and row["p"]["b"] == "12345678.5"
    assert row["has"] and not row["not"]


def test_flag_names_are_sorted(spark):
    df = spark.createDataFrame([({"flag_b": " TRUE ", "flag_a": "1", "flag_c": "0", "x": "1"},), ({"flag_c": None},)], "p map<string,string>")
    assert [r[0] for r in df.select(P.active_flags("p")).collect()] == ["a,b", None]


def test_weighted_score(spark):
    flags = list(S.FLAG_SETS["clean"])
    df = spark.createDataFrame([tuple([1] * len(flags)), tuple([0] * len(flags)), tuple(int(f == "flag_sound_high") for f in flags)], flags)
    score, pct = H.degradation_score("clean")
    got = [(float(r[0]), float(r[1])) for r in df.select(score, pct).collect()]
    assert got == [(15.2, 100.0), (0.0, 0.0), (0.8, 5.3)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=200))
def test_half_even_is_pythons_round(spark, values):
    values += [2.675, 0.125, 0.375, 12.25, 12.35, 1.005, -2.5, 0.5, 1.5, 2.5, 1e-9]
    for digits in (0, 1, 2):
        got = apply(spark, "double", lambda c, d=digits: D.half_even(c, d), values)
        assert all(math.isclose(g, round(v, digits), rel_tol=0, abs_tol=0) for g, v in zip(got, values))
