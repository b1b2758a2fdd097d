"""Numbers keep all their digits until they are judged."""

import pytest

from millwright.functions import parse as P

CASES = [("0.6999996", False, 1), ("0.7", True, 1), ("2.4999999", True, 2), ("100.0000004", True, 100), ("1234567890123.5", True, None)]


@pytest.mark.parametrize("text, risky, whole", CASES)
def test_digits_survive(spark, text, risky, whole):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select((P.parse_number("t") >= 0.7).alias("risky"), P.parse_int("t").alias("whole"), P.parse_number("t").alias("n")).first()
    assert (row.risky, row.whole) == (risky, whole) and format(row.n.normalize(), "f") == text


def test_sums_of_the_widest_measures(spark):
    """Twenty whole digits are kept and summed; longer ones are null and counted."""
    from millwright.operators import analytics as A
    from millwright.plans import medallion as M

    rows = [(i, "energie_business.csv", "energie", {"machine_id": "M", "timestamp": "2024-01-01", "energy_consumption_kwh": x})
            for i, x in enumerate(["9" * 20, "9" * 20 + ".25", "9" * 25, "0." + "3" * 20])]
    rows += [(9, "mes_business.csv", "mes", {"machine_id": "M", "plant_id": "P", "timestamp": "2024-01-01", "good_qty": "1"})]
    bronze = spark.createDataFrame(rows, "bronze_event_id long, source_file string, source_system string, payload map<string,string>")
    stg = M.staging(bronze)
    energy = M.fact_energy(stg)
    assert [None if r[0] is None else format(r[0].normalize(), "f") for r in energy.orderBy("bronze_event_id").select("energy_consumption_kwh").collect()] == [
        "9" * 20, "9" * 20 + ".25", None, "0.33333333"
    ]
    assert A.energy_by_site(energy, M.fact_production(stg)).first()["energy"] > 6e19
    assert [tuple(r) for r in M.unread_numbers(bronze).collect()] == [("energie", "energy_consumption_kwh", 1)]


def test_scratch_scope_deletes_what_it_made(spark):
    import os

    from millwright.session import materialise, scratch_scope

    with scratch_scope(spark) as paths:
        outer = materialise(spark.range(3), "outer")
        with scratch_scope(spark):
            inner = materialise(outer, "inner").inputFiles()
        assert not any(os.path.exists(f.removeprefix("file://")) for f in inner) and outer.count() == 3
    assert paths and not any(os.path.exists(p) for p in paths)
