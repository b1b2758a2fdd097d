"""Status ladders, labels and display values of the dashboards.

Arguments are SQL expressions given as text, mostly column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.functions.parse import text_map


def half_even_sql(e: str, digits: int = 1) -> str:
    scale = f"CAST({10**digits} AS DOUBLE)"
    x = f"CAST({e} AS DOUBLE)"
    product = f"({x} * {scale})"
    carrier = f"({x} * CAST(134217729 AS DOUBLE))"
    high = f"({carrier} - ({carrier} - {x}))"
    error = f"(({high} * {scale} - {product}) + ({x} - {high}) * {scale})"
    tie = f"abs({product} - CAST(floor({product}) AS DOUBLE)) = 0.5D"
    return (
        f"(CASE WHEN {tie} AND {error} > 0 THEN CAST(ceil({product}) AS DOUBLE) "
        f"WHEN {tie} AND {error} < 0 THEN CAST(floor({product}) AS DOUBLE) ELSE rint({product}) END / {scale})"
    )


def half_even(e: str, digits: int = 1) -> Column:
    """Round a double half to even on its binary value, keeping null.

    Scaling can land exactly on a half although the true product lies beside it, so
    the rounding error of the product is recovered (split multiplication) and decides.
    """
    return F.expr(half_even_sql(e, digits))


def whole_sql(e: str) -> str:
    return f"CAST(rint(CAST({e} AS DOUBLE)) AS BIGINT)"


def whole(e: str) -> Column:
    """Nearest integer, halves to even."""
    return F.expr(whole_sql(e))


def status_trs(e: str) -> Column:
    return F.expr(f"CASE WHEN {e} >= 85 THEN 'good' WHEN {e} >= 70 THEN 'warn' ELSE 'crit' END")


def status_reach(e: str) -> Column:
    return F.expr(f"CASE WHEN {e} >= 90 THEN 'good' WHEN {e} >= 80 THEN 'warn' ELSE 'crit' END")


def status_scrap(e: str) -> Column:
    return F.expr(f"CASE WHEN {e} IS NULL OR {e} < 3 THEN 'good' WHEN {e} < 5 THEN 'warn' ELSE 'crit' END")


def status_rul(e: str) -> Column:
    return F.expr(f"CASE WHEN {e} < 30 THEN 'crit' WHEN {e} < 90 THEN 'warn' ELSE 'good' END")


def status_risk(e: str) -> Column:
    return F.expr(f"CASE WHEN {e} >= 75 THEN 'crit' WHEN {e} >= 50 THEN 'warn' ELSE 'good' END")


def severity_label(e: str) -> Column:
    return F.expr(f"coalesce({text_map(S.SEVERITY_WORDS)}[lower({e})], 'mineur')")


def risk_score(probability: str, rul_days: str) -> Column:
    """0-100 score: equal parts of the classifier output and of how close the end of life is."""
    classifier = f"(coalesce(CAST({probability} AS DOUBLE), 0D) * 100)"
    urgency = f"greatest(0D, least(100D, 100D * (1D - CAST({rul_days} AS DOUBLE) / {S.RUL_HORIZON_DAYS})))"
    return F.expr(
        f"CASE WHEN {rul_days} IS NULL THEN {whole_sql(classifier)} "
        f"ELSE {whole_sql(f'0.5D * {classifier} + 0.5D * {urgency}')} END"
    )


def _key_text(e: str, pieces: list[tuple[int, int]]) -> Column:
    text = f"CAST({e} AS STRING)"
    shown = ", ".join(f"substring({text}, {start}, {n})" for start, n in pieces)
    return F.expr(
        f"CASE WHEN {e} IS NULL THEN '' WHEN length({text}) = 8 THEN concat_ws('/', {shown}) ELSE {text} END"
    )


def day_label(date_id: str) -> Column:
    return _key_text(date_id, [(7, 2), (5, 2)])


def date_label(date_id: str) -> Column:
    return _key_text(date_id, [(7, 2), (5, 2), (1, 4)])


def alert_title(alert_type: str) -> Column:
    text = f"replace(coalesce(nullif({alert_type}, ''), 'Alerte'), '_', ' ')"
    return F.expr(f"concat(upper(substring({text}, 1, 1)), lower(substring({text}, 2)))")


def model_label(name: str, version: str) -> Column:
    """Name and version; null without a name."""
    return F.expr(
        f"CASE WHEN nullif({name}, '') IS NOT NULL THEN concat({name}, coalesce(concat(' v', nullif({version}, '')), '')) END"
    )


def state_of(risk: str, threshold: float = 0.5) -> Column:
    return F.expr(f"CASE WHEN {risk} >= {threshold} THEN 'at_risk' ELSE 'normal' END")


def clamp_rul(days: str) -> Column:
    return F.expr(f"CASE WHEN {days} IS NOT NULL THEN greatest(CAST({days} AS DOUBLE), 0D) END")


def mean_risk_tone(mean: str) -> Column:
    return F.expr(f"CASE WHEN {mean} >= 0.5 THEN 'crit' WHEN {mean} >= 0.25 THEN 'warn' ELSE 'good' END")


def mean_rul_tone(mean: str) -> Column:
    return F.expr(f"CASE WHEN {mean} < 90 THEN 'warn' ELSE 'good' END")


def alert_count_tone(count: str) -> Column:
    return F.expr(f"CASE WHEN {count} > 100 THEN 'crit' ELSE 'warn' END")
