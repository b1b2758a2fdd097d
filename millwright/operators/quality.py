"""Data-quality audit: completeness, anomalies, distributions and the maturity score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.functions.parse import coerce_number, missing_to_null
from millwright.functions.status import half_even_sql


def normalise_for_audit(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Missing markers to null and known numeric columns to numbers, in one projection."""

    def cleaned(c: str) -> Column:
        text = missing_to_null(F.col(c), S.AUDIT_MISSING_MARKERS) if _is_text(df, c) else F.col(c)
        return coerce_number(text) if c in numeric else text

    return df.select(*[cleaned(c).alias(c) for c in df.columns])


def _is_text(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.simpleString() == "string"


def missing_by_column(df: DataFrame, dataset: str) -> DataFrame:
    """Missing count and share per column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(f"m_{i}") for i, c in enumerate(df.columns)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(f"m_{i}"), F.lit(0)).alias("missing_count"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select("_rows", F.explode(pairs).alias("p")).select(
        F.lit(dataset).alias("dataset"),
        "p.column_name",
        "p.missing_count",
        (F.col("p.missing_count") / F.nullif(F.col("_rows"), F.lit(0))).alias("missing_pct"),
    )


def union_missing(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [missing_by_column(df, n) for n, df in tables.items()])


def top_missing(missing: DataFrame, n: int = 20, overall: bool = False) -> DataFrame:
    """First columns with gaps: by dataset and then count, or by count alone."""
    worst = [F.desc("missing_count"), F.asc("column_name")]
    return missing.filter("missing_count > 0").orderBy(*(worst if overall else ["dataset", *worst])).limit(n)


def _cells(df: DataFrame, source: str, side: str) -> DataFrame:
    missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias(f"{side}_rows"), F.coalesce(F.sum(missing), F.lit(0)).alias(f"{side}_missing")
    ).select(
        F.lit(source).alias("source"),
        f"{side}_rows",
        f"{side}_missing",
        (F.col(f"{side}_rows") * len(df.columns)).alias(f"{side}_cells"),
    )


def completeness_summary(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows, cells and missing cells of each source before and after cleaning."""
    raw = reduce(DataFrame.unionByName, [_cells(r, n, "raw") for n, (r, _) in pairs.items()])
    clean = reduce(DataFrame.unionByName, [_cells(c, n, "clean") for n, (_, c) in pairs.items()])
    return raw.join(clean, "source").withColumns(
        {
            f"{side}_missing_pct": F.col(f"{side}_missing")
            / F.nullif(F.col(f"{side}_cells"), F.lit(0))
            for side in ("raw", "clean")
        }
    )


def completeness_totals(summary: DataFrame) -> DataFrame:
    total = summary.agg(
        *[F.sum(f"{side}_{k}").alias(f"{side}_{k}") for side in ("raw", "clean") for k in ("missing", "cells")]
    )
    rate = (F.col("raw_missing") - F.col("clean_missing")) / F.nullif(F.col("raw_missing"), F.lit(0))
    return total.select(
        "raw_missing",
        "clean_missing",
        (F.col("raw_missing") / F.nullif(F.col("raw_cells"), F.lit(0))).alias("raw_missing_pct"),
        (F.col("clean_missing") / F.nullif(F.col("clean_cells"), F.lit(0))).alias("clean_missing_pct"),
        F.coalesce(rate, F.lit(0.0)).alias("improvement_rate"),
    )


def out_of_range(c: Column, low, high, low_included: bool = True) -> Column:
    below = c < low if low_included else c <= low
    return F.coalesce(below | (c > high), F.lit(False))


def anomaly_counts(raw: dict[str, DataFrame], clean: dict[str, DataFrame], rules: dict | None = None) -> DataFrame:
    """Out-of-range values per named rule before and after cleaning; each table is read once."""
    rules = rules or S.ANOMALY_RULES
    found = []
    for side, tables in (("raw", raw), ("clean", clean)):
        for dataset, df in tables.items():
            own = {label: r for label, r in rules.items() if r[0] == dataset and r[1] in df.columns}
            if not own:
                continue
            bad = [out_of_range(F.col(c).cast("double"), low, high, included) for _, c, low, high, included in own.values()]
            counts = df.agg(*[F.count_if(b).alias(f"c{i}") for i, b in enumerate(bad)])
            told = [F.struct(F.lit(label).alias("anomaly_type"), F.lit(r[1]).alias("column_name"), F.col(f"c{i}").alias("n")) for i, (label, r) in enumerate(own.items())]
            found.append(counts.select(F.lit(side).alias("side"), F.inline(F.array(*told))))
    sides = [F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).alias(f"{s}_anomalies") for s in ("raw", "clean")]
    return reduce(DataFrame.unionByName, found).groupBy("anomaly_type", "column_name").agg(*sides)


def production_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("actual_production_qty").alias("actual_total"),
        F.sum("good_qty").alias("good_total"),
        F.sum("scrap_qty").alias("scrap_total"),
        (
            F.sum("scrap_qty").cast("double")
            / F.nullif(F.sum("actual_production_qty").cast("double"), F.lit(0.0))
        ).alias("scrap_rate"),
        (F.sum("quality_score").cast("double") / F.nullif(F.count("quality_score"), F.lit(0))).alias("quality_mean"),
    )


def production_by_machine(df: DataFrame) -> DataFrame:
    """Quantities per machine; rows without a machine keep a group of their own."""
    return df.groupBy("machine_id").agg(
        F.sum("actual_production_qty").alias("actual"),
        F.sum("good_qty").alias("good"),
        F.sum("scrap_qty").alias("scrap"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins from the minimum to the maximum, last bin closed."""
    value = F.col(column).cast("double")
    known = df.select(value.alias("v")).filter("v is not null")
    ends = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")))
    placed = known.withColumn("e", ends.scalar())
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    index = F.least(
        F.floor((F.col("v") - F.col("e.lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)
    )
    return placed.groupBy(F.coalesce(index, F.lit(0)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def maturity_score(totals: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Five scores out of ten from the missing and anomaly rates."""
    counts = anomalies.agg(
        F.struct(F.sum("raw_anomalies").alias("raw"), F.sum("clean_anomalies").alias("clean"))
    )
    rounded = half_even_sql
    mean = "(completeness + coherence + traceability + reliability) / 4"
    steps = {
        "completeness": f"greatest(0D, least(10D, {rounded('(1D - clean_missing_pct) * 10')}))",
        "coherence": "CASE WHEN _a.clean = 0 THEN 10D ELSE "
        f"greatest(0D, {rounded('10D - _a.clean / greatest(_a.raw, 1) * 10')}) END",
        "traceability": f"{S.TRACEABILITY_SCORE}D",
        "reliability": rounded("(completeness + coherence) / 2"),
        "ai_readiness": f"greatest(0D, least(10D, {rounded(f'{mean} - 1')}))",
    }
    out = totals.withColumn("_a", counts.scalar())
    for name, value in steps.items():
        out = out.selectExpr("*", f"{value} AS {name}")
    return out.select("completeness", "coherence", "traceability", "reliability", "ai_readiness")


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def flag_prevalence(df: DataFrame, flags: list[str]) -> DataFrame:
    """Share of rows each flag is set on, most frequent first."""
    means = df.agg(*[(F.sum(f).cast("double") / F.count(f)).alias(f) for f in flags])
    return means.unpivot([], flags, "flag", "prevalence").orderBy(F.desc("prevalence"), "flag")


def repair_timestamps(df: DataFrame, column: str, raw: str) -> DataFrame:
    """Use the raw timestamp when the cleaned ones are implausibly old (median year below 2000)."""
    years = df.groupBy(F.year(column).alias("y")).agg(F.count(F.lit(1)).alias("n")).filter("y is not null")
    median = years.agg(F.expr("percentile(y, 0.5, n)")).scalar()
    repaired = F.coalesce(F.col(raw), F.col(column))
    return df.withColumn(column, F.when(median < 2000, repaired).otherwise(F.col(column)))
