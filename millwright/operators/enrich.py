"""Business context from the machine mapping, factories and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S


def add_factory_profiles(mapping: DataFrame, factories: DataFrame) -> DataFrame:
    return mapping.join(factories.select("factory_id", *S.FACTORY_PROFILE), "factory_id", "left")


def unmapped_machines(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Machine ids of the data that the mapping does not know."""
    ids = df.select(F.col("machine_id").cast("string").alias("old_machine_id")).distinct()
    return ids.filter("old_machine_id is not null").join(
        mapping.select("old_machine_id"), "old_machine_id", "left_anti"
    )


def assert_mapped(df: DataFrame, mapping: DataFrame, dataset: str, shown: int = 50) -> None:
    missing = [r[0] for r in unmapped_machines(df, mapping).orderBy("old_machine_id").take(shown)]
    if missing:
        raise ValueError(f"{dataset}: machines missing from the mapping: {missing}")


def preserve_source_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rename the columns a join would collide with to ``old_<name>``."""
    renames = {c: f"old_{c}" for c in columns if c in df.columns and f"old_{c}" not in df.columns}
    return df.withColumnsRenamed(renames)


def enrich_machine(df: DataFrame, mapping: DataFrame, dataset: str, check: bool = True) -> DataFrame:
    """Swap in the business machine id and add the context columns of the mapping."""
    if check:
        assert_mapped(df, mapping, dataset)
    source = preserve_source_columns(
        df.withColumn("old_machine_id", F.col("machine_id")).drop("machine_id"), S.MAPPING_CONTEXT
    )
    known = [c for c in S.MAPPING_COLUMNS if c in mapping.columns]
    return source.join(mapping.select(*known), "old_machine_id", "left")


def enrich_mes(df: DataFrame, mapping: DataFrame, parts: DataFrame, check: bool = True) -> DataFrame:
    source = df.withColumns({"old_plant_id": F.col("plant_id"), "old_product_id": F.col("product_id")})
    out = enrich_machine(source.drop("plant_id", "product_id"), mapping, "mes", check)
    out = out.withColumns({"plant_id": F.col("factory_id"), "product_id": F.col("default_product_id")})
    return out.drop("default_product_id").join(parts.select("product_id", "part_name"), "product_id", "left")


def remap_values(df: DataFrame, column: str, pairs: dict[str, str]) -> DataFrame:
    return df.replace(pairs, subset=[column])


def enrich_erp(df: DataFrame, factories: DataFrame, parts: DataFrame) -> DataFrame:
    remapped = remap_values(df, "plant_id", {"FR02": "ES01"})
    sites = factories.withColumnRenamed("factory_id", "plant_id")
    return remapped.join(sites, "plant_id", "left").join(
        parts.select("product_id", "part_name", "product_family"), "product_id", "left"
    )


def product_eligibility(parts: DataFrame) -> DataFrame:
    """One (factory, product) row per entry of the pipe-separated list."""
    entry = F.explode(F.split(F.coalesce(F.col("eligible_factory_ids"), F.lit("")), r"\|"))
    return parts.select("product_id", entry.alias("factory_id")).filter("factory_id <> ''")


def eligible_parts(factories: DataFrame, parts: DataFrame) -> DataFrame:
    """Products each factory is listed for."""
    allowed = factories.select("factory_id").join(product_eligibility(parts), "factory_id")
    return allowed.select("factory_id", "product_id")


def row_aligned(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns of ``right`` beside the row of ``left`` with the same row key."""
    return left.join(right.select(key, *columns), key, "left")
