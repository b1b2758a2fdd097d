"""Business context: suppliers as the machine mapping, regions as factories, parts as products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S
from millwright.catalog import oracle as Q
from millwright.catalog.registry import query
from millwright.operators import enrich as E
from millwright.plans import business as B
from millwright.session import scratch_path
from millwright.sources.stored import Store


def factories(t):
    profile = [F.concat(F.lit(f"{c}:"), F.lower("r_name")).alias(c) for c in S.FACTORY_PROFILE]
    return t.read("region").select(
        F.concat(F.lit("PL"), "r_regionkey").alias("factory_id"), F.col("r_name").alias("factory_name"),
        F.lower("r_name").alias("country"), *profile,
    )


def bare_mapping(t):
    """Mapping without the factory profile; suppliers with a negative balance are not mapped."""
    return t.machines().filter("s_acctbal >= 0").select(
        F.concat(F.lit("S"), "s_suppkey").alias("old_machine_id"), F.concat(F.lit("CNC_"), "s_suppkey").alias("machine_id"),
        F.col("s_name").alias("machine_name"), F.lit("CNC").alias("machine_type"),
        F.concat(F.lit("PL"), "n_regionkey").alias("factory_id"), F.col("r_name").alias("factory_name"),
        F.concat(F.lit("LN"), "n_nationkey").alias("production_line_id"), F.col("n_name").alias("production_line_name"),
        F.concat(F.lit("P"), F.col("s_suppkey")).alias("default_product_id"),
    )


def mapping(t):
    return E.add_factory_profiles(bare_mapping(t), factories(t))


def parts(t):
    return t.read("part").select(
        F.concat(F.lit("P"), "p_partkey").alias("product_id"), F.col("p_name").alias("part_name"), F.col("p_type").alias("product_family"),
        F.when(F.col("p_size") < 25, F.concat(F.lit("PL"), F.col("p_size") % 5, F.lit("|PL4"))).otherwise(
            F.when(F.col("p_size") < 40, "PL1|PL2|PL3")
        ).alias("eligible_factory_ids"),
    )


MAPPING = {
    "mapping": """SELECT 'S' || s_suppkey AS old_machine_id, 'CNC_' || s_suppkey AS machine_id, s_name AS machine_name,
    'PL' || n.n_regionkey AS factory_id, r_name AS factory_name, 'LN' || n.n_nationkey AS production_line_id, 'P' || s_suppkey AS default_product_id
    FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey JOIN region ON n.n_regionkey = r_regionkey WHERE s_acctbal >= 0"""
}


def readings(t):
    return t.events().select(
        "event_id", F.concat(F.lit("S"), "user_id").alias("machine_id"), "value", F.col("event_type").alias("country"),
    )


@query(
    "enrich_machine",
    Q.sql(
        """SELECT event_id, 'S' || user_id AS old_machine_id, m.machine_id, m.factory_id, event_type AS old_country, m.production_line_id,
        'oee_profile:' || lower(m.factory_name) AS oee_profile FROM events e LEFT JOIN mapping m ON m.old_machine_id = 'S' || user_id""",
        **MAPPING,
    ),
)
def _machine(t):
    out = E.enrich_machine(readings(t), mapping(t), "scada", check=False)
    return out.select("event_id", "old_machine_id", "machine_id", "factory_id", "old_country", "production_line_id", "oee_profile")


@query("preserve_source_cols", "SELECT event_id, value, event_type AS old_country FROM events")
def _preserve(t):
    return E.preserve_source_columns(readings(t).drop("machine_id"), S.MAPPING_CONTEXT)


@query(
    "enrich_profiles",
    Q.sql("SELECT old_machine_id, factory_id, 'site_maturity_level:' || lower(factory_name) AS site_maturity_level, 'systems_maturity:' || lower(factory_name) AS systems_maturity FROM mapping", **MAPPING),
)
def _profiles(t):
    return mapping(t).select("old_machine_id", "factory_id", "site_maturity_level", "systems_maturity")


@query(
    "enrich_mes",
    Q.sql(
        """SELECT l_orderkey, l_linenumber, l_partkey, m.machine_id, 'S' || l_suppkey AS old_machine_id, m.factory_id AS plant_id, 'X' AS old_plant_id,
        m.default_product_id AS product_id, 'P' || l_partkey AS old_product_id, p_name AS part_name
        FROM lineitem LEFT JOIN mapping m ON m.old_machine_id = 'S' || l_suppkey LEFT JOIN part ON 'P' || p_partkey = m.default_product_id""",
        **MAPPING,
    ),
)
def _mes(t):
    source = t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("S"), "l_suppkey").alias("machine_id"), F.lit("X").alias("plant_id"),
        F.concat(F.lit("P"), "l_partkey").alias("product_id"),
    )
    return E.enrich_mes(source, mapping(t), parts(t), check=False).select(
        "l_orderkey", "l_linenumber", "l_partkey", "machine_id", "old_machine_id", "plant_id", "old_plant_id", "product_id",
        "old_product_id", "part_name",
    )


@query(
    "enrich_erp",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'ES01' ELSE 'PL' || substr(o_orderpriority, 1, 1) END AS plant_id, r_name AS factory_name,
       'P' || o_custkey AS product_id, p_name AS part_name, p_type AS product_family
       FROM orders LEFT JOIN region ON o_orderstatus <> 'F' AND 'PL' || r_regionkey = 'PL' || substr(o_orderpriority, 1, 1)
       LEFT JOIN part ON p_partkey = o_custkey""",
)
def _erp(t):
    source = t.read("orders").select(
        "o_orderkey", F.concat(F.lit("P"), "o_custkey").alias("product_id"),
        F.when(F.col("o_orderstatus") == "F", "FR02").otherwise(F.concat(F.lit("PL"), F.substring("o_orderpriority", 1, 1))).alias("plant_id"),
    )
    out = E.enrich_erp(source, factories(t), parts(t))
    return out.select("o_orderkey", "plant_id", "factory_name", "product_id", "part_name", "product_family")


@query("unmapped_machines", Q.sql("SELECT DISTINCT 'S' || user_id AS old_machine_id FROM events WHERE 'S' || user_id NOT IN (SELECT old_machine_id FROM mapping)", **MAPPING))
def _unmapped(t):
    return E.unmapped_machines(readings(t), mapping(t))


@query("set_difference", "SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def _difference(t):
    known = t.read("customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    return t.read("orders").select("o_custkey").subtract(known)


@query(
    "product_eligibility",
    """SELECT 'P' || p_partkey AS product_id, unnest(string_split(CASE WHEN p_size < 25 THEN 'PL' || (p_size % 5) || '|PL4' WHEN p_size < 40 THEN 'PL1|PL2|PL3' END, '|')) AS factory_id FROM part""",
)
def _eligibility(t):
    return E.product_eligibility(parts(t))


@query(
    "eligible_parts",
    """SELECT factory_id, count(*) AS n FROM (SELECT unnest(string_split(CASE WHEN p_size < 25 THEN 'PL' || (p_size % 5) || '|PL4' WHEN p_size < 40 THEN 'PL1|PL2|PL3' END, '|')) AS factory_id FROM part)
       WHERE factory_id IN (SELECT 'PL' || r_regionkey FROM region) GROUP BY 1""",
)
def _eligible(t):
    return E.eligible_parts(factories(t), parts(t)).groupBy("factory_id").agg(F.count(F.lit(1)).alias("n"))


@query("row_aligned_join", "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _aligned(t):
    return E.row_aligned(t.read("documents").select("doc_id", "lang"), t.read("labels"), "doc_id", ["quality"])


@query("leak_free_features", Q.sql("SELECT count(*) AS n, CAST(sum(failure_within_7_days) AS BIGINT) AS positives, CAST(15 AS BIGINT) AS n_columns FROM silver"))
def _features(t):
    from millwright.ml.features import build_xy

    xy = build_xy(t.silver(), "clf")
    return xy.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"), F.lit(len(xy.columns) - 1).cast("long").alias("n_columns"))


@query("target_not_null", Q.sql(f"SELECT machine_id, {Q.dbl('s_remaining_useful_life_days')} AS label FROM silver WHERE s_remaining_useful_life_days IS NOT NULL"))
def _target(t):
    from millwright.ml.features import build_xy

    return build_xy(t.silver(), "reg").select("machine_id", "label")


# ------------------------------------------------------------------ published tables
SOURCES = {
    "energie": "SELECT CAST(o_orderkey AS VARCHAR) AS row_key, 'S' || o_custkey AS machine FROM orders WHERE o_orderstatus <> 'P'",
    "gmao": "SELECT CAST(o_orderkey AS VARCHAR) AS row_key, 'S' || o_custkey AS machine FROM orders WHERE o_orderstatus = 'P'",
    "scada_capteurs": "SELECT CAST(event_id AS VARCHAR) AS row_key, 'S' || user_id AS machine FROM events",
}
PUBLISHED = " UNION ALL ".join(
    f"""SELECT '{name}_business' AS table_name, s.row_key, m.machine_id, s.machine AS old_machine_id, m.factory_id AS plant, m.production_line_id AS line
    FROM ({sql}) s LEFT JOIN mapping m ON m.old_machine_id = s.machine"""
    for name, sql in SOURCES.items()
)
PUBLISHED += """ UNION ALL SELECT 'mes_business', s.l_orderkey || '-' || s.l_linenumber, m.machine_id, 'S' || s.l_suppkey, m.factory_id, p.p_name
  FROM lineitem s LEFT JOIN mapping m ON m.old_machine_id = 'S' || s.l_suppkey LEFT JOIN part p ON m.default_product_id = 'P' || p.p_partkey
UNION ALL SELECT 'erp_business', CAST(c_custkey AS VARCHAR), NULL, NULL, CASE WHEN c_nationkey = 3 THEN 'ES01' ELSE 'PL' || (c_nationkey % 6) END, p_name
  FROM customer LEFT JOIN part ON p_partkey = c_custkey
UNION ALL SELECT 'factories', 'PL' || r_regionkey, NULL, NULL, r_name, NULL FROM region
UNION ALL SELECT 'production_lines', 'LN' || n_nationkey, NULL, NULL, 'PL' || n_regionkey, n_name FROM nation
UNION ALL SELECT 'parts', 'P' || p_partkey, NULL, NULL, NULL, p_name FROM part
UNION ALL SELECT 'machine_mapping', old_machine_id, machine_id, old_machine_id, factory_id, production_line_id FROM mapping"""


@query("publish_business_tables", Q.sql(PUBLISHED, **MAPPING))
def _publish(t):
    """All nine tables after a first set was published and replaced with one commit."""
    orders = t.read("orders").withColumn("machine_id", F.concat(F.lit("S"), "o_custkey"))
    sources = {
        "energie": orders.where("o_orderstatus <> 'P'"), "gmao": orders.where("o_orderstatus = 'P'"),
        "scada_capteurs": t.read("events").withColumn("machine_id", F.concat(F.lit("S"), "user_id")),
        "mes": t.read("lineitem").select(
            "l_orderkey", "l_linenumber", F.concat(F.lit("S"), "l_suppkey").alias("machine_id"), F.lit("old").alias("plant_id"), F.lit("old").alias("product_id")
        ),
        "erp": t.read("customer").select(
            "c_custkey", F.when(F.col("c_nationkey") == 3, "FR02").otherwise(F.concat(F.lit("PL"), F.col("c_nationkey") % 6)).alias("plant_id"),
            F.concat(F.lit("P"), "c_custkey").alias("product_id"),
        ),
    }
    lines = t.read("nation").select(
        F.concat(F.lit("LN"), "n_nationkey").alias("production_line_id"), F.concat(F.lit("PL"), "n_regionkey").alias("factory_id"), "n_name"
    )
    tables = B.business_tables(sources, factories(t), lines, parts(t), mapping(t), check=False)
    keys = {"energie_business": ["o_orderkey"], "gmao_business": ["o_orderkey"], "scada_capteurs_business": ["event_id"],
            "mes_business": ["l_orderkey"], "erp_business": ["c_custkey"]}
    store = Store(t.spark, scratch_path(t.spark, "business"), 4)
    B.publish(store, {n: df.limit(0) for n, df in tables.items()}, keys)
    B.publish(store, tables, keys)
    none = F.lit(None).cast("string")
    shown = {n: ("o_orderkey", "machine_id", "old_machine_id", "factory_id", "production_line_id") for n in ("energie_business", "gmao_business")}
    shown |= {
        "scada_capteurs_business": ("event_id", "machine_id", "old_machine_id", "factory_id", "production_line_id"),
        "mes_business": (F.concat_ws("-", "l_orderkey", "l_linenumber"), "machine_id", "old_machine_id", "plant_id", "part_name"),
        "erp_business": ("c_custkey", none, none, "plant_id", "part_name"), "factories": ("factory_id", none, none, "factory_name", none),
        "production_lines": ("production_line_id", none, none, "factory_id", "n_name"), "parts": ("product_id", none, none, none, "part_name"),
        "machine_mapping": ("old_machine_id", "machine_id", "old_machine_id", "factory_id", "production_line_id"),
    }
    names = ("row_key", "machine_id", "old_machine_id", "plant", "line")
    rows = [
        store.read(n).select(F.lit(n).alias("table_name"), *[(F.col(c) if isinstance(c, str) else c).cast("string").alias(a) for c, a in zip(columns, names)])
        for n, columns in shown.items()
    ]
    return reduce(DataFrame.unionByName, rows)
