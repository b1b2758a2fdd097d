"""The enriched business tables, published together."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millwright.operators import enrich as E
from millwright.sources.stored import Store

#: Key columns of each published table.
KEYS = {"factories": ["factory_id"], "production_lines": ["production_line_id"], "parts": ["product_id"], "machine_mapping": ["old_machine_id"]}
#: Sources whose rows get the context of their machine.
BY_MACHINE = {"energie": "energie_business", "gmao": "gmao_business", "scada_capteurs": "scada_capteurs_business"}


def business_tables(
    sources: dict[str, DataFrame], factories: DataFrame, lines: DataFrame, parts: DataFrame, mapping: DataFrame, check: bool = True
) -> dict[str, DataFrame]:
    """The four reference tables and the five sources with their business context.

    ``sources`` has energie, gmao, scada_capteurs, mes and erp. With ``check`` a machine that
    the mapping does not know is an error.
    """
    out = {"factories": factories, "production_lines": lines, "parts": parts, "machine_mapping": mapping.drop("default_product_id")}
    for source, name in BY_MACHINE.items():
        out[name] = E.enrich_machine(sources[source], mapping, source, check).drop("default_product_id")
    out["mes_business"] = E.enrich_mes(sources["mes"], mapping, parts, check)
    out["erp_business"] = E.enrich_erp(sources["erp"], factories, parts)
    return out


def publish(store: Store, tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> int:
    """Write all tables and show them with one commit; until then readers see the set before.

    ``keys`` names the columns that deal a table's rows to its buckets.
    """
    for name, df in tables.items():
        store.replace(name, df, keys.get(name) or KEYS.get(name) or df.columns[:1])
    return store.commit()
