"""The test tables seen as the industrial domain.

``events`` become sensor readings, ``lineitem`` production records, ``orders`` energy and
maintenance records, ``part``, ``supplier``, ``nation`` and ``region`` the products,
machines, lines and plants. Field text keeps the defects of real sources: blanks, padding,
words instead of numbers, implausible values, absent keys.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas as S
from millwright.functions.parse import event_key_sql
from millwright.plans import medallion as M
from millwright.session import tune
from millwright.sources.lake import with_payload

TS = "yyyy-MM-dd HH:mm:ss"
K = "CAST(get_json_object(props, '$.k') AS int)"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text."""

    def shown(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd")
        return c

    return df.select(*[shown(f).alias(f.name) for f in df.schema.fields])


#: Rows of a source that one task parses; tasks grow in number with the table, not in length.
TASK_ROWS = 250_000


def dealt(df: DataFrame, key: str, parts: int = 1) -> DataFrame:
    """Rows dealt to the cores by their key, in at least ``parts`` tasks, so that what follows runs on all of them.

    Filters on parsed columns, which joins add for their keys too, would be moved below the
    shuffle and parse every row in the few tasks of the scan. No filter moves below one that
    is not deterministic; this one is true for every row.
    """
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), key).where(F.spark_partition_id() >= 0)


class Tables:
    """Access to one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def source(self, name: str, key: str) -> DataFrame:
        """A table that poses as a raw source of many files; here it is one file of one or two row groups,
        which a scan cannot divide, so its rows are dealt to the cores by their key."""
        rows = self.read(name)
        return dealt(rows, key, math.ceil(rows.count() / TASK_ROWS))

    # ------------------------------------------------------------ readings
    def events(self) -> DataFrame:
        return self.source("events", "event_id").withColumn("k", F.expr(K))

    READING = {
        "timestamp": "CASE WHEN k < 1 THEN '' ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") END",
        "machine_id": "CASE WHEN k > 98 THEN '' ELSE concat('S', user_id) END",
        "cycle_time_sec": "CAST(k + 15 AS string)",
        "Temperature_C": "CAST(value AS decimal(18,2))",
        "Vibration_mms": "CAST(CAST(k * 0.1 AS decimal(10,1)) AS string)",
        "Sound_dB": "CAST(k + 30 AS string)",
        "Oil_Level_pct": "CAST(100 - k AS string)",
        "Coolant_Level_pct": "CASE WHEN event_type = 'view' THEN concat(' ', k, ' ') ELSE CAST(k AS string) END",
        "Hydraulic_Pressure_bar": "CAST(k * 2 + 30 AS string)",
        "Coolant_Flow_L_min": "CAST(k AS string)",
        "Heat_Index": "CAST(k + 25 AS string)",
        "Power_Consumption_kW": "CASE WHEN k < 95 THEN CAST(CAST(k * 1.5 AS decimal(10,1)) AS string) END",
        "Operational_Hours": "CAST(event_id AS string)",
        "Error_Codes_Last_30_Days": "CAST(CAST(k * 0.1 AS decimal(10,1)) AS string)",
        "AI_Override_Events": "CASE WHEN event_type = 'click' THEN 'n/a' ELSE CAST(k div 25 AS string) END",
        "Failure_Within_7_Days": "CASE WHEN k >= 93 THEN 1 ELSE 0 END",
        "Remaining_Useful_Life_days": "CAST(380 - k * 4 AS string)",
        "predicted_failure_probability": "CAST(CAST(k * 0.01 AS decimal(10,2)) AS string)",
        "sensor_anomaly_score": "CAST(CAST((110 - k) * 0.01 AS decimal(10,2)) AS string)",
        "flag_temperature_high": "CASE WHEN value > 72 THEN '1' ELSE '0' END",
        "flag_vibration_high": "CASE WHEN k >= 80 THEN 'true' ELSE 'false' END",
        "flag_oil_low": "CASE WHEN k >= 88 THEN ' Oui ' END",
    }
    EVENT_FILE = f"""CASE event_type WHEN 'purchase' THEN 'erp_business.csv' WHEN 'signup' THEN 'crm_sale.csv'
        WHEN 'view' THEN CASE WHEN k < 50 THEN 'scada_capteurs_sale.csv' ELSE 'scada_capteurs_business.csv' END
        ELSE '{S.REALTIME_SOURCE_FILE}' END"""
    EVENT_SYSTEM = "CASE event_type WHEN 'purchase' THEN 'erp' WHEN 'signup' THEN 'crm' ELSE 'scada_capteurs' END"

    def raw_events(self) -> DataFrame:
        """Events with their payload as JSON text."""
        return self.as_raw(self.events())

    def as_raw(self, events: DataFrame) -> DataFrame:
        fields = ", ".join(f"'{n}', {e}" for n, e in self.READING.items())
        return events.selectExpr(
            "event_id AS bronze_event_id", f"{self.EVENT_FILE} AS source_file", f"{self.EVENT_SYSTEM} AS source_system",
            f"to_json(named_struct({fields})) AS payload_json",
        )

    def bronze_events(self) -> DataFrame:
        return with_payload(self.raw_events())

    def silver(self) -> DataFrame:
        return M.bronze_to_silver(self.bronze_events())

    # ------------------------------------------------------------ production
    def machines(self) -> DataFrame:
        """supplier with its line and plant."""
        return (
            self.read("supplier")
            .join(self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", "n_nationkey", "n_regionkey", "n_name", "r_name", "s_name", "s_acctbal")
        )

    @staticmethod
    def _bronze(df: DataFrame, key: str, file: str, system: str, fields: dict[str, str]) -> DataFrame:
        """Texts are columns before they are a map, and a statement that only looks keys up reads the columns: no map
        is built for it. The filter, true for every row, keeps the two steps apart."""
        pairs = ", ".join(f"'{n}', `_{n}`" for n in fields)
        texts = df.selectExpr(f"CAST({key} AS bigint) AS bronze_event_id", *[f"CAST({e} AS string) AS `_{n}`" for n, e in fields.items()], "spark_partition_id() AS _part")
        return texts.where("_part >= 0").selectExpr(
            "bronze_event_id", f"'{file}' AS source_file", f"'{system}' AS source_system", f"map({pairs}) AS payload",
        )

    MES = {
        "timestamp": f"date_format(l_shipdate + make_dt_interval(0, l_linenumber * 3), '{TS}')",
        "shift": "CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'O' THEN ' Matin ' ELSE 'après-midi' END "
        "WHEN l_returnflag = 'N' THEN 'week end' END",
        "plant_id": "concat('PL', n_regionkey)",
        "production_line_id": "concat('LN', n_nationkey)",
        "machine_id": "concat('S', l_suppkey)",
        "product_id": "concat('P', l_partkey)",
        "planned_production_qty": "'60'",
        "actual_production_qty": "concat(' ', CAST(l_quantity AS int))",
        "good_qty": "CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS int) - floor(l_quantity / 10) ELSE CAST(l_quantity AS int) END",
        "scrap_qty": "CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_returnflag = 'R' THEN CAST(floor(l_quantity / 10) AS string) ELSE '0' END",
        "cycle_time_sec": "CAST(CAST(l_extendedprice AS decimal(18,2)) * 0.001 AS decimal(18,5))",
        "production_speed": "CAST(round(l_tax * 100) AS int) + 80",
        "downtime_minutes": "CASE WHEN l_discount = 0 THEN '' ELSE CAST(CAST(round(l_discount * 100) AS int) * 10 AS string) END",
        "setup_time_minutes": "l_linenumber * 5",
        "defect_type": "CASE l_returnflag WHEN 'R' THEN 'Rayure' WHEN 'A' THEN ' ' END",
        "defect_category": "CASE WHEN l_linestatus = 'F' THEN 'esthetique' END",
        "defect_severity": "CASE WHEN l_returnflag = 'R' THEN 'major' END",
        "is_conforming": "CASE l_returnflag WHEN 'N' THEN 'True' WHEN 'A' THEN ' oui ' ELSE '0' END",
        "scrap_flag": "CASE WHEN l_returnflag = 'R' THEN 'YES' ELSE '' END",
        "rework_required": "CASE WHEN l_returnflag = 'R' THEN 't' END",
        "dimension_measurement": "CAST(9 + CAST(l_quantity AS decimal(4,0)) * 0.04 AS decimal(18,2))",
        "tolerance_min": "'9.5'",
        "tolerance_max": "'10.5'",
        "quality_score": "100 - CAST(round(l_discount * 100) AS int)",
    }

    def bronze_mes(self) -> DataFrame:
        lines = self.source("lineitem", "l_orderkey").join(
            self.machines().select("s_suppkey", "n_nationkey", "n_regionkey"),
            F.col("l_suppkey") == F.col("s_suppkey"),
            "left",
        )
        key = event_key_sql(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "CAST(l_extendedprice AS decimal(18,2))"
        )
        return self._bronze(lines, key, "mes_business.csv", "mes", self.MES)

    # ------------------------------------------------------------ energy, maintenance
    PRICE = "CAST(o_totalprice AS decimal(18,2))"
    ENERGY = {
        "timestamp": f"date_format(o_orderdate, '{TS}')",
        "machine_id": "concat('S', o_custkey)",
        "energy_consumption_kwh": PRICE,
        "compressed_air_usage": f"CAST({PRICE} * 0.001 AS decimal(18,5))",
        "cooling_water_usage": "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '12.5' END",
        "power_peak_kw": "CASE WHEN o_orderpriority = '1-URGENT' THEN '1e3' ELSE concat(substring(o_orderpriority, 1, 1), '00') END",
        "energy_cost": f"CAST({PRICE} * 0.1 AS decimal(18,3))",
    }
    MAINTENANCE = {
        "timestamp": f"date_format(o_orderdate, '{TS}')",
        "machine_id": "concat('S', o_custkey)",
        "maintenance_event_id": "concat('MEV', o_orderkey)",
        "maintenance_type": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'corrective' ELSE ' preventive' END",
        "failure_type": "lower(substring(o_orderpriority, 3))",
        "failure_code": "concat('F00', substring(o_orderpriority, 1, 1))",
        "failure_severity": "CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'major' ELSE '' END",
        "repair_time_minutes": f"CAST({PRICE} * 0.001 AS decimal(18,5))",
        "downtime_minutes": "CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE concat(substring(o_orderpriority, 1, 1), '5') END",
        "maintenance_cost": PRICE,
        "predicted_failure_probability": "concat('0.', substring(o_orderpriority, 1, 1))",
    }

    def bronze_energy(self) -> DataFrame:
        orders = self.source("orders", "o_orderkey").filter("o_orderstatus <> 'P'")
        return self._bronze(orders, "o_orderkey", "energie_business.csv", "energie", self.ENERGY)

    def bronze_maintenance(self) -> DataFrame:
        orders = self.source("orders", "o_orderkey").filter("o_orderstatus = 'P'")
        return self._bronze(orders, "o_orderkey", "gmao_business.csv", "gmao", self.MAINTENANCE)

    # ------------------------------------------------------------ reference rows
    PARTS = {"product_id": "concat('P', p_partkey)", "part_name": "p_name", "product_family": "p_type"}
    LINES = {
        "production_line_id": "concat('LN', n_nationkey)", "production_line_name": "n_name",
        "factory_id": "concat('PL', n_regionkey)",
    }
    PLANTS = {"factory_id": "concat('PL', r_regionkey)", "factory_name": "r_name", "country": "lower(r_name)"}
    MACHINES = {
        "machine_id": "concat('S', s_suppkey)", "machine_type": "s_name",
        "production_line_id": "concat('LN', n_nationkey)", "factory_id": "concat('PL', n_regionkey)",
        "installation_year": "CASE WHEN s_acctbal > 0 THEN '2015.5' ELSE 'unknown' END",
    }

    def bronze_reference(self) -> DataFrame:
        sources = [
            (self.read("part"), "p_partkey", "parts", self.PARTS),
            (self.read("nation"), "n_nationkey", "production_lines", self.LINES),
            (self.read("region"), "r_regionkey", "factories", self.PLANTS),
            (self.machines(), "s_suppkey", "machine_mapping", self.MACHINES),
        ]
        return reduce(
            DataFrame.unionByName, [self._bronze(df, key, f"{name}.csv", name, f) for df, key, name, f in sources]
        )

    def bronze(self) -> DataFrame:
        return reduce(
            DataFrame.unionByName,
            [self.bronze_events(), self.bronze_mes(), self.bronze_energy(), self.bronze_maintenance(), self.bronze_reference()],
        )

    # ------------------------------------------------------------ gold
    def production(self) -> DataFrame:
        return M.fact_production(M.staging(self.bronze_mes()))

    def quality(self) -> DataFrame:
        return M.fact_quality(M.staging(self.bronze_mes()))

    def energy(self) -> DataFrame:
        return M.fact_energy(M.staging(self.bronze_energy()))

    def maintenance(self) -> DataFrame:
        return M.fact_maintenance(M.staging(self.bronze_maintenance()))

    def alerts(self) -> DataFrame:
        return M.fact_alerts(M.staging(self.bronze_events()))

    def plants(self) -> DataFrame:
        return M.dim_plant(M.staging(self.bronze_reference()))

    def gold(self) -> dict[str, DataFrame]:
        return {
            "fact_production": self.production(), "fact_quality": self.quality(), "fact_energy": self.energy(),
            "fact_maintenance": self.maintenance(), "fact_alerts": self.alerts(), "dim_plant": self.plants(),
        }

    def predictions(self) -> DataFrame:
        """Model answers for the newest reading of each machine; half of the answers have no RUL."""
        from millwright.operators.ordered import latest_by

        newest = latest_by(
            self.silver().filter("machine_id is not null")
            .select("machine_id", "event_ts", "bronze_event_id", "predicted_failure_probability",
                    "remaining_useful_life_days", "error_codes_last_30_days"),
            "machine_id", "event_ts", "bronze_event_id",
        )
        p = F.col("predicted_failure_probability").cast("double")
        return newest.select(
            "machine_id",
            F.when(p >= 0.5, "at_risk").otherwise("normal").alias("state"),
            p.alias("risk_score"),
            F.col("remaining_useful_life_days").cast("double").alias("rul_days"),
        )
