"""Schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

NUM = T.DecimalType(18, 6)
#: Parsed text keeps all its digits until a rule has judged it.
EXACT = T.DecimalType(38, 18)
#: Measures of the facts: all whole digits of ``EXACT``, and room for the sums of ten billion rows.
MEASURE = T.DecimalType(28, 8)

ENVELOPE = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("row_number", T.LongType()),
        T.StructField("ingestion_mode", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
        T.StructField("datalake_ingested_at", T.StringType()),
    ]
)
REQUIRED_ENVELOPE = ("source_file", "source_system", "payload")

# ---------------------------------------------------------------------------
# They must equal the reference's for the results to agree.
# ---------------------------------------------------------------------------
NUMBER_PATTERN = r"^-?[0-9]+(\.[0-9]+)?\z"
DATE_PREFIX_PATTERN = r"(?s)^[0-9]{4}-[0-9]{2}-[0-9]{2}.*"
TRUE_WORDS = ["1", "true", "t", "yes", "y", "oui"]

SOURCE_SYSTEMS = [
    "mes", "gmao", "energie", "scada_capteurs", "erp",
    "machine_mapping", "factories", "production_lines", "parts",
]
REALTIME_SOURCE_FILE = "industrial_realtime_stream"
BUSINESS_SUFFIX = "_business.csv"
VARIANT_SUFFIXES = ["_sale", "_propre", "_business"]

# shift id: (words, name, start, end)
SHIFTS = {
    "SHIFT_MATIN": (["matin", "morning"], "matin", "06:00", "14:00"),
    "SHIFT_APRES_MIDI": (["apres-midi", "après-midi", "afternoon"], "apres-midi", "14:00", "22:00"),
    "SHIFT_NUIT": (["nuit", "night"], "nuit", "22:00", "06:00"),
}

# Silver columns: payload key, silver column, plausible range (None = no range).
SILVER_NUMBERS = [
    ("cycle_time_sec", "cycle_time_sec", (20, 120)),
    ("Temperature_C", "temperature_c", (0, 100)),
    ("Vibration_mms", "vibration_mms", (0, 8)),
    ("Sound_dB", "sound_db", (40, 110)),
    ("Oil_Level_pct", "oil_level_pct", (0, 100)),
    ("Coolant_Level_pct", "coolant_level_pct", (0, 100)),
    ("Hydraulic_Pressure_bar", "hydraulic_pressure_bar", (50, 200)),
    ("Coolant_Flow_L_min", "coolant_flow_l_min", (0, 80)),
    ("Heat_Index", "heat_index", (0, 120)),
    ("Power_Consumption_kW", "power_consumption_kw", (0, 120)),
    ("Operational_Hours", "operational_hours", None),
    ("Remaining_Useful_Life_days", "remaining_useful_life_days", (0, 365)),
    ("predicted_failure_probability", "predicted_failure_probability", (0, 1)),
    ("sensor_anomaly_score", "sensor_anomaly_score", (0, 1)),
]
SILVER_COUNTS = [
    ("Error_Codes_Last_30_Days", "error_codes_last_30_days"),
    ("AI_Override_Events", "ai_override_events"),
    ("Failure_Within_7_Days", "failure_within_7_days"),
]
SENSOR_KEYS_REQUIRED = ["Temperature_C", "Vibration_mms", "Power_Consumption_kW"]

# Plausible ranges of the cleaning rules.
SENSOR_LIMITS = {
    "Temperature_C": (0, 100),
    "Vibration_mms": (0, 8),
    "Sound_dB": (40, 110),
    "Oil_Level_pct": (0, 100),
    "Coolant_Level_pct": (0, 100),
    "Hydraulic_Pressure_bar": (50, 200),
    "Coolant_Flow_L_min": (0, 80),
    "Heat_Index": (0, 120),
    "Power_Consumption_kW": (0, 120),
    "energy_consumption_kwh": (0, 150),
    "compressed_air_usage": (0, 80),
    "cooling_water_usage": (0, 60),
    "power_peak_kw": (0, 200),
}

# Flag thresholds: flag name: (measure, comparison, threshold), one set per producer.
FLAG_SETS = {
    "clean": {
        "flag_temperature_high": ("Temperature_C", ">", 72),
        "flag_vibration_high": ("Vibration_mms", ">", 2.8),
        "flag_sound_high": ("Sound_dB", ">", 82),
        "flag_oil_low": ("Oil_Level_pct", "<", 72),
        "flag_coolant_low": ("Coolant_Level_pct", "<", 68),
        "flag_pressure_low": ("Hydraulic_Pressure_bar", "<", 112),
        "flag_coolant_flow_low": ("Coolant_Flow_L_min", "<", 24),
        "flag_heat_high": ("Heat_Index", ">", 78),
        "flag_power_high": ("Power_Consumption_kW", ">", 55),
        "flag_error_codes_high": ("Error_Codes_Last_30_Days", ">=", 4),
        "flag_anomaly_high": ("sensor_anomaly_score", ">=", 0.70),
    },
    "stream": {
        "flag_temperature_high": ("Temperature_C", ">=", 82),
        "flag_vibration_high": ("Vibration_mms", ">=", 5),
        "flag_sound_high": ("Sound_dB", ">=", 90),
        "flag_oil_low": ("Oil_Level_pct", "<=", 35),
        "flag_coolant_low": ("Coolant_Level_pct", "<=", 35),
        "flag_pressure_low": ("Hydraulic_Pressure_bar", "<=", 80),
        "flag_coolant_flow_low": ("Coolant_Flow_L_min", "<=", 20),
        "flag_heat_high": ("Heat_Index", ">=", 85),
        "flag_power_high": ("Power_Consumption_kW", ">=", 80),
        "flag_error_codes_high": ("stress", ">=", 1),
        "flag_anomaly_high": ("sensor_anomaly_score", ">=", 0.7),
    },
    "experiment": {
        "flag_temperature_high": ("Temperature_C", ">", 68),
        "flag_vibration_high": ("Vibration_mms", ">", 2.6),
        "flag_sound_high": ("Sound_dB", ">", 82),
        "flag_oil_low": ("Oil_Level_pct", "<", 78),
        "flag_coolant_low": ("Coolant_Level_pct", "<", 72),
        "flag_pressure_low": ("Hydraulic_Pressure_bar", "<", 115),
        "flag_coolant_flow_low": ("Coolant_Flow_L_min", "<", 25),
        "flag_heat_high": ("Heat_Index", ">", 75),
        "flag_power_high": ("Power_Consumption_kW", ">", 55),
        "flag_error_codes_high": ("Error_Codes_Last_30_Days", ">=", 3),
        "flag_anomaly_high": ("sensor_anomaly_score", ">=", 0.70),
        "flag_operational_hours_high": ("Operational_Hours", ">=", 1200),
    },
}
FLAG_WEIGHTS = {
    "flag_vibration_high": "2.0",
    "flag_temperature_high": "1.6",
    "flag_oil_low": "1.5",
    "flag_coolant_low": "1.4",
    "flag_pressure_low": "1.4",
    "flag_error_codes_high": "1.8",
    "flag_anomaly_high": "1.5",
    "flag_heat_high": "1.2",
    "flag_power_high": "1.0",
    "flag_sound_high": "0.8",
    "flag_coolant_flow_low": "1.0",
    "flag_operational_hours_high": "1.0",
}

SEVERITY_WORDS = {
    "critical": "critique", "high": "critique",
    "major": "majeur", "warning": "majeur", "medium": "majeur",
}
DEFECT_CATEGORIES = {
    "rayure": "esthetique", "fissure": "fonctionnel",
    "deformation": "dimensionnel", "no_defect": "none",
}
MISSING_MARKERS = ["None", "none", "NULL", "null", "nan", ""]
AUDIT_MISSING_MARKERS = MISSING_MARKERS + [" ", "NaN"]

SHIFT_MINUTES = 480
HIGH_RISK = "0.7"
RUL_HORIZON_DAYS = 365
DEFAULT_READING_TS = "2026-01-01 00:00:00"

# Serving contract of one sensor reading, in order.
SENSOR_FLOATS = [
    "cycle_time_sec", "temperature_c", "vibration_mms", "sound_db", "oil_level_pct",
    "coolant_level_pct", "hydraulic_pressure_bar", "coolant_flow_l_min", "heat_index",
    "power_consumption_kw", "operational_hours",
]
SENSOR_INTS = ["error_codes_last_30_days", "ai_override_events"]
READING_FIELDS = [
    "machine_id", *SENSOR_FLOATS, "error_codes_last_30_days", "quality_status", "ai_override_events",
]

# Learning tables.
TIME_COL = "event_ts"
TARGET_CLF = "failure_within_7_days"
TARGET_REG = "remaining_useful_life_days"
NUMERIC_FEATURES = [*SENSOR_FLOATS, "error_codes_last_30_days", "ai_override_events"]
LEAKY_FEATURES = ["predicted_failure_probability", "sensor_anomaly_score"]
CATEGORICAL_FEATURES = ["machine_id", "quality_status"]
TRAIN_FRAC = 0.70
VAL_FRAC = 0.15
SEQUENCE_LENGTH = 24

EXTRACT_COLUMNS = [
    "event_ts", "machine_id", "cycle_time_sec", "temperature_c", "vibration_mms", "sound_db",
    "oil_level_pct", "coolant_level_pct", "hydraulic_pressure_bar", "coolant_flow_l_min",
    "heat_index", "power_consumption_kw", "operational_hours", "error_codes_last_30_days",
    "sensor_anomaly_score", "predicted_failure_probability", "ai_override_events",
    "quality_status", "remaining_useful_life_days", "failure_within_7_days",
]

FACTORY_PROFILE = [
    "site_maturity_level", "equipment_level", "sensor_reliability", "data_quality_level",
    "maintenance_strategy", "machine_availability_profile", "oee_profile",
    "unplanned_downtime_profile", "quality_drift_profile", "energy_efficiency_profile",
    "systems_maturity",
]
MAPPING_CONTEXT = [
    "factory_id", "factory_name", "country", "production_line_id", "production_line_name",
    "product_family", "manufacturer", "criticality_level", "machine_generation", *FACTORY_PROFILE,
]
MAPPING_COLUMNS = [
    "old_machine_id", "machine_id", "machine_name", "machine_type", *MAPPING_CONTEXT,
    "default_product_id",
]
BUSINESS_CATEGORICALS = [
    "machine_type", "factory_id", "production_line_id", "product_family", "manufacturer",
    "criticality_level", "machine_generation", *FACTORY_PROFILE,
]

# Columns each fact rewrites when its event id is already present; the others keep
# the first value loaded.
FACT_UPDATE_COLUMNS = {
    "fact_production": [
        "actual_production_qty", "good_qty", "scrap_qty", "availability_rate",
        "performance_rate", "quality_rate", "trs", "scrap_rate",
    ],
    "fact_quality": [
        "dimension_measurement", "tolerance_min", "tolerance_max", "is_conforming",
        "scrap_flag", "rework_required", "quality_score",
    ],
    "fact_maintenance": [
        "maintenance_type", "failure_type", "failure_code", "failure_severity",
        "repair_time_minutes", "downtime_minutes", "maintenance_cost",
    ],
    "fact_energy": [
        "energy_consumption_kwh", "compressed_air_usage", "cooling_water_usage",
        "power_peak_kw", "energy_cost", "energy_per_good_piece",
    ],
    "fact_alerts": ["alert_type", "alert_severity", "alert_reason", "is_active"],
}

# Named anomaly rules of the audit: label: (dataset, column, low, high, low is included).
ANOMALY_RULES = {
    "Énergie hors seuil": ("energie", "energy_consumption_kwh", 0, 150, True),
    "Cycle hors seuil": ("scada_capteurs", "cycle_time_sec", 20, 120, True),
    "Scrap incohérent": ("mes", "scrap_qty", 0, 500, True),
    "Downtime incohérent": ("gmao", "downtime_minutes", 0, 500, True),
    "Production planifiée incohérente": ("erp", "planned_production_qty", 0, 3000, False),
}
TRACEABILITY_SCORE = 8.0
