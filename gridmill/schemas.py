"""Declared schemas of the feeds and of the tables kept by the engine."""

from __future__ import annotations

from pyspark.sql import types as T

LOAD_MESSAGE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("load", T.DoubleType()),
    T.StructField("key_id", T.StringType()),
])

GAS_MESSAGE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("key_id", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("s3_key", T.StringType(), nullable=False),
    T.StructField("processed_at", T.TimestampType(), nullable=False),
])

# Generation types shown in the daily mix.
GENERATION_COLUMNS = [
    "biomass_actual_aggregated",
    "fossil_brown_coal_lignite_actual_aggregated",
    "fossil_gas_actual_aggregated",
    "fossil_hard_coal_actual_aggregated",
    "fossil_oil_actual_aggregated",
    "geothermal_actual_aggregated",
    "hydro_pumped_storage_actual_aggregated",
    "hydro_run-of-river_and_poundage_actual_aggregated",
    "solar_actual_consumption",
    "wind_offshore_actual_aggregated",
    "wind_onshore_actual_aggregated",
]

# Forecast element codes and the column each one becomes.
FORECAST_ELEMENTS = {
    "TTT": "temperature_2m",
    "TX": "temperature_max",
    "TN": "temperature_min",
    "DD": "wind_direction",
    "FF": "wind_speed",
    "Rad1h": "global_irradiance",
    "ww": "significant_weather",
    "N": "total_cloud_cover",
    "SunD1": "sunshine_dur",
}
KELVIN_COLUMNS = ["temperature_2m", "temperature_max", "temperature_min"]

# Station weather parameters. name -> (category, technical columns that are dropped).
WEATHER_PARAMETERS = {
    "TU": ("air_temperature", ["QN_9", "eor", "RF_TU"]),
    "SD": ("sun", ["QN_7", "eor"]),
    "FF": ("wind", ["QN_3", "eor"]),
    "ST": ("solar", ["QN_592", "eor", "MESS_DATUM_WOZ", "ATMO_LBERG"]),
    "F": ("wind_synop", ["QN_8", "eor"]),
    "VN": ("total_cloud_cover", ["QN_8", "V_N_I"]),
    "R1": ("precipitation", ["QN_8", "WRTR", "RS_IND"]),
}


def weather_parameter(name: str) -> tuple[str, list[str]]:
    if name not in WEATHER_PARAMETERS:
        raise ValueError(f"unknown weather parameter {name!r}; known: {', '.join(WEATHER_PARAMETERS)}")
    return WEATHER_PARAMETERS[name]
