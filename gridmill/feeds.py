"""The feeds as adapters over the given tables, in Spark and as SQL for the check.

Both forms describe the same rows; the SQL is the left side of every oracle.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill.operators.ordered import row_index

AS_OF = datetime(2024, 1, 17, 15, 30, tzinfo=timezone.utc)
AS_OF_SATURDAY = datetime(2024, 1, 20, 15, 30, tzinfo=timezone.utc)
AS_OF_LEDGER = datetime(1998, 1, 8, tzinfo=timezone.utc)

_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP, o_orderpriority STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with its declared schema (times as instants)."""
    reader = spark.read
    if name in _SCHEMAS:
        reader = reader.schema(_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("date"), F.col("value").alias("load"),
        F.concat(F.lit("record_"), F.col("event_id").cast("string")).alias("key_id"), F.col("event_type").alias("area"))


def gas_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = "decimal(18,2)"
    close = F.col("value").cast(cents) + (F.col("user_id") % 7).cast(cents) - F.lit(3).cast(cents)
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("date"), F.col("value").alias("open_price"),
        close.cast("double").alias("close_price"))


def generation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("value").cast("string")

    def of(kind: str):
        return F.when(F.col("event_type") == kind, text)

    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("date"),
        of("click").alias("biomass_actual_aggregated"),
        of("view").alias("fossil_gas_actual_aggregated"),
        of("purchase").when(F.col("event_type") == "error", "n/e").alias("solar_actual_consumption"),
        of("signup").alias("wind_onshore_actual_aggregated"))


GENERATION_GIVEN = ["biomass_actual_aggregated", "fossil_gas_actual_aggregated", "solar_actual_consumption",
                    "wind_onshore_actual_aggregated"]


def forecast_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = (F.when(F.col("event_type") == "click", "TTT").when(F.col("event_type") == "view", "FF")
               .when(F.col("event_type") == "purchase", "Rad1h").when(F.col("event_type") == "signup", "SunD1")
               .otherwise("N"))
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", element.alias("element"), "value")
    # A user's events of one kind in order; nothing bounds them, so the scan is cut inside a user.
    placed = row_index(rows, ["event_id"], ["user_id", "element"], "step")
    return placed.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("station"), "element",
        F.col("step").cast("int").alias("step"), F.when(F.col("value") >= 2, F.col("value")).alias("value"))


def climate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("stations_id"), "ts", F.col("value").alias("tt_tu"),
                                                 F.lit("eor").alias("eor"), F.lit(0).alias("src_rank"))


def climate_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"))
    return e.select("event_id", F.col("user_id").alias("stations_id"), "ts", F.col("value").alias("tt_tu"),
                    F.lit("eor").alias("eor"), F.lit(0).alias("src_rank"))


def climate_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    return e.select("event_id", F.col("user_id").alias("stations_id"), "ts", (F.col("value") + 100).alias("tt_tu"),
                    F.lit("eor").alias("eor"), F.lit(1).alias("src_rank"))


def _object_key():
    return F.concat(F.lit("electricity/load/"), F.col("o_orderkey").cast("string"), F.lit(".parquet"))


def lake_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(_object_key().alias("s3_key"))


def processed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F") \
        .select(_object_key().alias("s3_key"), F.col("o_orderdate").alias("processed_at"))


def publish_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("seq"), F.col("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("load"))


SQL = {
    "load_raw": """SELECT event_id, ts AS date, value AS load,
        concat('record_', CAST(event_id AS VARCHAR)) AS key_id, event_type AS area FROM events""",
    "gas_raw": """SELECT event_id, ts AS date, value AS open_price,
        CAST(CAST(value AS DECIMAL(18,2)) + CAST(user_id % 7 AS DECIMAL(18,2)) - CAST(3 AS DECIMAL(18,2)) AS DOUBLE)
        AS close_price FROM events""",
    "generation_raw": """SELECT event_id, ts AS date,
        CASE WHEN event_type='click' THEN CAST(value AS VARCHAR) END AS biomass_actual_aggregated,
        CASE WHEN event_type='view' THEN CAST(value AS VARCHAR) END AS fossil_gas_actual_aggregated,
        CASE WHEN event_type='purchase' THEN CAST(value AS VARCHAR)
             WHEN event_type='error' THEN 'n/e' END AS solar_actual_consumption,
        CASE WHEN event_type='signup' THEN CAST(value AS VARCHAR) END AS wind_onshore_actual_aggregated
        FROM events""",
    "forecast_long": """SELECT concat('U', CAST(user_id AS VARCHAR)) AS station,
        CASE event_type WHEN 'click' THEN 'TTT' WHEN 'view' THEN 'FF' WHEN 'purchase' THEN 'Rad1h'
                        WHEN 'signup' THEN 'SunD1' ELSE 'N' END AS element,
        CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS INTEGER) AS step,
        CASE WHEN value >= 2 THEN value END AS value FROM events""",
    "climate_all": """SELECT event_id, user_id AS stations_id, ts, value AS tt_tu, 'eor' AS eor, 0 AS src_rank FROM events""",
    "climate_recent": """SELECT event_id, user_id AS stations_id, ts, value AS tt_tu, 'eor' AS eor, 0 AS src_rank
        FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
    "climate_historical": """SELECT event_id, user_id AS stations_id, ts, value + 100 AS tt_tu, 'eor' AS eor,
        1 AS src_rank FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'""",
    "lake_objects": """SELECT concat('electricity/load/', CAST(o_orderkey AS VARCHAR), '.parquet') AS s3_key
        FROM orders""",
    "processed_files": """SELECT concat('electricity/load/', CAST(o_orderkey AS VARCHAR), '.parquet') AS s3_key,
        o_orderdate AS processed_at FROM orders WHERE o_orderstatus = 'F'""",
    "publish_raw": """SELECT o_custkey AS source_id, o_orderkey AS seq, o_orderdate AS date, o_totalprice AS load
        FROM orders""",
}


def with_feeds(body: str, *feeds: str) -> str:
    """SQL text with the adapters it uses in front; ``body`` may go on with more CTEs."""
    ctes = ",\n".join(f"{f} AS ({SQL[f]})" for f in feeds)
    if body.lstrip().startswith(","):
        return f"WITH {ctes}{body}"
    return f"WITH {ctes}\n{body}" if feeds else body
