"""How the driver's tables stand in for the reference's record types.

* ``events`` is the behaviour stream: ``props.k`` is the item / ad / page,
  ``event_type`` the behaviour (``view`` = page view ``pv``, ``click`` = ad
  click, ``error`` = failed login, ``signup`` = order created, ``purchase`` =
  order paid), ``user_id`` the user and, for the sensor jobs, the sensor id
  with ``value`` as its temperature (Fahrenheit).
* ``orders`` / ``lineitem`` give one create and one pay/receipt per order for
  the order-timeout and reconciliation jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import read_table

def item_col():
    """props.k as a long: the item / ad / page of an event."""
    return F.get_json_object("props", "$.k").cast("long")

# DuckDB spelling of the same item extraction, used by the oracles
ITEM_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def behaviors(spark: SparkSession, sf: str) -> DataFrame:
    """UserBehavior view: user_id, item_id, behavior, ts (+ event_id for ordering)."""
    return events(spark, sf).select(
        "event_id", "ts", "user_id", item_col().alias("item_id"), F.col("event_type").alias("behavior"), "value"
    )


def sensors(spark: SparkSession, sf: str) -> DataFrame:
    """SensorReading view: sensor_id, ts, temperature (+ event_id)."""
    return events(spark, sf).select(
        "event_id", "ts", F.col("user_id").alias("sensor_id"), F.col("value").alias("temperature")
    )
