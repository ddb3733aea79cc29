"""Sensor jobs: temperature jump (D15, D22), continuous rise (D16), average
(D17) and min/max (D18) per window, freezing alarm (D19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import fahrenheit_to_celsius
from tidemark.functions.timefns import interval
from tidemark.operators.scan import greedy_windows
from tidemark.operators.sequence import DEFAULT_CHUNK, neighbours, plan_chunks, running
from tidemark.operators.transforms import forward_with_alarm
from tidemark.operators.windows import tumbling
from tidemark.plans.registry import query
from tidemark.plans.tables import sensors

# --- library form ----------------------------------------------------------


def temperature_jump(readings: DataFrame, threshold: float = 10.0, key: str = "sensor_id", ts: str = "ts",
                     order=("ts",), max_silence: str | None = None) -> DataFrame:
    """|temp - previous temp| > threshold -> (sensor, previous, current).

    The first reading of a sensor never alerts.  With ``max_silence`` (D22)
    the previous reading is forgotten once the sensor was silent longer than
    that (the reference's clean-up timer).
    """
    n = neighbours(readings, [key], list(order), ["temperature", ts], prev=True)
    hit = F.col("prev_temperature").isNotNull() & (
        F.abs(F.col("temperature") - F.col("prev_temperature")) > F.lit(threshold))
    if max_silence:
        hit = hit & (F.col(ts) <= F.col(f"prev_{ts}") + interval(max_silence))
    return n.where(hit).select(key, ts, F.col("prev_temperature").alias("last_temp"), "temperature")


def continuous_rise(readings: DataFrame, duration: str = "10 seconds", key: str = "sensor_id", ts: str = "ts",
                    order=("ts",), chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """Alert when a temperature keeps rising for ``duration``; same result as the stream.

    A rise (temp > previous) arms a timer at ``ts + duration`` unless one is armed; a fall
    (temp < previous, equal keeps going) at or before that time disarms it; after an alert
    the next rise arms again.  Times are in milliseconds, as timers are.

    The rises that arm are the anchors of :func:`tidemark.operators.scan.greedy_windows` with
    falls as resets; each alerts unless the next fall comes in time.
    """
    order = list(order)
    chunks = plan_chunks(readings, [key], ts, chunk)
    n = neighbours(readings.select(key, *order, "temperature"), [key], order, ["temperature"], prev=True, chunk=chunks)
    n = n.select(key, *order, F.coalesce(F.col("temperature") > F.col("prev_temperature"), F.lit(False)).alias("__rise"),
                 F.coalesce(F.col("temperature") < F.col("prev_temperature"), F.lit(False)).alias("__fall"))
    n = n.where("__rise or __fall")
    at = F.date_trunc("millisecond", F.col(ts)).cast(readings.schema[ts].dataType)
    a = greedy_windows(n, [key], order, F.col("__rise"), F.col("__fall"), duration, "__armed", chunks)
    a = running(a, [key], order, {"__end": ("last", F.when(F.col("__fall"), at))}, reverse=True,
                include_current=False, chunk=chunks)
    fire = at + interval(duration)
    return a.where(F.col("__armed") & (F.col("__end").isNull() | (F.col("__end") > fire))).select(
        key, at.alias("rise_start"), fire.alias("alert_time"))


def average_celsius(readings: DataFrame, size: str = "5 seconds", key: str = "sensor_id", ts: str = "ts"
                    ) -> DataFrame:
    """F -> C, then the average per sensor per tumbling window."""
    c = readings.withColumn("celsius", fahrenheit_to_celsius(F.col("temperature")))
    return tumbling(c, ts, size, [key], [F.avg("celsius").alias("avg_celsius")])


def min_max_temperature(readings: DataFrame, size: str = "5 seconds", key: str = "sensor_id", ts: str = "ts"
                        ) -> DataFrame:
    """Minimum and maximum per sensor per tumbling window."""
    return tumbling(readings, ts, size, [key],
                    [F.min("temperature").alias("min_temp"), F.max("temperature").alias("max_temp")])


def freezing_alarm(readings: DataFrame, limit: float = 32.0) -> DataFrame:
    """Every reading forwarded (tag main), readings below ``limit`` also tagged freezing."""
    return forward_with_alarm(readings, F.col("temperature") < F.lit(limit), "freezing")


# --- driver-table mapping --------------------------------------------------

_SENSOR = "SELECT event_id, ts, user_id AS sensor_id, value AS temperature FROM events"


@query("D15_temp_jump", f"""
WITH s AS ({_SENSOR}),
l AS (SELECT *, lag(temperature) OVER (PARTITION BY sensor_id ORDER BY ts, event_id) AS last_temp FROM s)
SELECT sensor_id, ts, last_temp, temperature FROM l
WHERE last_temp IS NOT NULL AND abs(temperature - last_temp) > 100
""")
def q_d15(spark, sf):
    return temperature_jump(sensors(spark, sf), 100.0, order=("ts", "event_id"))


@query("D22_self_cleaning_jump", f"""
WITH s AS ({_SENSOR}),
l AS (SELECT *, lag(temperature) OVER w AS last_temp, lag(ts) OVER w AS last_ts
      FROM s WINDOW w AS (PARTITION BY sensor_id ORDER BY ts, event_id))
SELECT sensor_id, ts, last_temp, temperature FROM l
WHERE last_temp IS NOT NULL AND abs(temperature - last_temp) > 50 AND ts <= last_ts + INTERVAL 12 HOUR
""")
def q_d22(spark, sf):
    return temperature_jump(sensors(spark, sf), 50.0, order=("ts", "event_id"), max_silence="12 hours")


# Reference semantics walked one event at a time with a recursive CTE: state
# (last temperature, timer); a due timer fires before the next row; the end of
# input fires what is left.  Timers have millisecond resolution.
RISE_SQL = """
WITH RECURSIVE s AS (
  SELECT user_id AS sid, value AS t, date_trunc('millisecond', ts) AS tsm,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
walk(sid, rn, last, timer, alert) AS (
  SELECT sid, rn, t, CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM s WHERE rn = 1
  UNION ALL
  SELECT s.sid, s.rn, s.t,
         CASE WHEN w.timer IS NOT NULL AND w.timer < s.tsm THEN
                CASE WHEN s.t > w.last THEN s.tsm + INTERVAL 6 HOUR END
              WHEN w.timer IS NULL THEN
                CASE WHEN s.t > w.last THEN s.tsm + INTERVAL 6 HOUR END
              ELSE CASE WHEN s.t < w.last THEN NULL ELSE w.timer END END,
         CASE WHEN w.timer IS NOT NULL AND w.timer < s.tsm THEN w.timer END
  FROM walk w JOIN s ON s.sid = w.sid AND s.rn = w.rn + 1),
ends AS (SELECT sid, max(rn) AS rn FROM s GROUP BY sid)
SELECT sid AS sensor_id, alert AS alert_time FROM walk WHERE alert IS NOT NULL
UNION ALL
SELECT w.sid, w.timer FROM walk w JOIN ends e ON w.sid = e.sid AND w.rn = e.rn WHERE w.timer IS NOT NULL
"""


@query("D16_temp_rise", RISE_SQL)
def q_d16(spark, sf):
    return continuous_rise(sensors(spark, sf), "6 hours", order=("ts", "event_id")).select("sensor_id", "alert_time")


@query("D16h_temp_rise_hot_key", RISE_SQL.replace("user_id AS sid", "user_id % 3 AS sid").replace(
    "PARTITION BY user_id", "PARTITION BY user_id % 3").replace("6 HOUR", "20 MINUTE"))
def q_d16h(spark, sf):
    """Three sensors, each cut into chunks of some 200 rows."""
    r = sensors(spark, sf).withColumn("sensor_id", F.col("sensor_id") % 3)
    return continuous_rise(r, "20 minutes", order=("ts", "event_id"), chunk="auto:300:200").select(
        "sensor_id", "alert_time")


@query("D17_avg_temp_celsius", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       user_id AS sensor_id, round(avg((value - 32) * 5 / 9), 4) + 0.0 AS avg_celsius
FROM events GROUP BY ALL
""")
def q_d17(spark, sf):
    return average_celsius(sensors(spark, sf), "1 day").withColumn("avg_celsius", F.round("avg_celsius", 4))


@query("D18_min_max_temp", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       user_id AS sensor_id, min(value) AS min_temp, max(value) AS max_temp
FROM events GROUP BY ALL
""")
def q_d18(spark, sf):
    return min_max_temperature(sensors(spark, sf), "1 day")


@query("D19_freezing_alarm", f"""
SELECT event_id, sensor_id, temperature, 'main' AS tag FROM ({_SENSOR})
UNION ALL SELECT event_id, sensor_id, temperature, 'freezing' FROM ({_SENSOR}) WHERE temperature < 32
""")
def q_d19(spark, sf):
    return freezing_alarm(sensors(spark, sf)).select("event_id", "sensor_id", "temperature", "tag")
