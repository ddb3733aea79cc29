"""Sources and sinks exercised on the driver tables
and the remaining pattern and trigger forms (C5, C6, W8, T6)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cep
from tidemark.plans.registry import query
from tidemark.plans.tables import events
from tidemark.session import scratch_path
from tidemark.sinks.writers import (changelog, read_buckets, upsert_buckets, write_csv, write_json_docs,
                                    write_text)
from tidemark.sources.files import csv_view, read_csv

_ID_TEMP = T.StructType([T.StructField("id", T.LongType()), T.StructField("temp", T.DoubleType())])


@query("K3_csv_sink_roundtrip", "SELECT user_id AS id, value AS temp FROM events")
def q_k3(spark, sf):
    path = scratch_path(spark, "k3-csv")
    write_csv(events(spark, sf).select(F.col("user_id").alias("id"), F.col("value").alias("temp")), path)
    return read_csv(spark, path, _ID_TEMP)


@query("S7_csv_ddl_view", "SELECT user_id AS id, value AS temp FROM events WHERE value > 100")
def q_s7(spark, sf):
    path = scratch_path(spark, "s7-csv")
    write_csv(events(spark, sf).select("user_id", "value"), path)
    csv_view(spark, "sensor_csv", path, "id BIGINT, temp DOUBLE")
    return spark.sql("SELECT id, temp FROM sensor_csv WHERE temp > 100")


@query("K2_text_sink_partitioned", """
SELECT event_type, CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) AS value FROM events
""")
def q_k2(spark, sf):
    path = scratch_path(spark, "k2-text")
    write_text(events(spark, sf).select("event_id", "user_id", "event_type"), path, ["event_type"])
    return spark.read.text(path).select("event_type", "value")


@query("K9_json_docs", """
SELECT CAST(event_id AS VARCHAR) AS _id, event_type, user_id FROM events
""")
def q_k9(spark, sf):
    path = scratch_path(spark, "k9-json")
    write_json_docs(events(spark, sf).select("event_id", "user_id", "event_type"), path, "event_id")
    docs = spark.read.schema("_id string, doc string").json(path)
    return docs.select("_id", F.get_json_object("doc", "$.event_type").alias("event_type"),
                       F.get_json_object("doc", "$.user_id").cast("long").alias("user_id"))


@query("K6_keyed_upsert", """
SELECT user_id, event_id AS last_event_id, value AS last_value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def q_k6(spark, sf):
    """Two upsert batches (first half of the month, then the rest) keyed by user."""
    e = events(spark, sf).select("user_id", F.col("event_id").alias("last_event_id"),
                                 F.col("value").alias("last_value"), "ts")
    path = scratch_path(spark, "k6-upsert")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    upsert_buckets(e.where(F.col("ts") < cut), path, 0, ["user_id"], ["ts", "last_event_id"], buckets=8)
    upsert_buckets(e.where(F.col("ts") >= cut), path, 1, ["user_id"], ["ts", "last_event_id"], buckets=8)
    return read_buckets(spark, path, 1).drop("ts")


@query("T13_retract_stream", """
WITH a AS (SELECT event_type, count(*) AS cnt FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
b AS (SELECT event_type, count(*) AS cnt FROM events GROUP BY 1)
SELECT FALSE AS flag, a.event_type, a.cnt FROM a JOIN b USING (event_type) WHERE a.cnt <> b.cnt
UNION ALL SELECT TRUE, b.event_type, b.cnt FROM b LEFT JOIN a USING (event_type) WHERE a.cnt IS NULL OR a.cnt <> b.cnt
""")
def q_t13(spark, sf):
    e = events(spark, sf)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    before = e.where(F.col("ts") < cut).groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    after = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    return changelog(before, after, ["event_type"])


_LEAD_SQL = """
WITH s AS (SELECT user_id, event_id, ts, event_type,
                  lead(event_type) OVER w AS n_type, lead(ts) OVER w AS n_ts, lead(event_id) OVER w AS n_id
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
"""


@query("C5_pattern_or_next", _LEAD_SQL + """
SELECT user_id, event_id AS start_id, ts AS start_ts, n_id AS buy_id, n_ts AS buy_ts FROM s
WHERE event_type IN ('error', 'signup') AND n_type = 'purchase' AND n_ts - ts < INTERVAL 6 HOUR
""")
def q_c5(spark, sf):
    e = events(spark, sf)
    stages = [("start", F.col("event_type").isin("error") | (F.col("event_type") == "signup"), ""),
              ("buy", F.col("event_type") == "purchase", "next")]
    return cep.match_sequence(e, "user_id", ["ts", "event_id"], "event_id", stages, "6 hours")


@query("C6_three_stage_followed_by", """
WITH nx AS (
  SELECT user_id, event_id, ts, event_type,
    first_value(CASE WHEN event_type = 'click' THEN {'id': event_id, 'ts': ts} END IGNORE NULLS) OVER w AS nclick,
    first_value(CASE WHEN event_type = 'purchase' THEN {'id': event_id, 'ts': ts} END IGNORE NULLS) OVER w AS nbuy
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT v.user_id, v.event_id AS view_id, v.ts AS view_ts, v.nclick.id AS click_id, v.nclick.ts AS click_ts,
       c.nbuy.id AS buy_id, c.nbuy.ts AS buy_ts
FROM nx v JOIN nx c ON c.event_id = v.nclick.id
WHERE v.event_type = 'view' AND c.nbuy IS NOT NULL AND c.nbuy.ts - v.ts < INTERVAL 1 DAY
""")
def q_c6(spark, sf):
    e = events(spark, sf)
    stages = [("view", F.col("event_type") == "view", ""),
              ("click", F.col("event_type") == "click", "followedBy"),
              ("buy", F.col("event_type") == "purchase", "followedBy")]
    return cep.match_sequence(e, "user_id", ["ts", "event_id"], "event_id", stages, "1 day")


@query("C6b_flat_select", """
WITH nx AS (
  SELECT user_id, event_id, ts, event_type,
    first_value(CASE WHEN event_type = 'click' THEN {'id': event_id, 'ts': ts} END IGNORE NULLS) OVER w AS nclick,
    first_value(CASE WHEN event_type = 'purchase' THEN {'id': event_id, 'ts': ts} END IGNORE NULLS) OVER w AS nbuy
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
m AS (
  SELECT v.user_id, v.event_id AS view_id, v.ts AS view_ts, v.nclick.ts AS click_ts, c.nbuy.ts AS buy_ts
  FROM nx v JOIN nx c ON c.event_id = v.nclick.id
  WHERE v.event_type = 'view' AND c.nbuy IS NOT NULL AND c.nbuy.ts - v.ts < INTERVAL 1 DAY)
SELECT user_id, view_id, 'view-click' AS step, view_ts AS from_ts, click_ts AS to_ts
FROM m WHERE click_ts - view_ts < INTERVAL 4 HOUR
UNION ALL
SELECT user_id, view_id, 'click-buy' AS step, click_ts AS from_ts, buy_ts AS to_ts
FROM m WHERE buy_ts - click_ts < INTERVAL 4 HOUR
""")
def q_c6b(spark, sf):
    """The quick steps of each match: none, one or both."""
    steps = F.array(*[F.struct(F.lit(f"{a}-{b}").alias("step"), F.col(f"{a}_ts").alias("from_ts"),
                               F.col(f"{b}_ts").alias("to_ts")) for a, b in (("view", "click"), ("click", "buy"))])
    quick = F.filter(steps, lambda s: s["to_ts"] < s["from_ts"] + F.expr("interval 4 hours"))
    return cep.flat_select(q_c6(spark, sf), quick, ["user_id", "view_id"])


@query("S8_stream_to_table_fields", """
SELECT event_id AS eid, user_id AS uid, ts AS rowtime, value AS temperature FROM events
""")
def q_s8(spark, sf):
    """All fields by position (``toDF``), then renamed and reordered by name."""
    e = events(spark, sf).select("event_id", "ts", "user_id", "value")
    by_position = e.toDF("eid", "rowtime", "uid", "temperature")
    return by_position.select("eid", "uid", "rowtime", "temperature")


@query("S10_table_by_name", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_s10(spark, sf):
    from tidemark.sources.files import register_tables

    register_tables(spark, sf, ["events"])
    return spark.table("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
