"""UDF surface (U1-U5) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import java_string_hash, scaled_hash
from tidemark.functions.udfs import AvgTemp, AvgTempFrame, SumTempFrame, register_functions, top2, user_aggregate, user_frame
from tidemark.plans.registry import query
from tidemark.plans.tables import sensors
from tidemark.sources.files import read_table

_HASH_SQL = """
WITH h AS (SELECT c_custkey, c_name,
                  list_reduce(list_transform(string_split(c_name, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
                              lambda a, c: (a * 31 + c) % 4294967296) AS u FROM customer),
s AS (SELECT c_custkey, c_name, CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS hc FROM h)
"""


@query("U1_scalar_hash", _HASH_SQL + """
SELECT c_custkey, c_name, CAST(hc AS INTEGER) AS hash_code,
       CAST(trunc(least(greatest(hc * CAST(1.23 AS DOUBLE), -2147483648.0), 2147483647.0)) AS INTEGER) AS scaled
FROM s
""")
def q_u1(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", "c_name", java_string_hash(F.col("c_name")).alias("hash_code"),
                    scaled_hash(F.col("c_name"), 1.23).alias("scaled"))


@query("U5_registered_sql_udf", _HASH_SQL + """
SELECT c_custkey, c_name,
       CAST(trunc(least(greatest(hc * CAST(10 AS DOUBLE), -2147483648.0), 2147483647.0)) AS INTEGER) AS scaled
FROM s
""")
def q_u5(spark, sf):
    register_functions(spark, factor=10.0)
    read_table(spark, sf, "customer").createOrReplaceTempView("customer_v")
    return spark.sql("SELECT c_custkey, c_name, hash_code(c_name) AS scaled FROM customer_v")


@query("U2_table_function", """
SELECT page_id, word, CAST(length(word) AS INTEGER) AS length FROM (
  SELECT page_id, unnest(string_split(url, '.')) AS word FROM pages)
""")
def q_u2(spark, sf):
    register_functions(spark)
    read_table(spark, sf, "pages").createOrReplaceTempView("pages_v")
    return spark.sql("SELECT p.page_id, s.word, s.length FROM pages_v p, LATERAL split_words(p.url, '.') s")


@query("U3_aggregate_function", """
SELECT user_id AS sensor_id, round(avg(value), 4) AS avg_temp FROM events GROUP BY user_id
""")
def q_u3(spark, sf):
    out = user_aggregate(sensors(spark, sf), "sensor_id", "temperature", AvgTemp, "avg_temp")
    return out.withColumn("avg_temp", F.round("avg_temp", 4))


@query("U3b_retracting_aggregate", """
SELECT event_id, user_id, round(avg(value) OVER w, 4) AS avg_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def q_u3b(spark, sf):
    """W12's averages by a user aggregate that retracts the rows that leave the frame."""
    out = user_frame(read_table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value", 2, AvgTempFrame, "avg")
    return out.select("event_id", "user_id", F.round("avg", 4).alias("avg_value"))


@query("U3h_retracting_aggregate_hot_key", """
SELECT event_id, event_type, round(sum(value) OVER w, 2) AS total
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 500 PRECEDING AND CURRENT ROW)
""")
def q_u3h(spark, sf):
    """Few, hot keys and long frames: numbered over chunks, aggregated over blocks of 700 rows."""
    out = user_frame(read_table(spark, sf, "events"), ["event_type"], ["ts", "event_id"], "value", 500, SumTempFrame,
                     "total", block_rows=700, chunk="auto:1000:400")
    return out.select("event_id", "event_type", F.round("total", 2).alias("total"))


@query("U4_table_aggregate", """
SELECT sensor_id, temp, rank FROM (
  SELECT user_id AS sensor_id, value AS temp,
         row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS rank FROM events)
WHERE rank <= 2
""")
def q_u4(spark, sf):
    return top2(sensors(spark, sf), "sensor_id", "temperature", ["ts", "event_id"])
