"""Transformations, partitioning, aggregations, windows and scalar functions (P, R, A, W, F).

Each query shows one operator of the reference's API on the driver tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import fahrenheit_to_celsius
from tidemark.functions.timefns import epoch_us
from tidemark.operators import transforms as X
from tidemark.operators.ranking import exact_median
from tidemark.operators.sequence import rows_frame
from tidemark.operators.windows import count_window, session, sliding, top_n, tumbling, window_time
from tidemark.plans.registry import query
from tidemark.plans.tables import ITEM_SQL, events, sensors
from tidemark.schemas import UserBehavior
from tidemark.sources.files import parse_delimited, read_table
from tidemark.sources.transforms import parse_apache_log, render_apache_log, render_user_behavior_csv

WORD_SEP = r"[ \t\n\r\f]+"

# --- P: projections, filters, routing --------------------------------------


@query("P1_parse_csv", f"""
SELECT user_id, {ITEM_SQL} AS item_id, CAST({ITEM_SQL} % 10 AS INTEGER) AS category_id,
       event_type AS behavior, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS timestamp
FROM events
""")
def q_p1(spark, sf):
    lines = render_user_behavior_csv(events(spark, sf))
    return parse_delimited(lines, UserBehavior)


@query("P2_filter_startswith", """
SELECT event_id, user_id FROM events WHERE starts_with(CAST(user_id AS VARCHAR), '1')
""")
def q_p2(spark, sf):
    return X.filter_prefix(events(spark, sf), "user_id", "1").select("event_id", "user_id")


@query("P3_flatmap", """
SELECT event_id, token FROM (SELECT event_id, unnest(string_split(props, ' ')) AS token FROM events)
""")
def q_p3(spark, sf):
    return X.flat_map_split(events(spark, sf), "props", " ", "token").select("event_id", "token")


@query("P4_rich_map", """
SELECT event_id, CASE WHEN value < 10 THEN 'low' WHEN value < 100 THEN 'mid' ELSE 'high' END AS level,
       CAST(user_id % 7 AS BIGINT) AS shard
FROM events
""")
def q_p4(spark, sf):
    return X.rich_map(events(spark, sf).select("event_id", "user_id", "value"))


@query("P5_table_select", """
SELECT user_id AS id, ts AS ts, value AS temp, upper(event_type) AS kind FROM events
""")
def q_p5(spark, sf):
    return events(spark, sf).selectExpr("user_id AS id", "ts", "value AS temp", "upper(event_type) AS kind")


@query("P6_table_where", """
SELECT event_id, user_id, value FROM events WHERE event_type = 'error'
""")
def q_p6(spark, sf):
    return events(spark, sf).where(F.col("event_type") == "error").select("event_id", "user_id", "value")


@query("P7_sql_select", """
SELECT user_id AS id, ts, value AS temperature FROM events WHERE user_id = 1
""")
def q_p7(spark, sf):
    events(spark, sf).createOrReplaceTempView("sensor_table")
    return spark.sql("SELECT user_id AS id, ts, value AS temperature FROM sensor_table WHERE user_id = 1")


@query("P8_split_select", """
SELECT event_id, 'high' AS stream FROM events WHERE value >= 30
UNION ALL SELECT event_id, 'low' FROM events WHERE value < 30
UNION ALL SELECT event_id, 'alert' FROM events WHERE event_type = 'error'
""")
def q_p8(spark, sf):
    routed = X.split_streams(
        events(spark, sf),
        {"high": F.col("value") >= 30, "low": F.col("value") < 30, "alert": F.col("event_type") == "error"},
    )
    return routed.select("event_id", "stream")


@query("P9_side_output", """
SELECT event_id, user_id, value, 'main' AS tag FROM events WHERE value >= 30
UNION ALL SELECT event_id, user_id, value, 'lowtemp' FROM events WHERE value < 30
""")
def q_p9(spark, sf):
    return X.side_output(events(spark, sf), F.col("value") >= 30, "lowtemp").select(
        "event_id", "user_id", "value", "tag")


@query("P10_f_to_c", """
SELECT event_id, round((value - 32) * 5 / 9, 4) AS celsius FROM events
""")
def q_p10(spark, sf):
    return events(spark, sf).select("event_id", F.round(fahrenheit_to_celsius(F.col("value")), 4).alias("celsius"))


@query("P11_apache_log", f"""
SELECT '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST({ITEM_SQL} % 256 AS VARCHAR) || '.1' AS ip,
       CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS event_time,
       CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
       '/' || event_type || '/' || CAST({ITEM_SQL} % 10 AS VARCHAR) AS url
FROM events
""")
def q_p11(spark, sf):
    return parse_apache_log(render_apache_log(events(spark, sf)))


# --- R: partitioning -------------------------------------------------------

@query("R1_key_by", "SELECT user_id, count(*) AS n, 1 AS tasks FROM events GROUP BY user_id")
def q_r1(spark, sf):
    """Every key is in exactly one task."""
    placed = X.key_by(events(spark, sf), ["user_id"], 16).select("user_id", F.spark_partition_id().alias("task"))
    return _tasks_of(placed)


def _tasks_of(placed):
    """Rows and number of tasks per user, with partial counts per (user, task)."""
    per_task = placed.groupBy("user_id", "task").agg(F.count(F.lit(1)).alias("n"))
    return per_task.groupBy("user_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).cast("int").alias("tasks"))


_SPREAD_SQL = "SELECT count(*) AS n, 8 AS tasks, TRUE AS even FROM events"


def _spread(df, slack):
    """Rows, tasks with rows, and whether no task has over 1 + ``slack`` times the mean."""
    per_task = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    return per_task.agg(F.sum("n").alias("n"), F.count(F.lit(1)).cast("int").alias("tasks"),
                        (F.max("n") <= F.avg("n") * (1 + slack)).alias("even"))


@query("R2_rebalance", _SPREAD_SQL)
def q_r2(spark, sf):
    return _spread(X.rebalance(events(spark, sf).select("event_id"), 8), 0.02)


@query("R2b_shuffle_random", _SPREAD_SQL)
def q_r2b(spark, sf):
    return _spread(X.shuffle_random(events(spark, sf).select("event_id"), 8), 0.5)


@query("R2c_rescale", _SPREAD_SQL.replace("8 AS", "2 AS"))
def q_r2c(spark, sf):
    """Neighbouring partitions are merged without a shuffle."""
    return _spread(X.rescale(X.rebalance(events(spark, sf).select("event_id"), 8), 2), 0.02)


@query("R3_broadcast", """
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q_r3(spark, sf):
    cust = read_table(spark, sf, "customer")
    nation = read_table(spark, sf, "nation")
    j = X.join_small(cust, nation, cust.c_nationkey == nation.n_nationkey)
    return j.select("c_custkey", "c_name", "n_name")


@query("R4_global", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type
""")
def q_r4(spark, sf):
    per_type = events(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return X.to_single_task(per_type)


@query("R5_partition_custom", """
SELECT user_id, count(*) AS n, CAST(user_id % 8 AS INTEGER) AS task FROM events GROUP BY user_id
""")
def q_r5(spark, sf):
    """The task number is the one the partitioner asked for."""
    placed = X.partition_custom(events(spark, sf), F.col("user_id") % 8, 8)
    return placed.groupBy("user_id", F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))


# --- A: aggregations -------------------------------------------------------


@query("A1_word_count", """
SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""")
def q_a1(spark, sf):
    docs = read_table(spark, sf, "documents").select("text")
    return X.word_count(docs, "text", WORD_SEP)


@query("A3_rolling_sum", """
SELECT event_id, user_id,
       first_value(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_ts,
       round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_sum
FROM events
""")
def q_a3(spark, sf):
    out = X.rolling(events(spark, sf), "user_id", ["ts", "event_id"],
                    {"running_sum": ("sum", "value"), "first_ts": ("first", "ts")})
    return out.select("event_id", "user_id", "first_ts", F.round("running_sum", 4).alias("running_sum"))


@query("A4_rolling_min_by", """
SELECT event_id, user_id, m.event_id AS min_event_id, m.value AS min_value FROM (
  SELECT event_id, user_id,
         min({'value': value, 'ts': ts, 'event_id': event_id}) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m
  FROM events)
""")
def q_a4(spark, sf):
    out = X.rolling_min_by(events(spark, sf), "user_id", ["ts", "event_id"], "value", ["event_id"])
    return out.select("event_id", "user_id", F.col("min_rec.event_id").alias("min_event_id"),
                      F.col("min_rec.value").alias("min_value"))


@query("A5_rolling_reduce", """
SELECT event_id, user_id,
       CASE WHEN row_number() OVER w = 1 THEN ts ELSE ts + INTERVAL 1 SECOND END AS ts_out,
       min(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS min_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def q_a5(spark, sf):
    return X.rolling_reduce_min(events(spark, sf), "user_id", ["ts", "event_id"], "value").select(
        "event_id", "user_id", "ts_out", "min_value")


@query("A6_count_by_key", """
SELECT user_id AS id, count(user_id) AS cnt FROM events GROUP BY user_id
""")
def q_a6(spark, sf):
    return events(spark, sf).groupBy(F.col("user_id").alias("id")).agg(F.count("user_id").alias("cnt"))


@query("A6b_count_by_key_sql", """
SELECT user_id AS id, count(user_id) AS cnt FROM events GROUP BY user_id
""")
def q_a6b(spark, sf):
    events(spark, sf).createOrReplaceTempView("sensor_table")
    return spark.sql("SELECT user_id AS id, count(user_id) AS cnt FROM sensor_table GROUP BY user_id")


@query("A7_window_count_avg", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS cnt, round(avg(value), 4) AS avg_value
FROM events GROUP BY ALL
""")
def q_a7(spark, sf):
    return tumbling(events(spark, sf), "ts", "1 day", keys=["event_type"],
                    aggs=[F.count(F.lit(1)).alias("cnt"), F.round(F.avg("value"), 4).alias("avg_value")])


@query("A8_window_reduce", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       user_id AS sensor_id, min(value) AS min_temp, max(ts) AS last_ts
FROM events GROUP BY ALL
""")
def q_a8(spark, sf):
    s = sensors(spark, sf)
    return tumbling(s, "ts", "1 day", keys=["sensor_id"],
                    aggs=[F.min("temperature").alias("min_temp"), F.max("ts").alias("last_ts")])


@query("A9_full_window", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       event_type, min(value) AS min_value, max(value) AS max_value,
       round(quantile_cont(value, 0.5), 4) AS median_value, count(*) AS cnt
FROM events GROUP BY ALL
""")
def q_a9(spark, sf):
    e = events(spark, sf).select(F.window("ts", "1 day").alias("w"), "event_type", "value")
    out = exact_median(e.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                                "event_type", "value"), ["window_start", "window_end", "event_type"], "value")
    return out.select("window_start", "window_end", "event_type", F.col("min").alias("min_value"),
                      F.col("max").alias("max_value"), F.round("median", 4).alias("median_value"), "cnt")


@query("A13_per_task_counter", """
SELECT CAST(user_id % 8 AS INTEGER) AS task, count(*) FILTER (value > 100) AS count FROM events GROUP BY ALL
""")
def q_a13(spark, sf):
    return X.per_task_count_if(events(spark, sf), F.col("value") > 100, F.col("user_id") % 8, 8)


@query("A14_builtin_aggs", """
SELECT event_type, count(*) AS cnt, round(sum(value), 4) AS total,
       round(sum(DISTINCT value), 4) AS total_distinct,
       round(coalesce(sum(value) FILTER (WHERE value > 1000), 0), 4) AS sum0_big
FROM events GROUP BY event_type
""")
def q_a14(spark, sf):
    e = events(spark, sf)
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.round(F.sum("value"), 4).alias("total"),
        F.round(F.sum_distinct("value"), 4).alias("total_distinct"),
        F.round(F.coalesce(F.sum(F.when(F.col("value") > 1000, F.col("value"))), F.lit(0.0)), 4).alias("sum0_big"),
    )


@query("A15_windowed_word_count", """
SELECT CAST(turn // 5 AS BIGINT) AS window_index, word, count(*) AS count FROM (
  SELECT turn, unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM conversations)
WHERE word <> '' GROUP BY ALL
""")
def q_a15(spark, sf):
    conv = read_table(spark, sf, "conversations").select("turn", "text")
    words = conv.select((F.col("turn") / 5).cast("long").alias("window_index"),
                        F.explode(F.split("text", WORD_SEP)).alias("word")).where(F.col("word") != "")
    return words.groupBy("window_index", "word").agg(F.count(F.lit(1)).alias("count"))


# --- W: windows ------------------------------------------------------------


@query("W1_tumble", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS count FROM events GROUP BY ALL
""")
def q_w1(spark, sf):
    return tumbling(events(spark, sf), "ts", "1 hour", keys=["event_type"])


@query("W2_slide", """
WITH p AS (SELECT event_type, epoch_us(ts) // 900000000 AS pane, count(*) AS c, sum(value) AS s
           FROM events GROUP BY ALL),
w AS (SELECT event_type, pane + j AS last, sum(c) AS c, sum(s) AS s FROM p, range(4) t(j) GROUP BY ALL)
SELECT make_timestamp((last + 1) * 900000000 - 3600000000) AS window_start,
       make_timestamp((last + 1) * 900000000) AS window_end, event_type,
       CAST(c AS BIGINT) AS count, round(s, 4) AS total
FROM w
""")
def q_w2(spark, sf):
    out = sliding(events(spark, sf), "ts", "1 hour", "15 minutes", keys=["event_type"],
                  measures={"count": ("count", None), "total": ("sum", "value")})
    return out.withColumn("total", F.round("total", 4))


@query("W2b_slide_uneven", """
WITH b AS (SELECT event_type, epoch_us(ts) AS us, epoch_us(ts) // 2400000000 AS s FROM events),
w AS (SELECT event_type, (s - j) * 2400000000 AS start_us FROM b, range(2) t(j)
      WHERE us < (s - j) * 2400000000 + 3600000000)
SELECT make_timestamp(start_us) AS window_start, make_timestamp(start_us + 3600000000) AS window_end,
       event_type, count(*) AS count FROM w GROUP BY ALL
""")
def q_w2b(spark, sf):
    return sliding(events(spark, sf), "ts", "1 hour", "40 minutes", keys=["event_type"])


@query("W3_session", """
WITH o AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                                      OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 6 HOUR
                                    THEN 1 ELSE 0 END AS brk FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS count
FROM s GROUP BY user_id, sid
""")
def q_w3(spark, sf):
    return session(events(spark, sf), "ts", "6 hours", keys=["user_id"])


@query("W5_count_window", """
WITH s AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
g AS (SELECT user_id, (rn - 1) // 5 AS window_index, count(*) AS count, round(sum(value), 4) AS sum,
             min(value) AS min, max(value) AS max FROM s GROUP BY ALL)
SELECT user_id, CAST(window_index AS BIGINT) AS window_index, count, sum, min, max FROM g WHERE count = 5
""")
def q_w5(spark, sf):
    out = count_window(events(spark, sf), ["user_id"], ["ts", "event_id"], 5, value="value")
    return out.withColumn("sum", F.round("sum", 4))


@query("W5b_count_window_slide", """
WITH s AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
f AS (SELECT user_id, rn AS fire_at_row FROM s WHERE rn % 2 = 0)
SELECT f.user_id, CAST(f.fire_at_row AS BIGINT) AS fire_at_row, count(*) AS count, round(sum(s.value), 4) AS sum,
       min(s.value) AS min, max(s.value) AS max
FROM f JOIN s ON s.user_id = f.user_id AND s.rn <= f.fire_at_row AND s.rn > f.fire_at_row - 10
GROUP BY ALL
""")
def q_w5b(spark, sf):
    out = count_window(events(spark, sf), ["user_id"], ["ts", "event_id"], 10, slide=2, value="value")
    return out.withColumn("sum", F.round("sum", 4))


@query("W7_custom_assigner", """
SELECT time_bucket(INTERVAL 1 DAY, ts - INTERVAL 6 HOUR) + INTERVAL 6 HOUR AS window_start,
       time_bucket(INTERVAL 1 DAY, ts - INTERVAL 6 HOUR) + INTERVAL 30 HOUR AS window_end,
       event_type, count(*) AS count FROM events GROUP BY ALL
""")
def q_w7(spark, sf):
    return tumbling(events(spark, sf), "ts", "1 day", keys=["event_type"], offset="6 hours")


@query("W9_evictor", """
WITH r AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, value,
                  row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 1 DAY, ts)
                                     ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, window_start, window_start + INTERVAL 1 DAY AS window_end,
       count(*) AS kept, round(sum(value), 4) AS total
FROM r WHERE rn <= 3 GROUP BY ALL
""")
def q_w9(spark, sf):
    e = events(spark, sf).withColumn("w", F.window("ts", "1 day"))
    kept = top_n(e, ["user_id", "w"], [F.col("ts").desc(), F.col("event_id").desc()], 3, "rn")
    return kept.groupBy("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")).agg(
        F.count(F.lit(1)).alias("kept"), F.round(F.sum("value"), 4).alias("total"))


@query("W10_table_group_window", """
SELECT user_id AS id, time_bucket(INTERVAL 1 HOUR, ts) AS w_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS w_end,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND AS w_rowtime,
       count(*) AS cnt, round(avg(value), 4) AS avg_temp
FROM events GROUP BY ALL
""")
def q_w10(spark, sf):
    s = events(spark, sf)
    out = s.groupBy(F.col("user_id").alias("id"), F.window("ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("cnt"), F.round(F.avg("value"), 4).alias("avg_temp"))
    return out.select("id", F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"),
                      window_time(F.col("w.end")).alias("w_rowtime"), "cnt", "avg_temp")


@query("W11_sql_hop", """
WITH b AS (SELECT event_type, epoch_us(ts) AS us, epoch_us(ts) // 1200000000 AS s FROM events),
w AS (SELECT event_type, (s - j) * 1200000000 AS start_us FROM b, range(3) t(j))
SELECT make_timestamp(start_us) AS window_start, make_timestamp(start_us + 3600000000) AS window_end,
       event_type, count(*) AS cnt FROM w GROUP BY ALL
""")
def q_w11(spark, sf):
    events(spark, sf).createOrReplaceTempView("sensor_events")
    return spark.sql("""
        SELECT window.start AS window_start, window.end AS window_end, event_type, count(*) AS cnt
        FROM sensor_events GROUP BY window(ts, '1 hour', '20 minutes'), event_type
    """)


@query("W12_over_rows", """
SELECT event_id, user_id,
       count(value) OVER w AS cnt, round(avg(value) OVER w, 4) AS avg_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def q_w12(spark, sf):
    out = rows_frame(events(spark, sf), ["user_id"], ["ts", "event_id"], "value", 2, ("count", "avg"))
    return out.select("event_id", "user_id", F.col("count").alias("cnt"), F.round("avg", 4).alias("avg_value"))


@query("W13_over_range", """
SELECT event_id, user_id,
       count(*) OVER w AS cnt, round(sum(value) OVER w, 4) AS total
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
""")
def q_w13(spark, sf):
    out = X.range_frame(events(spark, sf), ["user_id"], "ts", "value", "6 hours")
    return out.select("event_id", "user_id", F.col("count").alias("cnt"), F.round("sum", 4).alias("total"))


# --- F: scalar functions ---------------------------------------------------


@query("F1_compare", """
SELECT event_id, value > 100 AS gt, user_id = 7 AS eq FROM events
""")
def q_f1(spark, sf):
    return events(spark, sf).select("event_id", (F.col("value") > 100).alias("gt"), (F.col("user_id") == 7).alias("eq"))


@query("F2_logic", """
SELECT event_id, (value > 100 OR user_id = 7) AS any_true, NOT (value > 100) AS negated,
       (value > 100) IS FALSE AS is_false FROM events
""")
def q_f2(spark, sf):
    return events(spark, sf).selectExpr(
        "event_id", "(value > 100 OR user_id = 7) AS any_true", "NOT (value > 100) AS negated",
        "(value > 100) IS FALSE AS is_false")


@query("F3_arith", """
SELECT event_id, round(value + 1, 4) AS plus_one, round(power(value, 2), 4) AS squared FROM events
""")
def q_f3(spark, sf):
    return events(spark, sf).select("event_id", F.round(F.col("value") + 1, 4).alias("plus_one"),
                                    F.round(F.pow("value", 2), 4).alias("squared"))


@query("F4_string", """
SELECT event_id, event_type || '#' || CAST(user_id AS VARCHAR) AS tag, upper(event_type) AS up,
       CAST(length(props) AS INTEGER) AS n_chars FROM events
""")
def q_f4(spark, sf):
    return events(spark, sf).select(
        "event_id", F.concat("event_type", F.lit("#"), F.col("user_id").cast("string")).alias("tag"),
        F.upper("event_type").alias("up"), F.char_length("props").alias("n_chars"))


@query("F5_datetime", """
SELECT event_id, CAST(ts AS DATE) AS d, ts + INTERVAL 2 DAY AS plus_two_days,
       ts >= TIMESTAMP '2024-01-15 00:00:00' AS second_half, CAST(ts - INTERVAL 10 MINUTE AS TIMESTAMP) AS minus_ten
FROM events
""")
def q_f5(spark, sf):
    return events(spark, sf).selectExpr(
        "event_id", "to_date(ts) AS d", "ts + INTERVAL 2 DAYS AS plus_two_days",
        "ts >= TIMESTAMP_NTZ'2024-01-15 00:00:00' AS second_half", "ts - INTERVAL 10 MINUTES AS minus_ten")


@query("F6_unixtime", """
SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_s,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS as_text,
       date_trunc('second', ts) AS rt
FROM events
""")
def q_f6(spark, sf):
    e = events(spark, sf)
    secs = F.floor(epoch_us(e, "ts") / 1_000_000).cast("long")
    e = e.withColumn("epoch_s", secs)
    return e.select(
        "event_id", "epoch_s",
        F.date_format(F.timestamp_seconds("epoch_s").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("as_text"),
        F.timestamp_seconds("epoch_s").cast("timestamp_ntz").alias("rt"))


@query("F7_string_helpers", """
SELECT event_id, trim(split_part(props, ':', 1)) AS head, trim(split_part(props, ':', 2)) AS tail,
       starts_with(event_type, 'p') AS starts_p FROM events
""")
def q_f7(spark, sf):
    parts = F.split("props", ":")
    return events(spark, sf).select(
        "event_id", F.trim(parts.getItem(0)).alias("head"), F.trim(parts.getItem(1)).alias("tail"),
        F.col("event_type").startswith("p").alias("starts_p"))


@query("J8_lateral_split", """
SELECT page_id, word, CAST(length(word) AS INTEGER) AS length FROM (
  SELECT page_id, unnest(string_split(url, '/')) AS word FROM pages)
""")
def q_j8(spark, sf):
    from tidemark.operators.joins import lateral_split
    return lateral_split(read_table(spark, sf, "pages"), "url", "/").select("page_id", "word", "length")


@query("J8b_lateral_outer", """
SELECT p.page_id, s.word, CAST(length(s.word) AS INTEGER) AS length
FROM pages p LEFT JOIN LATERAL (SELECT unnest(string_split(p.url, 'news/')) AS word) s ON TRUE
WHERE s.word IS NULL OR s.word <> ''
""")
def q_j8b(spark, sf):
    from tidemark.operators.joins import lateral_split
    out = lateral_split(read_table(spark, sf, "pages"), "url", "news/", outer=True)
    return out.where(F.col("word").isNull() | (F.col("word") != "")).select("page_id", "word", "length")

