"""SQL and Table-API windows and frames, declared time columns, keyed state and retract streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.joins import cogroup_rows
from tidemark.operators.sequence import running
from tidemark.operators.windows import session, sliding
from tidemark.plans.registry import query
from tidemark.plans.stream_queries import SLICES, _events, _replay, _sliced_sql
from tidemark.plans.tables import ITEM_SQL, events, item_col
from tidemark.session import scratch_path
from tidemark.sinks.writers import write_csv
from tidemark.sources.files import csv_view
from tidemark.streaming import jobs as S
from tidemark.streaming.late import RetractStream
from tidemark.streaming.runner import event_time, run_foreach_batch, run_to_parquet

_SESSION_SQL = """
WITH l AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev, event_id FROM events),
s AS (SELECT user_id, ts, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 12 HOUR THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM l)
SELECT user_id AS id, min(ts) AS w_start, max(ts) + INTERVAL 12 HOUR AS w_end, count(*) AS cnt
FROM s GROUP BY user_id, sid
"""


@query("W10b_table_slide", """
WITH b AS (SELECT user_id, value, epoch_us(ts) // 1800000000 AS pane FROM events),
w AS (SELECT user_id, value, pane + j AS last FROM b, range(4) t(j))
SELECT user_id AS id, make_timestamp((last + 1) * 1800000000 - 7200000000) AS w_start,
       make_timestamp((last + 1) * 1800000000) AS w_end, count(*) AS cnt FROM w GROUP BY ALL
""")
def q_w10b(spark, sf):
    """Slide over 2 hours every 30 minutes, from pane counts."""
    return sliding(events(spark, sf), "ts", "2 hours", "30 minutes", keys=["user_id"]).select(
        F.col("user_id").alias("id"), F.col("window_start").alias("w_start"), F.col("window_end").alias("w_end"),
        F.col("count").alias("cnt"))


@query("W10c_table_session", _SESSION_SQL)
def q_w10c(spark, sf):
    out = session(events(spark, sf), "ts", "12 hours", ["user_id"], [F.count(F.lit(1)).alias("cnt")],
                  order=["ts", "event_id"])
    return out.select(F.col("user_id").alias("id"), F.col("session_start").alias("w_start"),
                      F.col("session_end").alias("w_end"), "cnt")


@query("W11b_sql_tumble", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS w_end,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND AS w_rowtime,
       event_type, count(*) AS cnt FROM events GROUP BY ALL
""")
def q_w11b(spark, sf):
    """TUMBLE with start, end and rowtime in SQL."""
    events(spark, sf).createOrReplaceTempView("tumble_events")
    return spark.sql("""
        SELECT w.start AS w_start, w.end AS w_end, w.end - INTERVAL '1' SECOND / 1000000 AS w_rowtime, event_type, cnt
        FROM (SELECT window(ts, '1 hour') AS w, event_type, count(*) AS cnt FROM tumble_events
              GROUP BY window(ts, '1 hour'), event_type)""")


@query("W11c_sql_session", _SESSION_SQL)
def q_w11c(spark, sf):
    events(spark, sf).createOrReplaceTempView("session_events")
    return spark.sql("""
        SELECT user_id AS id, w.start AS w_start, w.end AS w_end, cnt
        FROM (SELECT user_id, session_window(ts, '12 hours') AS w, count(*) AS cnt FROM session_events
              GROUP BY user_id, session_window(ts, '12 hours'))""")


@query("W13b_over_unbounded_rows", """
SELECT event_id, user_id, count(*) OVER w AS cnt, round(sum(value) OVER w, 4) AS total
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def q_w13b(spark, sf):
    out = running(events(spark, sf), ["user_id"], ["ts", "event_id"],
                  {"cnt": ("count", "value"), "s": ("sum", "value")})
    return out.select("event_id", "user_id", "cnt", F.round("s", 4).alias("total"))


@query("W13c_over_unbounded_range", """
WITH e AS (SELECT *, CAST(ts AS DATE) AS day FROM events)
SELECT event_id, user_id, count(*) OVER w AS cnt, round(sum(value) OVER w, 4) AS total
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY day RANGE UNBOUNDED PRECEDING)
""")
def q_w13c(spark, sf):
    """Rows of one day are peers: running sums over days, joined back to the rows."""
    e = events(spark, sf).withColumn("day", F.date_trunc("day", F.col("ts").cast("timestamp")))
    days = e.groupBy("user_id", "day").agg(F.count("value").alias("n"), F.sum("value").alias("v"))
    upto = running(days, ["user_id"], ["day"], {"cnt": ("sum", "n"), "s": ("sum", "v")})
    return e.join(upto.select("user_id", "day", "cnt", "s"), ["user_id", "day"]).select(
        "event_id", "user_id", "cnt", F.round("s", 4).alias("total"))


@query("S7b_ddl_time_column", """
SELECT time_bucket(INTERVAL 1 HOUR, date_trunc('second', ts)) AS w_start, count(*) AS cnt FROM events GROUP BY ALL
""")
def q_s7b(spark, sf):
    """A declared table with a computed time column, used as the row time of a window."""
    path = scratch_path(spark, "s7b-csv")
    write_csv(events(spark, sf).select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts")), path)
    csv_view(spark, "sensor_time", path, "id BIGINT, ts BIGINT", {"rt": "to_timestamp(from_unixtime(ts))"})
    return spark.sql("""
        SELECT w.start AS w_start, cnt FROM (
          SELECT window(rt, '1 hour') AS w, count(*) AS cnt FROM sensor_time GROUP BY window(rt, '1 hour'))
        """).select(F.col("w_start").cast("timestamp_ntz").alias("w_start"), "cnt")


@query("A15b_event_time_word_count", f"""
WITH w AS (SELECT ts, unnest(string_split(event_type || ' item' || CAST({ITEM_SQL} % 10 AS VARCHAR), ' ')) AS word FROM events)
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       word, count(*) AS count FROM w GROUP BY ALL
""")
def q_a15b(spark, sf):
    """Words of text lines in event-time windows, over several micro-batches."""
    line = F.concat_ws(" ", "event_type", F.concat(F.lit("item"), (item_col() % 10).cast("string")))
    s = _events(spark, sf, "30 minutes", flush=True, sliced=True, late="30 minutes",
                pre=lambda d: d.select("ts", F.explode(F.split(line, r"\s+")).alias("word")))
    return run_to_parquet(S.window_counts(s, "ts", "1 hour", keys=["word"]), "a15b")


@query("J6b_cogroup_rows", """
WITH e AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_id, event_type FROM events
           WHERE event_type IN ('click', 'view'))
SELECT user_id, window_start,
       coalesce(string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) FILTER (event_type = 'click'), '') AS clicks,
       coalesce(string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) FILTER (event_type = 'view'), '') AS views
FROM e GROUP BY ALL
""")
def q_j6b(spark, sf):
    """The rows of both sides of a (user, day) window side by side, either side may be empty."""
    e = events(spark, sf).where(F.col("event_type").isin("click", "view"))

    def rows(kind):
        ids = F.collect_list(F.when(F.col("event_type") == kind, F.col("event_id")))
        return F.array_join(F.array_sort(ids).cast("array<string>"), " ")

    return e.groupBy("user_id", F.window("ts", "1 day").alias("w")).agg(
        rows("click").alias("clicks"), rows("view").alias("views")).select(
        "user_id", F.col("w.start").alias("window_start"), "clicks", "views")


@query("J6c_cogroup_zipped", """
WITH e AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_id, event_type,
             row_number() OVER (PARTITION BY user_id, event_type, time_bucket(INTERVAL 1 DAY, ts) ORDER BY event_id) AS seq
           FROM events WHERE event_type IN ('click', 'view'))
SELECT user_id, window_start, seq, max(event_id) FILTER (event_type = 'click') AS click_id,
       max(event_id) FILTER (event_type = 'view') AS view_id FROM e GROUP BY ALL
""")
def q_j6c(spark, sf):
    """The rows of both sides of a (user, day) as rows, the i-th click beside the i-th view."""
    e = events(spark, sf).select("user_id", F.window("ts", "1 day")["start"].alias("window_start"), "event_id", "event_type")
    sides = [e.where(F.col("event_type") == t).drop("event_type") for t in ("click", "view")]
    out = cogroup_rows(*sides, ["user_id", "window_start"], ["event_id"])
    return out.select("user_id", "window_start", "seq", F.col("left_event_id").alias("click_id"),
                      F.col("right_event_id").alias("view_id"))


@query("T9b_reducing_aggregating_state", """
SELECT event_id, user_id AS sensor_id, min(value) OVER w AS min_temp,
       count(*) OVER w AS n, round(sum(value) OVER w, 2) AS total
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def q_t9b(spark, sf):
    """Reducing state (minimum) and aggregating state (count and sum) per sensor, over micro-batches."""
    s = _replay(spark, sf, "events", "ts", True).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("sensor_id"),
        F.col("value").alias("temperature"))
    out = run_to_parquet(S.running_statistics(s), "t9b")
    return out.select("event_id", "sensor_id", "min_temp", "n", F.round("total", 2).alias("total"))


@query("W4_processing_time_windows", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def q_w4(spark, sf):
    """Counts per processing-time window; summed over the windows the clock does not matter."""
    s = S.with_processing_time(_replay(spark, sf, "events", "ts", True).select("event_type"))
    counts = s.groupBy(F.window("proc_time", "10 seconds"), "event_type").agg(F.count(F.lit(1)).alias("count"))
    out = run_foreach_batch(counts, "w4", lambda b: b, mode="complete", overwrite=True)
    return out.groupBy("event_type").agg(F.sum("count").alias("count"))


@query("W4b_processing_time_clock", f"""
WITH {_sliced_sql(0)}
SELECT time_bucket(INTERVAL 1 HOUR, ts + slice * INTERVAL 90 MINUTE) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts + slice * INTERVAL 90 MINUTE) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS count FROM e GROUP BY ALL
""")
def q_w4b(spark, sf):
    """Processing-time windows with the clock handed in, so starts and counts can be checked: the
    clock of a row is its time plus 90 minutes for each slice before its own."""
    lo, width = _slice_width(spark, sf)
    slices = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - lo) / width)
    clock = F.col("ts").cast("timestamp") + F.make_dt_interval(mins=(slices * 90).cast("int"))
    s = S.with_processing_time(_replay(spark, sf, "events", "ts", True), clock=clock).select("event_type", "proc_time")
    s = event_time(s, "proc_time", "0 seconds", flush=True)
    return run_to_parquet(S.window_counts(s, "proc_time", "1 hour", keys=["event_type"]), "w4b")


def _slice_width(spark, sf):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = events(spark, sf).agg(F.min(us), F.max(us)).first()
    return lo or 0, ((hi or 0) - (lo or 0)) // SLICES + 1


@query("T13b_retract_stream_running", f"""
WITH {_sliced_sql(0)},
k AS (SELECT slice, event_type, count(*) AS c FROM e GROUP BY ALL),
t AS (SELECT slice, event_type, c, CAST(sum(c) OVER (PARTITION BY event_type ORDER BY slice) AS BIGINT) AS total FROM k)
SELECT TRUE AS flag, event_type, total AS cnt FROM t
UNION ALL SELECT FALSE, event_type, total - c FROM t WHERE total > c
""")
def q_t13b(spark, sf):
    """A running count as a retract stream: each micro-batch takes back the old count of a
    changed key and adds the new one."""
    s = _replay(spark, sf, "events", "ts", True).select("event_type")
    return RetractStream(spark, ["event_type"], "cnt").run(s)

