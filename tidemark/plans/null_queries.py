"""Rows without a key: a null key is a key, and as the largest one it is cut like any other.

Every tenth user of the events is made unknown, so the null key holds a tenth of all rows;
the scans are told to cut keys of more than 300 rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timefns import interval
from tidemark.operators.ranking import exact_median, ranked
from tidemark.operators.sequence import neighbours, rows_frame
from tidemark.operators.windows import count_window
from tidemark.plans.registry import query
from tidemark.plans.stream_queries import SLICES, _sliced_sql
from tidemark.plans.tables import events
from tidemark.session import scratch_path
from tidemark.sinks.writers import read_buckets, upsert_buckets
from tidemark.sources.files import stream_slices
from tidemark.streaming.late import AllowedLateness, RetractStream

CUT = "auto:300:100"
_SQL = "WITH n AS (SELECT *, CASE WHEN user_id % 10 <> 0 THEN user_id END AS k FROM events)\n"


def _unknown(df):
    return df.withColumn("k", F.when(F.col("user_id") % 10 != 0, F.col("user_id")))


@query("W14n_rank_null_key", _SQL + """
SELECT k, event_id, rank() OVER (PARTITION BY k ORDER BY value DESC) AS rnk,
       row_number() OVER (PARTITION BY k ORDER BY value DESC, event_id) AS row_num FROM n
""")
def q_w14n(spark, sf):
    out = ranked(_unknown(events(spark, sf)), ["k"], "value", ["event_id"])
    return out.select("k", "event_id", F.col("rnk").cast("long").alias("rnk"), F.col("row_num").cast("long").alias("row_num"))


@query("A9n_median_null_key", _SQL + """
SELECT k, min(value) AS min, max(value) AS max, median(value) AS median, count(*) AS cnt FROM n GROUP BY k
""")
def q_a9n(spark, sf):
    return exact_median(_unknown(events(spark, sf)), ["k"], "value")


@query("W5n_count_window_null_key", _SQL + """
, r AS (SELECT k, value, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS rn FROM n)
SELECT f.k, f.rn AS fire_at_row, count(*) AS count, round(sum(r.value), 4) AS sum
FROM r f JOIN r ON f.k IS NOT DISTINCT FROM r.k AND r.rn BETWEEN f.rn - 9 AND f.rn
WHERE f.rn % 4 = 0 GROUP BY f.k, f.rn
""")
def q_w5n(spark, sf):
    out = count_window(_unknown(events(spark, sf)), ["k"], ["ts", "event_id"], 10, 4, "value", chunk=CUT)
    return out.select("k", "fire_at_row", "count", F.round("sum", 4).alias("sum"))


@query("W12n_over_rows_null_key", _SQL + """
SELECT event_id, k, count(*) OVER w AS count, round(sum(value) OVER w, 4) AS sum, min(value) OVER w AS min
FROM n WINDOW w AS (PARTITION BY k ORDER BY ts, event_id ROWS 5 PRECEDING)
""")
def q_w12n(spark, sf):
    out = rows_frame(_unknown(events(spark, sf)), ["k"], ["ts", "event_id"], "value", 5, ("count", "sum", "min"), chunk=CUT)
    return out.select("event_id", "k", "count", F.round("sum", 4).alias("sum"), "min")


@query("D15n_temp_jump_null_key", _SQL + """
, l AS (SELECT event_id, k, ts, value, lag(value) OVER w AS last_temp, lag(ts) OVER w AS last_ts
        FROM n WINDOW w AS (PARTITION BY k ORDER BY ts, event_id))
SELECT event_id, k, last_temp, value FROM l WHERE abs(value - last_temp) > 100 AND ts <= last_ts + INTERVAL 6 HOUR
""")
def q_d15n(spark, sf):
    n = neighbours(_unknown(events(spark, sf)), ["k"], ["ts", "event_id"], ["value", "ts"], chunk=CUT)
    hit = (F.abs(F.col("value") - F.col("prev_value")) > 100) & (F.col("ts") <= F.col("prev_ts") + interval("6 hours"))
    return n.where(hit).select("event_id", "k", F.col("prev_value").alias("last_temp"), "value")


@query("K6n_upsert_null_key", _SQL + """
SELECT k, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_id DESC) AS rn FROM n)
WHERE rn = 1
""")
def q_k6n(spark, sf):
    """Three versions; the last one touches the unknown key and a few others only."""
    e = _unknown(events(spark, sf)).select("k", "event_id", "value", "ts")
    path = scratch_path(spark, "k6n-upsert")
    first = F.lit("2024-01-12").cast("timestamp_ntz")
    second = F.col("k").isNull() | (F.col("k") % 16 == 3)
    for v, rows in enumerate((F.col("ts") < first, (F.col("ts") >= first) & ~F.coalesce(second, F.lit(False)),
                              (F.col("ts") >= first) & second)):
        upsert_buckets(e.where(rows), path, v, ["k"], ["ts", "event_id"], buckets=16)
    return read_buckets(spark, path, 2).select("k", "event_id", "value")


_KEYED = _sliced_sql(6).replace("SELECT event_id, user_id, event_type, ts,",
                                "SELECT event_id, nullif(event_type, 'view') AS kind, ts,")


@query("T6n_allowed_lateness_null_key", f"""
WITH {_KEYED},
w AS (SELECT slice, kind, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, before FROM e JOIN wm USING (slice)),
k AS (SELECT slice, kind, window_start, count(*) AS c FROM w
      WHERE before IS NULL OR window_start + INTERVAL 4 HOUR > before - INTERVAL 10 MINUTE GROUP BY ALL),
s AS (SELECT wm.slice, g.kind, g.window_start, coalesce(c, 0) AS c,
             sum(coalesce(c, 0)) OVER (PARTITION BY g.kind, g.window_start ORDER BY wm.slice) AS total,
             wm.slice = {SLICES - 1} OR g.window_start + INTERVAL 1 HOUR <= after - INTERVAL 10 MINUTE AS due
      FROM wm CROSS JOIN (SELECT DISTINCT kind, window_start FROM k) g
      LEFT JOIN k ON k.slice = wm.slice AND k.kind IS NOT DISTINCT FROM g.kind AND k.window_start = g.window_start),
f AS (SELECT kind, window_start, min(slice) AS first_slice FROM s WHERE due AND total > 0 GROUP BY ALL)
SELECT s.window_start, s.kind, CAST(total AS BIGINT) AS count,
       CASE WHEN slice = first_slice THEN 'first' ELSE 'update' END AS emission
FROM s JOIN f ON s.kind IS NOT DISTINCT FROM f.kind AND s.window_start = f.window_start
WHERE slice = first_slice OR (slice > first_slice AND c > 0)
""")
def q_t6n(spark, sf):
    s = stream_slices(spark, sf, "events", "ts", SLICES, "6 hours", F.col("event_id") % 10 == 0).select(
        F.nullif(F.col("event_type"), F.lit("view")).alias("kind"), "ts")
    return AllowedLateness(spark, ["kind"], "ts", "1 hour", "10 minutes", "3 hours").run(s).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "kind", "count", "emission")


@query("T13n_retract_stream_null_key", f"""
WITH {_KEYED.replace(str(6 * 3_600_000_000), "0")},
k AS (SELECT slice, kind, count(*) AS c FROM e GROUP BY ALL),
t AS (SELECT slice, kind, c, CAST(sum(c) OVER (PARTITION BY kind ORDER BY slice) AS BIGINT) AS total FROM k)
SELECT TRUE AS flag, kind, total AS cnt FROM t
UNION ALL SELECT FALSE, kind, total - c FROM t WHERE total > c
""")
def q_t13n(spark, sf):
    s = stream_slices(spark, sf, "events", "ts", SLICES).select(F.nullif(F.col("event_type"), F.lit("view")).alias("kind"))
    return RetractStream(spark, ["kind"], "cnt").run(s)
