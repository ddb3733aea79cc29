"""Streaming twins run over the driver's tables as file streams (availableNow).

Each query replays a table as an unbounded source, runs the streaming
operator with watermarks / keyed state / timers, writes to an exactly-once
parquet sink in the checkpoint root and returns what was written.  Where the
semantics are deterministic the oracle is the batch twin's SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import basics, detection, io_queries, marketing, reconcile, sensors, traffic  # noqa: F401 (oracles)
from tidemark.plans.registry import _ORACLES, query
from tidemark.plans.tables import ITEM_SQL, item_col
from tidemark.sources.files import read_table, stream_slices, stream_table
from tidemark.streaming import jobs as S
from tidemark.streaming import processors as P
from tidemark.streaming.runner import event_time, run_foreach_batch, run_to_parquet


#: Micro-batches of the rate-limited replays.
SLICES = 5


def _replay(spark, sf, name, ts, sliced, late=None):
    """A table as a stream: one file, or with ``sliced`` rate-limited micro-batches in time
    order, in which every tenth row arrives ``late``."""
    if not sliced:
        return stream_table(spark, sf, name)
    key = {"events": "event_id", "orders": "o_orderkey"}[name]
    return stream_slices(spark, sf, name, ts, SLICES, late, F.col(key) % 10 == 0)


def _events(spark, sf, delay="0 seconds", flush=False, pre=None, sliced=False, late=None):
    """The events table as a stream.  ``flush`` (needed where windows close or
    timers fire) adds the end-of-input sentinel.  Row filters and projections
    go in ``pre``: they must run before the watermark so the sentinel (which
    has null columns) reaches the watermark operator."""
    raw = _replay(spark, sf, "events", "ts", sliced, late)
    if pre is not None:
        raw = pre(raw)
    return event_time(raw, "ts", delay, flush=flush)


@query("T3_stream_window_count", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS count FROM events GROUP BY ALL
""")
def q_t3(spark, sf, sliced=False):
    s = _events(spark, sf, "1 hour", flush=True, sliced=sliced, late="30 minutes")
    return run_to_parquet(S.window_counts(s, "ts", "1 hour", keys=["event_type"]), "t3")


@query("D1s_hot_items_stream", _ORACLES["D1_hot_items"])
def q_d1s(spark, sf, sliced=False):
    s = _events(spark, sf, "30 minutes", flush=True, sliced=sliced, late="30 minutes", pre=lambda d: d.where(F.col("event_type") == "view").withColumn(
        "item_id", item_col()))
    counts = S.window_counts(s, "ts", "1 hour", "5 minutes", keys=["item_id"])
    return run_foreach_batch(counts, "d1s", S.top_n_per_batch(3, "item_id"))


@query("D2s_hot_urls_stream", _ORACLES["D2_hot_urls"])
def q_d2s(spark, sf):
    """Access-log lines parsed in the stream; watermark 1 s out-of-orderness +
    60 s lateness as in the reference; closed windows ranked per batch."""
    from tidemark.sources.transforms import parse_apache_log, render_apache_log

    logs = parse_apache_log(render_apache_log(stream_table(spark, sf, "events")))
    s = event_time(logs, "event_time", "61 seconds", flush=True)
    counts = S.window_counts(s, "event_time", "6 hours", "1 hour", keys=["url"])
    return run_foreach_batch(counts, "d2s", S.top_n_per_batch(5, "url"))


@query("D20s_click_browse_stream", _ORACLES["D20_click_browse_join"])
def q_d20s(spark, sf):
    """Stream-stream interval join of clicks with the views of the hour before."""
    clicks = _events(spark, sf, delay="1 hour", pre=lambda d: d.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), "ts")).withColumnRenamed("ts", "click_ts")
    views = _events(spark, sf, delay="1 hour", pre=lambda d: d.where(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("view_id"), "ts")).withColumnRenamed("ts", "view_ts")
    out = run_to_parquet(S.interval_join_streams(clicks, views, ["user_id"], "click_ts", "view_ts",
                                                 "-1 hour", "0 seconds"), "d20s")
    return out.select("user_id", "click_id", "view_id",
                      F.col("click_ts").cast("timestamp_ntz").alias("click_ts"),
                      F.col("view_ts").cast("timestamp_ntz").alias("view_ts"))


@query("D19s_freezing_alarm_stream", _ORACLES["D19_freezing_alarm"])
def q_d19s(spark, sf):
    from tidemark.operators.transforms import forward_with_alarm

    s = stream_table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("sensor_id"), F.col("value").alias("temperature"))
    return run_to_parquet(forward_with_alarm(s, F.col("temperature") < 32.0, "freezing"), "d19s")


@query("D17s_avg_celsius_stream", _ORACLES["D17_avg_temp_celsius"])
def q_d17s(spark, sf):
    from tidemark.functions.scalar import fahrenheit_to_celsius

    s = _sensor_stream(spark, sf, flush=True).withColumn("celsius", fahrenheit_to_celsius(F.col("temperature")))
    out = run_to_parquet(S.window_aggregate(s, "ts", "1 day", ["sensor_id"], [F.avg("celsius").alias("a")]), "d17s")
    return out.select("window_start", "window_end", "sensor_id", F.round("a", 4).alias("avg_celsius"))


@query("D18s_min_max_stream", _ORACLES["D18_min_max_temp"])
def q_d18s(spark, sf):
    s = _sensor_stream(spark, sf, flush=True)
    return run_to_parquet(S.window_aggregate(s, "ts", "1 day", ["sensor_id"], [
        F.min("temperature").alias("min_temp"), F.max("temperature").alias("max_temp")]), "d18s")


@query("D6s_marketing_total_stream", _ORACLES["D6_marketing_total"])
def q_d6s(spark, sf):
    s = _events(spark, sf, flush=True, pre=lambda d: d.where(F.upper("event_type") != "ERROR").select("ts"))
    out = run_to_parquet(S.window_counts(s, "ts", "1 hour", "10 minutes"), "d6s")
    return out.select("window_start", "window_end", F.lit("app marketing").alias("channel"),
                      F.lit("total").alias("behavior"), "count")


@query("D4s_uv_stream", _ORACLES["D4_unique_visitors"])
def q_d4s(spark, sf):
    s = _events(spark, sf, flush=True, pre=lambda d: d.where(F.col("event_type") == "view"))
    pairs = S.distinct_users_per_window(s, "ts", "1 hour", "user_id")
    return run_foreach_batch(pairs, "d4s", lambda b: b.groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("uv")))


@query("D8s_click_filter_stream", f"""
WITH c AS (SELECT event_id, ts, user_id, {ITEM_SQL} % 3 AS ad_id FROM events WHERE event_type = 'click'),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS n FROM c)
SELECT event_id, user_id, ad_id, CASE WHEN n <= 1 THEN 'pass' WHEN n = 2 THEN 'warn' ELSE 'drop' END AS status FROM n
""")
def q_d8s(spark, sf, sliced=False):
    s = _events(spark, sf, "30 minutes", flush=True, sliced=sliced, late="30 minutes",
                pre=lambda d: d.where(F.col("event_type") == "click").select(
                    "event_id", "ts", "user_id", (item_col() % 3).alias("ad_id")))
    out = S.click_fraud(s, 1, ["event_id", "user_id", "ad_id"], hold=True)
    return run_to_parquet(out, "d8s")


@query("D7s_ad_by_province_stream", _ORACLES["D7_ad_by_province"])
def q_d7s(spark, sf):
    """D8 keyed filter, then the per-province window count on its output
    (two stateful operators chained on one watermark)."""
    s = _events(spark, sf, flush=True, pre=lambda d: d.where(F.col("event_type") == "click").select(
        "event_id", "ts", "user_id", (item_col() % 3).alias("ad_id"),
        F.concat(F.lit("province_"), (item_col() % 10).cast("string")).alias("province")))
    passed = S.click_fraud(s, 1, ["event_id", "ts", "user_id", "ad_id", "province"], event_time_col="ts")
    passed = passed.where(F.col("status") == "pass")
    return run_to_parquet(S.window_counts(passed, "ts", "1 hour", "5 minutes", keys=["province"]), "d7s")


@query("D5s_marketing_stream", _ORACLES["D5_marketing_by_channel"])
def q_d5s(spark, sf, sliced=False):
    from tidemark.plans.marketing import _channel_of

    s = _events(spark, sf, "30 minutes", flush=True, sliced=sliced, late="30 minutes", pre=lambda d: d.where(F.upper("event_type") != "ERROR").select(
        "ts", F.upper("event_type").alias("behavior"), _channel_of(item_col()).alias("channel")))
    return run_to_parquet(S.window_counts(s, "ts", "1 hour", "10 minutes", keys=["channel", "behavior"]), "d5s")


@query("D21s_dynamic_threshold_stream", _ORACLES["D21_dynamic_threshold"])
def q_d21s(spark, sf, sliced=False):
    kind = F.when(F.col("event_type") == "signup", "rule").otherwise("reading")
    s = _events(spark, sf, "30 minutes", flush=True, sliced=sliced, late="30 minutes", pre=lambda d: d.select(
        F.col("user_id").alias("sensor_id"), "ts", "event_id", kind.alias("kind"), "value"))
    return run_to_parquet(S.dynamic_threshold(s), "d21s")


@query("D9s_login_fail_stream", """
WITH l AS (SELECT event_id, ts, user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type
           FROM events),
s AS (SELECT *, lag(event_type) OVER w AS prev_type, lag(ts) OVER w AS prev_ts
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, prev_ts AS first_fail_time, ts AS last_fail_time
FROM s WHERE event_type = 'fail' AND prev_type = 'fail' AND ts < prev_ts + INTERVAL 2 HOUR
""")
def q_d9s(spark, sf, sliced=False):
    s = _events(spark, sf, "30 minutes", flush=True, sliced=sliced, late="30 minutes").select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type"))
    out = run_to_parquet(S.login_fail(s, "2 hours"), "d9s")
    return out.select("user_id", F.col("first_fail_time").cast("timestamp_ntz").alias("first_fail_time"),
                      F.col("last_fail_time").cast("timestamp_ntz").alias("last_fail_time"))


@query("D10s_pattern_stream", """
WITH l AS (SELECT event_id, ts, user_id, event_type = 'error' AS fail FROM events),
s AS (SELECT *, lead(fail) OVER w AS next_fail, lead(ts) OVER w AS next_ts
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts AS first_ts, next_ts AS second_ts, TRUE AS matched
FROM s WHERE fail AND next_fail AND next_ts - ts < INTERVAL 3 HOUR
""")
def q_d10s(spark, sf, sliced=False):
    s = _events(spark, sf, "30 minutes", flush=True, sliced=sliced, late="30 minutes", pre=lambda d: d.select(
        "user_id", "ts", F.col("event_id").alias("seq"), "event_type"))
    out = S.pattern(s, "user_id", F.col("event_type") == "error", F.col("event_type") == "error", "next", "3 hours")
    res = run_to_parquet(out, "d10s")
    return res.select("user_id", F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
                      F.col("second_ts").cast("timestamp_ntz").alias("second_ts"), "matched")


@query("D11s_order_timeout_stream", """
WITH o AS (SELECT event_id, ts, user_id, event_type FROM events WHERE event_type IN ('signup', 'purchase')),
s AS (SELECT *, first_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS) OVER (
          PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_ts
      FROM o)
SELECT user_id, ts AS first_ts, CASE WHEN pay_ts - ts < INTERVAL 6 HOUR THEN pay_ts END AS second_ts,
       coalesce(pay_ts - ts < INTERVAL 6 HOUR, FALSE) AS matched
FROM s WHERE event_type = 'signup'
""")
def q_d11s(spark, sf, sliced=False):
    s = _events(spark, sf, "30 minutes", flush=True, sliced=sliced, late="30 minutes", pre=lambda d: d.where(F.col("event_type").isin("signup", "purchase")).select(
        "user_id", "ts", F.col("event_id").alias("seq"), "event_type"))
    out = S.pattern(s, "user_id", F.col("event_type") == "signup", F.col("event_type") == "purchase", "followedBy",
                    "6 hours", emit_timeouts=True)
    res = run_to_parquet(out, "d11s")
    return res.select("user_id", F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
                      F.col("second_ts").cast("timestamp_ntz").alias("second_ts"), "matched")


def _partner():
    """Every fifth payment or receipt names an unknown order: partners are missing both ways."""
    return F.when(F.col("o_orderkey") % 5 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))


_PARTNER_SQL = "CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey ELSE o_orderkey END"


def _orders_stream(spark, sf, sliced=False):
    """A creation and a payment per order; the payment comes (totalprice mod 50) - 10 days
    after the order date."""
    o = _replay(spark, sf, "orders", "o_orderdate", sliced, "20 days")
    creates = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ts"),
                       F.lit("create").alias("event_type"), F.lit(0).alias("seq"))
    pays = o.select(_partner().alias("order_id"), _shifted("o_orderdate", 50, 10).alias("ts"),
                    F.lit("pay").alias("event_type"), F.lit(1).alias("seq"))
    return creates.unionByName(pays)


def _shifted(col, mod, back):
    days = (F.floor(F.col("o_totalprice")).cast("long") % mod - back).cast("int")
    return F.timestamp_add("DAY", days, F.col(col))


_SHIFT_SQL = "o_orderdate + to_days(CAST(floor(o_totalprice) AS BIGINT) % {mod} - {back})"


@query("D12s_order_pay_stream", f"""
WITH c AS (SELECT o_orderkey AS order_id, o_orderdate AS create_time FROM orders),
p AS (SELECT {_PARTNER_SQL} AS order_id, {_SHIFT_SQL.format(mod=50, back=10)} AS pay_time FROM orders)
SELECT coalesce(c.order_id, p.order_id) AS order_id,
       CASE WHEN create_time IS NULL THEN 'already payed but not found create log'
            WHEN pay_time IS NULL THEN 'order timeout'
            WHEN pay_time < create_time THEN 'payed'
            WHEN pay_time < create_time + INTERVAL 30 DAY THEN 'payed successfully'
            ELSE 'payed but already timeout' END AS result_msg
FROM c FULL OUTER JOIN p ON c.order_id = p.order_id
""")
def q_d12s(spark, sf, sliced=False):
    s = event_time(_orders_stream(spark, sf, sliced), "ts", "50 days", flush=True)
    return run_to_parquet(S.order_pay(s, "30 days"), "d12s")


@query("D13s_tx_reconcile_stream", f"""
WITH p AS (SELECT o_orderkey AS tx_id, o_orderdate AS pay_time FROM orders),
r AS (SELECT {_PARTNER_SQL} AS tx_id, {_SHIFT_SQL.format(mod=70, back=35)} AS receipt_time FROM orders),
m AS (SELECT p.tx_id, pay_time, receipt_time FROM p JOIN r ON p.tx_id = r.tx_id
      AND receipt_time BETWEEN pay_time - INTERVAL 30 DAY AND pay_time + INTERVAL 30 DAY)
SELECT tx_id, pay_time, receipt_time, 'matched' AS tag FROM m
UNION ALL SELECT tx_id, pay_time, NULL, 'unmatched_pay' FROM p WHERE tx_id NOT IN (SELECT tx_id FROM m)
UNION ALL SELECT tx_id, NULL, receipt_time, 'unmatched_receipt' FROM r WHERE tx_id NOT IN (SELECT tx_id FROM m)
""")
def q_d13s(spark, sf, sliced=False):
    o = _replay(spark, sf, "orders", "o_orderdate", sliced, "20 days")
    pays = o.select(
        F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("ts"), F.lit("pay").alias("side"),
        F.lit(0).alias("seq"))
    receipts = o.select(
        _partner().alias("tx_id"), _shifted("o_orderdate", 70, 35).alias("ts"),
        F.lit("receipt").alias("side"), F.lit(1).alias("seq"))
    s = event_time(pays.unionByName(receipts), "ts", "70 days", flush=True)
    out = run_to_parquet(S.tx_match(s, "30 days"), "d13s")
    return out.select("tx_id", F.col("pay_time").cast("timestamp_ntz").alias("pay_time"),
                      F.col("receipt_time").cast("timestamp_ntz").alias("receipt_time"), "tag")


def _sensor_stream(spark, sf, flush=True, sliced=False):
    return _events(spark, sf, "30 minutes", flush=flush, sliced=sliced, late="30 minutes").select("event_id", "ts", F.col("user_id").alias("sensor_id"),
                                     F.col("value").alias("temperature"))


@query("D15s_temp_jump_stream", _ORACLES["D15_temp_jump"])
def q_d15s(spark, sf, sliced=False):
    out = run_to_parquet(S.temperature_jump(_sensor_stream(spark, sf, sliced=sliced), 100.0, hold=True), "d15s")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("D13r_tx_reconcile_repeated_stream", _ORACLES["D13_tx_reconcile"])
def q_d13r(spark, sf):
    """An id has one payment and several receipts, both over three micro-batches."""
    pays = stream_slices(spark, sf, "orders", "o_orderdate", 3, "20 days", F.col("o_orderkey") % 10 == 0)
    receipts = stream_slices(spark, sf, "lineitem", "l_shipdate", 3, "20 days", F.col("l_orderkey") % 7 == 0)
    s = pays.select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("ts"), F.lit("pay").alias("side"),
                    F.lit(0).cast("long").alias("seq")).unionByName(receipts.select(
                        F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").alias("ts"),
                        F.lit("receipt").alias("side"), F.col("l_linenumber").cast("long").alias("seq")))
    out = run_to_parquet(S.tx_match(event_time(s, "ts", "400 days", flush=True), "30 days"), "d13r")
    return out.select("tx_id", F.col("pay_time").cast("timestamp_ntz").alias("pay_time"),
                      F.col("receipt_time").cast("timestamp_ntz").alias("receipt_time"), "tag")


@query("D22s_self_cleaning_stream", _ORACLES["D22_self_cleaning_jump"])
def q_d22s(spark, sf, sliced=False):
    out = run_to_parquet(S.temperature_jump(_sensor_stream(spark, sf, sliced=sliced), 50.0, "12 hours", hold=True),
                         "d22s")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("D16s_temp_rise_stream", sensors.RISE_SQL)
def q_d16s(spark, sf, sliced=False):
    out = run_to_parquet(S.continuous_rise(_sensor_stream(spark, sf, flush=True, sliced=sliced), "6 hours"), "d16s")
    return out.withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))


@query("A2_stream_word_count", _ORACLES["A1_word_count"])
def q_a2(spark, sf):
    docs = stream_table(spark, sf, "documents").select("text")
    words = docs.select(F.explode(F.split("text", r"[ \t\n\r\f]+")).alias("word")).where(F.col("word") != "")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return run_foreach_batch(counts, "a2", lambda b: b, mode="complete", overwrite=True)


def _sliced_sql(late_hours: int) -> str:
    """CTE ``e``: the events with the slice they arrive in, every tenth row late."""
    return f"""
b AS (SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // {SLICES} + 1 AS width FROM events),
e AS (SELECT event_id, user_id, event_type, ts, CAST(least((epoch_us(ts) - lo
        + CASE WHEN event_id % 10 = 0 THEN {late_hours * 3_600_000_000} ELSE 0 END) // width, {SLICES - 1}) AS INTEGER) AS slice
      FROM events, b),
m AS (SELECT slice, max(ts) AS top FROM e GROUP BY slice),
wm AS (SELECT slice, max(top) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
              max(top) OVER (ORDER BY slice) AS after FROM m)"""


@query("T7_late_side_output", f"""
WITH {_sliced_sql(6)}
SELECT event_id, user_id, CASE WHEN ts < before - INTERVAL 1 HOUR THEN 'late' ELSE 'on_time' END AS tag
FROM e JOIN wm USING (slice)
""")
def q_t7(spark, sf):
    """Five micro-batches; every tenth row is six hours out of order, the delay is one hour."""
    from tidemark.session import scratch_path
    from tidemark.streaming.late import read_tagged

    s = _replay(spark, sf, "events", "ts", True, "6 hours").select("event_id", "user_id", "ts")
    out = scratch_path(spark, "t7")
    q = S.tag_late(s, "ts", "1 hour", out, out + "-ckpt")
    q.awaitTermination()
    return read_tagged(spark, out).select("event_id", "user_id", "tag")


@query("T6_allowed_lateness", f"""
WITH {_sliced_sql(6)},
w AS (SELECT slice, event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, before FROM e JOIN wm USING (slice)),
k AS (SELECT slice, event_type, window_start, count(*) AS c FROM w
      WHERE before IS NULL OR window_start + INTERVAL 4 HOUR > before - INTERVAL 10 MINUTE GROUP BY ALL),
s AS (SELECT wm.slice, g.event_type, g.window_start, coalesce(c, 0) AS c,
             sum(coalesce(c, 0)) OVER (PARTITION BY g.event_type, g.window_start ORDER BY wm.slice) AS total,
             wm.slice = {SLICES - 1} OR g.window_start + INTERVAL 1 HOUR <= after - INTERVAL 10 MINUTE AS due
      FROM wm CROSS JOIN (SELECT DISTINCT event_type, window_start FROM k) g
      LEFT JOIN k USING (slice, event_type, window_start)),
f AS (SELECT event_type, window_start, min(slice) AS first_slice FROM s WHERE due AND total > 0 GROUP BY ALL)
SELECT window_start, event_type, CAST(total AS BIGINT) AS count,
       CASE WHEN slice = first_slice THEN 'first' ELSE 'update' END AS emission
FROM s JOIN f USING (event_type, window_start) WHERE slice = first_slice OR (slice > first_slice AND c > 0)
""")
def q_t6(spark, sf):
    """Hourly counts fire when the watermark (10 minutes) passes the window's end and again
    for rows that come within three hours after it; later rows are dropped."""
    from tidemark.streaming.late import AllowedLateness

    s = _replay(spark, sf, "events", "ts", True, "6 hours").select("event_type", "ts")
    return AllowedLateness(spark, ["event_type"], "ts", "1 hour", "10 minutes", "3 hours").run(s).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "count", "emission")


@query("D2r_hot_urls_every_ranking", f"""
WITH {_sliced_sql(6)},
r AS (SELECT slice, {traffic._URL_SQL.replace("event_type", "x.event_type")} AS url,
             epoch_us(date_trunc('second', x.ts)) // 3600000000 AS pane FROM e JOIN events x USING (event_id)),
t AS (SELECT slice, epoch_us(date_trunc('second', before)) - 600000000 AS passed,
             epoch_us(date_trunc('second', after)) - 600000000 AS due FROM wm),
a AS (SELECT slice, url, (pane + 1 + j) * 3600000000 AS end_us, count(*) AS c FROM r, range(6) g(j) GROUP BY ALL),
k AS (SELECT a.* FROM a JOIN t USING (slice) WHERE passed IS NULL OR end_us > passed - 10800000000),
s AS (SELECT t.slice, t.passed, t.due, u.url, u.end_us,
             sum(coalesce(c, 0)) OVER (PARTITION BY u.url, u.end_us ORDER BY t.slice) AS total
      FROM t CROSS JOIN (SELECT DISTINCT url, end_us FROM k) u LEFT JOIN k USING (slice, url, end_us)),
o AS (SELECT * FROM s WHERE total > 0 AND (passed IS NULL OR end_us > passed - 10800000000)),
n AS (SELECT slice, end_us, url, total, end_us <= due AS fired,
             row_number() OVER (PARTITION BY slice, end_us ORDER BY total DESC, url) AS rank FROM o),
l AS (SELECT slice, end_us, fired, list({{'rank': rank, 'url': url, 'count': CAST(total AS BIGINT)}} ORDER BY rank) AS now
      FROM n WHERE rank <= 5 AND (fired OR slice = {SLICES - 1}) GROUP BY ALL),
c AS (SELECT end_us, now, lag(now) OVER (PARTITION BY end_us ORDER BY slice) AS was FROM l),
f AS (SELECT end_us, unnest(now) AS x, CASE WHEN was IS NULL THEN 'first' ELSE 'update' END AS emission
      FROM c WHERE was IS NULL OR was <> now)
SELECT make_timestamp(end_us) AS window_end, x.url AS url, x.count AS count, x.rank AS rank, emission FROM f
""")
def q_d2r(spark, sf):
    """Every ranking of a window of log lines: at the watermark (10 minutes) and again for each
    micro-batch whose late rows, up to three hours after its end, change the first five."""
    from tidemark.sources.transforms import parse_apache_log, render_apache_log
    from tidemark.streaming.late import LateRanking

    logs = parse_apache_log(render_apache_log(_replay(spark, sf, "events", "ts", True, "6 hours")))
    out = LateRanking(spark, ["url"], "event_time", "6 hours", "10 minutes", "3 hours", 5, "1 hour").run(
        logs.select("url", "event_time"))
    return out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@query("W8_early_firing_update", f"""
WITH {_sliced_sql(6)},
k AS (SELECT slice, event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS c FROM e GROUP BY ALL)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type,
       CAST(sum(c) OVER (PARTITION BY event_type, window_start ORDER BY slice) AS BIGINT) AS count FROM k
""")
def q_w8(spark, sf):
    """Update mode: every micro-batch that adds to a window emits its count again."""
    s = _events(spark, sf, "1 day", sliced=True, late="6 hours")
    counts = S.window_counts(s, "ts", "1 day", keys=["event_type"])
    return run_foreach_batch(counts, "w8", lambda b: b, mode="update")


_LOGIN_TIMER_SQL = """
WITH RECURSIVE s AS (
  SELECT user_id AS uid, event_type = 'error' AS fail, ts, date_trunc('millisecond', ts) AS tsm,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
walk(uid, rn, cnt, first_f, last_f, timer, e_first, e_last, e_cnt) AS (
  SELECT uid, rn, CASE WHEN fail THEN 1 ELSE 0 END, CASE WHEN fail THEN ts END, CASE WHEN fail THEN ts END,
         CASE WHEN fail THEN tsm + INTERVAL 2 HOUR END,
         CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT)
  FROM s WHERE rn = 1
  UNION ALL
  SELECT s.uid, s.rn,
         CASE WHEN NOT s.fail THEN 0 WHEN fired THEN 1 ELSE w.cnt + 1 END,
         CASE WHEN NOT s.fail THEN NULL WHEN fired OR w.first_f IS NULL THEN s.ts ELSE w.first_f END,
         CASE WHEN NOT s.fail THEN NULL ELSE s.ts END,
         CASE WHEN NOT s.fail THEN NULL WHEN fired OR w.timer IS NULL THEN s.tsm + INTERVAL 2 HOUR ELSE w.timer END,
         CASE WHEN fired AND w.cnt >= 2 THEN w.first_f END,
         CASE WHEN fired AND w.cnt >= 2 THEN w.last_f END,
         CASE WHEN fired AND w.cnt >= 2 THEN w.cnt END
  FROM walk w JOIN (SELECT *, TRUE AS dummy FROM s) s ON s.uid = w.uid AND s.rn = w.rn + 1,
       LATERAL (SELECT w.timer IS NOT NULL AND w.timer < s.tsm AS fired)),
ends AS (SELECT uid, max(rn) AS rn FROM s GROUP BY uid)
SELECT uid AS user_id, e_first AS first_fail_time, e_last AS last_fail_time, e_cnt AS fails
FROM walk WHERE e_cnt IS NOT NULL
UNION ALL
SELECT w.uid, w.first_f, w.last_f, CAST(w.cnt AS BIGINT) FROM walk w JOIN ends e ON w.uid = e.uid AND w.rn = e.rn
WHERE w.timer IS NOT NULL AND w.cnt >= 2
"""


def _logins(spark, sf):
    kind = F.when(F.col("event_type") == "error", "fail").otherwise("success")
    return read_table(spark, sf, "events").select("user_id", "ts", "event_id", kind.alias("event_type"))


@query("D9c_login_fail_timer", _LOGIN_TIMER_SQL)
def q_d9c(spark, sf):
    """The timer form in batch."""
    return detection.login_fail_timer(_logins(spark, sf), "2 hours", order=("ts", "event_id"))


@query("D9h_login_fail_timer_hot_key", _LOGIN_TIMER_SQL.replace("user_id AS uid", "user_id % 2 AS uid").replace(
    "PARTITION BY user_id", "PARTITION BY user_id % 2").replace("2 HOUR", "6 MINUTE"))
def q_d9h(spark, sf):
    """Two users, each cut into chunks of some 200 rows."""
    logins = _logins(spark, sf).withColumn("user_id", F.col("user_id") % 2)
    return detection.login_fail_timer(logins, "6 minutes", order=("ts", "event_id"), chunk="auto:300:200")


@query("D9b_login_fail_timer_stream", _LOGIN_TIMER_SQL)
def q_d9b(spark, sf, sliced=False):
    """Timer form of the login check: >= 2 fails within 2 hours of the first, no success between."""
    s = _events(spark, sf, "30 minutes", flush=True, sliced=sliced, late="30 minutes", pre=lambda d: d.select(
        "user_id", "ts", F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type")))
    out = run_to_parquet(S.login_fail_timer(s, "2 hours"), "d9b")
    return out.select("user_id", F.col("first_fail_time").cast("timestamp_ntz").alias("first_fail_time"),
                      F.col("last_fail_time").cast("timestamp_ntz").alias("last_fail_time"), "fails")


@query("C6s_three_stage_stream", _ORACLES["C6_three_stage_followed_by"])
def q_c6s(spark, sf):
    """View, click, purchase (each followed by the next) over five micro-batches with late rows."""
    return _sequence(spark, sf, "c6s", "1 day", [("view", F.col("event_type") == "view", ""),
                                                 ("click", F.col("event_type") == "click", "followedBy"),
                                                 ("buy", F.col("event_type") == "purchase", "followedBy")])


@query("C5s_pattern_or_next_stream", _ORACLES["C5_pattern_or_next"])
def q_c5s(spark, sf):
    """An error or a signup with a purchase right behind it."""
    return _sequence(spark, sf, "c5s", "6 hours", [
        ("start", (F.col("event_type") == "error") | (F.col("event_type") == "signup"), ""),
        ("buy", F.col("event_type") == "purchase", "next")])


_MIXED = [("view", "event_type = 'view'", ""), ("click", "event_type = 'click'", "next"),
          ("sign", "event_type = 'signup'", "followedBy"), ("buy", "event_type = 'purchase'", "followedBy")]


@query("C8b_mixed_stages_timeouts_stream", """
WITH s AS (SELECT user_id, event_id, ts, event_type, lead(event_type) OVER w AS n_type, lead(event_id) OVER w AS n_id,
             lead(ts) OVER w AS n_ts,
             first_value(CASE WHEN event_type = 'signup' THEN {'id': event_id, 'ts': ts} END IGNORE NULLS) OVER f AS sign,
             first_value(CASE WHEN event_type = 'purchase' THEN {'id': event_id, 'ts': ts} END IGNORE NULLS) OVER f AS buy
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
             f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
m AS (SELECT v.user_id, v.event_id AS view_id, v.ts AS view_ts, v.ts + INTERVAL 2 DAY AS until,
             v.n_type, v.n_id, v.n_ts, c.sign, b.buy
      FROM s v LEFT JOIN s c ON c.event_id = v.n_id LEFT JOIN s b ON b.event_id = c.sign.id WHERE v.event_type = 'view'),
k AS (SELECT *, n_ts < until AS has_click, coalesce(n_ts < until AND sign.ts < until, FALSE) AS has_sign,
             coalesce(n_ts < until AND sign.ts < until AND buy.ts < until, FALSE) AS has_buy
      FROM m WHERE n_type IS NULL OR n_type = 'click' OR n_ts >= until)
SELECT user_id, view_id, view_ts,
       CASE WHEN has_click THEN n_id END AS click_id, CASE WHEN has_click THEN n_ts END AS click_ts,
       CASE WHEN has_sign THEN sign.id END AS sign_id, CASE WHEN has_sign THEN sign.ts END AS sign_ts,
       CASE WHEN has_buy THEN buy.id END AS buy_id, CASE WHEN has_buy THEN buy.ts END AS buy_ts, has_buy AS matched
FROM k
""")
def q_c8b(spark, sf):
    """Four stages, strict and relaxed contiguity mixed, and every partial match that ran out of time."""
    stages = [(n, F.expr(c), k) for n, c, k in _MIXED]
    return _sequence(spark, sf, "c8b", "2 days", stages, emit_timeouts=True)


def _sequence(spark, sf, name, within, stages, emit_timeouts=False):
    s = _events(spark, sf, "30 minutes", flush=True, sliced=True, late="30 minutes")
    out = run_to_parquet(S.match_sequence(s, "user_id", "event_id", stages, within, emit_timeouts), name)
    columns = [F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_ts") else F.col(c) for c in out.columns]
    return out.select(*columns) if emit_timeouts else out.select(*columns).drop("matched")


@query("J3s_switch_gate_stream", _ORACLES["J3_switch_gate"])
def q_j3s(spark, sf):
    """The gate's clock is the event time, so the replay is exact; it runs on the processing clock alike."""
    kind = F.when(F.col("event_type") == "signup", "switch").otherwise("fact")
    s = _events(spark, sf, "30 minutes", flush=True, sliced=True, late="30 minutes",
                pre=lambda d: d.where(F.col("event_type").isin("signup", "view")).select(
                    "event_id", "user_id", "ts", kind.alias("kind")))
    out = run_to_parquet(S.switch_gate(s, "1 day"), "j3s")
    return out.select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                      F.col("opened_at").cast("timestamp_ntz").alias("opened_at"))


def _late_events(spark, sf, pre=None):
    return _events(spark, sf, "30 minutes", flush=True, sliced=True, late="30 minutes", pre=pre)


@query("W5s_count_window_slide_stream", _ORACLES["W5b_count_window_slide"])
def q_w5s(spark, sf):
    """Sliding count windows over five micro-batches with late rows."""
    out = run_to_parquet(S.count_window(_late_events(spark, sf), "user_id", "value", 10, 2), "w5s")
    return out.withColumn("sum", F.round("sum", 4))


@query("W8b_fire_and_purge", """
WITH r AS (SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start, value,
             (row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL 1 DAY, ts) ORDER BY ts, event_id) - 1) // 7 AS g
           FROM events)
SELECT event_type, window_start, g + 1 AS firing, count(*) AS count, round(sum(value), 4) AS sum FROM r GROUP BY ALL
""")
def q_w8b(spark, sf):
    """Every seventh row of a (type, day) fires and purges; the end of the day fires the rest."""
    out = run_to_parquet(S.triggered_window(_late_events(spark, sf), "event_type", "value", "1 day",
                                            P.CountTrigger(7, purge=True)), "w8b")
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "firing", "count",
                      F.round("sum", 4).alias("sum"))


@query("W8c_fire_without_purge", """
WITH r AS (SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start, value,
             row_number() OVER w AS rn, count(*) OVER (PARTITION BY event_type, time_bucket(INTERVAL 1 DAY, ts)) AS n,
             sum(value) OVER (w ROWS UNBOUNDED PRECEDING) AS s
           FROM events WINDOW w AS (PARTITION BY event_type, time_bucket(INTERVAL 1 DAY, ts) ORDER BY ts, event_id))
SELECT event_type, window_start, (rn + 6) // 7 AS firing, rn AS count, round(s, 4) AS sum FROM r WHERE rn % 7 = 0 OR rn = n
""")
def q_w8c(spark, sf):
    """The same trigger without purging: every firing is the window so far."""
    out = run_to_parquet(S.triggered_window(_late_events(spark, sf), "event_type", "value", "1 day",
                                            P.CountTrigger(7, purge=False)), "w8c")
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "firing", "count",
                      F.round("sum", 4).alias("sum"))


def _two_sides(spark, sf, pairs, names):
    e = _late_events(spark, sf, lambda d: d.where(F.col("event_type").isin("click", "view")).select(
        "user_id", "ts", F.col("event_id").alias("ident"), "event_type"))
    sides = [e.where(F.when(F.col("event_type") == t, F.col("ts")).isNotNull()) for t in ("click", "view")]
    out = run_to_parquet(S.window_sides(*sides, "user_id", "1 day", pairs, names), "j56s")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("J5s_window_join_stream", _ORACLES["J5_window_join"])
def q_j5s(spark, sf):
    """Clicks with the views of the same user and day, over five micro-batches."""
    return _two_sides(spark, sf, True, ("click_id", "view_id"))


@query("J6s_cogroup_stream", _ORACLES["J6_cogroup"])
def q_j6s(spark, sf):
    """Both sides of a (user, day), either may be empty."""
    out = _two_sides(spark, sf, False, ("clicks", "views"))
    return out.select("user_id", "window_start", *[F.size(c).cast("long").alias(c) for c in ("clicks", "views")])


# --- the same jobs over several rate-limited micro-batches -------------------

for _name, _job in (("T3", q_t3), ("D1s", q_d1s), ("D5s", q_d5s), ("D8s", q_d8s), ("D9s", q_d9s), ("D9b", q_d9b),
                    ("D10s", q_d10s), ("D11s", q_d11s), ("D12s", q_d12s), ("D13s", q_d13s), ("D15s", q_d15s),
                    ("D16s", q_d16s), ("D21s", q_d21s), ("D22s", q_d22s)):
    _full = next(n for n in _ORACLES if n.startswith(f"{_name}_"))
    query(f"{_full}_sliced", _ORACLES[_full])(
        lambda spark, sf, job=_job: job(spark, sf, sliced=True))
