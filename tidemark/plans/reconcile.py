"""Two-input jobs: reconciliation (D13, D14), click/browse join (D20), dynamic
thresholds (D21) and the join operators J1, J3-J7, J9."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import interval
from tidemark.operators.joins import asof_latest, connect, interval_join, window_join
from tidemark.operators.sequence import neighbours, plan_chunks
from tidemark.operators.windows import tumbling
from tidemark.plans.registry import query
from tidemark.plans.tables import events
from tidemark.sources.files import read_table

# --- library form ----------------------------------------------------------


def reconcile(pays: DataFrame, receipts: DataFrame, bound: str = "5 seconds") -> DataFrame:
    """Pays (tx_id, pay_time) against receipts (tx_id, receipt_time).

    Each side waits ``bound`` for the other (event time, both ends closed):
    tag ``matched`` for pairs, ``unmatched_pay`` / ``unmatched_receipt`` for
    rows without a partner (per row, i.e. a full outer interval join; with
    unique tx ids per side, as in the reference, that is one-to-one).
    """
    p = pays.select(F.col("tx_id").alias("pay_tx"), "pay_time", F.col("tx_id"))
    r = receipts.select(F.col("tx_id").alias("receipt_tx"), "receipt_time", F.col("tx_id"))
    j = interval_join(p, r, ["tx_id"], "pay_time", "receipt_time", f"-{bound}" if not bound.startswith("-")
                      else bound, bound, how="full", left_id="pay_tx", right_id="receipt_tx")
    tag = (F.when(F.col("pay_tx").isNotNull() & F.col("receipt_tx").isNotNull(), "matched")
           .when(F.col("pay_tx").isNotNull(), "unmatched_pay").otherwise("unmatched_receipt"))
    return j.select(F.coalesce("pay_tx", "receipt_tx").alias("tx_id"), "pay_time", "receipt_time", tag.alias("tag"))


def reconcile_join(pays: DataFrame, receipts: DataFrame, bound: str = "5 seconds") -> DataFrame:
    """The interval-join form, matched pairs only."""
    return interval_join(pays, receipts.withColumnRenamed("tx_id", "tx_id"), ["tx_id"], "pay_time",
                         "receipt_time", f"-{bound}", bound).select("tx_id", "pay_time", "receipt_time")


def dynamic_threshold_alerts(readings: DataFrame, rules: DataFrame, key: str = "sensor_id",
                             order=("ts",)) -> DataFrame:
    """|temp - previous temp| > the sensor's latest threshold.

    ``rules`` (key, ts, threshold): a threshold of 0.0 deletes the rule.  The
    previous temperature starts at 0.0, as in the reference's value state.
    Both per-key scans are chunked; rules are joined as-of, not broadcast,
    since the rule stream grows with the data.
    """
    order = list(order)
    # one decision for both scans: the keys that are hot in either input
    chunks = plan_chunks(readings.select(key, order[0]).unionByName(rules.select(key, order[0])), [key], order[0])
    r = neighbours(readings, [key], order, ["temperature"], prev=True, chunk=chunks)
    r = r.withColumn("last_temp", F.coalesce(F.col("prev_temperature"), F.lit(0.0))).drop("prev_temperature")
    a = asof_latest(r, rules, [key], order[0], order, ["threshold"], chunk=chunks)
    diff = F.abs(F.col("temperature") - F.col("last_temp"))
    hit = F.col("threshold").isNotNull() & (F.col("threshold") != 0.0) & (diff > F.col("threshold"))
    return a.where(hit).withColumn("temp_diff", diff)


def switch_gate(facts: DataFrame, switches: DataFrame, key: str, order=("ts",), duration: str = "10 seconds"
                ) -> DataFrame:
    """Forward a fact while its key's latest switch-on is less than ``duration`` old."""
    ts = order[0]
    s = switches.select(key, *order).withColumn("opened_at", F.col(ts))
    a = asof_latest(facts, s, [key], ts, list(order), ["opened_at"])
    return a.where(F.col("opened_at").isNotNull() & (F.col(ts) < F.col("opened_at") + interval(duration)))


# --- driver-table mapping --------------------------------------------------


def _pays_receipts(spark, sf):
    pays = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("tx_id"),
                                                 F.col("o_orderdate").alias("pay_time"))
    receipts = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").alias("receipt_time"))
    return pays, receipts


_TX_SQL = """
WITH p AS (SELECT o_orderkey AS tx_id, o_orderdate AS pay_time FROM orders),
r AS (SELECT l_orderkey AS tx_id, l_shipdate AS receipt_time FROM lineitem),
m AS (SELECT p.tx_id, pay_time, receipt_time FROM p JOIN r ON p.tx_id = r.tx_id
      AND receipt_time BETWEEN pay_time - INTERVAL 30 DAY AND pay_time + INTERVAL 30 DAY)
"""


@query("D13_tx_reconcile", """
WITH p AS (SELECT o_orderkey AS tx_id, o_orderdate AS pay_time FROM orders),
r AS (SELECT l_orderkey AS tx_id, l_shipdate AS receipt_time FROM lineitem)
SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, pay_time, receipt_time,
       CASE WHEN p.tx_id IS NOT NULL AND r.tx_id IS NOT NULL THEN 'matched'
            WHEN p.tx_id IS NOT NULL THEN 'unmatched_pay' ELSE 'unmatched_receipt' END AS tag
FROM p FULL OUTER JOIN r ON p.tx_id = r.tx_id
 AND receipt_time BETWEEN pay_time - INTERVAL 30 DAY AND pay_time + INTERVAL 30 DAY
""")
def q_d13(spark, sf):
    pays, receipts = _pays_receipts(spark, sf)
    return reconcile(pays, receipts, "30 days")


@query("D14_tx_match_join", _TX_SQL + "SELECT tx_id, pay_time, receipt_time FROM m")
def q_d14(spark, sf):
    pays, receipts = _pays_receipts(spark, sf)
    return reconcile_join(pays, receipts, "30 days")


def _typed(spark, sf, t, prefix):
    return events(spark, sf).where(F.col("event_type") == t).select(
        "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))


@query("D20_click_browse_join", """
SELECT c.user_id, c.event_id AS click_id, v.event_id AS view_id, c.ts AS click_ts, v.ts AS view_ts
FROM events c JOIN events v ON c.user_id = v.user_id
 AND v.ts BETWEEN c.ts - INTERVAL 1 HOUR AND c.ts
WHERE c.event_type = 'click' AND v.event_type = 'view'
""")
def q_d20(spark, sf):
    clicks, views = _typed(spark, sf, "click", "click"), _typed(spark, sf, "view", "view")
    return interval_join(clicks, views, ["user_id"], "click_ts", "view_ts", "-1 hour", 0).select(
        "user_id", "click_id", "view_id", "click_ts", "view_ts")


@query("J4_interval_join", """
SELECT p.user_id, p.event_id AS pay_id, v.event_id AS view_id
FROM events p JOIN events v ON p.user_id = v.user_id
 AND v.ts >= p.ts - INTERVAL 2 HOUR AND v.ts <= p.ts + INTERVAL 1 HOUR
WHERE p.event_type = 'purchase' AND v.event_type = 'view'
""")
def q_j4(spark, sf):
    pays, views = _typed(spark, sf, "purchase", "pay"), _typed(spark, sf, "view", "view")
    return interval_join(pays, views, ["user_id"], "pay_ts", "view_ts", "-2 hours", "1 hour").select(
        "user_id", "pay_id", "view_id")


@query("J4b_interval_left_outer", """
SELECT p.user_id, p.event_id AS pay_id, v.event_id AS view_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') p LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND v.ts > p.ts - INTERVAL 30 MINUTE AND v.ts < p.ts + INTERVAL 30 MINUTE
""")
def q_j4b(spark, sf):
    pays, views = _typed(spark, sf, "purchase", "pay"), _typed(spark, sf, "view", "view")
    return interval_join(pays, views, ["user_id"], "pay_ts", "view_ts", "-30 minutes", "30 minutes", how="left",
                         left_id="pay_id", right_id="view_id", lower_open=True, upper_open=True).select(
        "user_id", "pay_id", "view_id")


@query("J5_window_join", """
SELECT c.user_id, time_bucket(INTERVAL 1 DAY, c.ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, c.ts) + INTERVAL 1 DAY AS window_end,
       c.event_id AS click_id, v.event_id AS view_id
FROM events c JOIN events v ON c.user_id = v.user_id
 AND time_bucket(INTERVAL 1 DAY, c.ts) = time_bucket(INTERVAL 1 DAY, v.ts)
WHERE c.event_type = 'click' AND v.event_type = 'view'
""")
def q_j5(spark, sf):
    clicks, views = _typed(spark, sf, "click", "click"), _typed(spark, sf, "view", "view")
    return window_join(clicks, views, ["user_id"], "click_ts", "view_ts", "1 day").select(
        "user_id", "window_start", "window_end", "click_id", "view_id")


@query("J6_cogroup", """
WITH c AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n
           FROM events WHERE event_type = 'click' GROUP BY ALL),
v AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n
      FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT coalesce(c.user_id, v.user_id) AS user_id, coalesce(c.window_start, v.window_start) AS window_start,
       coalesce(c.n, 0) AS clicks, coalesce(v.n, 0) AS views
FROM c FULL OUTER JOIN v ON c.user_id = v.user_id AND c.window_start = v.window_start
""")
def q_j6(spark, sf):
    e = events(spark, sf)
    c = tumbling(e.where(F.col("event_type") == "click"), "ts", "1 day", ["user_id"],
                 [F.count(F.lit(1)).alias("clicks")]).drop("window_end")
    v = tumbling(e.where(F.col("event_type") == "view"), "ts", "1 day", ["user_id"],
                 [F.count(F.lit(1)).alias("views")]).drop("window_end")
    j = c.join(v, ["user_id", "window_start"], "full")
    return j.select("user_id", "window_start", F.coalesce("clicks", F.lit(0)).alias("clicks"),
                    F.coalesce("views", F.lit(0)).alias("views"))


@query("J1_connect_comap", """
SELECT event_id, user_id, value, 'warning' AS status FROM events WHERE value >= 30
UNION ALL SELECT event_id, user_id, NULL, 'healthy' FROM events WHERE value < 30
""")
def q_j1(spark, sf):
    e = events(spark, sf)
    warn = e.where(F.col("value") >= 30).select("event_id", "user_id", "value", F.lit("warning").alias("status"))
    low = e.where(F.col("value") < 30).select("event_id", "user_id", F.lit("healthy").alias("status"))
    return connect((warn, "warning"), (low, "low")).select("event_id", "user_id", "value", "status")


@query("J9_union", """
SELECT event_id, user_id, event_type FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'
""")
def q_j9(spark, sf):
    e = events(spark, sf).select("event_id", "user_id", "event_type")
    return e.where(F.col("event_type") == "view").unionByName(e.where(F.col("event_type") == "click"))


@query("J3_switch_gate", """
WITH s AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN ts END) OVER (
             PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS opened_at FROM events)
SELECT event_id, user_id, ts, opened_at FROM s
WHERE event_type = 'view' AND opened_at IS NOT NULL AND ts < opened_at + INTERVAL 1 DAY
""")
def q_j3(spark, sf):
    e = events(spark, sf)
    views = e.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    switches = e.where(F.col("event_type") == "signup").select("event_id", "user_id", "ts")
    return switch_gate(views, switches, "user_id", ("ts", "event_id"), "1 day").select(
        "event_id", "user_id", "ts", "opened_at")


@query("D21_dynamic_threshold", """
WITH r AS (SELECT event_id, ts, user_id AS sensor_id, value AS temperature,
                  coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0.0) AS last_temp
           FROM events WHERE event_type <> 'signup'),
u AS (SELECT event_id, ts, sensor_id, temperature, last_temp, NULL::DOUBLE AS thr, TRUE AS is_fact FROM r
      UNION ALL SELECT event_id, ts, user_id, NULL, NULL, value, FALSE FROM events WHERE event_type = 'signup'),
a AS (SELECT *, last_value(thr IGNORE NULLS) OVER (PARTITION BY sensor_id ORDER BY ts, event_id
                                                   ROWS UNBOUNDED PRECEDING) AS threshold FROM u)
SELECT sensor_id, event_id, temperature, threshold, round(abs(temperature - last_temp), 4) AS temp_diff
FROM a WHERE is_fact AND threshold IS NOT NULL AND threshold <> 0 AND abs(temperature - last_temp) > threshold
""")
def q_d21(spark, sf):
    e = events(spark, sf)
    readings = e.where(F.col("event_type") != "signup").select(
        "event_id", "ts", F.col("user_id").alias("sensor_id"), F.col("value").alias("temperature"))
    rules = e.where(F.col("event_type") == "signup").select(
        "event_id", "ts", F.col("user_id").alias("sensor_id"), F.col("value").alias("threshold"))
    out = dynamic_threshold_alerts(readings, rules, "sensor_id", ("ts", "event_id"))
    return out.select("sensor_id", "event_id", "temperature", "threshold", F.round("temp_diff", 4).alias("temp_diff"))
