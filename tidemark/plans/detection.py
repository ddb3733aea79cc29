"""Detection jobs: login failures (D9, D10) and order payment time-outs.

Batch forms run in event-time order with a unique tie-break; the per-key
order comes from the chunked scans in tidemark.operators.sequence, so a user
with a third of all events does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import interval
from tidemark.operators import cep
from tidemark.operators.scan import greedy_windows
from tidemark.operators.sequence import DEFAULT_CHUNK, neighbours, plan_chunks, running
from tidemark.plans.registry import query
from tidemark.plans.tables import events
from tidemark.sources.files import read_table

# --- library form ----------------------------------------------------------


def login_fail_state(logins: DataFrame, gap: str = "2 seconds", key: str = "user_id", ts: str = "ts",
                     order=("ts",), fail: str = "fail") -> DataFrame:
    """Keyed-state detector.  A fail that follows a fail of the same user
    (no success in between) less than ``gap`` later raises a warning.

    The stored fail is always the user's previous event when that event is a
    fail (a success clears it), so the state machine is a ``lag`` by one row.
    """
    n = neighbours(logins, [key], list(order), ["event_type", ts], prev=True)
    hit = ((F.col("event_type") == fail) & (F.col("prev_event_type") == fail)
           & (F.col(ts) < F.col(f"prev_{ts}") + interval(gap)))
    return n.where(hit).select(
        key, F.col(f"prev_{ts}").alias("first_fail_time"), F.col(ts).alias("last_fail_time"),
        F.lit(f"login fail in {gap}.").alias("warning_msg"))


def login_fail_timer(logins: DataFrame, window: str = "5 seconds", min_fails: int = 2, key: str = "user_id",
                     ts: str = "ts", order=("ts",), fail: str = "fail", chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """Fails are collected from a first one on for ``window``; a success in that time
    clears them; otherwise ``min_fails`` or more give one warning.  The stream's result.

    First fails are the anchors of greedy windows with successes as resets.
    """
    order = list(order)
    chunks = plan_chunks(logins, [key], ts, chunk)
    failed = F.col("event_type") == fail
    a = greedy_windows(logins.select(key, *order, "event_type"), [key], order, failed, ~failed, window, "__first", chunks)
    a = running(a, [key], order, {"__end": ("last", F.when(~failed, F.col(ts)))}, reverse=True,
                include_current=False, chunk=chunks)
    opened = F.struct(*[F.col(c) for c in order], "__end")
    a = running(a, [key], order, {"__open": ("last", F.when(F.col("__first"), opened))}, chunk=chunks)
    out = a.where(failed).groupBy(key, "__open").agg(F.min(ts).alias("first_fail_time"), F.max(ts).alias("last_fail_time"),
                                                     F.count(F.lit(1)).alias("fails"))

    def ms(c: str):
        return F.date_trunc("millisecond", F.col(c))

    kept = F.col("__open.__end").isNull() | (ms("__open.__end") > ms(f"__open.{ts}") + interval(window))
    return out.where((F.col("fails") >= min_fails) & kept).drop("__open")


def login_fail_pattern(logins: DataFrame, within: str = "3 seconds", key: str = "user_id", ts: str = "ts",
                       order=("ts",), fail: str = "fail") -> DataFrame:
    """Pattern ``begin(fail).next(fail).within(d)``; matches may overlap."""
    first = F.col("event_type") == fail
    second = F.col("event_type") == fail
    m = cep.next_pattern(logins, key, list(order), first, second, within, [ts])
    return m.select(key, F.col(f"first_{ts}").alias("first_fail_time"),
                    F.col(f"second_{ts}").alias("second_fail_time"))


def order_timeout_pattern(orders: DataFrame, within: str = "15 minutes", key: str = "order_id",
                          ts: str = "ts", order=("ts",), create: str = "create", pay: str = "pay",
                          payload=("event_id",)) -> DataFrame:
    """``begin(create).followedBy(pay).within(d)`` with a timeout output.

    Every create is matched with the first later pay of its key; when that pay
    is missing or not earlier than ``create + d`` the create times out.
    """
    m = cep.followed_by(orders, key, list(order), F.col("event_type") == create,
                        F.col("event_type") == pay, within, [ts, *payload])
    return m.select(
        key, F.col(f"first_{ts}").alias("create_time"),
        *[F.col(f"first_{p}").alias(f"create_{p}") for p in payload],
        F.when(F.col("matched"), F.col(f"second_{ts}")).alias("pay_time"),
        F.when(F.col("matched"), F.lit("payed successfully")).otherwise(F.lit("timeout")).alias("result"),
    )


def order_pay_state(creates: DataFrame, pays: DataFrame, timeout: str = "15 minutes",
                    key: str = "order_id") -> DataFrame:
    """Keyed-state order check, event-time rule.  ``creates`` and ``pays``
    carry (key, ts); the first of each per key is used.

    * pay before create ............................ payed
    * create <= pay < create + timeout ............. payed successfully
    * pay >= create + timeout ...................... payed but already timeout
    * pay without create ........................... already payed but not found create log
    * create without pay ........................... order timeout
    """
    c = creates.groupBy(key).agg(F.min("ts").alias("create_time"))
    p = pays.groupBy(key).agg(F.min("ts").alias("pay_time"))
    j = c.join(p, on=key, how="full")
    ct, pt = F.col("create_time"), F.col("pay_time")
    msg = (F.when(ct.isNull(), "already payed but not found create log")
           .when(pt.isNull(), "order timeout")
           .when(pt < ct, "payed")
           .when(pt < ct + interval(timeout), "payed successfully")
           .otherwise("payed but already timeout"))
    return j.select(key, "create_time", "pay_time", msg.alias("result_msg"))


# --- driver-table mapping --------------------------------------------------


def login_events(spark, sf):
    """error = failed login, anything else = success."""
    return events(spark, sf).select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type"))


def order_events(spark, sf):
    """signup = order created, purchase = order paid, keyed by user."""
    e = events(spark, sf).where(F.col("event_type").isin("signup", "purchase"))
    return e.select("event_id", "ts", "user_id",
                    F.when(F.col("event_type") == "signup", "create").otherwise("pay").alias("event_type"))


_LOGIN_SQL = """
WITH l AS (SELECT event_id, ts, user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type
           FROM events)
"""


@query("D9_login_fail_state", _LOGIN_SQL + """,
s AS (SELECT *, lag(event_type) OVER w AS prev_type, lag(ts) OVER w AS prev_ts
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, prev_ts AS first_fail_time, ts AS last_fail_time, 'login fail in 2 hours.' AS warning_msg
FROM s WHERE event_type = 'fail' AND prev_type = 'fail' AND ts < prev_ts + INTERVAL 2 HOUR
""")
def q_d9(spark, sf):
    return login_fail_state(login_events(spark, sf), "2 hours", order=("ts", "event_id"))


@query("D10_login_fail_cep", _LOGIN_SQL + """,
s AS (SELECT *, lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts AS first_fail_time, next_ts AS second_fail_time
FROM s WHERE event_type = 'fail' AND next_type = 'fail' AND next_ts - ts < INTERVAL 3 HOUR
""")
def q_d10(spark, sf):
    return login_fail_pattern(login_events(spark, sf), "3 hours", order=("ts", "event_id"))


@query("D11_order_timeout_cep", """
WITH o AS (SELECT event_id, ts, user_id, event_type FROM events WHERE event_type IN ('signup', 'purchase')),
s AS (SELECT *, first_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS) OVER (
          PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_ts
      FROM o)
SELECT user_id, ts AS create_time, event_id AS create_event_id,
       CASE WHEN pay_ts - ts < INTERVAL 6 HOUR THEN pay_ts END AS pay_time,
       CASE WHEN pay_ts - ts < INTERVAL 6 HOUR THEN 'payed successfully' ELSE 'timeout' END AS result
FROM s WHERE event_type = 'signup'
""")
def q_d11(spark, sf):
    return order_timeout_pattern(order_events(spark, sf), "6 hours", key="user_id", order=("ts", "event_id"))


@query("D12_order_pay_state", """
WITH c AS (SELECT o_orderkey AS order_id, min(o_orderdate) AS create_time FROM orders GROUP BY 1),
p AS (SELECT l_orderkey AS order_id, min(l_shipdate) AS pay_time FROM lineitem GROUP BY 1)
SELECT coalesce(c.order_id, p.order_id) AS order_id, create_time, pay_time,
       CASE WHEN create_time IS NULL THEN 'already payed but not found create log'
            WHEN pay_time IS NULL THEN 'order timeout'
            WHEN pay_time < create_time THEN 'payed'
            WHEN pay_time < create_time + INTERVAL 365 DAY THEN 'payed successfully'
            ELSE 'payed but already timeout' END AS result_msg
FROM c FULL OUTER JOIN p ON c.order_id = p.order_id
""")
def q_d12(spark, sf):
    creates = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                                     F.col("o_orderdate").alias("ts"))
    pays = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"),
                                                    F.col("l_shipdate").alias("ts"))
    return order_pay_state(creates, pays, "365 days", key="order_id")
