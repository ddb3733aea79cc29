"""Marketing jobs: app marketing by channel (D5), total (D6), ad clicks by
province (D7) after the click-fraud filter (D8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequence import DEFAULT_CHUNK, sequence_number
from tidemark.operators.windows import sliding
from tidemark.plans.registry import query
from tidemark.plans.tables import ITEM_SQL, events, item_col

N_CHANNELS = 4


def _channel_of(k: Column) -> Column:
    """The channel an item is marketed through: its number modulo the channels."""
    return F.concat(F.lit("channel_"), (k % N_CHANNELS).cast("string"))


_CHANNEL_SQL = f"'channel_' || CAST({ITEM_SQL} % {N_CHANNELS} AS VARCHAR)"

# --- library form ----------------------------------------------------------


def marketing_by_channel(df: DataFrame, ts: str = "ts", size: str = "1 hour", slide: str = "10 seconds",
                         excluded: str = "UNINSTALL") -> DataFrame:
    """Count per (channel, behavior) per sliding window, ``excluded`` behaviour dropped."""
    kept = df.where(F.col("behavior") != excluded)
    return sliding(kept, ts, size, slide, keys=["channel", "behavior"]).select(
        "window_start", "window_end", "channel", "behavior", "count")


def marketing_total(df: DataFrame, ts: str = "ts", size: str = "1 hour", slide: str = "10 seconds",
                    excluded: str = "UNINSTALL") -> DataFrame:
    """The same count over all channels and behaviours."""
    kept = df.where(F.col("behavior") != excluded)
    out = sliding(kept, ts, size, slide)
    return out.select("window_start", "window_end", F.lit("app marketing").alias("channel"),
                      F.lit("total").alias("behavior"), "count")


def click_fraud_filter(clicks: DataFrame, max_clicks: int = 100, ts: str = "ts",
                       keys=("user_id", "ad_id"), order=("ts",), chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """Per (user, ad, day) the first ``max_clicks`` clicks pass; the click
    after them raises one warning; later clicks are dropped silently.

    The day is the UTC day of the event time (the reference resets its
    counters at processing-time midnight; event time keeps replays exact).
    Returns all clicks with ``n`` (position in the day) and ``status`` in
    {pass, warn, drop}; the position is the chunked per-key sequence number,
    so one user hammering one ad is spread over many tasks.
    """
    d = clicks.withColumn("day", F.to_date(ts))
    seq = sequence_number(d, list(keys) + ["day"], list(order), name="n", chunk=chunk)
    status = (F.when(F.col("n") <= max_clicks, "pass")
              .when(F.col("n") == max_clicks + 1, "warn").otherwise("drop"))
    return seq.withColumn("status", status)


def blacklist_warnings(filtered: DataFrame, max_clicks: int = 100) -> DataFrame:
    """D8 side output: one warning per (user, ad, day) over the limit."""
    return filtered.where(F.col("status") == "warn").select(
        "user_id", "ad_id", "day", F.lit(f"Click over {max_clicks} times today.").alias("msg"))


def ad_clicks_by_province(passed: DataFrame, ts: str = "ts", size: str = "1 hour",
                          slide: str = "5 seconds") -> DataFrame:
    """Clicks per province per sliding window."""
    return sliding(passed, ts, size, slide, keys=["province"]).select(
        "window_start", "window_end", "province", "count")


# --- driver-table mapping --------------------------------------------------


def marketing_events(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", "ts", "user_id", F.upper("event_type").alias("behavior"),
                    _channel_of(item_col()).alias("channel"))


def ad_clicks(spark, sf):
    e = events(spark, sf).where(F.col("event_type") == "click")
    return e.select("event_id", "ts", "user_id", (item_col() % 3).alias("ad_id"),
                    F.concat(F.lit("province_"), (item_col() % 10).cast("string")).alias("province"))


_MKT_PANES = f"""
WITH m AS (SELECT upper(event_type) AS behavior, {_CHANNEL_SQL} AS channel, epoch_us(ts) // 600000000 AS pane
           FROM events WHERE upper(event_type) <> 'ERROR'),
p AS (SELECT {{keys}} pane, count(*) AS c FROM m GROUP BY ALL),
w AS (SELECT {{keys}} pane + j AS last, sum(c) AS c FROM p, range(6) t(j) GROUP BY ALL)
SELECT make_timestamp((last + 1) * 600000000 - 3600000000) AS window_start,
       make_timestamp((last + 1) * 600000000) AS window_end, {{out}} CAST(c AS BIGINT) AS count FROM w
"""


@query("D5_marketing_by_channel", _MKT_PANES.format(keys="channel, behavior,", out="channel, behavior,"))
def q_d5(spark, sf):
    return marketing_by_channel(marketing_events(spark, sf), "ts", "1 hour", "10 minutes", excluded="ERROR")


@query("D6_marketing_total", _MKT_PANES.format(
    keys="", out="'app marketing' AS channel, 'total' AS behavior,"))
def q_d6(spark, sf):
    return marketing_total(marketing_events(spark, sf), "ts", "1 hour", "10 minutes", excluded="ERROR")


_CLICKS_SQL = f"""
WITH c AS (SELECT event_id, ts, user_id, {ITEM_SQL} % 3 AS ad_id, 'province_' || CAST({ITEM_SQL} % 10 AS VARCHAR) AS province,
                  CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click'),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, day ORDER BY ts, event_id) AS n FROM c)
"""


@query("D8_click_filter", _CLICKS_SQL + "SELECT event_id, user_id, ad_id, day, n FROM n WHERE n <= 1")
def q_d8(spark, sf):
    f = click_fraud_filter(ad_clicks(spark, sf), 1, order=("ts", "event_id"))
    return f.where(F.col("status") == "pass").select("event_id", "user_id", "ad_id", "day", "n")


@query("D8b_blacklist", _CLICKS_SQL + """
SELECT user_id, ad_id, day, 'Click over 1 times today.' AS msg FROM n WHERE n = 2
""")
def q_d8b(spark, sf):
    f = click_fraud_filter(ad_clicks(spark, sf), 1, order=("ts", "event_id"))
    return blacklist_warnings(f, 1)


@query("D7_ad_by_province", _CLICKS_SQL + """,
p AS (SELECT province, epoch_us(ts) // 300000000 AS pane, count(*) AS c FROM n WHERE n <= 1 GROUP BY ALL),
w AS (SELECT province, pane + j AS last, sum(c) AS c FROM p, range(12) t(j) GROUP BY ALL)
SELECT make_timestamp((last + 1) * 300000000 - 3600000000) AS window_start,
       make_timestamp((last + 1) * 300000000) AS window_end, province, CAST(c AS BIGINT) AS count FROM w
""")
def q_d7(spark, sf):
    f = click_fraud_filter(ad_clicks(spark, sf), 1, order=("ts", "event_id"))
    return ad_clicks_by_province(f.where(F.col("status") == "pass"), "ts", "1 hour", "5 minutes")
