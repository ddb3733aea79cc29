"""Traffic jobs: hot items (D1), hot URLs (D2), page views (D3), unique visitors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import bitmap_slot
from tidemark.operators.ranking import ranked
from tidemark.operators.windows import sliding, sliding_distinct, top_n, tumbling
from tidemark.plans.registry import query
from tidemark.plans.tables import ITEM_SQL, behaviors, events
from tidemark.sources.transforms import render_apache_log, parse_apache_log


# --- library form ----------------------------------------------------------


def hot_items(df: DataFrame, ts: str = "ts", item: str = "item_id", size: str = "1 hour",
              slide: str = "5 minutes", n: int = 3) -> DataFrame:
    """Views per item per sliding window, top ``n`` per window end.

    Ties (equal counts) go to the smaller item id.
    """
    counts = sliding(df, ts, size, slide, keys=[item])
    top = top_n(counts, ["window_end"], [F.col("count").desc(), F.col(item).asc()], n)
    return top.select("window_end", item, "count", "rank")


def hot_urls(logs: DataFrame, ts: str = "event_time", size: str = "10 minutes",
             slide: str = "5 seconds", n: int = 5) -> DataFrame:
    """Hits per URL per sliding window, top ``n`` per window end."""
    counts = sliding(logs, ts, size, slide, keys=["url"])
    top = top_n(counts, ["window_end"], [F.col("count").desc(), F.col("url").asc()], n)
    return top.select("window_end", "url", "count", "rank")


def page_views(df: DataFrame, ts: str = "ts", size: str = "1 hour") -> DataFrame:
    """D3: page views per tumbling window."""
    return tumbling(df, ts, size, aggs=[F.count(F.lit(1)).alias("pv")])


def unique_visitors(df: DataFrame, ts: str = "ts", user: str = "user_id", size: str = "1 hour") -> DataFrame:
    """D4 exact: distinct users per tumbling window (two-stage distinct, no single task)."""
    return tumbling(df, ts, size, aggs=[F.count_distinct(user).alias("uv")])


def unique_visitors_bitmap(df: DataFrame, ts: str = "ts", user: str = "user_id",
                           size: str = "1 hour", bits: int = 29, seed: int = 61) -> DataFrame:
    """D4 bitmap: users hashed to one of 2^bits slots; the count of set slots.

    Slots are grouped into Spark bitmap buckets (32768 bits each); each
    (window, bucket) bitmap is built with partial aggregation and only the
    per-bucket counts are summed, so no task ever holds the whole 2^29-bit set.
    """
    s = df.withColumn("__slot", bitmap_slot(F.col(user).cast("string"), bits, seed))
    per_bucket = s.groupBy(F.window(ts, size).alias("w"), F.bitmap_bucket_number("__slot").alias("b")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("__slot"))).alias("n")
    )
    out = per_bucket.groupBy("w").agg(F.sum("n").cast("long").alias("uv"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv")


# --- registered queries on the driver tables -------------------------------

_PANE_SQL = """
WITH pv AS (SELECT {key} AS {name}, epoch_us(ts) AS us FROM {src} WHERE {where}),
panes AS (SELECT {name}, us // {slide} AS pane, count(*) AS c FROM pv GROUP BY ALL),
win AS (SELECT {name}, pane + j AS last, sum(c) AS cnt FROM panes, range({k}) t(j) GROUP BY ALL),
ranked AS (
  SELECT make_timestamp((last + 1) * {slide}) AS window_end, {name}, CAST(cnt AS BIGINT) AS count,
         row_number() OVER (PARTITION BY last ORDER BY cnt DESC, {name}) AS rank
  FROM win)
SELECT window_end, {name}, count, rank FROM ranked WHERE rank <= {n}
"""


@query("D1_hot_items", _PANE_SQL.format(key=ITEM_SQL, name="item_id", src="events",
                                         where="event_type = 'view'", slide=300_000_000, k=12, n=3))
def q_d1(spark, sf):
    pv = behaviors(spark, sf).where(F.col("behavior") == "view")
    return hot_items(pv, "ts", "item_id", "1 hour", "5 minutes", 3)


_URL_SQL = f"'/' || event_type || '/' || CAST({ITEM_SQL} % 10 AS VARCHAR)"


@query("D2_hot_urls", _PANE_SQL.format(key=_URL_SQL, name="url", src="events", where="TRUE",
                                        slide=3_600_000_000, k=6, n=5).replace(
    "epoch_us(ts)", "epoch_us(date_trunc('second', ts))"))
def q_d2(spark, sf):
    logs = parse_apache_log(render_apache_log(events(spark, sf)))
    return hot_urls(logs, "event_time", "6 hours", "1 hour", 5)


@query("D3_page_views", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS pv
FROM events WHERE event_type = 'view' GROUP BY 1, 2
""")
def q_d3(spark, sf):
    return page_views(events(spark, sf).where(F.col("event_type") == "view"), "ts", "1 hour")


@query("D4_unique_visitors", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1, 2
""")
def q_d4(spark, sf):
    return unique_visitors(events(spark, sf).where(F.col("event_type") == "view"), "ts", "user_id", "1 hour")


_SLOT_SQL = ("list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda ch: ascii(ch)), "
             "lambda a, c: (a * 61 + c) % 536870912)")


@query("D4b_uv_bitmap", f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT {_SLOT_SQL}) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1, 2
""")
def q_d4b(spark, sf):
    return unique_visitors_bitmap(events(spark, sf).where(F.col("event_type") == "view"))


@query("A12_bitmap_distinct_day", f"""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       count(DISTINCT {_SLOT_SQL}) AS uv
FROM events GROUP BY 1, 2
""")
def q_a12(spark, sf):
    return unique_visitors_bitmap(events(spark, sf), size="1 day")


@query("D4c_uv_sliding", """
WITH v AS (SELECT DISTINCT user_id, epoch_us(ts) // 300000000 AS pane FROM events WHERE event_type = 'view'),
w AS (SELECT pane + j AS last, user_id FROM v, range(12) t(j))
SELECT make_timestamp((last + 1) * 300000000 - 3600000000) AS window_start,
       make_timestamp((last + 1) * 300000000) AS window_end,
       count(DISTINCT user_id) AS distinct_count
FROM w GROUP BY last
""")
def q_d4c(spark, sf):
    return sliding_distinct(events(spark, sf).where(F.col("event_type") == "view"),
                            "ts", "1 hour", "5 minutes", "user_id")


@query("A10_item_window_counts", """
WITH pv AS (SELECT %s AS item_id, epoch_us(ts) // 300000000 AS pane FROM events WHERE event_type = 'view'),
panes AS (SELECT item_id, pane, count(*) AS c FROM pv GROUP BY ALL),
win AS (SELECT item_id, pane + j AS last, sum(c) AS cnt FROM panes, range(12) t(j) GROUP BY ALL)
SELECT make_timestamp((last + 1) * 300000000) AS window_end, item_id, CAST(cnt AS BIGINT) AS count FROM win
""" % ITEM_SQL)
def q_a10(spark, sf):
    pv = behaviors(spark, sf).where(F.col("behavior") == "view")
    return sliding(pv, "ts", "1 hour", "5 minutes", keys=["item_id"]).select("window_end", "item_id", "count")


@query("A11_distinct_per_window", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       count(DISTINCT user_id) AS uv
FROM events GROUP BY 1, 2
""")
def q_a11(spark, sf):
    return unique_visitors(events(spark, sf), "ts", "user_id", "1 day")


@query("W6_window_all", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS count
FROM events GROUP BY 1, 2
""")
def q_w6(spark, sf):
    return tumbling(events(spark, sf), "ts", "1 hour")


@query("W14_rank", """
WITH t AS (SELECT event_type, user_id, round(sum(value), 4) AS total FROM events GROUP BY ALL)
SELECT event_type, user_id, total,
       rank() OVER (PARTITION BY event_type ORDER BY total DESC) AS rnk,
       row_number() OVER (PARTITION BY event_type ORDER BY total DESC, user_id) AS row_num
FROM t
""")
def q_w14(spark, sf):
    t = events(spark, sf).groupBy("event_type", "user_id").agg(F.round(F.sum("value"), 4).alias("total"))
    return ranked(t, ["event_type"], "total", ["user_id"]).select("event_type", "user_id", "total", "rnk", "row_num")


@query("W15_topn_per_window", """
WITH t AS (SELECT time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, user_id,
                  round(sum(value), 4) AS total FROM events GROUP BY ALL)
SELECT window_end, user_id, total, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY total DESC, user_id) AS rank FROM t)
WHERE rank <= 3
""")
def q_w15(spark, sf):
    t = tumbling(events(spark, sf), "ts", "1 day", keys=["user_id"],
                 aggs=[F.round(F.sum("value"), 4).alias("total")])
    return top_n(t, ["window_end"], [F.col("total").desc(), F.col("user_id")], 3).select(
        "window_end", "user_id", "total", "rank")


@query("W16_sql_topn", """
WITH t AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
                  time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
                  %s AS item_id, count(*) AS cnt
           FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT window_start, window_end, item_id, cnt, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rn FROM t)
WHERE rn <= 5
""" % ITEM_SQL)
def q_w16(spark, sf):
    behaviors(spark, sf).createOrReplaceTempView("user_behavior")
    return spark.sql("""
        SELECT window_start, window_end, item_id, cnt, rn FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS BIGINT) AS rn
          FROM (SELECT window.start AS window_start, window.end AS window_end, item_id, count(*) AS cnt
                FROM user_behavior WHERE behavior = 'view'
                GROUP BY window(ts, '1 day'), item_id))
        WHERE rn <= 5
    """)


@query("W17_sort_take", """
SELECT %s AS item_id, count(*) AS views FROM events WHERE event_type = 'view'
GROUP BY 1 ORDER BY views DESC, item_id LIMIT 10
""" % ITEM_SQL)
def q_w17(spark, sf):
    pv = behaviors(spark, sf).where(F.col("behavior") == "view")
    return (pv.groupBy("item_id").agg(F.count(F.lit(1)).alias("views"))
            .orderBy(F.col("views").desc(), "item_id").limit(10))
