"""Line parsers for the reference's text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import epoch_us

APACHE_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def parse_apache_log(df: DataFrame, col: str = "value", user_field: int = 1) -> DataFrame:
    """Blank-separated access-log line -> ip, user_id, event_time, method, url.

    Fields 0, ``user_field`` (1 in the code, 2 in the tutorial), 3, 5 and 6;
    the time is ``dd/MM/yyyy:HH:mm:ss``.
    """
    p = F.split(F.col(col), " ")
    return df.select(
        p.getItem(0).alias("ip"),
        p.getItem(user_field).alias("user_id"),
        F.to_timestamp_ntz(p.getItem(3), F.lit(APACHE_TIME_FORMAT)).alias("event_time"),
        p.getItem(5).alias("method"),
        p.getItem(6).alias("url"),
    )


def render_apache_log(events: DataFrame) -> DataFrame:
    """Access-log lines derived from the events table (one per event).

    ip from user and item, method GET for views else POST, url
    ``/<event_type>/<k mod 10>``.
    """
    k = F.get_json_object("props", "$.k").cast("long")
    line = F.concat_ws(
        " ",
        F.concat_ws(".", F.lit("10"), (F.col("user_id") % 256).cast("string"), (k % 256).cast("string"), F.lit("1")),
        F.col("user_id").cast("string"),
        F.lit("-"),
        F.date_format("ts", APACHE_TIME_FORMAT),
        F.lit("+0000"),
        F.when(F.col("event_type") == "view", "GET").otherwise("POST"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), (k % 10).cast("string")),
    )
    return events.select(line.alias("value"))


def render_user_behavior_csv(events: DataFrame) -> DataFrame:
    """UserBehavior CSV lines (user, item, category, behavior, epoch seconds) from events."""
    k = F.get_json_object("props", "$.k").cast("long")
    secs = F.floor(epoch_us(events, "ts") / 1_000_000)
    line = F.concat_ws(
        ", ",
        F.col("user_id").cast("string"), k.cast("string"), (k % 10).cast("string"),
        F.col("event_type"), secs.cast("string"),
    )
    return events.select(line.alias("value"))
