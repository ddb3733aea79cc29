"""Record types of the behaviour-analytics jobs, as explicit Spark schemas."""

from pyspark.sql import types as T

SensorReading = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.LongType()),       # epoch seconds
    T.StructField("temperature", T.DoubleType()),
])

UserBehavior = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),      # pv, buy, cart, fav
    T.StructField("timestamp", T.LongType()),       # epoch seconds
])

ApacheLogEvent = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])

MarketingUserBehavior = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("behavior", T.StringType()),      # CLICK, DOWNLOAD, INSTALL, UNINSTALL
    T.StructField("channel", T.StringType()),
    T.StructField("timestamp", T.LongType()),       # epoch milliseconds
])

AdClickEvent = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("timestamp", T.LongType()),       # epoch seconds
])

LoginEvent = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()),    # fail, success
    T.StructField("event_time", T.LongType()),      # epoch seconds
])

OrderEvent = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("event_type", T.StringType()),    # create, pay
    T.StructField("tx_id", T.StringType()),         # empty on create
    T.StructField("event_time", T.LongType()),      # epoch seconds
])

ReceiptEvent = T.StructType([
    T.StructField("tx_id", T.StringType()),
    T.StructField("pay_channel", T.StringType()),
    T.StructField("event_time", T.LongType()),      # epoch seconds
])

Events = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
