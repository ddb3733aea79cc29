"""Golden tests on the sample files of samples.py."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import (AD_CLICK_LOG, DATA_TXT, LOGIN_LOG, ORDER_LOG, OUTPUT2, RECEIPT_LOG, SENSOR_TXT,
                      read_sample, ref_file)
from samples import T0, TEXT
from tidemark import schemas
from tidemark.functions.scalar import java_string_hash, scaled_hash
from tidemark.functions.timefns import seconds_to_ts
from tidemark.functions.udfs import AvgTemp, register_functions, top2, user_aggregate
from tidemark.operators import transforms as X
from tidemark.operators.joins import interval_join, lateral_split
from tidemark.operators.sequence import rows_frame, running
from tidemark.operators.windows import tumbling
from tidemark.plans import detection, marketing, reconcile, sensors
from tidemark.sources.files import read_csv, read_text


def utc(sec):
    return dt.datetime.fromtimestamp(sec, dt.UTC).replace(tzinfo=None)


@pytest.fixture(scope="module")
def readings(spark):
    df = read_sample(spark, SENSOR_TXT, schemas.SensorReading)
    return df.select("seq", F.col("id").alias("sensor_id"), seconds_to_ts(F.col("timestamp")).alias("ts"),
                     "temperature")


def test_word_count(spark):
    wc = X.word_count(read_text(spark, ref_file(DATA_TXT)), "value", " ")
    got = {r.word: r["count"] for r in wc.collect()}
    assert got["hello"] == 3 and got["you"] == 3
    assert got == Counter(" ".join(TEXT).split())


def test_filters_and_csv_sink(spark, readings, tmp_path):
    assert X.filter_prefix(readings, "sensor_id", "sensor_1").count() == 6       # sensor_10 too
    readings.createOrReplaceTempView("sensor_fixture")
    s1 = spark.sql("SELECT sensor_id AS id, temperature AS temp FROM sensor_fixture "
                   "WHERE sensor_id = 'sensor_1' ORDER BY seq")
    from tidemark.sinks.writers import write_csv
    write_csv(s1.coalesce(1), str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), T.StructType([
        T.StructField("id", T.StringType()), T.StructField("temp", T.DoubleType())]))
    golden = read_csv(spark, ref_file(OUTPUT2), T.StructType([
        T.StructField("id", T.StringType()), T.StructField("temp", T.DoubleType())]))
    assert sorted(back.collect()) == sorted(golden.collect())
    assert golden.count() == 5


def test_split_select_and_side_output(readings):
    routed = X.split_streams(readings, {"high": F.col("temperature") >= 30, "low": F.col("temperature") < 30})
    counts = {r.stream: r["count"] for r in routed.groupBy("stream").count().collect()}
    assert counts == {"high": 6, "low": 2}
    tagged = X.side_output(readings, F.col("temperature") >= 30, "lowtemp")
    assert tagged.where("tag = 'lowtemp'").count() == 2


def test_count_avg_top2(readings):
    counts = {r.sensor_id: r["count"] for r in readings.groupBy("sensor_id").count().collect()}
    assert counts == {"sensor_1": 5, "sensor_6": 1, "sensor_7": 1, "sensor_10": 1}
    avg = {r.sensor_id: round(r.avg_temp, 4) for r in
           user_aggregate(readings, "sensor_id", "temperature", AvgTemp, "avg_temp").collect()}
    assert avg == {"sensor_1": 35.6, "sensor_6": 12.5, "sensor_7": 8.0, "sensor_10": 41.0}
    t2 = top2(readings, "sensor_id", "temperature", ["seq"]).collect()
    s1 = sorted((r.rank, r.temp) for r in t2 if r.sensor_id == "sensor_1")
    assert s1 == [(1, 40.0), (2, 38.0)]
    assert sum(1 for r in t2 if r.sensor_id != "sensor_1") == 3


def units_hash(s):
    """String.hashCode: h = 31 h + unit over UTF-16 units, as a signed 32-bit number."""
    raw, h = s.encode("utf-16-be"), 0
    for i in range(0, len(raw), 2):
        h = (31 * h + int.from_bytes(raw[i:i + 2], "big")) % 2 ** 32
    return h - 2 ** 32 if h >= 2 ** 31 else h


def test_hash_functions(spark):
    texts = ["sensor_1", "", "a", "a\U0001f600b", "été ünï", "日本語", "x" * 200]
    register_functions(spark, 1.23)
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = {r.s: r for r in df.select("s", java_string_hash(F.col("s")).alias("h"), scaled_hash(F.col("s"), 1.23).alias("f"),
                                     F.expr("hash_code(s)").alias("q")).collect()}
    assert units_hash("sensor_1") == 1262115052 and got["sensor_1"].f == 1552401513
    for t in texts:
        want = max(min(int(units_hash(t) * 1.23), 2 ** 31 - 1), -2 ** 31)
        assert (got[t].h, got[t].f, got[t].q) == (units_hash(t), want, want)
    # factor 10 overflows the int range and is clamped like Double.toInt
    assert df.select(scaled_hash(F.col("s"), 10.0).alias("f")).first().f == 2147483647


def test_table_function(spark, readings):
    assert lateral_split(readings, "sensor_id", "_").count() == 16
    register_functions(spark)
    readings.createOrReplaceTempView("sensor_fixture2")
    n = spark.sql("SELECT s.* FROM sensor_fixture2, LATERAL split_words(sensor_id, '_') s").count()
    assert n == 16


def test_tumble_and_over_rows(readings):
    s1 = readings.where("sensor_id = 'sensor_1'")
    w = tumbling(s1, "ts", "10 seconds")
    ends = sorted((r.window_end, r["count"]) for r in w.collect())
    assert ends == [(utc(T0), 1), (utc(T0 + 10), 3), (utc(T0 + 100), 1)]
    # 2 preceding rows; tiny chunks force every chunk-border path
    for chunk in ("1 hour", "2 seconds"):
        fr = rows_frame(s1, ["sensor_id"], ["ts", "seq"], "temperature", 2, ("avg",), chunk=chunk)
        got = [round(r.avg, 4) for r in fr.orderBy("ts").collect()]
        assert got == [30.5, 33.5, 33.3333, 36.5, 37.0]


def test_temperature_jump(readings):
    assert sensors.temperature_jump(readings, 10.0, order=("seq",)).count() == 0
    j = sensors.temperature_jump(readings, 5.0, order=("seq",)).collect()
    assert sorted((r.last_temp, r.temperature) for r in j) == [(30.5, 36.5), (33.0, 40.0)]


def test_rolling_sum_doc_example(spark):
    df = spark.createDataFrame([(0, 1, 2, 2), (1, 2, 3, 1), (2, 2, 2, 4), (3, 1, 5, 3)],
                               "seq long, k long, v long, other long")
    out = running(df, ["k"], ["seq"], {"sum_v": ("sum", "v"), "first_other": ("first", "other")}, chunk=1)
    got = [(r.k, r.sum_v, r.first_other) for r in out.orderBy("seq").collect()]
    assert got == [(1, 2, 2), (2, 3, 1), (2, 5, 1), (1, 7, 2)]


@pytest.fixture(scope="module")
def logins(spark):
    df = read_sample(spark, LOGIN_LOG, schemas.LoginEvent)
    return df.select("seq", "user_id", "event_type", seconds_to_ts(F.col("event_time")).alias("ts"))


def test_login_fail_state_arrival_and_event_time(logins):
    arrival = detection.login_fail_state(logins, "2 seconds", order=("seq",)).collect()
    assert sorted((r.user_id, r.first_fail_time, r.last_fail_time) for r in arrival) == [
        (41, utc(T0 + 43), utc(T0 + 44)), (41, utc(T0 + 46), utc(T0 + 43))]
    event = detection.login_fail_state(logins, "2 seconds", order=("ts", "seq")).collect()
    assert sorted((r.user_id, r.first_fail_time, r.last_fail_time) for r in event) == [
        (41, utc(T0 + 42), utc(T0 + 43)), (41, utc(T0 + 43), utc(T0 + 44))]


def test_login_fail_pattern(logins):
    m = detection.login_fail_pattern(logins, "3 seconds", order=("ts", "seq")).collect()
    assert sorted((r.user_id, r.first_fail_time, r.second_fail_time) for r in m) == [
        (41, utc(T0 + 42), utc(T0 + 43)), (41, utc(T0 + 43), utc(T0 + 44)), (41, utc(T0 + 44), utc(T0 + 46))]


@pytest.fixture(scope="module")
def orders(spark):
    df = read_sample(spark, ORDER_LOG, schemas.OrderEvent)
    return df.select("seq", "order_id", "event_type", "tx_id", seconds_to_ts(F.col("event_time")).alias("ts"))


def test_order_timeout_pattern(orders):
    m = detection.order_timeout_pattern(orders, "15 minutes", order=("ts", "seq"), payload=("seq",))
    res = {r.order_id: r.result for r in m.collect()}
    assert sum(1 for v in res.values() if v == "payed successfully") == 30
    assert sorted(k for k, v in res.items() if v == "timeout") == [31, 32]
    assert 33 not in res


def test_order_pay_state(orders):
    c = orders.where("event_type = 'create'").select("order_id", "ts")
    p = orders.where("event_type = 'pay'").select("order_id", "ts")
    res = {r.order_id: r.result_msg for r in detection.order_pay_state(c, p, "15 minutes").collect()}
    assert sum(1 for v in res.values() if v == "payed successfully") == 30
    assert sorted(k for k, v in res.items() if v == "payed but already timeout") == [31, 32]
    assert res[33] == "already payed but not found create log"


def test_reconcile(spark, orders):
    pays = orders.where("tx_id <> ''").select("tx_id", F.col("ts").alias("pay_time"))
    rc = read_sample(spark, RECEIPT_LOG, schemas.ReceiptEvent).select(
        "tx_id", seconds_to_ts(F.col("event_time")).alias("receipt_time"))
    both = reconcile.reconcile(pays, rc, "5 seconds").collect()
    tags = {}
    for r in both:
        tags.setdefault(r.tag, []).append(r.tx_id)
    assert sorted(tags["matched"]) == [f"tx{i:02d}" for i in range(1, 7)]
    assert len(tags["unmatched_pay"]) == 27 and len(tags["unmatched_receipt"]) == 24
    assert reconcile.reconcile_join(pays, rc, "5 seconds").count() == 6


def test_click_fraud_and_province(spark):
    clicks = read_sample(spark, AD_CLICK_LOG, schemas.AdClickEvent).select(
        "seq", "user_id", "ad_id", "province", seconds_to_ts(F.col("timestamp")).alias("ts"))
    f = marketing.click_fraud_filter(clicks, 100, order=("ts", "seq"))
    hot = f.where("user_id = 900 AND ad_id = 17")
    st = {r.status: r["count"] for r in hot.groupBy("status").count().collect()}
    assert st == {"pass": 100, "warn": 1, "drop": 20}
    warns = marketing.blacklist_warnings(f, 100).collect()
    assert [(w.user_id, w.ad_id) for w in warns] == [(900, 17)]
    passed = f.where("status = 'pass'")
    totals = {r.province: r["count"] for r in passed.groupBy("province").count().collect()}
    assert totals == {"north": 100, "south": 8, "east": 8, "west": 8}


def test_click_browse_interval_join(spark):
    clicks = spark.createDataFrame([("user_2", dt.datetime(2019, 11, 16, 17, 30))], "user_id string, click_ts timestamp_ntz")
    browses = spark.createDataFrame([("user_2", dt.datetime(2019, 11, 16, 17, m)) for m in (19, 20, 22, 26, 30, 31)],
                                    "user_id string, view_ts timestamp_ntz")
    j = interval_join(clicks, browses, ["user_id"], "click_ts", "view_ts", "-10 minutes", 0).collect()
    assert sorted(r.view_ts.minute for r in j) == [20, 22, 26, 30]
