"""Streaming behaviour: restart from a checkpoint, late rows, batch parity, replay-safe sinks."""

import datetime as dt
import uuid

import pandas as pd
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sinks.writers import changelog, upsert_parquet
from tidemark.streaming import jobs as S
from tidemark.streaming.runner import event_time, run_to_end

SCHEMA = "event_id long, ts timestamp_ntz, sensor_id long, temperature double"


def _write(spark, folder, rows):
    pdf = pd.DataFrame(rows, columns=["event_id", "ts", "sensor_id", "temperature"])
    spark.createDataFrame(pdf, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _t(m):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=m)


def _start(spark, stream_df, out, ckpt):
    run_to_end(stream_df, lambda: (
        stream_df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
        .trigger(availableNow=True).queryName(f"t_{uuid.uuid4().hex[:6]}").start()))


def test_restart_resumes_without_duplicates(spark):
    inp, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    ckpt = out + "-ckpt"
    _write(spark, inp, [(1, _t(0), 7, 10.0), (2, _t(1), 7, 30.0), (3, _t(2), 8, 5.0)])

    def build():
        src = spark.readStream.schema(SCHEMA).parquet(inp)
        return S.temperature_jump(event_time(src, "ts", "0 seconds"), 10.0)

    _start(spark, build(), out, ckpt)
    first = spark.read.parquet(out).count()
    assert first == 1                                          # 10 -> 30
    # new data arrives; the restarted query keeps the per-sensor state (last = 30.0)
    _write(spark, inp, [(4, _t(3), 7, 45.0), (5, _t(4), 8, 6.0)])
    _start(spark, build(), out, ckpt)
    res = sorted((r.sensor_id, r.last_temp, r.temperature) for r in spark.read.parquet(out).collect())
    assert res == [(7, 10.0, 30.0), (7, 30.0, 45.0)]


def test_late_rows_are_tagged(spark):
    inp, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-out")
    _write(spark, inp, [(1, _t(0), 1, 1.0), (2, _t(60), 1, 2.0)])

    from tidemark.streaming.late import read_tagged

    def run():
        src = spark.readStream.schema(SCHEMA).parquet(inp)
        S.tag_late(src, "ts", "10 minutes", out, out + "-ckpt").awaitTermination()

    run()
    _write(spark, inp, [(3, _t(5), 1, 3.0), (4, _t(55), 1, 4.0)])   # watermark is now t(50)
    run()
    tags = {r.event_id: r.tag for r in read_tagged(spark, out).collect()}
    assert tags == {1: "on_time", 2: "on_time", 3: "late", 4: "on_time"}


def test_window_counts_close_with_watermark(spark):
    inp, out = scratch_path(spark, "w-in"), scratch_path(spark, "w-out")
    _write(spark, inp, [(i, _t(i * 7), 1, float(i)) for i in range(20)])
    src = spark.readStream.schema(SCHEMA).parquet(inp)
    _start(spark, S.window_counts(event_time(src, "ts", "0 seconds", flush=True), "ts", "30 minutes"),
           out, out + "-ckpt")
    got = sorted((r.window_start, r["count"]) for r in spark.read.parquet(out).collect())
    batch = spark.read.parquet(inp).groupBy(F.window("ts", "30 minutes").alias("w")).count()
    want = sorted((r.w.start, r["count"]) for r in batch.collect())
    assert got == want


def test_upsert_replay_is_idempotent(spark):
    path = scratch_path(spark, "upsert")
    b0 = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (1, "c", 2)], "k long, v string, seq long")
    b1 = spark.createDataFrame([(2, "d", 3), (3, "e", 3)], "k long, v string, seq long")
    upsert_parquet(b0, path, 0, ["k"], ["seq"])
    out1 = upsert_parquet(b1, path, 1, ["k"], ["seq"])
    out1_again = upsert_parquet(b1, path, 1, ["k"], ["seq"])   # replayed batch
    assert out1 == out1_again
    got = sorted((r.k, r.v) for r in spark.read.parquet(out1).collect())
    assert got == [(1, "c"), (2, "d"), (3, "e")]


def test_changelog_retract_pairs(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    after = spark.createDataFrame([("a", 1), ("b", 3), ("c", 1)], "k string, n long")
    got = sorted((r.flag, r.k, r.n) for r in changelog(before, after, ["k"]).collect())
    assert got == [(False, "b", 2), (True, "b", 3), (True, "c", 1)]


def test_login_fail_timer_doc_list(spark):
    """fail 1, success 2, fail 3, fail 4 (seconds): the success disarms the
    first timer, fails 3 and 4 fire one warning at 8 s."""
    inp, out = scratch_path(spark, "lf-in"), scratch_path(spark, "lf-out")
    base = dt.datetime(2024, 1, 1)
    rows = [(1, "fail", 1), (1, "success", 2), (1, "fail", 3), (1, "fail", 4)]
    pdf = pd.DataFrame([(u, e, base + dt.timedelta(seconds=s), i) for i, (u, e, s) in enumerate(rows)],
                       columns=["user_id", "event_type", "ts", "seq"])
    spark.createDataFrame(pdf, "user_id long, event_type string, ts timestamp_ntz, seq long").write.parquet(inp)
    src = spark.readStream.schema("user_id long, event_type string, ts timestamp_ntz, seq long").parquet(inp)
    _start(spark, S.login_fail_timer(event_time(src, "ts", "0 seconds", flush=True), "5 seconds"), out,
           out + "-ckpt")
    got = [(r.fails, r.first_fail_time.second, r.last_fail_time.second) for r in spark.read.parquet(out).collect()]
    assert got == [(2, 3, 4)]


def test_processing_time_column(spark):
    inp = scratch_path(spark, "pt-in")
    _write(spark, inp, [(1, _t(0), 1, 1.0)])
    src = spark.readStream.schema(SCHEMA).parquet(inp)
    out = scratch_path(spark, "pt-out")
    _start(spark, S.with_processing_time(src), out, out + "-ckpt")
    assert spark.read.parquet(out).where("proc_time IS NOT NULL").count() == 1


def _brute_rise(pdf, duration_s):
    """The rising-temperature timer, one event at a time (reference semantics)."""
    out = []
    d = dt.timedelta(seconds=duration_s)
    for sid, g in pdf.sort_values(["ts", "event_id"]).groupby("sensor_id"):
        last, timer = None, None
        for r in g.itertuples(index=False):
            ts = r.ts.floor("ms")                       # timers have millisecond resolution
            if timer is not None and timer < ts:
                out.append((sid, timer))
                timer = None
            if last is not None and r.temperature > last and timer is None:
                timer = ts + d
            elif last is not None and r.temperature < last and timer is not None:
                timer = None
            last = r.temperature
        if timer is not None:
            out.append((sid, timer))
    return sorted(out)


def test_continuous_rise_stream_vs_brute_force(spark):
    from conftest import SF
    from tidemark.plans.stream_queries import q_d16s

    got = sorted((r.sensor_id, r.alert_time) for r in q_d16s(spark, SF).collect())
    ev = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "event_id", "ts", "user_id AS sensor_id", "value AS temperature").toPandas()
    want = [(int(s), t.to_pydatetime()) for s, t in _brute_rise(ev, 6 * 3600)]
    assert got == want


def test_state_ttl_mode_runs(spark):
    inp, out = scratch_path(spark, "ttl-in"), scratch_path(spark, "ttl-out")
    _write(spark, inp, [(1, _t(0), 7, 10.0), (2, _t(1), 7, 30.0)])
    src = spark.readStream.schema(SCHEMA).parquet(inp)
    # processing-time mode keeps firing no-data batches (for TTL and timers), so it
    # runs on a processing-time trigger and is stopped once the input is consumed
    q = (S.temperature_jump(event_time(src, "ts", "0 seconds"), 10.0, ttl="1 hour").writeStream
         .format("parquet").option("path", out).option("checkpointLocation", out + "-ckpt")
         .trigger(processingTime="1 second").start())
    try:
        q.awaitTermination(25)       # never ends by itself; the input is read in the first batch
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 1


def test_late_click_counts_on_its_own_day(spark):
    """Two clicks on day 2, a late one of day 1, a third of day 2: only the third is over the limit."""
    inp, out = scratch_path(spark, "cf-in"), scratch_path(spark, "cf-out")
    schema = "event_id long, ts timestamp_ntz, user_id long, ad_id long"
    day = dt.datetime(2024, 1, 2)

    def write(rows):
        spark.createDataFrame(pd.DataFrame([(i, t, 1, 1) for i, t in rows],
                                           columns=["event_id", "ts", "user_id", "ad_id"]), schema).coalesce(
            1).write.mode("append").parquet(inp)

    def run():
        src = event_time(spark.readStream.schema(schema).parquet(inp), "ts", "1 hour")
        _start(spark, S.click_fraud(src, 2, ["event_id"]), out, out + "-ckpt")

    write([(1, day + dt.timedelta(minutes=1)), (2, day + dt.timedelta(minutes=2))])
    run()
    write([(3, day - dt.timedelta(minutes=1))])
    run()
    write([(4, day + dt.timedelta(minutes=3)), (5, day + dt.timedelta(minutes=4))])
    run()
    got = {r.event_id: r.status for r in spark.read.parquet(out).collect()}
    assert got == {1: "pass", 2: "pass", 3: "pass", 4: "warn", 5: "drop"}
