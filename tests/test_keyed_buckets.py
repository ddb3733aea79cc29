"""Keyed state by buckets: its size, the store, many keys at once, slices of several files."""

import datetime as dt
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import udfs
from tidemark.session import ROCKSDB_PROVIDER, scratch_path
from tidemark.sources import files
from tidemark.streaming import jobs as S
from tidemark.streaming import keyed
from tidemark.streaming.runner import event_time, run_foreach_batch, run_to_parquet

BASE = dt.datetime(2024, 1, 1)
READINGS = "event_id long, ts timestamp_ntz, sensor_id long, temperature double"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def source(spark, rows, schema):
    inp = scratch_path(spark, "kb")
    columns = [c.split()[0] for c in schema.split(", ")]
    spark.createDataFrame(pd.DataFrame(rows, columns=columns), schema).coalesce(1).write.parquet(inp)
    return spark.readStream.schema(schema).parquet(inp)


def readings(n, keys):
    rng = np.random.default_rng(3)
    return [(i, BASE + dt.timedelta(seconds=i), int(rng.integers(keys)), float(rng.integers(100))) for i in range(n)]


@pytest.fixture
def memory_store(spark):
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield
    spark.conf.set(PROVIDER, old)


def test_state_is_kept_per_bucket(spark):
    """The calls of the store do not grow with the keys."""
    rows = readings(1200, 600)
    s = event_time(source(spark, rows, READINGS), "ts", "0 seconds")
    out = scratch_path(spark, "kb-out")
    old = spark.conf.get("tidemark.streamBuckets", None)
    spark.conf.set("tidemark.streamBuckets", "16")
    try:
        q = (S.temperature_jump(s, 30.0).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", out + "-c").trigger(availableNow=True)
             .queryName(f"kb_{uuid.uuid4().hex[:6]}").start())
        q.awaitTermination()
    finally:
        spark.conf.unset("tidemark.streamBuckets") if old is None else spark.conf.set("tidemark.streamBuckets", old)
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators) <= 64
    want, last = [], {}
    for i, ts, k, t in rows:
        if k in last and abs(t - last[k]) > 30.0:
            want.append((k, ts, last[k], t))
        last[k] = t
    got = [(r.sensor_id, r.ts, r.last_temp, r.temperature) for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted(want)


def test_running_statistics_bring_their_store(spark, memory_store):
    """the query alone, in a session whose state store cannot keep keyed state."""
    rows = readings(60, 5)
    out = run_to_parquet(S.running_statistics(source(spark, rows, READINGS).withColumn(
        "ts", F.col("ts").cast("timestamp"))), "kb")
    got = sorted((r.event_id, r.min_temp, r.n, r.total) for r in out.collect())
    want, seen = [], {}
    for i, _, k, t in rows:
        seen.setdefault(k, []).append(t)
        want.append((i, min(seen[k]), len(seen[k]), sum(seen[k])))
    assert got == want


def test_complete_counts_are_not_kept_in_memory(spark, memory_store):
    """all words of a complete-mode count lie in the store on disk."""
    rows = [(i, BASE, i % 7, 0.0) for i in range(50)]
    counts = source(spark, rows, READINGS).groupBy("sensor_id").agg(F.count(F.lit(1)).alias("n"))
    out = run_foreach_batch(counts, "kb", lambda b: b, mode="complete", overwrite=True)
    assert sum(r.n for r in out.collect()) == 50
    assert spark.conf.get(PROVIDER) == ROCKSDB_PROVIDER


def test_both_sides_of_a_window_without_keyed_calls(spark):
    """window join and co-group are aggregations; null keys and null ids count."""
    rows = [(1, BASE, 1, 0.0), (2, BASE, 1, 1.0), (None, BASE, 1, 1.0), (4, BASE, None, 1.0), (5, BASE, None, 0.0)]
    s = event_time(source(spark, rows, READINGS.replace("event_id", "ident")), "ts", "0 seconds", flush=True)
    sides = [s.where(F.when(F.col("temperature") == v, F.col("ts")).isNotNull()) for v in (0.0, 1.0)]
    pairs = S.window_sides(*sides, "sensor_id", "1 day", True)
    assert "TransformWithState" not in pairs._jdf.queryExecution().logical().toString()
    got = {(r.sensor_id, r.left_id, r.right_id) for r in run_to_parquet(pairs, "kb").collect()}
    assert got == {(1, 1, 2), (1, 1, None), (None, 5, 4)}


def test_large_slices_are_several_files(spark, tmp_path, monkeypatch):
    """A slice is written and read by many tasks and still is one micro-batch."""
    table = pd.DataFrame([(i, BASE + dt.timedelta(seconds=i if i < 200 else 299), 1, 0.0) for i in range(300)],
                         columns=["event_id", "ts", "sensor_id", "temperature"])
    spark.createDataFrame(table, READINGS).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(files, "SLICE_ROWS", 20)
    s = files.stream_slices(spark, str(tmp_path), "events", "ts", 5)
    counts = s.groupBy().agg(F.count(F.lit(1)).alias("n"))
    out = run_foreach_batch(counts, "kb", lambda b: b, mode="complete", keep_batch_id=True)
    # the fourth slice is empty and keeps its place
    assert sorted((r.batch_id, r.n) for r in out.collect()) == [(0, 60), (1, 120), (2, 180), (3, 200), (4, 300)]


def test_user_aggregate_accumulates_whole_batches(spark, monkeypatch):
    """one call per Arrow batch, however many keys it holds; nulls add nothing."""
    df = spark.createDataFrame([(i % 500, float(i)) for i in range(1000)] + [(None, 4.0), (7, None), (900, None)],
                               "k long, v double").coalesce(1)
    seen = spark.sparkContext.accumulator(0)

    class Counted(udfs.AvgTemp):
        @staticmethod
        def accumulate(values, group, n):
            seen.add(1)
            return udfs.AvgTemp.accumulate(values, group, n)

    monkeypatch.setattr(udfs, "LOCAL_ROWS", 100)
    got = {r.k: r.m for r in udfs.user_aggregate(df, "k", "v", Counted, "m").collect()}
    assert got == {**{k: k + 250.0 for k in range(500)}, None: 4.0, 900: None}
    assert seen.value <= 3


def test_times_do_not_go_through_the_cache_of_to_datetime(monkeypatch):
    """on a large bucket that cache failed on an index of its own; repeated values and nulls are converted without it."""
    def fail(*args, **kwargs):
        raise ValueError("'indices' contains values less than allowed (-69 < -1)")

    monkeypatch.setattr(keyed.pd, "to_datetime", fail)
    days = np.arange(200_000) % 300 * 86_400_000_000
    days[::3], days[1::6] = keyed.NO_TIME, keyed.NO_NUMBER
    got = keyed.from_micros(days)
    want = days.astype("datetime64[us]")
    want[np.abs(days) >= -keyed.NO_TIME] = np.datetime64("NaT")
    assert got.equals(pd.Series(want))
    assert keyed.from_micros([1, None]).isna().tolist() == [False, True]
    assert keyed.from_micros(pd.Series([5, 6], index=[3, 9])).index.tolist() == [3, 9]
