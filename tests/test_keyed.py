"""Keyed processors: order behind the watermark, repeated ids, patterns, both clocks, expiry, buckets."""

import datetime as dt
import itertools
import os
import random
import subprocess
import sys
import time
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sinks.writers import read_buckets, upsert_buckets
from tidemark.streaming import jobs as S
from tidemark.streaming import processors as P
from tidemark.streaming.runner import event_time, run_to_end

BASE = dt.datetime(2024, 1, 1)


def at(s):
    return BASE + dt.timedelta(seconds=s)


def replay(spark, schema, batches, build, delay="1 minute"):
    """Each list of rows is one micro-batch; what the query has written in the end."""
    inp, out = scratch_path(spark, "k-in"), scratch_path(spark, "k-out")
    columns = [c.split()[0] for c in schema.split(", ")]
    for i, rows in enumerate(batches):
        spark.createDataFrame(pd.DataFrame(rows, columns=columns), schema).coalesce(1).write.parquet(f"{inp}/{i}")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{inp}/*")
    df = build(event_time(src, "ts", delay, flush=True))
    run_to_end(df, lambda: df.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-c")
               .trigger(availableNow=True).queryName(f"k_{uuid.uuid4().hex[:6]}").start())
    return spark.read.parquet(out).collect()


READINGS = "event_id long, ts timestamp_ntz, sensor_id long, temperature double"


def test_a_reading_between_two_others(spark):
    """Readings at 0 and 20 s, then one of 10 s: 10, 20, 30 degrees in order never jump by 15."""
    got = replay(spark, READINGS, [[(1, at(0), 7, 10.0), (2, at(20), 7, 30.0)], [(3, at(10), 7, 20.0)]],
                 lambda s: S.temperature_jump(s, 15.0, hold=True))
    assert got == []
    got = replay(spark, READINGS, [[(1, at(0), 7, 10.0), (2, at(20), 7, 30.0)], [(3, at(10), 7, 29.0)]],
                 lambda s: S.temperature_jump(s, 15.0, hold=True))
    assert [(r.ts, r.last_temp, r.temperature) for r in got] == [(at(10), 10.0, 29.0)]


def test_null_key_is_a_key(spark):
    rows = [(1, at(0), None, 10.0), (2, at(5), None, 50.0)]
    schema = "event_id long, ts timestamp_ntz, sensor_id long, temperature double"
    inp = scratch_path(spark, "nk")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(inp)
    out = scratch_path(spark, "nk-out")
    df = S.temperature_jump(event_time(spark.readStream.schema(schema).parquet(inp), "ts", "1 minute", flush=True), 15.0,
                            hold=True)
    run_to_end(df, lambda: df.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-c")
               .trigger(availableNow=True).start())
    assert [(r.sensor_id, r.last_temp) for r in spark.read.parquet(out).collect()] == [(None, 10.0)]


def test_every_payment_and_receipt_counts(spark):
    """Pays at 0 and 4 s, a receipt at 8 s, bound 5 s; ids repeat and rows come in any order."""
    schema = "tx_id long, ts timestamp_ntz, side string, seq long"
    got = replay(spark, schema, [[(1, at(0), "pay", 0), (1, at(4), "pay", 0)], [(1, at(8), "receipt", 1)]],
                 lambda s: S.tx_match(s, "5 seconds"))
    assert sorted((r.tag, r.pay_time, r.receipt_time) for r in got) == [
        ("matched", at(4), at(8)), ("unmatched_pay", at(0), None)]
    rng = random.Random(8)
    rows = [(rng.randrange(3), at(rng.randrange(200)), rng.choice(["pay", "receipt"]), i) for i in range(120)]
    got = replay(spark, schema, [rows[:50], rows[50:90], rows[90:]], lambda s: S.tx_match(s, "5 seconds"), "10 minutes")
    want = []
    pays, receipts = ([r for r in rows if r[2] == s] for s in P.TxMatch.SIDES)
    near = [(p, q) for p, q in itertools.product(pays, receipts) if p[0] == q[0]
            and abs((p[1] - q[1]).total_seconds()) <= 5]
    want += [(p[0], p[1], q[1], "matched") for p, q in near]
    want += [(p[0], p[1], None, "unmatched_pay") for p in pays if all(p is not x for x, _ in near)]
    want += [(q[0], None, q[1], "unmatched_receipt") for q in receipts if all(q is not x for _, x in near)]
    assert sorted(map(repr, ((r.tx_id, r.pay_time, r.receipt_time, r.tag) for r in got))) == sorted(map(repr, want))


class Store:
    """List state in memory: the automaton alone, cut into calls at will."""

    def __init__(self):
        self.rows = []

    def getListState(self, name, schema):
        return self

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []


def brute_patterns(rows, contiguity, within):
    """(idents of the stages, matched) by following every start on its own."""
    out = []
    for i, (us, meets, ident) in enumerate(rows):
        if not meets & 1:
            continue
        chain, j, alive = [ident], i, True
        for stage in range(1, len(contiguity)):
            nxt = j + 1 if contiguity[stage] == "next" else next(
                (k for k in range(j + 1, len(rows)) if rows[k][1] >> stage & 1), None)
            if nxt is None or nxt >= len(rows) or rows[nxt][0] >= us + within:
                break  # out of time, or waiting at the end
            if not rows[nxt][1] >> stage & 1:
                alive = False
                break
            chain.append(rows[nxt][2])
            j = nxt
        if alive:
            out.append((tuple(chain), len(chain) == len(contiguity)))
    return sorted(out)


@pytest.mark.parametrize("contiguity", [["", "followedBy"], ["", "next"], ["", "followedBy", "followedBy"],
                                        ["", "next", "followedBy", "next"], ["", "followedBy", "next", "followedBy"]])
def test_patterns_equal_brute_force(contiguity):
    rng = np.random.default_rng(len(contiguity))
    names = [f"s{i}" for i in range(len(contiguity))]
    for trial in range(60):
        n, within = int(rng.integers(1, 60)), int(rng.integers(1, 60))
        rows = [(int(t), int(m), i) for i, (t, m) in enumerate(zip(np.sort(rng.integers(0, 150, n)),
                                                                   rng.integers(0, 1 << len(contiguity), n)))]
        p = P.PatternMatcher(names, contiguity, within, "k", emit_timeouts=True)
        p.open(Store())
        got, done = [], 0
        for now in [*sorted(rng.integers(0, 150, 3).tolist()), 10_000]:
            ready = [r for r in rows[done:] if r[0] <= now]
            done += len(ready)
            out, deadline = p.advance("key", pd.DataFrame(ready, columns=["us", "meets", "ident"]), int(now))
            assert deadline is None or deadline > now
            for r in out.itertuples(index=False):
                ids = [getattr(r, f"{s}_id") for s in names]
                got.append((tuple(int(x) for x in ids if pd.notna(x)), r.matched))
        assert sorted(got) == brute_patterns(rows, contiguity, within)
        assert not p.parts.rows


def test_gate_on_the_real_clock(spark):
    """The same gate on processing time: facts pass until the timer closes it."""
    schema = "user_id long, ts timestamp_ntz, event_id long, kind string"
    inp, out = scratch_path(spark, "gate"), scratch_path(spark, "gate-out")

    def write(*rows):
        spark.createDataFrame(pd.DataFrame(rows, columns=["user_id", "ts", "event_id", "kind"]), schema).coalesce(
            1).write.mode("append").parquet(inp)

    write((1, at(0), 1, "fact"), (1, at(0), 2, "switch"), (1, at(0), 3, "fact"))
    s = event_time(spark.readStream.schema(schema).parquet(inp), "ts", "0 seconds")
    q = (S.switch_gate(s, "4 seconds", clock="processing").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-c").trigger(processingTime="1 second").start())

    def passed(n, seconds=40):
        end = time.time() + seconds
        while time.time() < end:
            try:
                ids = sorted(r.event_id for r in spark.read.parquet(out).collect())
            except Exception:  # nothing written yet
                ids = []
            if len(ids) >= n:
                return ids
            time.sleep(0.5)
        return ids

    try:
        assert passed(1) == [3]
        time.sleep(6)  # the timer closes the gate
        write((1, at(1), 4, "fact"), (2, at(1), 5, "switch"), (2, at(1), 6, "fact"))
        assert passed(2) == [3, 6]
    finally:
        q.stop()


def test_idle_state_expires(spark):
    """After the time to live the last reading is forgotten, so nothing jumps."""
    inp, out = scratch_path(spark, "ttl2"), scratch_path(spark, "ttl2-out")

    def write(*rows):
        spark.createDataFrame(pd.DataFrame(rows, columns=["event_id", "ts", "sensor_id", "temperature"]), READINGS).coalesce(
            1).write.mode("append").parquet(inp)

    def run(ttl, seconds):
        src = event_time(spark.readStream.schema(READINGS).parquet(inp), "ts", "0 seconds")
        q = (S.temperature_jump(src, 10.0, ttl=ttl).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", out + "-c").trigger(processingTime="1 second").start())
        q.awaitTermination(seconds)
        q.stop()

    write((1, at(0), 7, 10.0))
    run("2 seconds", 12)
    time.sleep(2)
    write((2, at(100), 7, 90.0), (3, at(101), 7, 50.0))
    run("2 seconds", 12)
    got = [(r.last_temp, r.temperature) for r in spark.read.parquet(out).collect()]
    assert got == [(90.0, 50.0)]


def test_untouched_buckets_keep_their_files(spark):
    path = scratch_path(spark, "buckets")
    first = spark.createDataFrame([(i, f"a{i}", 1) for i in range(40)] + [(None, "n", 1)], "k long, v string, seq long")
    upsert_buckets(first, path, 0, ["k"], ["seq"], buckets=8)
    second = spark.createDataFrame([(3, "b", 2), (3, "c", 3), (None, "m", 2)], "k long, v string, seq long")
    for _ in range(2):  # a repeated batch changes nothing
        upsert_buckets(second, path, 1, ["k"], ["seq"], buckets=8)
    got = {r.k: r.v for r in read_buckets(spark, path, 1).collect()}
    assert got == {**{i: f"a{i}" for i in range(40)}, 3: "c", None: "m"}
    files = {str(r[0]) for r in read_buckets(spark, path, 1).select(F.input_file_name()).distinct().collect()}
    old = {str(r[0]) for r in read_buckets(spark, path, 0).select(F.input_file_name()).distinct().collect()}
    written = {f.split("__bucket=")[1].split("/")[0] for f in files - old}
    assert 1 <= len(written) <= 2 and all("v=0000000001" in f for f in files - old)
    assert {f.split("__bucket=")[1].split("/")[0] for f in files & old} == {str(b) for b in range(8)} - written
    assert read_buckets(spark, path, 0).count() == 41


def test_a_stream_starts_from_any_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from tidemark.session import get_spark
from tidemark.plans import registry
spark = get_spark("local[2]", shuffle_partitions=2)
print("rows:", registry.queries()["D15s_temp_jump_stream"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows:" in out.stdout, out.stderr[-2000:]
