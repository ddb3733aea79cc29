"""Re-ranking of late windows, a flush that outlives its driver, retracting frames, zipped co-groups."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.udfs import AvgTempFrame, SumTempFrame, user_frame
from tidemark.operators.joins import cogroup_rows
from tidemark.session import scratch_path
from tidemark.streaming import jobs as S
from tidemark.streaming import runner
from tidemark.streaming.late import LateRanking
from tidemark.streaming.runner import event_time, run_to_parquet

HITS = "url string, ts timestamp_ntz"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def hits(spark, batches):
    """One file per batch, read one a trigger."""
    inp = scratch_path(spark, "hits")
    for i, rows in enumerate(batches):
        spark.createDataFrame([(u, at(m)) for u, m in rows], HITS).coalesce(1).write.parquet(f"{inp}/{i:03d}")
    return spark.readStream.schema(HITS).option("maxFilesPerTrigger", 1).parquet(f"{inp}/*")


def rankings(batches, size, slide, delay, lateness, n):
    """What must be emitted, batch by batch."""
    windows, shown, out = {}, {}, []
    top = before = None

    def show(end, passed):
        rank = sorted(windows[end].items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:n]
        if shown.get(end) != rank:
            kind = "update" if end in shown else "first"
            out.extend((at(end), u, c, r + 1, kind) for r, (u, c) in enumerate(rank))
            shown[end] = rank

    for rows in batches:
        for u, m in rows:
            first = (m // slide + 1) * slide
            for end in range(first, first + size, slide):
                if before is None or end > before - lateness:
                    windows.setdefault(end, {}).setdefault(u, 0)
                    windows[end][u] += 1
        top = max([m for _, m in rows] + ([] if top is None else [top]))
        for end in sorted(windows):
            if end <= top - delay and (before is None or end > before - lateness):
                show(end, before)
        before = top - delay
    for end in sorted(windows):
        if end > before:
            show(end, before)
    return out


def test_every_changed_ranking_is_emitted(spark):
    rnd = random.Random(5)
    batches = []
    for b in range(5):
        rows = [(rnd.choice(["/a", "/b", "/c", "/d", None]), b * 60 + rnd.randrange(60)) for _ in range(25)]
        rows += [(rnd.choice(["/a", "/d", None]), max(0, b * 60 - rnd.randrange(100))) for _ in range(6)]
        batches.append(rows)
    got = LateRanking(spark, ["url"], "ts", "30 minutes", "5 minutes", "40 minutes", 2, "10 minutes").run(
        hits(spark, batches)).select(F.col("window_end").cast("timestamp_ntz"), "url", "count", "rank", "emission")
    want = rankings(batches, 30, 10, 5, 40, 2)
    key = str
    assert sorted(map(key, map(tuple, got.collect()))) == sorted(map(key, want))
    assert sum(x[-1] == "update" for x in want) > 5


def test_a_late_row_below_the_first_n_emits_nothing(spark):
    batches = [[("/a", 1), ("/a", 2), ("/b", 3), ("/b", 4), ("/z", 100)], [("/c", 5), ("/z", 101)], [("/b", 6)]]
    got = LateRanking(spark, ["url"], "ts", "30 minutes", "0 seconds", "3 hours", 2).run(hits(spark, batches)).where(
        F.col("window_end") == F.lit(at(30))).orderBy("emission", "rank").collect()
    assert [(r.url, r["count"], r["rank"], r.emission) for r in got] == [
        ("/a", 2, 1, "first"), ("/b", 2, 2, "first"), ("/b", 3, 1, "update"), ("/a", 2, 2, "update")]


def test_slide_must_divide_the_size(spark):
    with pytest.raises(ValueError):
        LateRanking(spark, ["url"], "ts", "30 minutes", "0 seconds", "3 hours", 2, "7 minutes")


@pytest.mark.parametrize("lost", ["before the flush is written", "after the flush is written"])
def test_a_lost_driver_still_flushes(spark, lost, monkeypatch):
    """The query is built again over the same folders; its last window closes, once."""
    out, sentinel = scratch_path(spark, "flushed"), scratch_path(spark, "kept-sentinel")
    source = hits(spark, [[("/a", 1), ("/a", 2)], [("/a", 70)]])

    def build():
        s = event_time(source, "ts", "0 seconds", flush=True, flush_folder=sentinel)
        return S.window_counts(s, "ts", "1 hour", keys=["url"])

    real = runner._pending

    def dies(stream):
        for folder in real(stream) if lost.startswith("after") else []:
            spark.read.parquet(f"{folder}/row").write.mode("append").parquet(f"{folder}/in")
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(runner, "_pending", dies)
        with pytest.raises(KeyboardInterrupt):
            run_to_parquet(build(), "x", folder=out)
    assert spark.read.parquet(out).count() == 1
    for _ in range(2):  # a third run has nothing left to do
        got = run_to_parquet(build(), "x", folder=out)
        assert sorted((r.window_start, r["count"]) for r in got.collect()) == [(at(0), 2), (at(60), 1)]


def frame_rows(n_keys=3, n=400):
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        k = rnd.choice([None, *range(n_keys)]) if i % 3 else 0  # key 0 is hot
        v = rnd.choice([None, float("nan"), math.inf, -math.inf]) if rnd.random() < 0.05 else round(rnd.uniform(-50, 50), 2)
        rows.append((i, k, v))
    return rows


@pytest.mark.parametrize("acc", [AvgTempFrame, SumTempFrame])
@pytest.mark.parametrize("preceding,block", [(0, 5), (4, 5), (9, 4), (1000, 7)])
def test_frames_equal_brute_force(spark, acc, preceding, block):
    rows = frame_rows()
    df = spark.createDataFrame(rows, "id long, k long, v double").repartition(5)
    with_small_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = {r.id: r.x for r in user_frame(df, ["k"], ["id"], "v", preceding, acc, "x", block,
                                             chunk="auto:50:20").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_small_batches)
    assert len(got) == len(rows)
    for i, k, _ in rows:
        mine = [v for j, kk, v in rows if kk == k and j <= i][-preceding - 1:]
        mine = [v for v in mine if v is not None]
        if not mine:
            assert got[i] is None
        else:
            with np.errstate(invalid="ignore"):
                want = np.sum(mine) if acc is SumTempFrame else np.mean(mine)
            assert got[i] == pytest.approx(want, nan_ok=True, abs=1e-9)


def test_frames_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, k long, v double")
    out = user_frame(df, ["k"], ["id"], "v", 2, AvgTempFrame, "x")
    assert out.columns == ["id", "k", "v", "x"] and out.count() == 0
    with pytest.raises(ValueError):
        user_frame(df, ["k"], ["id"], "v", -1, AvgTempFrame, "x")


def test_cogrouped_rows_lie_side_by_side(spark):
    left = spark.createDataFrame([(1, 10, "a"), (1, 11, "b"), (None, 12, "c")], "k long, id long, v string")
    right = spark.createDataFrame([(1, 20), (None, 21), (None, 22), (3, 23)], "k long, id long")
    got = {(r.k, r.seq): (r.left_id, r.left_v, r.right_id) for r in cogroup_rows(left, right, ["k"], ["id"]).collect()}
    assert got == {(1, 1): (10, "a", 20), (1, 2): (11, "b", None), (None, 1): (12, "c", 21),
                   (None, 2): (None, None, 22), (3, 1): (None, None, 23)}
