"""A null key is a key, and a key that holds a third of all rows is cut: equal to plain windows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import cep, scan
from tidemark.operators.keys import join_keys
from tidemark.operators.ranking import exact_median, numbered, ranked
from tidemark.operators.sequence import neighbours, plan_chunks, rows_frame, running
from tidemark.operators.transforms import range_frame
from tidemark.operators.windows import count_window, session

CHUNKINGS = ["auto", "auto:100:30", "1 hour", "3 days"]
ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def ev(spark):
    """Null is the hot key; key 1 has null values; key 2 is small."""
    from conftest import SF

    e = spark.read.parquet(f"{SF}/events.parquet").limit(900).select("event_id", "ts", "value", "event_type")
    key = F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("long")).when(F.col("event_id") % 50 == 1, F.lit(2)).otherwise(
        F.col("event_id") % 4)
    e = e.withColumn("k", key).withColumn("v", F.when(F.col("k") == 1, F.lit(None)).otherwise(F.col("value")))
    return e.cache()


def same(got, want, cols):
    def rows(d):
        # sums that cancel in another order differ in their last digits
        return sorted(repr([f"{v + 1e-7:.3f}" if isinstance(v, float) else v for v in (r[c] for c in cols)])
                      for r in d.select(*cols).collect())

    assert rows(got) == rows(want)


@pytest.mark.parametrize("chunk", CHUNKINGS)
def test_scans(ev, chunk):
    w = Window.partitionBy("k").orderBy(*ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    same(neighbours(ev, ["k"], ORDER, ["v"], nxt=True, chunk=chunk),
         ev.select("event_id", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v")),
         ["event_id", "prev_v", "next_v"])
    same(running(ev, ["k"], ORDER, {"s": ("sum", "v"), "n": ("count", "v"), "m": ("min", "v"), "l": ("last", "v"),
                                    "f": ("first", "v")}, chunk=chunk),
         ev.select("event_id", F.sum("v").over(upto).alias("s"), F.count("v").over(upto).alias("n"),
                   F.min("v").over(upto).alias("m"), F.last("v", True).over(upto).alias("l"),
                   F.first("v", True).over(upto).alias("f")), ["event_id", "s", "n", "m", "l", "f"])


@pytest.mark.parametrize("chunk", CHUNKINGS)
@pytest.mark.parametrize("n", [2, 45])
def test_frames(ev, chunk, n):
    """45 rows reach over several chunks."""
    w = Window.partitionBy("k").orderBy(*ORDER).rowsBetween(-n, 0)
    same(rows_frame(ev, ["k"], ORDER, "v", n, ("count", "sum", "avg", "min", "max"), chunk=chunk),
         ev.select("event_id", F.count("v").over(w).alias("count"), F.sum("v").over(w).alias("sum"),
                   F.avg("v").over(w).alias("avg"), F.min("v").over(w).alias("min"), F.max("v").over(w).alias("max")),
         ["event_id", "count", "sum", "avg", "min", "max"])


@pytest.mark.parametrize("chunk", CHUNKINGS)
def test_range_frames(ev, chunk):
    w = Window.partitionBy("k").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-7_200_000_000, 0)
    same(range_frame(ev, ["k"], "ts", "v", "2 hours", chunk=chunk),
         ev.select("event_id", F.count(F.lit(1)).over(w).alias("count"), F.sum("v").over(w).alias("sum")),
         ["event_id", "count", "sum"])


def test_numbers_and_ranks(ev):
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), "event_id")
    same(numbered(ev, ["k"], ["v", "event_id"], ["v"]), ev.select("event_id", F.row_number().over(w).alias("row_num")),
         ["event_id", "row_num"])
    same(ranked(ev, ["k"], "v", ["event_id"]),
         ev.select("event_id", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc())).alias("rnk")),
         ["event_id", "rnk"])
    known = ev.where("v is not null")
    same(exact_median(known, ["k"], "v"), known.groupBy("k").agg(
        F.median("v").alias("median"), F.count("v").alias("cnt")), ["k", "median", "cnt"])


@pytest.mark.parametrize("chunk", CHUNKINGS[:2])
@pytest.mark.parametrize("slide", [3, 4])
def test_count_windows_that_slide(ev, chunk, slide):
    n = ev.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*ORDER)))
    fires = n.where(F.col("rn") % slide == 0).select(F.col("k").alias("fk"), F.col("rn").alias("fire_at_row"))
    want = fires.join(n, F.col("fk").eqNullSafe(F.col("k")) & (F.col("rn") <= F.col("fire_at_row"))
                      & (F.col("rn") > F.col("fire_at_row") - 6)).groupBy("k", "fire_at_row").agg(
        F.count(F.lit(1)).alias("count"), F.sum("v").alias("sum"))
    same(count_window(ev, ["k"], ORDER, 6, slide, "v", chunk=chunk), want, ["k", "fire_at_row", "count", "sum"])


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("chunk", CHUNKINGS)
def test_sessions(ev, keys, chunk):
    want = ev.groupBy(*keys, F.session_window("ts", "20 minutes").alias("w")).agg(F.count(F.lit(1)).alias("count"))
    same(session(ev, "ts", "20 minutes", keys, order=ORDER, chunk=chunk),
         want.select(*keys, F.col("w.start").alias("session_start"), "count"), [*keys, "session_start", "count"])


@pytest.mark.parametrize("chunk", CHUNKINGS)
def test_patterns(ev, chunk):
    stages = [("a", F.col("event_type") == "view", ""), ("b", F.col("event_type") == "click", "next"),
              ("c", F.col("event_type") == "view", "followedBy"), ("d", F.col("event_type") == "click", "followedBy")]
    got = cep.match_sequence(ev, "k", ORDER, "event_id", stages, "2 days", chunk)
    want = []
    for k, g in ev.toPandas().sort_values(ORDER).groupby("k", dropna=False):
        rows = list(g.itertuples(index=False))
        for i, r in enumerate(rows):
            if r.event_type != "view" or i + 1 >= len(rows) or rows[i + 1].event_type != "click":
                continue
            at = [i, i + 1]
            for kind in ("view", "click"):
                at.append(next((j for j in range(at[-1] + 1, len(rows)) if rows[j].event_type == kind), None))
                if at[-1] is None:
                    break
            if at[-1] is not None and rows[at[-1]].ts < r.ts + pd.Timedelta("2 days"):
                want.append([rows[j].event_id for j in at])
    ids = sorted([r[f"{c}_id"] for c in "abcd"] for r in got.collect())
    assert ids == sorted(want) and ids


def brute_windows(at, point, reset, duration):
    out, end = [], None
    for t, p, r in zip(at, point, reset):
        if r:
            end = None
        opens = bool(p and (end is None or t > end))
        if opens:
            end = t + duration
        out.append(opens)
    return np.array(out, bool), end


def test_summaries_combine():
    rng = np.random.default_rng(4)
    for trial in range(300):
        n = int(rng.integers(1, 60))
        at = np.sort(rng.integers(0, 120, n))
        point, reset = rng.random(n) < 0.7, rng.random(n) < rng.choice([0.0, 0.05, 0.3])
        duration = int(rng.integers(0, 40))
        want, end = brute_windows(at, point, reset, duration)
        cuts = np.r_[0, np.sort(rng.integers(0, n + 1, 3)), n]
        parts = [slice(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
        sums = [scan.summarise(at[p], point[p], reset[p], duration) for p in parts]
        state, got = scan.CLOSED, []
        for p, s in zip(parts, sums):
            got.append(scan.anchors(at[p], point[p], reset[p], duration, state))
            state = s.leave(state)
        assert (np.concatenate(got) == want).all()
        whole = sums[0]
        for s in sums[1:]:
            whole = scan.combine(whole, s)
        assert whole.leave(scan.CLOSED) == state == (scan.CLOSED if end is None else end)


@pytest.mark.parametrize("chunk", CHUNKINGS)
def test_greedy_windows(ev, chunk):
    got = scan.greedy_windows(ev, ["k"], ORDER, F.col("event_type") != "view", F.col("event_type") == "error",
                              "3 hours", chunk=chunk)
    want = {}
    for _, g in ev.toPandas().sort_values(ORDER).groupby("k", dropna=False):
        at = g.ts.astype("datetime64[us]").astype("int64") // 1000
        opens, _ = brute_windows(at, g.event_type != "view", g.event_type == "error", 3 * 3_600_000)
        want |= dict(zip(g.event_id, opens))
    assert {r["event_id"]: r["anchor"] for r in got.collect()} == want


def test_whole_keys_need_one_scan(ev):
    """Without a hot key the plan is the plain window's: one exchange, no join."""
    plan = session(ev, "ts", "1 hour", ["k"], order=ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan_chunks(ev, ["k"], "ts").split is False and plan_chunks(ev, ["k"], "ts", "auto:10:5").split


def test_join_keys(spark):
    a = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, a int")
    b = spark.createDataFrame([(None, 4), (2, 5), (7, 6)], "k int, b int")
    assert sorted(map(repr, map(tuple, join_keys(a, b, ["k"], "full").collect()))) == sorted(
        map(repr, [(None, 1, 4), (1, 2, None), (2, 3, 5), (7, None, 6)]))
    assert sorted(r.a for r in join_keys(a, b, ["k"], "left_semi").collect()) == [1, 3]
    assert [r.a for r in join_keys(a, b, ["k"], "left_anti").collect()] == [2]
