"""Skew-safe operators against brute-force references on a small driver table.

Every chunked primitive must equal the plain one-task-per-key window
function.  The ``hot`` variants put every row under one key (the worst case
the chunking exists for) and use tiny chunks so most rows sit near a border.
"""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF
from tidemark.operators import cep
from tidemark.operators.joins import asof_latest, interval_join
from tidemark.operators.sequence import neighbours, rows_frame, running, sequence_number
from tidemark.operators.transforms import range_frame
from tidemark.operators.windows import count_window, sliding, sliding_distinct


def rows(df, cols):
    def norm(v):
        return round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(norm(v) for v in r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def ev(spark):
    return spark.read.parquet(f"{SF}/events.parquet").withColumn("hot", F.lit(1))


@pytest.mark.parametrize("key,chunk", [("user_id", "1 hour"), ("hot", "10 minutes"), ("hot", "3 days")])
def test_neighbours(ev, key, chunk):
    got = neighbours(ev, [key], ["ts", "event_id"], ["value", "event_id"], prev=True, nxt=True, chunk=chunk)
    w = Window.partitionBy(key).orderBy("ts", "event_id")
    want = ev.select("*", F.lag("value").over(w).alias("prev_value"), F.lead("event_id").over(w).alias("next_event_id"))
    cols = ["event_id", "prev_value", "next_event_id"]
    assert rows(got, cols) == rows(want, cols)


@pytest.mark.parametrize("key,chunk", [("user_id", "1 hour"), ("hot", "10 minutes")])
def test_running(ev, key, chunk):
    specs = {"s": ("sum", "value"), "n": ("count", "value"), "mn": ("min", "value"), "mx": ("max", "value"),
             "f": ("first", F.when(F.col("event_type") == "view", F.col("event_id"))),
             "l": ("last", F.when(F.col("event_type") == "view", F.col("event_id")))}
    got = running(ev, [key], ["ts", "event_id"], specs, chunk=chunk)
    w = Window.partitionBy(key).orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    v = F.when(F.col("event_type") == "view", F.col("event_id"))
    want = ev.select("event_id", F.sum("value").over(w).alias("s"), F.count("value").over(w).alias("n"),
                     F.min("value").over(w).alias("mn"), F.max("value").over(w).alias("mx"),
                     F.first(v, True).over(w).alias("f"), F.last(v, True).over(w).alias("l"))
    cols = ["event_id", "s", "n", "mn", "mx", "f", "l"]
    assert rows(got, cols) == rows(want, cols)
    # reverse, strictly after: the nearest later view
    got_r = running(ev, [key], ["ts", "event_id"], {"nv": ("last", v)}, reverse=True, include_current=False,
                    chunk=chunk)
    wr = Window.partitionBy(key).orderBy("ts", "event_id").rowsBetween(1, Window.unboundedFollowing)
    want_r = ev.select("event_id", F.first(v, True).over(wr).alias("nv"))
    assert rows(got_r, ["event_id", "nv"]) == rows(want_r, ["event_id", "nv"])


def test_sequence_number_hot_key(ev):
    got = sequence_number(ev, ["hot"], ["ts", "event_id"], chunk="5 minutes")
    want = ev.select("event_id", F.row_number().over(Window.partitionBy("hot").orderBy("ts", "event_id")).alias("seq"))
    assert rows(got, ["event_id", "seq"]) == rows(want, ["event_id", "seq"])


@pytest.mark.parametrize("key,chunk", [("user_id", "1 hour"), ("hot", "20 minutes")])
def test_rows_frame(ev, key, chunk):
    got = rows_frame(ev, [key], ["ts", "event_id"], "value", 3, ("count", "sum", "avg", "min", "max"), chunk=chunk)
    w = Window.partitionBy(key).orderBy("ts", "event_id").rowsBetween(-3, 0)
    want = ev.select("event_id", F.count("value").over(w).alias("count"), F.sum("value").over(w).alias("sum"),
                     F.avg("value").over(w).alias("avg"), F.min("value").over(w).alias("min"),
                     F.max("value").over(w).alias("max"))
    cols = ["event_id", "count", "sum", "avg", "min", "max"]
    assert rows(got, cols) == rows(want, cols)


@pytest.mark.parametrize("key,chunk", [("user_id", "1 hour"), ("hot", "30 minutes")])
def test_range_frame(ev, key, chunk):
    got = range_frame(ev, [key], "ts", "value", "2 hours", chunk=chunk)
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    w = Window.partitionBy(key).orderBy("__us").rangeBetween(-7_200_000_000, 0)
    want = ev.withColumn("__us", us).select("event_id", F.count(F.lit(1)).over(w).alias("count"),
                                            F.sum("value").over(w).alias("sum"))
    assert rows(got, ["event_id", "count", "sum"]) == rows(want, ["event_id", "count", "sum"])


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("bucket", [None, "20 minutes"])
def test_interval_join(ev, how, bucket):
    a = ev.where("event_type = 'click'").select("user_id", F.col("event_id").alias("a_id"), F.col("ts").alias("a_ts"))
    b = ev.where("event_type = 'view'").select("user_id", F.col("event_id").alias("b_id"), F.col("ts").alias("b_ts"))
    got = interval_join(a, b, ["user_id"], "a_ts", "b_ts", "-3 hours", "1 hour", how=how, left_id="a_id",
                        right_id="b_id", bucket=bucket)
    cond = ((a.user_id == b.user_id) & (b.b_ts >= a.a_ts - F.expr("INTERVAL 3 HOURS"))
            & (b.b_ts <= a.a_ts + F.expr("INTERVAL 1 HOUR")))
    spark_how = {"inner": "inner", "left": "left", "right": "right", "full": "full"}[how]
    want = a.join(b, cond, spark_how)
    assert rows(got, ["a_id", "b_id"]) == rows(want, ["a_id", "b_id"])


def test_sliding_panes_equal_window(ev):
    got = sliding(ev, "ts", "1 hour", "10 minutes", keys=["event_type"],
                  measures={"count": ("count", None), "total": ("sum", "value"), "mx": ("max", "value")})
    w = ev.groupBy(F.window("ts", "1 hour", "10 minutes").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("count"), F.sum("value").alias("total"), F.max("value").alias("mx"))
    want = w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "count", "total", "mx")
    cols = ["window_start", "window_end", "event_type", "count", "total", "mx"]
    assert rows(got, cols) == rows(want, cols)
    gd = sliding_distinct(ev, "ts", "2 hours", "30 minutes", "user_id")
    wd = ev.groupBy(F.window("ts", "2 hours", "30 minutes").alias("w")).agg(
        F.count_distinct("user_id").alias("distinct_count")).select(
        F.col("w.end").alias("window_end"), "distinct_count")
    assert rows(gd, ["window_end", "distinct_count"]) == rows(wd, ["window_end", "distinct_count"])


def test_count_windows(ev):
    got = count_window(ev, ["hot"], ["ts", "event_id"], 7, value="value", chunk="2 hours")
    rn = ev.withColumn("rn", F.row_number().over(Window.partitionBy("hot").orderBy("ts", "event_id")))
    want = rn.groupBy(F.floor((F.col("rn") - 1) / 7).alias("window_index")).agg(
        F.count(F.lit(1)).alias("count"), F.sum("value").alias("sum")).where("count = 7")
    assert rows(got, ["window_index", "count", "sum"]) == rows(want, ["window_index", "count", "sum"])


def _brute_followed_by(pdf, within_s):
    out = set()
    for uid, g in pdf.sort_values(["ts", "event_id"]).groupby("user_id"):
        recs = list(g.itertuples(index=False))
        for i, r in enumerate(recs):
            if r.event_type != "signup":
                continue
            nxt = next((x for x in recs[i + 1:] if x.event_type == "purchase"), None)
            ok = nxt is not None and (nxt.ts - r.ts).total_seconds() < within_s
            out.add((uid, r.event_id, nxt.event_id if ok else None))
    return out


def test_followed_by_brute_force(ev):
    got = cep.followed_by(ev, "user_id", ["ts", "event_id"], F.col("event_type") == "signup",
                          F.col("event_type") == "purchase", "12 hours", ["event_id"], chunk="2 hours")
    g = {(r.user_id, r.first_event_id, r.second_event_id if r.matched else None) for r in got.collect()}
    assert g == _brute_followed_by(ev.select("user_id", "event_id", "ts", "event_type").toPandas(), 12 * 3600)


def test_asof_latest_hot_key(ev):
    facts = ev.where("event_type = 'view'").select("hot", "event_id", "ts")
    ups = ev.where("event_type = 'signup'").select("hot", "event_id", "ts", F.col("value").alias("thr"))
    got = asof_latest(facts, ups, ["hot"], "ts", ["ts", "event_id"], ["thr"], chunk="1 hour")
    w = Window.partitionBy("hot").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = ev.select("event_id", "event_type", F.last(F.when(F.col("event_type") == "signup", F.col("value")), True)
                     .over(w).alias("thr")).where("event_type = 'view'")
    assert rows(got, ["event_id", "thr"]) == rows(want, ["event_id", "thr"])


def test_sessions_chunked_equal_session_window(ev):
    from tidemark.operators.windows import session

    got = session(ev, "ts", "45 minutes", keys=["hot"], order=["ts", "event_id"], chunk="30 minutes")
    want = ev.groupBy("hot", F.session_window("ts", "45 minutes").alias("w")).agg(F.count(F.lit(1)).alias("count"))
    want = want.select("hot", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "count")
    cols = ["session_start", "session_end", "count"]
    assert rows(got, cols) == rows(want, cols)


@pytest.mark.parametrize("fn", ["neighbours", "running", "rows_frame"])
def test_auto_chunks_split_only_hot_keys(spark, ev, fn):
    """'auto': keys above tidemark.hotKeyRows get fine chunks, the rest stay whole."""
    spark.conf.set("tidemark.hotKeyRows", "200")       # key -1 (a third of the rows) is hot, users are not
    spark.conf.set("tidemark.chunkRows", "40")         # about 8 chunks for the hot key
    try:
        d = ev.withColumn("k", F.when(F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
        w = Window.partitionBy("k").orderBy("ts", "event_id")
        if fn == "neighbours":
            got = neighbours(d, ["k"], ["ts", "event_id"], ["value"], chunk="auto")
            want = d.select("event_id", F.lag("value").over(w).alias("prev_value"))
            cols = ["event_id", "prev_value"]
        elif fn == "running":
            got = running(d, ["k"], ["ts", "event_id"], {"s": ("sum", "value")}, chunk="auto")
            want = d.select("event_id", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
            cols = ["event_id", "s"]
        else:
            got = rows_frame(d, ["k"], ["ts", "event_id"], "value", 2, ("sum",), chunk="auto")
            want = d.select("event_id", F.sum("value").over(w.rowsBetween(-2, 0)).alias("sum"))
            cols = ["event_id", "sum"]
        assert rows(got, cols) == rows(want, cols)
    finally:
        spark.conf.unset("tidemark.hotKeyRows")
        spark.conf.unset("tidemark.chunkRows")


def test_rolling_max_by_earliest_on_ties(ev):
    from tidemark.operators.transforms import rolling_min_by

    d = ev.withColumn("v", F.floor(F.col("value") / 50))          # many ties
    got = rolling_min_by(d, "user_id", ["ts", "event_id"], "v", ["event_id"], largest=True)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    # earliest row holding the running maximum: max over (v, -position)
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    want = d.withColumn("pos", pos).select(
        "event_id", F.max(F.struct(F.col("v"), (-F.col("pos")).alias("np"), F.col("event_id"))).over(w).alias("m"))
    got_rows = rows(got.select("event_id", F.col("min_rec.event_id").alias("best")), ["event_id", "best"])
    want_rows = rows(want.select("event_id", F.col("m.event_id").alias("best")), ["event_id", "best"])
    assert got_rows == want_rows


def test_numbered_ranked_and_median_match_windows(spark):
    """One key holds half of the rows; ties and repeated rows included."""
    import statistics

    from tidemark.operators.ranking import exact_median, numbered, ranked

    rows = [("hot" if i % 2 else f"k{i % 5}", i % 37, i) for i in range(400)] + [("hot", 5, 5)] * 3 + [("one", 1, 1)]
    df = spark.createDataFrame(rows, "k string, v long, id long")
    got = numbered(df, ["k"], ["v", "id"], ["v"]).collect()
    for k in {r[0] for r in rows}:
        mine = sorted((r.row_num, -r.v, r.id) for r in got if r.k == k)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [m[1:] for m in mine] == sorted((-v, i) for kk, v, i in rows if kk == k)
    for r in ranked(df, ["k"], "v", ["id"]).collect():
        assert r.rnk == 1 + sum(1 for k, v, _ in rows if k == r.k and v > r.v)
    for r in exact_median(df, ["k"], "v").collect():
        values = [v for k, v, _ in rows if k == r.k]
        assert (r["min"], r["max"], r["median"], r["cnt"]) == (min(values), max(values), statistics.median(values), len(values))


def test_flat_select_gives_none_one_or_more_rows_per_match(spark):
    from tidemark.operators import cep

    matches = spark.createDataFrame([(1, []), (2, [5]), (3, [6, 7])], "k int, xs array<int>")
    rows = F.transform("xs", lambda x: F.struct(x.alias("x"), (x * 2).alias("twice")))
    got = cep.flat_select(matches, rows, ["k"]).collect()
    assert sorted(map(tuple, got)) == [(2, 5, 10), (3, 6, 12), (3, 7, 14)]
