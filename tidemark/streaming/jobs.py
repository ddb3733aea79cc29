"""Streaming twins of the batch jobs.

Every function takes a streaming DataFrame that already went through
:func:`tidemark.streaming.runner.event_time` (TIMESTAMP column + watermark)
and returns a streaming DataFrame; over closed windows / fired timers the
results equal the batch twins in tidemark.plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import duration_us
from tidemark.operators.windows import top_n
from tidemark.streaming import processors as P
from tidemark.streaming.keyed import run_keyed


def _us(d: str) -> int:
    return duration_us(d)


def _ms(d: str) -> int:
    return duration_us(d) // 1000


def window_counts(stream: DataFrame, ts: str, size: str, slide: str | None = None, keys=()) -> DataFrame:
    """W1/W2 + T3: windowed count in append mode (emitted when the watermark closes the window).

    Sliding windows whose slide divides the size are two chained window
    aggregations: rows are counted per slide-long pane, and each closed pane
    (at its ``window_time``) is added into the size/slide windows containing
    it, so raw rows are never copied.
    """
    if slide and duration_us(size) != duration_us(slide) and duration_us(size) % duration_us(slide) == 0:
        panes = stream.groupBy(F.window(ts, slide).alias("pw"), *keys).agg(F.count(F.lit(1)).alias("n"))
        out = panes.groupBy(F.window(F.window_time("pw"), size, slide).alias("w"), *keys).agg(
            F.sum("n").alias("count"))
    else:
        w = F.window(ts, size, slide) if slide else F.window(ts, size)
        out = stream.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("count"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys,
                      F.col("count").cast("long").alias("count"))


def top_n_per_batch(n: int, item: str, order_col: str = "count"):
    """W15 for streams: the closed windows of one micro-batch ranked per
    window end (all counts of a window arrive together in append mode)."""

    def rank(batch: DataFrame) -> DataFrame:
        return top_n(batch, ["window_end"], [F.col(order_col).desc(), F.col(item).asc()], n).select(
            "window_end", item, order_col, "rank")

    return rank


def distinct_users_per_window(stream: DataFrame, ts: str, size: str, user: str) -> DataFrame:
    """D4 stream, first stage: one row per (window, user) once the window closes."""
    return stream.groupBy(F.window(ts, size).alias("w"), user).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), user)


def temperature_jump(stream: DataFrame, threshold: float, max_silence: str | None = None,
                     ttl: str | None = None, hold: bool = False) -> DataFrame:
    """D15/D22/T11 via value state (+ clean-up timer, or T14 state TTL on the processing clock).

    ``hold`` orders the readings behind the watermark; without it they count as they arrive."""
    clock = {"hold": False, "clock": "processing"} if ttl else {"hold": hold}
    proc = P.TemperatureJump(threshold, _us(max_silence) if max_silence else None,
                             ttl_ms=_ms(ttl) if ttl else None, **clock)
    return run_keyed(stream.withColumn("at", F.unix_micros("ts")), ["sensor_id"], proc,
                     "sensor_id long, ts timestamp, last_temp double, temperature double")


def running_statistics(stream: DataFrame) -> DataFrame:
    """Minimum, count, sum and mean so far per sensor, one row per reading."""
    return run_keyed(stream, ["sensor_id"], P.RunningStatistics(),
                     "event_id long, sensor_id long, min_temp double, n long, total double, avg_temp double")


def click_fraud(stream: DataFrame, max_clicks: int, cols: list[str], event_time_col: str | None = None,
                hold: bool = False) -> DataFrame:
    """D8 via map state (clicks per day) and a timer at the end of each day.  With ``event_time_col`` (one
    of ``cols``) the output keeps the watermark, so a windowed aggregation
    can follow (D7 after D8).  ``hold`` orders the clicks behind the watermark."""
    types = {f.name: f.dataType.simpleString() for f in stream.select(*cols).schema.fields}
    schema = stream.select(*cols).schema.add("status", "string")
    keys = ["user_id", "ad_id"]
    return run_keyed(stream, keys, P.ClickFraudFilter(max_clicks, types, keys, hold=hold), schema, event_time_col or "")


def login_fail(stream: DataFrame, gap: str) -> DataFrame:
    """D9 via value state, rows in event-time order."""
    return run_keyed(stream, ["user_id"], P.LoginFailState(_us(gap)),
                     "user_id long, first_fail_time timestamp, last_fail_time timestamp")


def order_pay(stream: DataFrame, timeout: str, grace: str | None = None) -> DataFrame:
    """D12 via value state and event-time timers (input: order_id, ts, event_type);
    ``grace`` (default: ``timeout``) is how long a partner may be out of order."""
    return run_keyed(stream, ["order_id"], P.PaymentCheck(_ms(timeout), _ms(grace or timeout)),
                     "order_id long, result_msg string")


def tx_match(stream: DataFrame, bound: str) -> DataFrame:
    """Tagged union (tx_id, ts, side, seq) through a two-sided keyed state."""
    return run_keyed(stream, ["tx_id"], P.TxMatch(_us(bound)),
                     "tx_id long, pay_time timestamp, receipt_time timestamp, tag string")


def continuous_rise(stream: DataFrame, duration: str) -> DataFrame:
    """D16 with event-time timers (re-arms after each alert, as the reference)."""
    return run_keyed(stream, ["sensor_id"], P.ContinuousRise(_ms(duration)), "sensor_id long, alert_time timestamp")


def match_sequence(stream: DataFrame, key: str, ident: str, stages, within: str | None = None,
                   emit_timeouts: bool = False) -> DataFrame:
    """A pattern of any number of stages, the twin of :func:`tidemark.operators.cep.match_sequence`.

    ``stages`` = [(name, condition, contiguity)].  One row per match: ``key``, ``<name>_id``
    and ``<name>_ts`` per stage and ``matched`` (false for time-outs).  Ties of time go by
    ``ident``.  Conditions are columns: rows are reduced to one bit per stage before they
    are grouped, and rows that meet none are dropped unless a ``next`` stage needs them.
    """
    bits = [F.when(cond, F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, cond, _) in enumerate(stages)]
    meets = bits[0]
    for b in bits[1:]:
        meets = meets.bitwiseOR(b)
    rows = stream.select(key, "ts", F.col(ident).alias("ident"), meets.cast("long").alias("meets"))
    if not any(c == "next" for _, _, c in stages[1:]):
        # mentions the event time, or Catalyst would drop rows below the watermark operator,
        # which they move on
        rows = rows.where(F.when(F.col("meets") != 0, F.col("ts")).isNotNull())
    ktype, itype = (stream.schema[c].dataType.simpleString() for c in (key, ident))
    names = [n for n, _, _ in stages]
    proc = P.PatternMatcher(names, [c for _, _, c in stages], _us(within) if within else None, key, itype,
                            emit_timeouts)
    columns = ", ".join(f"{n}_id {itype}, {n}_ts timestamp" for n in names)
    return run_keyed(rows, [key], proc, f"{key} {ktype}, {columns}, matched boolean")


def pattern(stream: DataFrame, key: str, first, second, contiguity: str, within: str | None,
            emit_timeouts: bool = False) -> DataFrame:
    """Two stages of :func:`match_sequence` over rows with a ``seq`` tie-break column."""
    out = match_sequence(stream, key, "seq", [("first", first, ""), ("second", second, contiguity)], within,
                         emit_timeouts)
    return out.select(key, "first_ts", "second_ts", "matched")


def switch_gate(stream: DataFrame, duration: str, clock: str = "event") -> DataFrame:
    """J3 (and T10): facts of a key are forwarded while its latest switch is less than
    ``duration`` old; tagged union (user_id, ts, event_id, kind in {switch, fact}).

    ``clock="processing"``: rows happen when they arrive and a processing-time timer closes
    the gate.  ``clock="event"``: the same processor over event time."""
    proc = P.SwitchGate(_us(duration), hold=clock == "event", clock=clock)
    return run_keyed(stream, ["user_id"], proc, "event_id long, user_id long, ts timestamp, opened_at timestamp")


def count_window(stream: DataFrame, key: str, value: str, size: int, slide: int) -> DataFrame:
    """Count windows per key in event-time order (ties by ``event_id``)."""
    ktype = stream.schema[key].dataType.simpleString()
    rows = stream.select(key, "ts", "event_id", F.col(value).cast("double").alias("value"))
    return run_keyed(rows, [key], P.CountWindow(size, slide, key),
                     f"{key} {ktype}, fire_at_row long, count long, sum double, min double, max double")


def triggered_window(stream: DataFrame, key: str, value: str, size: str, trigger: P.CountTrigger) -> DataFrame:
    """Tumbling windows with a trigger per element."""
    ktype = stream.schema[key].dataType.simpleString()
    rows = stream.select(key, F.window("ts", size)["start"].alias("window_start"), "ts", "event_id",
                         F.col(value).cast("double").alias("value"))
    return run_keyed(rows, [key, "window_start"], P.TriggeredWindow(_us(size), trigger),
                     f"{key} {ktype}, window_start timestamp, firing long, count long, sum double")


def window_sides(left: DataFrame, right: DataFrame, key: str, size: str, pairs: bool, names=("left_id", "right_id")
                 ) -> DataFrame:
    """J5/J6 between two streams (each ``key``, ``ts``, ``ident``) that share one watermark: their
    union is aggregated per (key, window), and both sides' ids are handed over once, when the
    watermark has passed the window's end; either side may be empty.

    ``pairs``: every left with every right row (J5); otherwise one row with both sides (J6)."""
    both = left.select(key, "ts", "ident", F.lit("left").alias("side")).unionByName(
        right.select(key, "ts", "ident", F.lit("right").alias("side")))
    # in a struct, so that a null id is collected too
    ids = [F.collect_list(F.when(F.col("side") == s, F.struct("ident"))).alias(n)
           for s, n in zip(("left", "right"), names)]
    sides = both.groupBy(F.window("ts", size).alias("w"), key).agg(*ids).select(
        key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *[F.array_sort(F.col(n)["ident"]).alias(n) for n in names])
    if not pairs:
        return sides
    one, two = names
    return sides.withColumn(one, F.explode(one)).withColumn(two, F.explode(two))


def tag_late(stream: DataFrame, ts: str, delay: str, out: str, checkpoint: str):
    """Rows behind the watermark tagged ``late`` (side output) instead of dropped."""
    from tidemark.streaming.late import split_late

    return split_late(stream, ts, delay, out, checkpoint)


def login_fail_timer(stream: DataFrame, window: str, min_fails: int = 2) -> DataFrame:
    """At least ``min_fails`` fails within ``window`` of the first, no success between."""
    return run_keyed(stream, ["user_id"], P.LoginFailTimer(_ms(window), min_fails),
                     "user_id long, first_fail_time timestamp, last_fail_time timestamp, fails long")


def with_processing_time(stream: DataFrame, col: str = "proc_time", clock: Column | None = None) -> DataFrame:
    """Processing time as a column; windows and watermarks on it give processing-time
    windows.  The clock is the micro-batch's, or is handed in for an exact replay."""
    return stream.withColumn(col, F.current_timestamp() if clock is None else clock)


def with_ingestion_time(stream: DataFrame, col: str = "ingest_time") -> DataFrame:
    """T1 ingestion time: stamped once at the source, then used as event time."""
    return stream.withColumn(col, F.current_timestamp())


def dynamic_threshold(stream: DataFrame) -> DataFrame:
    """D21/J7 live rules: tagged union (sensor_id, ts, event_id, kind, value) in event-time
    order through one keyed state holding the threshold and the last temperature."""
    return run_keyed(stream, ["sensor_id"], P.DynamicThreshold(),
                     "sensor_id long, event_id long, temperature double, threshold double, temp_diff double")


def interval_join_streams(left: DataFrame, right: DataFrame, keys, left_ts: str, right_ts: str,
                          lower: str, upper: str) -> DataFrame:
    """J4/D20 between two streams: equal keys and right_ts in
    [left_ts + lower, left_ts + upper].  Both inputs carry watermarks; the
    time bound lets Spark drop join state once the watermark passes it."""
    cond = [left[k] == right[k] for k in keys]
    lo = F.expr(f"INTERVAL {duration_us(lower) // 1_000_000} SECONDS")
    hi = F.expr(f"INTERVAL {duration_us(upper) // 1_000_000} SECONDS")
    cond.append(right[right_ts] >= left[left_ts] + lo)
    cond.append(right[right_ts] <= left[left_ts] + hi)
    out = left.join(right, cond, "inner")
    return out.drop(*[right[k] for k in keys])


def window_aggregate(stream: DataFrame, ts: str, size: str, keys, aggs) -> DataFrame:
    """Tumbling-window aggregates in append mode."""
    out = stream.groupBy(F.window(ts, size).alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys,
                      *[c for c in out.columns if c not in ("w", *keys)])
