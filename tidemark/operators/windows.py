"""Event-time windows, pane pre-aggregation, count windows and Top-N.

Alignment follows the reference's assigners and Spark's ``F.window``: windows
are epoch aligned, left-closed right-open, start at multiples of the slide
(plus an optional offset), and empty windows are never produced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timefns import bucket_of, duration_us, epoch_us, interval, is_ntz
from tidemark.operators.keys import join_keys
from tidemark.operators.sequence import DEFAULT_CHUNK, neighbours, plan_chunks, running, sequence_number

# Mergeable measure kinds: partial results of panes can be combined.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _ts_from_us(us: Column, ntz: bool) -> Column:
    if ntz:
        return F.timestamp_add("MICROSECOND", us, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.timestamp_micros(us)


def _measure(kind: str, col: str | Column | None) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if kind == "count":
        return F.count(F.lit(1)) if c is None else F.count(c)
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](c)


def tumbling(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str] = (),
    aggs: Sequence[Column] = (),
    offset: str | None = None,
) -> DataFrame:
    """Tumbling event-time window aggregate; adds window_start / window_end."""
    w = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    aggs = list(aggs) or [F.count(F.lit(1)).alias("count")]
    out = df.groupBy(w.alias("w"), *keys).agg(*aggs)
    return out.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *keys, *[c for c in out.columns if c not in ("w", *keys)],
    )


def sliding(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    measures: dict[str, tuple[str, str | Column | None]] | None = None,
    offset: str | None = None,
) -> DataFrame:
    """Sliding window aggregate of mergeable measures via panes.

    Rows are first aggregated per (key, pane) where a pane is one slide
    long; then every pane is copied to the ``size/slide`` windows that contain
    it and merged.  Raw rows are never multiplied: the copy works on pane
    partials, which is what makes 1 h / 5 s windows (720 copies) affordable.
    When the slide does not divide the size the built-in ``F.window`` is used.
    """
    measures = measures or {"count": ("count", None)}
    keys = list(keys)
    size_us, slide_us = duration_us(size), duration_us(slide)
    off_us = duration_us(offset) if offset else 0
    ntz = is_ntz(df, ts)
    if size_us % slide_us != 0 or size_us == slide_us:
        w = F.window(ts, size, slide, offset) if offset else F.window(ts, size, slide)
        out = df.groupBy(w.alias("w"), *keys).agg(
            *[_measure(k, c).alias(n) for n, (k, c) in measures.items()]
        )
        return out.select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            *keys, *measures.keys(),
        )
    k = size_us // slide_us
    panes = df.groupBy(*keys, bucket_of(df, ts, slide, offset or 0).alias("__pane")).agg(
        *[_measure(kind, c).alias(n) for n, (kind, c) in measures.items()]
    )
    # window index = index of its last pane; pane p lies in windows p .. p+k-1
    expanded = panes.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn(
        "__last", F.col("__pane") + F.col("__j")
    )
    out = expanded.groupBy(*keys, "__last").agg(
        *[_MERGE[kind](F.col(n)).alias(n) for n, (kind, _) in measures.items()]
    )
    end_us = (F.col("__last") + 1) * F.lit(slide_us) + F.lit(off_us)
    return out.select(
        _ts_from_us(end_us - F.lit(size_us), ntz).alias("window_start"),
        _ts_from_us(end_us, ntz).alias("window_end"),
        *keys,
        *[F.col(n).cast("long") if measures[n][0] == "count" else F.col(n) for n in measures],
    )


def sliding_distinct(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    value: str,
    keys: Sequence[str] = (),
    name: str = "distinct_count",
) -> DataFrame:
    """Exact distinct count of ``value`` per sliding window.

    De-duplicates (key, pane, value) first -- the shuffle carries each value
    once per pane -- then expands panes to windows and de-duplicates again.
    """
    keys = list(keys)
    size_us, slide_us = duration_us(size), duration_us(slide)
    ntz = is_ntz(df, ts)
    if size_us % slide_us != 0:
        raise ValueError("slide must divide size")
    k = size_us // slide_us
    panes = df.select(*keys, value, bucket_of(df, ts, slide).alias("__pane")).distinct()
    out = (
        panes.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        .withColumn("__last", F.col("__pane") + F.col("__j"))
        .groupBy(*keys, "__last")
        .agg(F.count_distinct(value).alias(name))
    )
    end_us = (F.col("__last") + 1) * F.lit(slide_us)
    return out.select(
        _ts_from_us(end_us - F.lit(size_us), ntz).alias("window_start"),
        _ts_from_us(end_us, ntz).alias("window_end"),
        *keys, F.col(name).cast("long").alias(name),
    )


def session(
    df: DataFrame,
    ts: str,
    gap: str,
    keys: Sequence[str] = (),
    aggs: Sequence[Column] = (),
    order: Sequence[str] | None = None,
    chunk: str = DEFAULT_CHUNK,
) -> DataFrame:
    """Session windows: a new session starts after more than ``gap`` without events.

    Batch: the break flag comes from the chunked ``lag`` and the session id
    from the chunked running count of breaks, then one hash aggregation per
    (key, session) -- a user with a third of all events is never gathered
    into one task.  Streams use ``F.session_window`` (same semantics: two
    events exactly ``gap`` apart share a session).
    """
    aggs = list(aggs) or [F.count(F.lit(1)).alias("count")]
    keys = list(keys)
    if df.isStreaming:
        out = df.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(*aggs)
        return out.select(
            *keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
            *[c for c in out.columns if c not in ("w", *keys)],
        )
    order = list(order or [ts])
    chunks = plan_chunks(df, keys, ts, chunk)  # both scans cut the keys alike
    n = neighbours(df, keys, order, [ts], prev=True, chunk=chunks, prefix_prev="__sp_")
    brk = F.col(f"__sp_{ts}").isNull() | (F.col(ts) > F.col(f"__sp_{ts}") + interval(gap))
    sid = running(n.withColumn("__brk", brk), keys, order,
                  {"__sid": ("count", F.when(F.col("__brk"), F.lit(1)))}, chunk=chunks)
    out = sid.groupBy(*keys, "__sid").agg(F.min(ts).alias("session_start"),
                                          (F.max(ts) + interval(gap)).alias("session_end"), *aggs)
    return out.drop("__sid")


def count_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    slide: int | None = None,
    value: str | None = None,
    chunk: str = DEFAULT_CHUNK,
) -> DataFrame:
    """Row-count windows per key (``countWindow(size[, slide])``).

    Tumbling: rows 1..size, size+1..2*size, ... of each key; only full
    windows fire, as in the reference.  Sliding: a window fires every
    ``slide`` rows and covers the last ``size`` rows (fewer at the start).
    The per-key position comes from the chunked :func:`sequence_number`.
    """
    keys = list(keys)
    seq = sequence_number(df, keys, order, name="__seq", chunk=chunk)
    v = F.col(value) if value else F.lit(1)
    if slide is None:
        g = seq.withColumn("__win", F.floor((F.col("__seq") - 1) / size))
        out = g.groupBy(*keys, "__win").agg(
            F.count(F.lit(1)).alias("count"), F.sum(v).alias("sum"),
            F.min(v).alias("min"), F.max(v).alias("max"),
        )
        return out.where(F.col("count") == size).select(
            *keys, F.col("__win").cast("long").alias("window_index"), "count", "sum", "min", "max"
        )
    # sliding: the window fired at row f (a multiple of slide) covers rows (f - size, f]
    last = seq.groupBy(*keys).agg(F.max("__seq").alias("__n"))
    if size % slide == 0:
        # panes of ``slide`` rows: aggregate each pane once, copy pane partials
        # to the size/slide windows containing them (raw rows are not copied)
        k = size // slide
        panes = seq.groupBy(*keys, F.floor((F.col("__seq") - 1) / slide).alias("__p")).agg(
            F.count(F.lit(1)).alias("count"), F.sum(v).alias("sum"), F.min(v).alias("min"), F.max(v).alias("max"))
        ex = panes.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn(
            "__fire", (F.col("__p") + F.col("__j") + 1) * slide)
        out = ex.groupBy(*keys, "__fire").agg(
            F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.min("min").alias("min"),
            F.max("max").alias("max"))
    else:
        reps = -(-size // slide)
        g = seq.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(reps - 1)))).withColumn(
            "__fire", (F.floor((F.col("__seq") - 1) / slide) + 1 + F.col("__i")) * slide
        )
        g = g.where((F.col("__fire") - F.col("__seq") < size) & (F.col("__fire") >= F.col("__seq")))
        out = g.groupBy(*keys, "__fire").agg(
            F.count(F.lit(1)).alias("count"), F.sum(v).alias("sum"),
            F.min(v).alias("min"), F.max(v).alias("max"),
        )
    # only windows whose firing row exists
    out = join_keys(out, last, keys) if keys else out.crossJoin(last)  # one row without keys
    out = out.where(F.col("__fire") <= F.col("__n"))
    return out.select(*keys, F.col("__fire").cast("long").alias("fire_at_row"),
                      F.col("count").cast("long").alias("count"), "sum", "min", "max")


def top_n(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Top ``n`` rows per partition, ``row_number`` semantics.

    ``row_number() <= n`` is planned by Catalyst with a partial
    WindowGroupLimit before the shuffle, so a huge partition (one window end
    holding every item) sends at most ``n`` rows per map task.  Callers pass
    a unique tie-break as the last ordering column.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return (
        df.withColumn(rank_col, F.row_number().over(w))
        .where(F.col(rank_col) <= n)
        .withColumn(rank_col, F.col(rank_col).cast("long"))
    )


def window_time(end: Column) -> Column:
    """Row time of a window result: its end minus one microsecond."""
    return end - F.expr("INTERVAL 1 MICROSECOND")


__all__ = [
    "tumbling", "sliding", "sliding_distinct", "session", "count_window", "top_n",
    "window_time", "epoch_us",
]
