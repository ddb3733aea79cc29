"""Stateless transformations, routing, partitioning and rolling aggregates (P, R, A).

Routing operators (split/select, side outputs) return ONE DataFrame with a
tag column; a consumer filters per tag.  In a stream the fan-out happens in
``foreachBatch`` on a persisted batch (see tidemark.sinks.writers).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timefns import duration_us, epoch_us
from tidemark.session import ship_package
from tidemark.operators.sequence import DEFAULT_CHUNK, plan_chunks, running

# --- P ---------------------------------------------------------------------


def filter_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Keep rows whose ``col`` (as text) starts with ``prefix``."""
    return df.where(F.col(col).cast("string").startswith(prefix))


def flat_map_split(df: DataFrame, col: str, sep: str, out: str = "token") -> DataFrame:
    """One output row per piece of ``col`` split on the regex ``sep``."""
    return df.withColumn(out, F.explode(F.split(F.col(col), sep)))


def split_streams(df: DataFrame, routes: dict[str, Column]) -> DataFrame:
    """A row goes to every named output whose condition holds (0..n copies)."""
    tags = F.array(*[F.when(cond, F.lit(name)) for name, cond in routes.items()])
    return df.withColumn("stream", F.explode(F.filter(tags, lambda t: t.isNotNull())))


def side_output(df: DataFrame, main: Column, side_tag: str, main_tag: str = "main") -> DataFrame:
    """Rows meeting ``main`` are tagged main, the rest go to the side output."""
    return df.withColumn("tag", F.when(main, F.lit(main_tag)).otherwise(F.lit(side_tag)))


def forward_with_alarm(df: DataFrame, alarm: Column, tag: str = "alarm") -> DataFrame:
    """D19 form: every row is forwarded (tag main) and alarm rows are copied to ``tag``."""
    return split_streams(df, {"main": F.lit(True), tag: alarm}).withColumnRenamed("stream", "tag")


def rich_map(df: DataFrame, low: float = 10.0, high: float = 100.0, shards: int = 7) -> DataFrame:
    """A "rich" function whose set-up runs once per partition (``open``).

    ``mapInPandas`` receives Arrow batches of a whole partition; the lookup
    table below is built once per task, then applied vectorised.
    """

    def per_partition(batches):
        bins = [-float("inf"), low, high, float("inf")]     # set-up ("open")
        labels = ["low", "mid", "high"]
        for pdf in batches:
            level = pd.cut(pdf["value"], bins=bins, labels=labels, right=False).astype(str)
            yield pd.DataFrame({"event_id": pdf["event_id"], "level": level,
                                "shard": (pdf["user_id"] % shards).astype("int64")})

    ship_package(df.sparkSession)
    return df.mapInPandas(per_partition, "event_id long, level string, shard long")


# --- R ---------------------------------------------------------------------


def key_by(df: DataFrame, keys: Sequence[str], n: int | None = None) -> DataFrame:
    """Hash-partition by key (what ``keyBy`` does before a keyed operator)."""
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """R2: round-robin to ``n`` partitions."""
    return df.repartition(n)


def shuffle_random(df: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """R2 ``shuffle``: random partition per row."""
    return df.repartition(n, F.rand(seed))


def rescale(df: DataFrame, n: int) -> DataFrame:
    """R2 ``rescale``: merge neighbouring partitions without a shuffle."""
    return df.coalesce(n)


def to_single_task(df: DataFrame) -> DataFrame:
    """R4 ``global``: everything in one partition.  Only for small, bounded
    inputs (a final report), never for raw data."""
    return df.coalesce(1)


def partition_custom(df: DataFrame, partition_id: Column, n: int) -> DataFrame:
    """Rows go to the partition number computed by ``partition_id``."""
    if hasattr(df, "repartitionById"):
        return df.repartitionById(n, partition_id.cast("int"))
    return df.repartition(n, partition_id)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a side that is usually small.

    No forced broadcast: the measured size of ``small`` against
    ``spark.sql.autoBroadcastJoinThreshold`` decides at run time (adaptive
    execution), beyond it both sides are shuffled and hot keys are split.
    """
    return big.join(small, on, how)


# --- A ---------------------------------------------------------------------


def word_count(df: DataFrame, col: str = "value", sep: str = r"\s+") -> DataFrame:
    """A1: words per text split on ``sep``; partial counts are combined map-side,
    so a very frequent word costs no more than a rare one."""
    words = df.select(F.explode(F.split(F.col(col), sep)).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def rolling(df: DataFrame, key, order: Sequence[str], specs: dict, chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """A3: one output per input row with the key's running aggregates so far."""
    return running(df, key, order, specs, chunk=chunk)


def rolling_min_by(df: DataFrame, key, order: Sequence[str], value: str, extra: Sequence[str] = (),
                   out: str = "min_rec", largest: bool = False, chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """A4 ``minBy``/``maxBy``: the whole record holding the smallest (largest)
    value so far; among equal values the earliest record wins."""
    fields = [value] + [c for c in order if c != value] + [c for c in extra if c not in order and c != value]
    if largest:
        # max over (value, -order) keeps the earliest among equal maxima
        rec = F.struct(F.col(value).alias(value),
                       *[(-epoch_us(df, c) if c in order and df.schema[c].dataType.typeName().startswith("timestamp")
                          else (-F.col(c) if c in order else F.col(c))).alias(f"__o_{c}") for c in fields[1:]],
                       *[F.col(c).alias(c) for c in fields[1:]])
        kind = "max"
    else:
        rec = F.struct(*[F.col(c).alias(c) for c in fields])
        kind = "min"
    res = running(df, key, order, {out: (kind, rec)}, chunk=chunk)
    if largest:
        res = res.withColumn(out, F.struct(*[F.col(f"{out}.{c}").alias(c) for c in fields]))
    return res


def rolling_reduce_min(df: DataFrame, key, order: Sequence[str], value: str, ts: str = "ts",
                       chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """A5 ``reduce((a, b) => (b.id, b.ts + 1, min(a.temp, b.temp)))``: the first
    row of a key passes unchanged, later rows carry ts + 1 s and the running min."""
    res = running(df, key, order, {"min_value": ("min", value), "__n": ("count", F.lit(1))}, chunk=chunk)
    ts_out = F.when(F.col("__n") == 1, F.col(ts)).otherwise(F.col(ts) + F.expr("INTERVAL 1 SECOND"))
    return res.withColumn("ts_out", ts_out).drop("__n")


def per_task_count_if(df: DataFrame, cond: Column, task: Column, tasks: int) -> DataFrame:
    """Per-task counter (operator list state): rows meeting ``cond`` per task.

    ``task`` (0 to ``tasks`` - 1) deals the rows; the counter of a task is read off the
    partition the rows are in.
    """
    dealt = partition_custom(df.select(cond.alias("hit"), task.alias("task")), F.col("task"), tasks)
    return dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count_if("hit").alias("count"))


# --- bounded RANGE frames --------------------------------------------------


def range_frame(df: DataFrame, keys: Sequence[str], ts: str, value: str, rng: str,
                chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """W13 ``RANGE BETWEEN rng PRECEDING AND CURRENT ROW``: count and sum.

    Keys are cut where their rows are dense (:func:`plan_chunks`): each hot key into ranges of
    time that hold about as many rows each, at least ``rng`` wide; other keys stay whole.
    The rows within ``rng`` of a range's end are copied into the next one as read-only
    "halo" rows, so every frame lies inside one (key, range) partition and a row has at most
    one copy.
    """
    keys, r_us = list(keys), duration_us(rng)
    chunks = plan_chunks(df, keys, ts, chunk)
    d = chunks.add(df, least=r_us, keep_width=True).withColumn("__us", epoch_us(df, ts))
    part = keys
    if chunks.split:
        part = [*keys, "__chunk"]
        d = d.withColumn("__halo", F.lit(False))
        end = (F.col("__chunk") + 1) * F.col("__width")
        d = d.unionByName(d.where(F.col("__us") >= end - r_us).withColumn("__chunk", F.col("__chunk") + 1)
                          .withColumn("__halo", F.lit(True)))
    w = Window.partitionBy(*part).orderBy("__us").rangeBetween(-r_us, 0)
    out = d.withColumn("count", F.count(F.lit(1)).over(w)).withColumn("sum", F.sum(value).over(w))
    return (out.where(~F.col("__halo")).drop("__halo") if chunks.split else out).drop("__us", "__chunk", "__width")
