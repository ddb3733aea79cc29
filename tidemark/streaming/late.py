"""Allowed lateness with repeated firing and ranking, and late rows to a side output.

Spark drops rows behind the watermark only inside stateful operators and
exposes no late-row output.  This ``foreachBatch`` writer keeps its own
watermark exactly as Spark defines it -- the largest event time of all
earlier micro-batches minus the allowed delay -- in one tiny file per batch,
and tags every row ``late`` or ``on_time``.  Each batch rewrites only its own
output and watermark file, so a replayed batch gives the same result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import duration_us
from tidemark.operators.windows import top_n
from tidemark.session import scratch_path
from tidemark.streaming.processors import RunningCount
from tidemark.streaming.runner import ensure_state_store, run_to_parquet


class LateSplitter:
    def __init__(self, out: str, ts: str, delay: str):
        self.out = out
        self.ts = ts
        self.delay_us = duration_us(delay)

    def _max_until(self, spark, batch_id: int):
        if batch_id == 0:
            return None
        return spark.read.parquet(f"{self.out}/_wm/batch_id={batch_id - 1}").first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # written and measured
        prev = self._max_until(spark, batch_id)
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        if prev is None:
            tag = F.lit("on_time")
        else:
            tag = F.when(us < F.lit(prev - self.delay_us), "late").otherwise("on_time")
        batch.withColumn("tag", tag).write.mode("overwrite").parquet(f"{self.out}/data/batch_id={batch_id}")
        cur = batch.agg(F.max(us).alias("m")).first()["m"]
        new = max(x for x in (prev, cur) if x is not None) if (prev is not None or cur is not None) else None
        spark.createDataFrame([(new,)], "max_us long").write.mode("overwrite").parquet(
            f"{self.out}/_wm/batch_id={batch_id}")
        batch.unpersist()


def split_late(stream: DataFrame, ts: str, delay: str, out: str, checkpoint: str, available_now: bool = True):
    """Start the query; results are read back with :func:`read_tagged`."""
    w = stream.writeStream.foreachBatch(LateSplitter(out, ts, delay)).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.queryName(f"late_{uuid.uuid4().hex[:8]}").start()


def read_tagged(spark, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/data").drop("batch_id")


class AllowedLateness:
    """Window counts that fire at the watermark and again for allowed late rows.

    The watermark of a micro-batch is the largest event time of the batches before it minus
    ``delay``.  A window fires (``first``) when the watermark passes its end; a batch that
    adds to a fired window fires it again (``update``) until ``lateness`` after its end, when
    it is forgotten; rows of forgotten windows are dropped.  The end of the input fires the
    windows that are left.

    With ``slide`` (a divisor of ``size``) the windows overlap: increments are kept per
    slide-long pane and added into the windows that hold the pane.

    State is increments: a batch writes the counts it adds, and nothing is ever rewritten.
    A window's count is the sum of its increments, and whether it has fired follows from the
    watermarks; increments of forgotten windows are not read again.  A batch reads the
    windows it adds to or that fall due.  A repeated batch rewrites its own increments only,
    so it gives the same result.  A null key is a key.
    """

    def __init__(self, spark, keys: list[str], ts: str, size: str, delay: str, lateness: str, slide: str | None = None):
        self.spark, self.keys, self.ts = spark, keys, ts
        self.size_us, self.delay_us, self.late_us = duration_us(size), duration_us(delay), duration_us(lateness)
        self.slide_us = duration_us(slide or size)
        if self.size_us % self.slide_us:
            raise ValueError("the slide must divide the size")
        self.out = scratch_path(spark, "lateness")
        self.added = None

    def _marks(self, batch_id: int) -> list[tuple[int, int | None, int | None]]:
        """(batch, largest event time up to it, end of its latest window) of the batches that a
        batch found open, itself last: what it wrote."""
        if batch_id < 0:
            return []
        rows = self.spark.read.parquet(f"{self.out}/wm/batch_id={batch_id}").collect()  # one row per open batch
        return sorted((r["batch"], r["top"], r["last"]) for r in rows)

    def _counts(self, marks: list, batch_id: int, alive: int | None) -> DataFrame:
        """Per open window and key: ``before`` (counts of the batches before) and ``now``."""
        read = [b for b, _, last in marks if last is not None and (alive is None or last > alive)]
        rows = self.spark.createDataFrame([], self.added)
        if read:
            rows = self.spark.read.schema(self.added).parquet(*[f"{self.out}/added/batch_id={b}" for b in read])
        ends = [F.col("pane_us") + i * self.slide_us for i in range(self.size_us // self.slide_us)]
        rows = rows.groupBy("pane_us", "batch", *self.keys).agg(F.sum("added").alias("added"))
        rows = rows.withColumn("end_us", ends[0] if len(ends) == 1 else F.explode(F.array(*ends)))
        if alive is not None:
            rows = rows.where(F.col("end_us") > alive)
        return rows.groupBy("end_us", *self.keys).agg(
            F.coalesce(F.sum(F.when(F.col("batch") < batch_id, F.col("added"))), F.lit(0)).alias("before"),
            F.coalesce(F.sum(F.when(F.col("batch") == batch_id, F.col("added"))), F.lit(0)).alias("now"))

    def _emit(self, counts: DataFrame, emission) -> DataFrame:
        return counts.select(F.timestamp_micros(F.col("end_us") - self.size_us).alias("window_start"), *self.keys,
                             (F.col("before") + F.col("now")).alias("count"), emission.alias("emission"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        marks = self._marks(batch_id - 1)
        top = marks[-1][1] if marks else None
        passed = None if top is None else top - self.delay_us
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        pane = us - F.pmod(us, F.lit(self.slide_us)) + self.slide_us
        reach = self.size_us - self.slide_us  # from a pane's end to the end of its latest window
        rows = batch.groupBy(pane.alias("pane_us"), *self.keys).agg(
            F.count(F.lit(1)).alias("added"), F.max(us).alias("__top"))
        rows = rows.withColumn("batch", F.lit(batch_id).cast("long")).persist()
        alive = None if passed is None else passed - self.late_us
        kept = rows if alive is None else rows.where(F.col("pane_us") + reach > alive)
        kept = kept.drop("__top")
        self.added = kept.schema
        kept.write.mode("overwrite").parquet(f"{self.out}/added/batch_id={batch_id}")
        seen, last = rows.agg(F.max("__top"), F.max("pane_us") + reach).first()
        rows.unpersist()
        top = max((t for t in (top, seen) if t is not None), default=None)
        marks = [m for m in marks if m[2] is not None and (alive is None or m[2] > alive)] + [(batch_id, top, last)]
        self.spark.createDataFrame(marks, "batch long, top long, last long").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.out}/wm/batch_id={batch_id}")
        counts = self._counts(marks, batch_id, alive)
        counts = counts.where(F.lit(False) if top is None else F.col("end_us") <= top - self.delay_us)
        self._fire(counts, passed).write.mode("overwrite").parquet(f"{self.out}/emitted/batch_id={batch_id}")
        self.last = batch_id

    def _fire(self, due: DataFrame, passed: int | None) -> DataFrame:
        """What a batch emits of the windows that are due after it; ``passed`` is the watermark before it."""
        was = F.lit(False) if passed is None else (F.col("end_us") <= passed) & (F.col("before") > 0)
        return self._emit(due.where(~was | (F.col("now") > 0)), F.when(was, "update").otherwise("first"))

    def run(self, stream: DataFrame) -> DataFrame:
        """Run to the end of the input; all emissions."""
        q = (stream.writeStream.foreachBatch(self).option("checkpointLocation", self.out + "-ckpt")
             .trigger(availableNow=True).queryName(f"lateness_{uuid.uuid4().hex[:8]}").start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"streaming query failed: {q.exception()}")
        marks = self._marks(self.last)
        passed = marks[-1][1] - self.delay_us if marks[-1][1] is not None else None
        rest = self._counts(marks, self.last, passed)  # what the last watermark has not passed
        return self.spark.read.parquet(f"{self.out}/emitted").drop("batch_id").unionByName(self._fire(rest, None))


class LateRanking(AllowedLateness):
    """D2 with allowed lateness: the ``n`` largest keys of a window, again whenever late rows change them.

    The counts of a window live past its first firing, as in :class:`AllowedLateness`.  A
    window emits its ranking when the watermark passes its end (``first``) and once more in
    every micro-batch whose late rows change the ranking, in order, key or count
    (``update``); late rows that leave the first ``n`` as they were emit nothing.  What a
    window emitted last follows from its counts before the batch, so no ranking is kept.

    A window is never in one task: both rankings are a Top-N with a limit before the shuffle.
    Ties go to the smaller key, a null key first.  Output: window_end, keys, count, rank, emission.
    """

    def __init__(self, spark, keys: list[str], ts: str, size: str, delay: str, lateness: str, n: int,
                 slide: str | None = None):
        super().__init__(spark, keys, ts, size, delay, lateness, slide)
        self.n = n

    def _fire(self, due: DataFrame, passed: int | None) -> DataFrame:
        shown = F.lit(0) if passed is None else F.when(F.col("end_us") <= passed, F.col("before")).otherwise(0)
        sides = F.array(F.struct(F.lit("after").alias("side"), (F.col("before") + F.col("now")).alias("count")),
                        F.struct(F.lit("before").alias("side"), shown.cast("long").alias("count")))
        counts = due.select("end_us", *self.keys, F.inline(sides)).where(F.col("count") > 0)
        top = top_n(counts, ["end_us", "side"], [F.col("count").desc(), *[F.col(k).asc() for k in self.keys]], self.n)
        entry = F.struct("rank", *self.keys, "count")
        both = top.groupBy("end_us").agg(*[
            F.array_sort(F.collect_list(F.when(F.col("side") == side, entry))).alias(f"__{side}")
            for side in ("before", "after")])  # at most n entries each
        changed = both.where(~F.col("__before").eqNullSafe(F.col("__after")))
        return changed.select(F.timestamp_micros("end_us").alias("window_end"), F.inline("__after"), F.when(
            F.size("__before") > 0, "update").otherwise("first").alias("emission")).select(
            "window_end", *self.keys, "count", "rank", "emission")


class RetractStream:
    """A running count per key as (flag, key, count) pairs.

    Every micro-batch takes back (false) the old count of each key it adds to and emits (true)
    the new one.  The count is keyed state, so a batch touches the keys it has rows of and no
    others.  A null key is a key.
    """

    def __init__(self, spark, keys: list[str], name: str):
        self.spark, self.keys, self.name = spark, keys, name

    def run(self, stream: DataFrame) -> DataFrame:
        types = [f"{f.name} {f.dataType.simpleString()}" for f in stream.select(*self.keys).schema.fields]
        ensure_state_store(self.spark)
        out = stream.select(*self.keys).groupBy(*self.keys).transformWithStateInPandas(
            RunningCount(self.keys, self.name), ", ".join(["flag boolean", *types, f"{self.name} long"]),
            "Append", "None")
        return run_to_parquet(out, "retract", spark=self.spark)
