"""Running streaming queries to durable, replay-safe outputs.

Outputs go to parquet folders under the cluster's checkpoint root (never a
machine-local folder, never the driver's memory).  Query checkpoints live
beside them, so a restarted query resumes exactly where it stopped.

``flush`` adds a second, at first empty file source.  When a bounded run has read all its
input, however many micro-batches that took, one sentinel row far in the future is written
to that source and the same query is run once more from its checkpoint: the final watermark
closes every window and fires every timer, as the end of a bounded source does.  The
sentinel is filtered out right after the watermark operator.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ROCKSDB_PROVIDER, ensure_utc, scratch_path, ship_package

SENTINEL_TS = dt.datetime(2100, 1, 1)
SENTINEL = "__sentinel"


def event_time(stream: DataFrame, ts: str = "ts", delay: str = "0 seconds", flush: bool = False,
               spark: SparkSession | None = None, flush_folder: str | None = None) -> DataFrame:
    """A TIMESTAMP event-time column with a bounded-out-of-orderness
    watermark (``delay``; ``0 seconds`` = ascending timestamps).

    NTZ columns are cast to the session (UTC) timestamp, which the watermark
    operator requires.  ``flush_folder`` is where the sentinel's source lies (a fresh folder
    by default); name it to build the same query again after a lost driver.
    """
    spark = spark or stream.sparkSession
    ensure_utc(spark)
    ensure_state_store(spark)
    s = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    if flush:
        s = s.withColumn(SENTINEL, F.lit(False)).unionByName(
            sentinel_stream(spark, s.drop(SENTINEL), ts, flush_folder), allowMissingColumns=True)
        # the filter must mention the event-time column, or Catalyst pushes it
        # below the watermark operator and the sentinel never moves the watermark
        s = s.withWatermark(ts, delay).where(~(F.col(SENTINEL) & (F.col(ts) == F.lit(SENTINEL_TS))))
        return s.drop(SENTINEL)
    return s.withWatermark(ts, delay)


def ensure_state_store(spark: SparkSession) -> None:
    """Keyed state (transformWithState) needs the RocksDB state store provider, which also keeps
    other state (a complete-mode aggregation) on disk instead of whole in the executors' memory."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)


def sentinel_stream(spark: SparkSession, like: DataFrame, ts: str, folder: str | None = None) -> DataFrame:
    """A file stream with the schema of ``like``, empty until :func:`run_to_end` copies its row there.

    The row lies in storage, in ``<folder>/row``, from the start, and the source reads ``<folder>/in``:
    what is still to be flushed can be told from the two folders alone, by any driver."""
    folder = folder or scratch_path(spark, "sentinel")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in like.schema.fields])
    full = T.StructType([*schema.fields, T.StructField(SENTINEL, T.BooleanType(), True)])
    row = tuple(SENTINEL_TS if f.name == ts else None for f in schema.fields) + (True,)
    spark.createDataFrame([row], full).coalesce(1).write.mode("ignore").parquet(f"{folder}/row")
    spark.createDataFrame([], full).write.mode("ignore").parquet(f"{folder}/in")
    return spark.readStream.schema(full).parquet(f"{folder}/in")


def _pending(stream: DataFrame) -> list[str]:
    """The sentinel folders among a stream's sources whose row is not in the source yet."""
    spark, leaves = stream.sparkSession, stream._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName() == "StreamingRelation" and leaf.output().mkString(" ").find(SENTINEL) >= 0:
            found.add(leaf.dataSource().options().apply("path").removesuffix("/in"))
    return sorted(f for f in found if spark.read.parquet(f"{f}/in").isEmpty())


def run_to_end(stream: DataFrame, start: Callable) -> None:
    """Run the query that ``start()`` starts until its input is read, then flush it.

    ``start`` must use the ``availableNow`` trigger and the same checkpoint each time.  A
    driver lost at any point can build the query again over the same folders and call this
    again: a flush that is still due is done, one that was done is not repeated.
    """
    ship_package(stream.sparkSession)
    ensure_state_store(stream.sparkSession)

    def once() -> None:
        q = start()
        q.awaitTermination()
        _raise_if_failed(q)

    once()
    pending = _pending(stream)
    for folder in pending:
        stream.sparkSession.read.parquet(f"{folder}/row").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    if pending:
        once()


@contextmanager
def stream_partitions(spark: SparkSession):
    """State partitions of the queries started inside: ``tidemark.streamPartitions`` if set,
    else the shuffle setting.  The number is fixed in a query's checkpoint for its life, so
    set it for the final size of the state."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("tidemark.streamPartitions", None) or old)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def run_to_parquet(stream: DataFrame, name: str, mode: str = "append",
                   spark: SparkSession | None = None, folder: str | None = None) -> DataFrame:
    """Run ``stream`` over all available input (availableNow) into an
    exactly-once parquet file sink; return the result as a batch DataFrame.
    ``folder`` (default: a fresh one) lets a later run go on where an earlier one stopped."""
    spark = spark or stream.sparkSession
    out = folder or scratch_path(spark, f"out-{name}")
    with stream_partitions(spark):
        run_to_end(stream, lambda: (
            stream.writeStream.format("parquet").outputMode(mode)
            .option("path", out).option("checkpointLocation", out + "-ckpt")
            .trigger(availableNow=True).queryName(f"{name}_{uuid.uuid4().hex[:8]}").start()))
    return spark.read.parquet(out)


def run_foreach_batch(stream: DataFrame, name: str, per_batch: Callable[[DataFrame], DataFrame],
                      mode: str = "append", overwrite: bool = False, keep_batch_id: bool = False,
                      spark: SparkSession | None = None) -> DataFrame:
    """``foreachBatch`` writing ``per_batch(batch)`` to a parquet folder.

    Each micro-batch writes its own ``batch_id=N`` partition with overwrite,
    so a replayed batch replaces its earlier attempt (idempotent sink).
    ``overwrite=True`` keeps only the latest batch (complete-mode results).
    """
    spark = spark or stream.sparkSession
    out = scratch_path(spark, f"fb-{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        res = per_batch(batch)
        if overwrite:
            res.write.mode("overwrite").parquet(out + "/latest")
        else:
            res.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with stream_partitions(spark):
        run_to_end(stream, lambda: (
            stream.writeStream.foreachBatch(write).outputMode(mode)
            .option("checkpointLocation", out + "-ckpt").trigger(availableNow=True)
            .queryName(f"{name}_{uuid.uuid4().hex[:8]}").start()))
    res = spark.read.parquet(out + "/latest" if overwrite else out)
    if "batch_id" in res.columns and not keep_batch_id:
        return res.drop("batch_id")
    return res


def _raise_if_failed(q) -> None:
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
