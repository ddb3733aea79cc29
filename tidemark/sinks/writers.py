"""Sinks (K1-K11, T13).

Batch writers are plain ``DataFrameWriter`` calls; stream writers are
``writeStream`` builders with a checkpoint, or ``foreachBatch`` functions that
are safe to replay (a batch rewrites only its own output).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import join_keys
from tidemark.session import materialize


def print_sink(df: DataFrame, label: str | None = None, n: int = 20):
    """K1 ``print([label])``: ``show`` for batches, the console sink for streams."""
    if df.isStreaming:
        return df.writeStream.format("console").option("truncate", "false").queryName(label or "print")
    if label:
        print(label)
    df.show(n, truncate=False)
    return None


def write_text(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K2 ``writeAsText``: one CSV-formatted text line per row; ``partition_by`` = bucket folders."""
    cols = [c for c in df.columns if c not in partition_by]
    lines = df.select(F.to_csv(F.struct(*cols)).alias("value"), *partition_by)
    w = lines.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


def stream_file_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "csv",
                     partition_by: Sequence[str] = ()):
    """K2 ``StreamingFileSink`` (exactly-once): file sink with a checkpoint."""
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.outputMode("append")


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """K3 CSV table sink (the reference writes id,temp rows without a header)."""
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


def write_json_docs(df: DataFrame, path: str, id_col: str) -> None:
    """K9 document-index sink, re-aimed: one JSON document per row, keyed by ``id_col``
    (upsert semantics come from :func:`upsert_parquet` when needed)."""
    df.select(F.col(id_col).cast("string").alias("_id"), F.to_json(F.struct(*df.columns)).alias("doc")) \
        .write.mode("overwrite").json(path)


def latest_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key of one batch (what an UPDATE-then-INSERT loop leaves behind).

    An aggregate, so a key with many rows is reduced before the shuffle; a null key is a key."""
    row, last = F.struct(*batch.columns), F.struct(*order)
    return batch.groupBy(*keys).agg(F.max_by(row, last).alias("__row")).select("__row.*")


def upsert_parquet(batch: DataFrame, table_path: str, version: int, keys: Sequence[str],
                   order: Sequence[str]) -> str:
    """K6/K8 keyed upsert, re-aimed to files, whole versions: version ``v`` of the table is
    version ``v-1`` without the batch's keys plus the batch's latest rows.

    Every version is a new folder, so a replayed batch rewrites the same
    version (idempotent) and readers never see a half-written table.
    Returns the folder of the new version.  For large tables see :func:`upsert_buckets`.
    """
    spark = batch.sparkSession
    new = latest_per_key(batch, keys, order)
    out = f"{table_path}/v={version:010d}"
    if version > 0:
        cur = _read_if_there(spark, f"{table_path}/v={version - 1:010d}")
        if cur is not None:
            new = join_keys(cur, new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)
    new.write.mode("overwrite").parquet(out)
    return out


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def upsert_buckets(batch: DataFrame, table_path: str, version: int, keys: Sequence[str], order: Sequence[str],
                   buckets: int = 64) -> None:
    """K6/K8 keyed upsert that rewrites only what a batch touches.

    Keys are hashed into ``buckets`` (fixed for the table's life; choose it so that a bucket
    is a few files).  A version writes the buckets that its batch has keys of, merged with
    their rows of before, and a manifest: for each bucket, the version that wrote it last.
    Other buckets keep their files.  Data comes before the manifest, so a reader of a version
    never sees half of it, and a repeated batch writes the same folders again.
    """
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    new = materialize(latest_per_key(batch, keys, order).withColumn("__bucket", bucket), "upsert")
    touched = {r[0] for r in new.select("__bucket").distinct().collect()}  # at most ``buckets`` numbers
    before = _manifest(spark, table_path, version - 1) if version > 0 else {}
    paths = [_bucket_path(table_path, before[b], b) for b in sorted(touched & set(before))]
    merged = new
    if paths:
        old = spark.read.parquet(*paths).withColumn("__bucket", bucket)
        merged = join_keys(old, new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)
    merged.write.mode("overwrite").partitionBy("__bucket").parquet(f"{table_path}/data/v={version:010d}")
    rows = sorted((before | dict.fromkeys(touched, version)).items())
    spark.createDataFrame(rows, "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(
        f"{table_path}/manifest/v={version:010d}")


def _bucket_path(table_path: str, version: int, bucket: int) -> str:
    return f"{table_path}/data/v={version:010d}/__bucket={bucket}"


def _manifest(spark: SparkSession, table_path: str, version: int) -> dict[int, int]:
    rows = _read_if_there(spark, f"{table_path}/manifest/v={version:010d}")
    return {} if rows is None else {r["bucket"]: r["version"] for r in rows.collect()}  # one row per bucket


def read_buckets(spark: SparkSession, table_path: str, version: int) -> DataFrame:
    """A version of a table that :func:`upsert_buckets` wrote."""
    return spark.read.parquet(*[_bucket_path(table_path, v, b)
                                for b, v in sorted(_manifest(spark, table_path, version).items())])


def jdbc_upsert_batch(batch: DataFrame, url: str, table: str, keys: Sequence[str], order: Sequence[str],
                      properties: dict) -> None:
    """K6 JDBC upsert: latest row per key into a staging table with
    ``write.jdbc``; the caller then runs one ``MERGE INTO table USING staging``
    on its database.  (No database is started here.)"""
    latest_per_key(batch, keys, order).write.jdbc(url, f"{table}_staging", mode="overwrite",
                                                   properties=properties)


def changelog(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """T13 ``toRetractStream``: (false, old row) and (true, new row) for every
    key whose value changed between two snapshots of a keyed result."""
    keys = list(keys)
    vals = [c for c in current.columns if c not in keys]
    p = previous.select(*keys, F.struct(*vals).alias("__old"))
    c = current.select(*keys, F.struct(*vals).alias("__new"))
    j = join_keys(p, c, keys, "full")
    changed = j.where(~F.col("__old").eqNullSafe(F.col("__new")))
    retract = changed.where(F.col("__old").isNotNull()).select(
        F.lit(False).alias("flag"), *keys, *[F.col(f"__old.{v}").alias(v) for v in vals])
    add = changed.where(F.col("__new").isNotNull()).select(
        F.lit(True).alias("flag"), *keys, *[F.col(f"__new.{v}").alias(v) for v in vals])
    return retract.unionByName(add)
