"""Bounded and unbounded sources.

Every reader takes an explicit schema: nothing is inferred from file contents.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefns import duration_us
from tidemark.session import scratch_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

#: Rows of one file of a replayed slice.
SLICE_ROWS = 500_000


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (column pruning and filter pushdown apply)."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> None:
    """Temp views over the parquet tables, for ``spark.sql``."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def from_collection(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A bounded in-memory collection."""
    return spark.createDataFrame(rows, schema)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Header-less CSV with a declared schema; blanks around fields are trimmed."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def csv_view(spark: SparkSession, name: str, path: str, ddl: str, computed: dict[str, str] | None = None) -> None:
    """``CREATE TEMP VIEW ... USING csv`` with a DDL schema.

    ``computed`` adds columns by SQL expression, such as a row time
    ``{"rt": "to_timestamp(from_unixtime(ts))"}``.
    """
    base = f"{name}__source" if computed else name
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {base} ({ddl}) USING csv "
        f"OPTIONS (path '{path}', header 'false', ignoreLeadingWhiteSpace 'true', "
        f"ignoreTrailingWhiteSpace 'true')"
    )
    if computed:
        more = ", ".join(f"{e} AS {c}" for c, e in computed.items())
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT *, {more} FROM {base}")


def parse_delimited(
    df: DataFrame, schema: T.StructType, col: str = "value", sep: str = ",", tolerant: bool = False,
    keep: tuple = (),
) -> DataFrame:
    """Split a text line, trim every field and cast it to the schema.

    Strict by default (a bad number fails the job, like ``toLong``);
    ``tolerant=True`` turns bad fields into nulls with ``try_cast``.
    """
    parts = F.split(F.col(col), sep, -1)
    out = [F.col(k) for k in keep]
    for i, f in enumerate(schema.fields):
        raw = F.trim(parts.getItem(i))
        typ = f.dataType.simpleString()
        if isinstance(f.dataType, T.StringType):
            out.append(raw.alias(f.name))
        elif tolerant:
            out.append(F.expr(f"try_cast(trim(split(`{col}`, '{sep}', -1)[{i}]) AS {typ})").alias(f.name))
        else:
            out.append(raw.cast(f.dataType).alias(f.name))
    return df.select(*out)


def stream_table(
    spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A driver table as an unbounded source.

    A table is one file or a folder of files.  The file source does not accept the path of a
    single file, but a pattern that only this file or folder matches.
    """
    schema = read_table(spark, sf_dir, name).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(os.path.join(sf_dir, f"{name}[.]parquet"))


def stream_slices(spark: SparkSession, sf_dir: str, name: str, ts: str, slices: int, late: str | None = None,
                  late_rows: Column | None = None, files: int | None = None) -> DataFrame:
    """S3: a driver table replayed as ``slices`` micro-batches in time order.

    The table's time span is cut into equal slices, each written to the scratch folder
    before the next one; the stream reads one slice (``files`` files, by default one per
    ``SLICE_ROWS`` rows, so many tasks write and read a large one) per trigger.  Rows
    that meet ``late_rows`` arrive as if they were ``late`` later: out of order.
    """
    table = read_table(spark, sf_dir, name)
    lo, hi, rows = table.agg(F.min(F.unix_micros(F.col(ts).cast("timestamp"))),
                             F.max(F.unix_micros(F.col(ts).cast("timestamp"))), F.count(F.lit(1))).first()
    files = files or max(1, -(-rows // (slices * SLICE_ROWS)))
    width = ((hi or 0) - (lo or 0)) // slices + 1
    us = F.unix_micros(F.col(ts).cast("timestamp")) - F.lit(lo or 0)
    if late:
        us = us + F.when(late_rows, F.lit(duration_us(late))).otherwise(F.lit(0))
    number = F.least(F.floor(us / F.lit(width)), F.lit(slices - 1))
    root = scratch_path(spark, f"slices-{name}")
    for k in range(slices):
        folder = f"{root}/{k:04d}"
        table.where(number == k).repartition(files).write.parquet(folder)
        # a trigger reads ``files`` files, so a slice with fewer rows than that gets empty ones
        while files > 1 and len(spark.read.schema(table.schema).parquet(folder).inputFiles()) < files:
            table.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/*")


def stream_text(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: continuously monitored folder of text files."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def stream_csv(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
        .csv(folder)
    )
