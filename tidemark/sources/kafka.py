"""Kafka source and sink.

The Kafka connector is not on this image's class path; the functions only
build the reader/writer, so they work wherever the connector is installed.
Delivery of the Spark Kafka sink is at-least-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
    group_id: str | None = None,
) -> DataFrame:
    """``value`` as a string column; ``auto.offset.reset`` maps to startingOffsets."""
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return r.load().select(F.col("value").cast("string").alias("value"))


def kafka_csv_stream(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, **kw
) -> DataFrame:
    """Kafka records holding CSV lines, parsed with ``from_csv``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return kafka_stream(spark, servers, topic, **kw).select(
        F.from_csv("value", ddl).alias("r")
    ).select("r.*")


def to_kafka_value(df: DataFrame, fmt: str = "csv") -> DataFrame:
    """K5: one ``value`` column, CSV or JSON text of the whole row."""
    row = F.struct(*df.columns)
    return df.select((F.to_csv(row) if fmt == "csv" else F.to_json(row)).alias("value"))


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, fmt: str = "csv"):
    """K4: streaming Kafka sink (at-least-once)."""
    return (
        to_kafka_value(df, fmt).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
