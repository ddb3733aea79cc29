"""Numbering, ranking and exact quantiles of large groups.

``row_number() over (partition by key)`` sorts a whole group in one task.  Here rows are range
partitioned by (key, order), numbered inside each (partition, key) cell, and shifted by the
rows of the key in earlier partitions: a group that holds a third of all rows is spread over
a third of the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keys import join_keys
from tidemark.session import materialize


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: Sequence[str] = (),
             name: str = "row_num") -> DataFrame:
    """``row_number`` per key in ``order`` (columns of ``descending`` from large to small).

    Repeated rows are told apart by their place in the written table.
    """
    keys, parts = list(keys), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    cells = materialize(tied.repartitionByRange(parts, *[F.col(k) for k in keys], *cols, "__tie")
                        .withColumn("__cell", F.spark_partition_id()), "ranking")
    earlier = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (cells.groupBy(*keys, "__cell").agg(F.count(F.lit(1)).alias("__n"))
             .select(*keys, "__cell", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__ahead")))
    within = F.row_number().over(Window.partitionBy("__cell", *keys).orderBy(*cols, "__tie"))
    return (join_keys(cells.withColumn("__rn", within), ahead, ["__cell", *keys])
            .withColumn(name, F.col("__ahead") + F.col("__rn")).drop("__cell", "__rn", "__ahead", "__tie"))


def ranked(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str], descending: bool = True) -> DataFrame:
    """``rnk`` (equal values share the first number) and ``row_num`` per key by the value ``by``."""
    n = numbered(df, keys, [by, *ties], [by] if descending else [])
    first = n.groupBy(*keys, by).agg(F.min("row_num").alias("rnk"))
    return join_keys(n, first, [*keys, by])


def exact_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key ``min, max, median, cnt`` of a column without nulls: the mean of the one or two
    middle rows."""
    n = numbered(df.select(*keys, value), keys, [value])
    whole = n.groupBy(*keys).agg(F.min(value).alias("min"), F.max(value).alias("max"),
                                 F.count(F.lit(1)).alias("cnt"))
    middle = (join_keys(n, whole.select(*keys, "cnt"), keys)
              .where("row_num = (cnt + 1) div 2 or row_num = (cnt + 2) div 2")
              .groupBy(*keys).agg(F.avg(value).alias("median")))
    return join_keys(whole, middle, keys)
