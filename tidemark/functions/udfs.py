"""User-defined functions of the Table API (U1-U5), Spark style.

* scalar (U1): the native expression is in tidemark.functions.scalar; registered
  for SQL (U5) it is a SQL function over the same built-ins.
* table function (U2): a SQL table function over ``explode(split(...))`` ->
  (word, length); its DataFrame form is tidemark.operators.joins.lateral_split.
* aggregate function (U3): an accumulator (create / accumulate / merge /
  get-value) run as partial aggregation: ``mapInPandas`` accumulates each
  partition per key, Spark's ``groupBy`` merges the accumulators, the result
  expression finishes.  No key is ever collected into one task.  Over sliding ROWS
  frames (``user_frame``) accumulators retract what leaves the frame.
* table-aggregate (U4): ``row_number() <= n`` per key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sequence import DEFAULT_CHUNK, sequence_number
from tidemark.operators.windows import top_n
from tidemark.session import ship_package


def register_functions(spark: SparkSession, factor: float = 1.23) -> None:
    """U5 ``registerFunction``: SQL functions over built-in expressions.

    ``hash_code(s)`` is ``(s.hashCode * factor).toInt`` over UTF-16 units (U1);
    ``split_words(s, sep)`` is the table function of U2: one (word, length) row per piece.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION hash_code(s STRING) RETURNS INT RETURN
          int(least(greatest((CASE WHEN java_hash(s) >= 2147483648 THEN java_hash(s) - 4294967296
                                   ELSE java_hash(s) END) * {float(factor)!r}D, -2147483648D), 2147483647D))"""
              .replace("java_hash(s)", "aggregate(transform(regexp_extract_all(hex(encode(s, 'UTF-16BE')), '.{4}', 0), "
                                       "u -> bigint(conv(u, 16, 10))), 0L, (h, c) -> (h * 31 + c) % 4294967296)"))
    spark.sql(r"""
        CREATE OR REPLACE TEMPORARY FUNCTION split_words(s STRING, sep STRING)
          RETURNS TABLE (word STRING, length INT) RETURN
          SELECT w, length(w) FROM explode(split(s, '\\Q' || sep || '\\E')) AS t(w)""")


#: Accumulators that a task merges at once.
LOCAL_ROWS = 1_000_000


class Accumulator:
    """U3 aggregate-function contract.

    ``fields``: accumulator columns; ``accumulate(values, group, n)``: each field's values for
    the ``n`` keys of an Arrow batch, whose rows come group by group; ``merge_local``: pandas
    aggregation per field merging the batches of one partition; ``merge``: Spark aggregate per
    field combining the partitions' accumulators; ``result``: final value from the merged fields.
    """

    fields: Sequence[tuple[str, str]] = ()
    merge_local: dict = {}

    @staticmethod
    def accumulate(values: np.ndarray, group: np.ndarray, n: int) -> dict[str, np.ndarray]:
        raise NotImplementedError

    @staticmethod
    def merge(field: str) -> Column:
        raise NotImplementedError

    @staticmethod
    def result() -> Column:
        raise NotImplementedError


class AvgTemp(Accumulator):
    """Average temperature: accumulator (sum, count)."""

    fields = (("sum", "double"), ("count", "long"))
    merge_local = {"sum": "sum", "count": "sum"}

    @staticmethod
    def accumulate(values: np.ndarray, group: np.ndarray, n: int) -> dict[str, np.ndarray]:
        there = ~np.isnan(values)
        values, group = values[there], group[there]
        count = np.bincount(group, minlength=n)
        # behind a zero each, so a group is summed as it would be alone and may be empty
        padded = np.zeros(len(values) + n)
        padded[np.arange(len(values)) + group + 1] = values
        return {"sum": np.add.reduceat(padded, np.cumsum(count) - count + np.arange(n)), "count": count}

    @staticmethod
    def merge(field: str) -> Column:
        return F.sum(field)

    @staticmethod
    def result() -> Column:
        return F.when(F.col("count") > 0, F.col("sum") / F.col("count"))


def user_aggregate(df: DataFrame, key: str, value: str, acc: type[Accumulator], out: str) -> DataFrame:
    """Run an :class:`Accumulator` with partial aggregation (see module doc)."""
    key_type = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, " + ", ".join(f"`{n}` {t}" for n, t in acc.fields)

    def merged_rows(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.groupby(key, as_index=False, sort=False, dropna=False).agg(acc.merge_local)

    def per_partition(batches):
        parts, rows = [], 0
        for pdf in batches:
            if not len(pdf):
                continue
            group, found = pd.factorize(pdf[key], use_na_sentinel=False)
            order = np.argsort(group, kind="stable")
            values = pdf[value].to_numpy("float64")[order]
            parts.append(pd.DataFrame({key: found, **acc.accumulate(values, group[order], len(found))}))
            rows += len(parts[-1])
            if rows > LOCAL_ROWS:  # many different keys: the rest is merged by Spark
                yield merged_rows(pd.concat(parts, ignore_index=True))
                parts, rows = [], 0
        if parts:
            # merge accumulators of the same key across this partition's batches
            yield merged_rows(pd.concat(parts, ignore_index=True))

    ship_package(df.sparkSession)
    partial = df.select(key, value).mapInPandas(per_partition, schema)
    merged = partial.groupBy(key).agg(*[acc.merge(n).alias(n) for n, _ in acc.fields])
    return merged.select(key, acc.result().alias(out))


class FrameAccumulator:
    """U3 aggregate-function contract for sliding frames: accumulate and retract.

    ``fields``: the accumulator's numpy fields, zero when empty; ``each(values, valid)``: what
    every single row adds to them (``valid`` is false for nulls); ``retract(field, total,
    gone)``: the field of the frame from the field over a stretch of rows and the field over
    its part before the frame; ``value(acc)``: (results, which of them are not null).
    ``result_type`` is the Spark type of the result.  All work on whole arrays.
    """

    fields: dict[str, str] = {}
    result_type = "double"

    @staticmethod
    def each(values: np.ndarray, valid: np.ndarray) -> dict[str, np.ndarray]:
        raise NotImplementedError

    @staticmethod
    def retract(field: str, total: np.ndarray, gone: np.ndarray) -> np.ndarray:
        return total - gone

    @staticmethod
    def value(acc: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError


class AvgTempFrame(FrameAccumulator):
    """Average temperature that retracts: (sum, count), with values that are no finite numbers
    counted beside the sum, since they could not be taken out of it again."""

    fields = {"sum": "float64", "count": "int64", "nan": "int64", "up": "int64", "down": "int64"}

    @staticmethod
    def each(values, valid):
        finite = valid & np.isfinite(values)
        return {"sum": np.where(finite, values, 0.0), "count": valid.astype("int64"),
                "nan": (valid & np.isnan(values)).astype("int64"), "up": (valid & (values == np.inf)).astype("int64"),
                "down": (valid & (values == -np.inf)).astype("int64")}

    @staticmethod
    def finite(acc):
        return acc["sum"] / np.maximum(acc["count"], 1)

    @classmethod
    def value(cls, acc):
        some, out = acc["count"] > 0, cls.finite(acc)
        out = np.where(acc["up"] > 0, np.inf, np.where(acc["down"] > 0, -np.inf, out))
        return np.where((acc["nan"] > 0) | ((acc["up"] > 0) & (acc["down"] > 0)), np.nan, out), some


class SumTempFrame(AvgTempFrame):
    """Total temperature that retracts."""

    @staticmethod
    def finite(acc):
        return acc["sum"]


def user_frame(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, preceding: int,
               acc: type[FrameAccumulator], out: str, block_rows: int | None = None,
               chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """A :class:`FrameAccumulator` over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW``.

    Each row is accumulated once and retracted once, whatever the length of the frame: rows
    are numbered within their key, cut into blocks of ``block_rows`` (default
    ``tidemark.chunkRows``, 1,000,000; at least ``preceding``) and sorted within their
    block, so a hot key is many tasks.  The last ``preceding`` rows of a block are also
    given to the next one.  A task runs over its blocks one Arrow batch at a time, keeping
    what the last ``preceding`` rows added: the frame of a row is a running total minus
    the total before its frame, both within the batch, so rounding errors don't build up.
    ``value`` must be numeric and ``order`` a total order within a key; a null key is a key, a
    null value adds nothing, and a frame without values gives null.
    """
    keys, order, n = list(keys), list(order), int(preceding)
    if n < 0:
        raise ValueError("preceding must not be negative")
    size = max(int(block_rows or df.sparkSession.conf.get("tidemark.chunkRows", "1000000")), n, 1)
    place = F.col("__seq") - 1
    block = F.floor(place / size).cast("long")
    own = F.struct(block.alias("__block"), F.lit(False).alias("__halo"))
    copy = F.struct((block + 1).alias("__block"), F.lit(True).alias("__halo"))
    rows = sequence_number(df, keys, order, "__seq", chunk=chunk).select(
        "*", F.col(value).cast("double").alias("__value"),
        F.inline(F.when(F.pmod(place, F.lit(size)) >= size - n, F.array(own, copy)).otherwise(F.array(own))))
    rows = rows.repartition(*keys, "__block").sortWithinPartitions(*keys, "__block", "__seq")
    columns = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DataType.fromDDL(acc.result_type))])

    def frames(batches):
        held = {f: np.zeros(0, t) for f, t in acc.fields.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("__value")
            valid = cell.is_valid().to_numpy(zero_copy_only=False)
            values = np.where(valid, cell.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0)
            back = np.minimum(batch.column("__seq").to_numpy(zero_copy_only=False) - 1, n)
            added, totals = acc.each(values, valid), {}
            for f, t in acc.fields.items():
                stretch = np.concatenate([held[f], added[f]]).astype(t, copy=False)
                upto = np.concatenate([np.zeros(1, t), np.cumsum(stretch)])
                last = np.arange(len(held[f]), len(stretch))
                totals[f] = acc.retract(f, upto[last + 1], upto[np.maximum(last - back, 0)])
                held[f] = stretch[max(len(stretch) - n, 0):]
            result, some = acc.value(totals)
            done = pa.array(result, mask=~some)
            mine = pa.compute.invert(batch.column("__halo"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], done], [*columns, out]).filter(mine)

    ship_package(df.sparkSession)
    return rows.mapInArrow(frames, schema)


def top2(df: DataFrame, key: str, value: str, order_tiebreak: Sequence[str] = ()) -> DataFrame:
    """U4 ``Top2Temp``: the two largest values per key with their rank."""
    ranked = top_n(df, [key], [F.col(value).desc(), *[F.col(c) for c in order_tiebreak]], 2)
    return ranked.select(key, F.col(value).alias("temp"), "rank")
