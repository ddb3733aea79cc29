"""Helpers the operators share: column access by exact name, scratch tables, text defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import session


def flatten(df: DataFrame) -> DataFrame:
    """``df`` with its columns renamed by position to ``_c0, _c1, ...``.

    Work columns can then be added under any other name, whatever the input's columns
    are called (clashing names and names that differ only by case included).
    """
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def flat_name(df: DataFrame, name: str) -> str:
    """The flattened name of the first column of ``df`` called exactly ``name``."""
    return f"_c{df.columns.index(name)}"


def take(df: DataFrame, **wanted: str) -> DataFrame:
    """Exactly the wanted columns (new name = old name), whatever else ``df`` holds."""
    return flatten(df).select(*[F.col(flat_name(df, old)).alias(new) for new, old in wanted.items()])


def restore(flat: DataFrame, like: DataFrame) -> DataFrame:
    """Back from :func:`flatten` to the columns of ``like``; work columns are dropped."""
    return flat.select(*[f"_c{i}" for i in range(len(like.columns))]).toDF(*like.columns)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` through a table in the shared checkpoint folder (see :func:`tidemark.session.materialize`)."""
    return session.materialize(df, f"llm-{name}")


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
