"""Joins on grouping keys: a null key is a key like any other, as in ``groupBy`` and windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on equal ``keys``, nulls equal to each other.

    Columns: the keys once, then the other columns of ``left`` and of ``right`` (none of the
    latter for ``left_semi`` and ``left_anti``).
    """
    keys = list(keys)
    other = right.select(*[F.col(k).alias(f"__jk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"__jk_{k}"]) for k in keys])
    j = left.join(other, same, how)
    rest = [F.col(c) for c in left.columns if c not in keys]
    if how in ("left_semi", "left_anti"):
        return j.select(*[F.col(k) for k in keys], *rest)
    # a key that is null on one side only belongs to the side that has the row, so coalesce is right
    picked = [F.coalesce(F.col(k), F.col(f"__jk_{k}")).alias(k) for k in keys]
    return j.select(*picked, *rest, *[F.col(c) for c in right.columns if c not in keys])
