"""Pattern matching over keyed, time-ordered events.

Spark has no MATCH_RECOGNIZE.  A pattern of two stages is a per-key ordered
scan:

* ``next`` (strict contiguity, C2): the very next event of the key must meet
  the second condition -- a ``lead`` by one row.
* ``followedBy`` (relaxed contiguity, C3): the first later event of the key
  meeting the second condition, other events skipped -- a reverse running
  "last non-null so far" scan (the nearest later match).
* ``within(d)`` (C4): second.ts - first.ts < d (strict, as the reference's
  pruning uses ``>=`` for time-outs).
* time-outs (C7): starts whose second stage is missing or too late.

Both scans use the chunked primitives of tidemark.operators.sequence, so no
key is ever gathered into one task, and no candidate pairs are formed.
Longer patterns nest the lookups, last stage first (:func:`match_sequence`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import interval
from tidemark.operators.sequence import DEFAULT_CHUNK, neighbours, plan_chunks, running


def next_pattern(df: DataFrame, key: str, order: Sequence[str], first: Column, second: Column,
                 within: str | None, cols: Sequence[str], chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """``begin(first).next(second)[.within(d)]``: one row per match with
    ``first_<c>`` and ``second_<c>`` columns."""
    ts = order[0]
    cols = list(dict.fromkeys([ts, *cols]))
    d = df.withColumn("__c1", first).withColumn("__c2", second)
    n = neighbours(d, [key], order, [*cols, "__c2"], prev=False, nxt=True, chunk=chunk)
    cond = F.col("__c1") & F.coalesce(F.col("next___c2"), F.lit(False))
    if within:
        cond = cond & (F.col(f"next_{ts}") < F.col(ts) + interval(within))
    return n.where(cond).select(
        key, *[F.col(c).alias(f"first_{c}") for c in cols], *[F.col(f"next_{c}").alias(f"second_{c}") for c in cols])


def followed_by(df: DataFrame, key: str, order: Sequence[str], first: Column, second: Column,
                within: str | None, cols: Sequence[str], chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """``begin(first).followedBy(second)[.within(d)]`` with time-outs.

    One row per event meeting ``first``: ``matched`` says whether the first
    later ``second`` event came in time; ``second_<c>`` is that event (or the
    too-late one, or null).
    """
    ts = order[0]
    cols = list(dict.fromkeys([ts, *cols]))
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    d = df.withColumn("__c1", first)
    s = running(d, [key], order, {"__nxt": ("last", F.when(second, payload))},
                reverse=True, include_current=False, chunk=chunk)
    s = s.where(F.col("__c1"))
    ok = F.col("__nxt").isNotNull()
    if within:
        ok = ok & (F.col(f"__nxt.{ts}") < F.col(ts) + interval(within))
    return s.select(
        key, *[F.col(c).alias(f"first_{c}") for c in cols],
        *[F.col(f"__nxt.{c}").alias(f"second_{c}") for c in cols],
        ok.alias("matched"))


def match_sequence(df: DataFrame, key: str, order: Sequence[str], id_col: str,
                   stages: Sequence[tuple[str, Column, str]], within: str | None = None,
                   chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """General pattern ``begin(s0).{next|followedBy}(s1)...[.within(d)]``.

    ``stages`` = [(name, condition, contiguity)], contiguity of the first
    stage ignored.  Returns one row per complete match with ``<name>_<id>``
    and ``<name>_<ts>`` for every stage (C6 ``select``).

    The stages are looked up from the last to the first: each row learns the next row (or the
    first later row) that meets a stage, together with what that row has learned already.
    All lookups run over one ordering of the input; nothing is joined.
    """
    ts = order[0]
    names = [n for n, _, _ in stages]
    look = df.withColumns({f"__s{i}": cond for i, (_, cond, _) in enumerate(stages)})
    chunks = plan_chunks(df, [key], ts, chunk)
    for i in range(len(stages) - 1, 0, -1):
        here = [F.col(id_col).alias("id"), F.col(ts).alias("ts")]
        if i + 1 < len(stages):
            here.append(F.col(f"__l{i + 1}").alias("then"))
        hit = F.when(F.col(f"__s{i}"), F.struct(*here))
        if i + 1 < len(stages):
            hit = F.when(F.col(f"__l{i + 1}").isNotNull() | F.lit(stages[i][2] == "followedBy"), hit)
        if stages[i][2] == "next":
            look = neighbours(look.withColumn(f"__r{i}", hit), [key], order, [f"__r{i}"], prev=False, nxt=True,
                              chunk=chunks).withColumnRenamed(f"next___r{i}", f"__l{i}").drop(f"__r{i}")
        elif stages[i][2] == "followedBy":
            look = running(look, [key], order, {f"__l{i}": ("last", hit)}, reverse=True, include_current=False,
                           chunk=chunks)
        else:
            raise ValueError(f"unknown contiguity {stages[i][2]}")
    picked = [F.col(key), F.col(id_col).alias(f"{names[0]}_id"), F.col(ts).alias(f"{names[0]}_ts")]
    at = "__l1"
    for name in names[1:]:
        picked += [F.col(f"{at}.id").alias(f"{name}_id"), F.col(f"{at}.ts").alias(f"{name}_ts")]
        at += ".then"
    m = look.where("__s0").select(*picked).where(F.col(f"{names[-1]}_ts").isNotNull())
    if within:
        m = m.where(F.col(f"{names[-1]}_ts") < F.col(f"{names[0]}_ts") + interval(within))
    return m


def flat_select(matches: DataFrame, rows: Column, keep: Sequence[str]) -> DataFrame:
    """0..n rows per match (C6 ``flatSelect``): the structs of the array ``rows``, beside the columns ``keep``."""
    return matches.select(*keep, F.explode(rows).alias("__row")).select(*keep, "__row.*")
