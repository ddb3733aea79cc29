"""Quality classifier: a sparse rule ensemble over text statistics.

1. Statistics of a text are Spark column expressions.
2. Small trees are grown on resampled labelled rows; every path from a root to a node is a
   conjunctive rule over the statistics.
3. A logistic model with an L1 penalty (lasso) weighs the rules; most weights become 0.
4. The remaining rules are compiled into one Spark column: the score.

Trees and weights are fitted on a bounded sample of labelled rows (``sample_rows``, chosen
by a hash of the identifier); scoring runs inside the scan of the documents, without any
shuffle or Python code.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import flat_name, flatten, materialize, restore, take, text_of

SAMPLE_ROWS = 20_000
SEED = 7


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text.

    All are shares or rates that do not change with the length of a text of one kind.
    """
    chars = F.greatest(F.length(text), F.lit(1))
    words = F.greatest(F.regexp_count(text, F.lit(r"\S+")), F.lit(1))
    lines = F.split(text, "\n")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    return {
        "upper_share": count("[A-Z]") / chars,
        "digit_share": count("[0-9]") / chars,
        "symbols_per_word": count(r"[#$%&*^~=_{}<>\\]") / words,
        "exclaims_per_word": count("!") / words,
        "bars_per_word": count(r"\|") / words,
        "stops_per_word": count("[.]") / words,
        "lines_per_word": F.size(lines) / words,
        "repeats_per_word": count(r"(?<!\S)(\S++)(?=\s+\1(?!\S))") / words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


def with_statistics(rows: DataFrame, text: Column, name: str = "stats") -> DataFrame:
    """``rows`` plus a struct of the statistics, computed once per row.

    They come from a generator with one output row: the optimizer cannot move a filter on a
    score below it, which would put the statistics into every rule of the filter.
    """
    stats = [c.cast("double").alias(k) for k, c in statistics(text).items()]
    rows = rows.select("*", F.struct(*stats).alias(f"{name}_once"))
    return rows.select("*", F.explode(F.array(f"{name}_once")).alias(name)).drop(f"{name}_once")


def fields(name: str = "stats") -> dict[str, Column]:
    return {k: F.col(f"{name}.{k}") for k in statistics(F.lit(""))}


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, at most?, threshold) with its weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self, stats: dict[str, Column]) -> Column:
        out = None
        for name, at_most, value in self.terms:
            term = stats[name] <= F.lit(value) if at_most else stats[name] > F.lit(value)
            out = term if out is None else out & term
        return out

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, at_most, value in self.terms:
            v = x[:, names.index(name)]
            out &= (v <= value) if at_most else (v > value)
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self, stats: dict[str, Column]) -> Column:
        """Probability of label 1."""
        total = F.lit(float(self.intercept))
        for r in self.rules:
            total = total + F.when(r.column(stats), F.lit(float(r.weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, names: list[str], features: np.ndarray, depth: int,
         least: int, path: tuple = ()) -> list[tuple]:
    """The paths to all nodes of a tree grown by Gini impurity.

    Cuts lie at quantiles of either label, moved to the middle of the gap above.
    """
    paths = [path] if path else []
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return paths
    best = None
    for f in features:
        v = x[:, f]
        cuts = np.unique([np.quantile(v[y == k], np.linspace(0, 1, 33), method="lower") for k in (0, 1)])
        low = v[:, None] <= cuts[None, :]
        n_low = low.sum(axis=0)
        ones_low = (low & (y[:, None] > 0)).sum(axis=0)
        n_high, ones_high = len(y) - n_low, y.sum() - ones_low
        with np.errstate(divide="ignore", invalid="ignore"):
            impurity = ones_low * (1 - ones_low / n_low) + ones_high * (1 - ones_high / n_high)
        impurity[(n_low < least) | (n_high < least)] = np.inf
        at = int(np.argmin(impurity))
        if np.isfinite(impurity[at]) and (best is None or impurity[at] < best[0] - 1e-12):
            best = (impurity[at], f, float(cuts[at]))
    if best is None:
        return paths
    _, f, cut = best
    above = x[x[:, f] > cut, f]
    cut = float((cut + above.min()) / 2)
    side = x[:, f] <= cut
    for at_most, rows in ((True, side), (False, ~side)):
        paths += grow(x[rows], y[rows], names, features, depth - 1, least, (*path, (names[f], at_most, cut)))
    return paths


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient; the intercept is free."""
    n = len(y)
    z = np.hstack([np.ones((n, 1)), a])
    rate = 4.0 * n / max(np.linalg.norm(z, 2) ** 2, 1e-9)
    w = np.zeros(z.shape[1])
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w[0] = np.log(share / (1 - share))
    v, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
        new = v - rate * (z.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 40, depth: int = 3,
        penalty: float = 2e-3) -> RuleModel:
    """The rule ensemble of labelled statistics.  With one label only, its share is the score
    (1 without any row: nothing speaks against a text)."""
    if len(y) == 0 or y.min() == y.max():
        return RuleModel(8.0 if len(y) == 0 or y[0] > 0 else -8.0, ())
    rng = np.random.default_rng(SEED)
    paths: dict[tuple, None] = {}
    least = max(5, len(y) // 500)
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        features = np.sort(rng.choice(len(names), max(2, len(names) * 2 // 3), replace=False))
        for p in grow(x[rows], y[rows], names, features, depth, least):
            paths[tuple(sorted(p))] = None
    rules, seen = [], set()
    for p in paths:
        hold = Rule(p).holds(x, names)
        key = hold.tobytes()
        if hold.any() and not hold.all() and key not in seen:
            seen.add(key)
            rules.append((Rule(p), hold))
    if not rules:
        return RuleModel(float(np.log(y.mean() / (1 - y.mean()))), ())
    intercept, weights = lasso_logistic(np.stack([h for _, h in rules], axis=1).astype(float), y, penalty)
    kept = [Rule(r.terms, float(w)) for (r, _), w in zip(rules, weights) if abs(w) > 1e-9]
    return RuleModel(intercept, tuple(kept))


def held_out(ident: Column) -> Column:
    """Rows that no model learns from: crc32 of the identifier as text, mod 4, is 2."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
          text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality") -> RuleModel:
    """Fit on at most about ``sample_rows`` labelled documents that are not held out.

    The sample is the labelled identifiers with the smallest hashes; several labels of one
    identifier are averaged, null labels and identifiers are left out.  Of their rows, equal
    ones count once, and at most ``2 * sample_rows`` with the smallest hashes leave the cluster.
    """
    known = (take(labels, id=label_id, label=label_col).where("id is not null and label is not null")
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.avg("label").alias("label")))
    n = known.count()
    share = min(1.0, sample_rows / max(n, 1))
    bound = int(share * (1 << 30))
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < bound)
    rows = take(docs, id=id_col, text=text_col).select("id", text_of("text").alias("text"))
    rows = rows.join(F.broadcast(sample), "id")  # sample_rows identifiers at any size
    stats = statistics(F.col("text"))
    names = list(stats)
    order = F.xxhash64("id", "text")
    rows = rows.select("id", "label", order.alias("h"), *[c.cast("double").alias(k) for k, c in stats.items()])
    rows = rows.dropDuplicates(["id", "h"]).orderBy("h", "label", "id").limit(2 * sample_rows)
    got = materialize(rows, "quality-sample").collect()  # written first, so the limit is taken on the cluster
    got.sort(key=lambda r: (r["h"], r["label"], r["id"]))
    x = np.array([[r[k] for k in names] for r in got], float).reshape(len(got), len(names))
    return fit(x, np.array([r["label"] >= 0.5 for r in got], float), names)


def score_documents(docs: DataFrame, model: RuleModel, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, held_out, score``.

    Null texts count as empty; empty texts are scored like any other (they have no repeats, symbols or capitals).
    Identifiers may be null or repeated; other columns are ignored; an empty table gives an
    empty result.
    """
    rows = with_statistics(take(docs, id=id_col, text=text_col), text_of("text"))
    return rows.select("id", held_out(F.col("id")).alias("held_out"), model.score(fields()).alias("score"))


def drop_low_quality(docs: DataFrame, model: RuleModel, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, with all their columns."""
    rows = with_statistics(flatten(docs), text_of(flat_name(docs, text_col)))
    return restore(rows.where(model.score(fields()) >= least), docs)
