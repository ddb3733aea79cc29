import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import queries as Q
from tidemark.llm import toxicity as X

from .conftest import PROSE

SF = "/root/testdata/sf0.01"
INSULTS = ["grubbler", "snorkfool", "vilewort"]


def corpus(n=1500):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(PROSE.split()) for _ in range(rng.randint(15, 150))]
        bad = i % 5 == 0
        if bad:
            for _ in range(max(2, len(w) // 12)):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS) + rng.choice(["", "s", "ing", "est", "ly"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark, make_docs):
    docs, labels = corpus()
    lb = spark.createDataFrame([*labels, (None, 1), (3, None), labels[6]], "doc_id long, toxic int")
    got = {r["id"]: r for r in X.score_documents(make_docs(docs), lb).collect()}
    return dict(docs), dict(labels), got


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def test_held_out_accuracy(scored):
    docs, labels, got = scored
    assert all(r["held_out"] == (fold(i) == 0) for i, r in got.items()) and len(got) == len(docs)
    held = [i for i in docs if fold(i) == 0]
    assert np.mean([(got[i]["score"] >= 0.5) == labels[i] for i in held]) >= 0.98
    clean = [got[i]["score"] for i in held if not labels[i]]
    assert np.mean([s >= 0.5 for s in clean]) <= 0.01


def brute_evidence(docs, labels, order=4, class_order=3, d=0.75):
    """Textbook interpolated Kneser-Ney with dictionaries of byte strings."""
    counts = {p: Counter() for p in ("toxic", "ordinary", "every")}
    grams = {}
    for i, text in docs.items():
        g = []
        for w in text.encode().translate(X.FOLD).split():
            s = b"\x01" * (order - 1) + w + b"\x02"
            g += [s[k:k + order] for k in range(len(s) - order + 1)]
        grams[i] = g
        counts["every"].update(g)
        if i in labels and fold(i) in (1, 2, 3):
            counts["toxic" if labels[i] else "ordinary"].update(g)
    levels = {p: {order: c} for p, c in counts.items()}
    for c in levels.values():
        for n in range(order - 1, 0, -1):
            c[n] = Counter(g[1:] for g, k in c[n + 1].items() if k)
    sums = {p: {n: defaultdict(lambda: [0, 0]) for n in c} for p, c in levels.items()}
    for p, c in levels.items():
        for n, t in c.items():
            for g, k in t.items():
                sums[p][n][g[:-1]][0] += k
                sums[p][n][g[:-1]][1] += 1

    def prob(p, g):
        if not g:
            return 1 / 256
        p_here = p if len(g) >= class_order else "every"
        low = prob(p, g[1:])
        total, kinds = sums[p_here][len(g)][g[:-1]]
        return (max(levels[p_here][len(g)][g] - d, 0) + d * kinds * low) / total if total else low

    ratio = {g: math.log(prob("toxic", g) / prob("ordinary", g)) for g in counts["every"]}
    return {i: (len(g), sum(ratio[x] for x in g)) for i, g in grams.items()}


def test_evidence_equals_brute_force(scored):
    docs, labels, got = scored
    want = brute_evidence(docs, labels)
    for i, r in got.items():
        assert r["grams"] == want[i][0] and r["evidence"] == pytest.approx(want[i][1], abs=1e-6)


def test_many_blocks_give_the_same(scored, spark, make_docs, monkeypatch):
    docs, labels, got = scored
    monkeypatch.setattr(X, "BLOCK_DOCS", 7)
    lb = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    again = {r["id"]: r["evidence"] for r in X.score_documents(make_docs(docs.items()), lb).collect()}
    assert all(again[i] == pytest.approx(r["evidence"], abs=1e-6) for i, r in got.items())


def test_held_out_labels_do_not_matter(scored, spark, make_docs):
    docs, labels, got = scored
    flipped = [(i, 1 - t if fold(i) == 0 else t) for i, t in labels.items()]
    again = X.score_documents(make_docs(docs.items()), spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert all(r["score"] == pytest.approx(got[r["id"]]["score"], abs=1e-9) for r in again.collect())


def test_odd_rows(spark, odd_docs, odd_rows, empty_docs):
    _, labels = corpus(100)
    lb = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = X.score_documents(odd_docs, lb).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert sorted(r["grams"] == 0 for r in got) == sorted(not (r[1] or "").strip() for r in odd_rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in X.score_documents(odd_docs, none).collect()} == {0.0}
    assert X.score_documents(empty_docs, lb).count() == 0


def test_query_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = Q.op13_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, y in held]) >= 0.93
