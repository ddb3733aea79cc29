import random
import zlib

import numpy as np
import pytest

from tidemark.llm import quality as Q

from .conftest import PROSE


def corpus(n=400):
    rng = random.Random(1)
    words = PROSE.split()
    docs, labels = [], []
    for i in range(n):
        t = " ".join(rng.choice(words) for _ in range(rng.randint(20, 200))).capitalize() + "."
        bad = i % 4 == 0
        if bad:
            t = [t.upper() + "!!", " | ".join(t.split()), " ".join(w + "***" for w in t.split()),
                 " ".join(w for w in t.split()[:6] for _ in range(12))][i // 4 % 4]
        docs.append((i, t))
        labels.append((i, int(not bad)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark, make_docs):
    docs, labels = corpus()
    df = make_docs(docs)
    lb = spark.createDataFrame([*labels, (None, 1), (3, None), (labels[5])], "doc_id long, quality int")
    return docs, dict(labels), df, lb, Q.train(df, lb)


def test_held_out_accuracy(fitted):
    docs, labels, df, lb, model = fitted
    got = {r["id"]: r for r in Q.score_documents(df, model).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"]]
    assert np.mean([(got[i]["score"] >= 0.7) == labels[i] for i in held]) >= 0.97
    assert 0 < len(model.rules) < 200


def test_rows_of_one_labelled_id_are_cut_on_the_cluster(spark, make_docs, monkeypatch):
    docs, _ = corpus(300)
    ident = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2)
    df = make_docs([(ident, t) for _, t in docs])
    taken, collect = [], type(df).collect

    def spy(self):
        out = collect(self)
        taken.append(len(out))
        return out

    monkeypatch.setattr(type(df), "collect", spy)
    Q.train(df, spark.createDataFrame([(ident, 1)], "doc_id long, quality int"), sample_rows=10)
    assert max(taken) == 20


def test_held_out_labels_do_not_matter(spark, fitted):
    docs, labels, df, _, model = fitted
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels.items()]
    again = Q.train(df, spark.createDataFrame(flipped, "doc_id long, quality int"))
    assert again.rules == model.rules and again.intercept == model.intercept


def test_columns_equal_numpy(fitted):
    model = fitted[-1]
    df = Q.take(fitted[2], text="text")
    stats = Q.statistics(Q.F.col("text"))
    rows = df.select(*[c.cast("double").alias(k) for k, c in stats.items()],
                     model.score(stats).alias("score")).collect()
    x = np.array([[r[k] for k in stats] for r in rows])
    total = model.intercept + sum(r.weight * r.holds(x, list(stats)) for r in model.rules)
    assert np.allclose([r["score"] for r in rows], 1 / (1 + np.exp(-total)))


def test_low_quality_goes(fitted, odd_docs, odd_rows):
    docs, labels, df, _, model = fitted
    out = Q.drop_low_quality(df, model)
    assert out.columns == df.columns
    assert {r["doc_id"] for r in out.collect()} == {
        r["id"] for r in Q.score_documents(df, model).collect() if r["score"] >= 0.7}
    scores = Q.score_documents(odd_docs, model).collect()
    assert len(scores) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in scores)


def test_without_labels_documents_stay(spark, odd_docs, empty_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.train(odd_docs, none)
    assert Q.drop_low_quality(odd_docs, model).count() == odd_docs.count()
    assert Q.score_documents(empty_docs, Q.train(empty_docs, none)).count() == 0
