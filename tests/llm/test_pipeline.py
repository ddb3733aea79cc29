import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tidemark.llm import bpe, quality

from .test_decontaminate import brute as leaks
from .test_exact_dedup import norm
from .test_simhash import brute_fingerprint, components

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    rows = docs.collect()
    good = {r["id"] for r in quality.score_documents(docs, model).collect() if r["score"] >= 0.7}
    rows = [r for r in rows if r["doc_id"] in good]
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(norm(r["text"]), r)
    rows = list(first.values())
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    root = components(set(fps.values()), 2)
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(least.get(root[f], i), i)
    rows = [r for r in rows if least[root[fps[r["doc_id"]]]] == r["doc_id"]]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, _, _ in leaks([(r["doc_id"], r["text"]) for r in rows], items)}
    rows = [r for r in rows if r["doc_id"] not in bad]
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")))
    want = {r["doc_id"]: (enc.encode_ordinary(r["text"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows}
    got = {r["doc_id"]: (list(r["ids"]), r["decoded_sha256"]) for r in pipeline.run(spark, SF).collect()}
    assert len(got) > 100 and got == want


@pytest.mark.parametrize("frame", ["odd_docs", "empty_docs"])
def test_stages_take_odd_rows(spark, request, frame):
    docs = request.getfixturevalue(frame)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        rows = out.collect()
        assert len(rows) <= docs.count()
        assert (len(rows) == 0) == (frame == "empty_docs")


def test_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
