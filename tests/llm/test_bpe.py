import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def replay(ranks):
    return bpe.MergeReplay(ranks, P.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aabeinst  \n'é1"), st.characters(exclude_categories=["Cs"]))),
                max_size=4))
def test_same_ids_as_the_library(replay, reference, texts):
    ends, ids = replay.encode(texts)
    want = [reference.encode_ordinary(t) for t in texts]
    assert ids.tolist() == [i for w in want for i in w]
    assert ends.tolist() == [sum(map(len, want[:k + 1])) for k in range(len(want))]
    at, data = replay.decode(ends, ids)
    assert data.tobytes() == "".join(texts).encode()


@pytest.mark.parametrize("word", ["a" * 3000, "ab" * 700, "thestonthe" * 60, " " * 500, "é" * 400, "x" * 256, "x" * 257])
def test_long_words(replay, reference, word):
    assert replay.encode([word])[1].tolist() == reference.encode_ordinary(word)


def test_other_ranks_with_merges_out_of_order():
    # "abc" ranks below "ab" and is also made of "a" + "bc"
    ranks = {bytes([i]): i for i in range(256)} | {b"bc": 300, b"abc": 256, b"ab": 299, b"abca": 298}
    ref = tiktoken.Encoding("t", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    own = bpe.MergeReplay(ranks, r"\w+")
    for text in ("abcabcab", "aabbccabca", "cabcabcabbc" * 40):
        assert own.encode([text])[1].tolist() == ref.encode_ordinary(text)


def test_store_is_bounded(ranks, reference):
    small = bpe.MergeReplay(ranks, P.PATTERN, store_words=3)
    for t in ("one two three four five", "six seven", "one two", "", "one"):
        assert small.encode([t])[1].tolist() == reference.encode_ordinary(t)
        assert len(small.slots) <= 3


def test_documents_round_trip(odd_docs, odd_rows, ranks, reference):
    out = bpe.encode_documents(odd_docs, ranks, P.PATTERN, decoded=True, keep=("lang", "digest"))
    assert out.columns == ["id", "lang", "digest", "ids", "bytes"]
    got = out.collect()
    want = [(r[0], reference.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in odd_rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r["id"], list(r["ids"]), bytes(r["bytes"])) for r in got), key=key) == sorted(want, key=key)
    back = bpe.decode_documents(out.select("id", "ids"), ranks, P.PATTERN).collect()
    assert sorted(bytes(r["ids"]) for r in back) == sorted(w[2] for w in want)


def test_empty(empty_docs, ranks):
    assert bpe.encode_documents(empty_docs, ranks, P.PATTERN).count() == 0
