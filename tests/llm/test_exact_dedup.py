import hashlib
import re
from collections import Counter, defaultdict

from tidemark.llm import exact_dedup as X


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_groups_match_brute_force(odd_docs, odd_rows):
    got = X.exact_groups(odd_docs, fan_in=2).collect()
    assert len(got) == len(odd_rows)
    groups = defaultdict(list)
    for r in odd_rows:
        groups[norm(r[1])].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            want[(i, min(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r["id"], r["keep_id"], r["group_size"], bytes(r["digest"]).hex()) for r in got) == want
    # exactly one row of each group is kept, and it has the smallest identifier
    kept = [r for r in got if r["kept"]]
    assert Counter(bytes(r["digest"]) for r in kept) == Counter({bytes(r["digest"]): 1 for r in got})
    assert all(r["id"] == r["keep_id"] for r in kept)


def test_hot_text_over_many_blocks(spark, make_docs):
    docs = make_docs([(i, "copy" if i % 3 else f"text {i}") for i in range(600)])
    got = {r["id"]: r for r in X.exact_groups(docs, fan_in=2).collect()}
    assert got[1]["kept"] and got[1]["group_size"] == 400
    assert all(got[i]["keep_id"] == 1 and not got[i]["kept"] for i in got if i % 3 and i != 1)
    assert all(got[i]["kept"] for i in got if i % 3 == 0)


def test_drop_copies_keeps_columns(odd_docs, odd_rows):
    out = X.drop_exact_copies(odd_docs)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert sorted(norm(r[1]) for r in rows) == sorted({norm(r[1]) for r in odd_rows})
    by_text = {norm(r[1]): r[0] for r in rows}
    assert by_text[norm(odd_rows[0][1])] == 3 and by_text[""] == 7


def test_empty(empty_docs):
    assert X.exact_groups(empty_docs).count() == 0
    assert X.drop_exact_copies(empty_docs).count() == 0


def test_the_row_that_stays_is_defined(spark, odd_docs):
    """Of rows with one identifier whose texts are equal up to white space, the first read stays,
    with its own columns; rows without an identifier only among themselves."""
    def row(i, text, source):
        return (i, text, "l" + source, source, None, None, None, None, None)

    rows = [row(4, "a  b", "p"), row(4, "a b", "q"), row(4, "a\tb", "r"), row(9, "a b", "s"), row(None, "a b", "t"),
            row(None, "c", "u"), row(None, "c ", "v"), row(None, "c  ", "w")]
    docs = spark.createDataFrame(rows, odd_docs.schema).coalesce(1)
    got = sorted((r["text"], r["source"], r["lang"]) for r in X.drop_exact_copies(docs).collect())
    assert got == [("a  b", "p", "lp"), ("c", "u", "lu"), ("c ", "v", "lv")]
