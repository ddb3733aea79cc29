import math
import re
from collections import Counter

from tidemark.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOTICE = {t.label: t.text for t in L.NOTICES}


def brute(text, templates=L.PHRASES + L.NOTICES):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    span = max(len(t.words) for t in templates)
    places, labels, base, score = set(), set(), set(), 0.0
    for start in range(0, max(len(words), 1), span):
        block = words[start:start + 2 * span]
        for t in templates:
            share = len(set(t.words) & set(block)) / len(set(t.words))
            if math.ceil(t.threshold * len(set(t.words)) - 1e-9) > share * len(set(t.words)) + 1e-9:
                continue
            if t.phrase:
                at = [(start + p, t.label) for p in range(span) if block[p:p + len(t.words)] == t.words]
                if not at:
                    continue
                places.update(at)
                base.add(t.label)
            labels.add(t.label)
            score = max(score, share)
    return len(words), tuple(sorted(places)), tuple(sorted(labels)), tuple(sorted(base)), round(score, 9)


TEXTS = [
    "Released under the MIT License.", "MIT\nlicense mit license MIT-license", "apache\t license, version 2",
    "the GNU General Public License and the general public licence", "mitlicense emit license", None, "", "license",
    ("Lorem " * 61) + "MIT " + "License " + "x " * 200 + "apache license",
    NOTICE["mit"].upper(), "prefix " * 40 + NOTICE["bsd"].replace(" ", " ,\n"),
    " ".join(w for i, w in enumerate(NOTICE["apache"].split()) if i % 9),
    " ".join(w for i, w in enumerate(NOTICE["gpl"].split()) if i % 2),
    "Licensed under CC BY-NC 4.0.", "under cc by", "KMIT LICENSE MITK license", "ÉMIT license",
    "word " * 20000 + "general public license " + "word " * 20000 + NOTICE["mpl"],
]


def test_matches_brute_force(make_docs):
    pairs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[0])]
    got = Counter()
    for r in L.scan(make_docs(pairs)).collect():
        got[(r["id"], r["n_words"], tuple((p["word"], p["label"]) for p in r["places"]), tuple(r["labels"]),
             tuple(r["base_labels"]), round(r["score"], 9))] += 1
        starts = [p["word"] for p in r["places"]]
        assert r["n_base"] == len(starts)
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
    assert got == Counter((i, *brute(t)) for i, t in pairs)


def test_every_notice_is_found(make_docs):
    got = {r["id"]: r["labels"] for r in L.scan(make_docs([(i, t.text) for i, t in enumerate(L.NOTICES)])).collect()}
    assert all(t.label in got[i] for i, t in enumerate(L.NOTICES))


def test_odd_rows_and_empty(odd_docs, odd_rows, empty_docs):
    got = L.scan(odd_docs).collect()
    assert Counter((r["id"], r["n_words"]) for r in got) == Counter((r[0], brute(r[1])[0]) for r in odd_rows)
    assert L.scan(empty_docs).count() == 0
