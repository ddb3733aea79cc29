import re
from collections import Counter

from tidemark.llm import pii as P

RULES = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(n):
    total = 0
    for i, c in enumerate(reversed(n)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule, text or ""):
            n = re.sub("[^0-9]", "", m.group())
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m.group().split("."))
                    or k == 2 and 16 <= len(n) <= 19 and luhn(n) or k == 3 and 8 <= len(n) <= 15):
                out.append((k, m.start(), m.end()))
    return out


TEXTS = [
    "mail a.b@c.de, then x@y.z_q@w.v and @a.b foo@@bar@x.y a@b", "été \U0001f600 ü@é.com ü a@b.co 日本 c@d.ef",
    "1.2.3.4 256.1.1.1 1.2.3.4.5 01.002.3.255 1.2.3 999999999999999999999.1.1.1 1..2.3.4.5",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 12 4111  1111 5500005555555559x",
    "+1 (807) 555-6237 +12 +1234567 +12345678 +1 2345678901234567 ++49 170 1234567.",
    "a@b.c+1 555 123 4567 1.2.3.4@x.y 4111111111111111@x.yz", None, "", "no digits", "@", "9" * 5000, "a" * 5000 + "@",
    "a1@b.cd " * 400,
]


def test_rules_match_brute_force(make_docs, odd_rows):
    pairs = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[0])] + [(r[0], r[1]) for r in odd_rows]
    got = Counter((r["id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"] if s["rule"]))
                  for r in P.scan(make_docs(pairs)).collect())
    assert got == Counter((i, tuple(sorted(brute(t)))) for i, t in pairs)


def test_context_discovers_unseen_identifiers(make_docs):
    pairs = [(i, f"filler words tel: +1 555 {1000 + i} {2000 + i} and more") for i in range(30)]
    pairs += [(100, "filler tel: 5551234567 and more"), (101, "count 5551234567x of 7777777777 pieces"),
              (102, "tel: soon"), (103, "so is 5551234567 here too")]
    got = {r["id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if not s["rule"]]
           for r in P.scan(make_docs(pairs)).collect()}
    assert got[100] == [(3, 12, 22)]
    assert got[101] == [] and got[102] == []
    assert got[103] == [(3, 6, 16)]  # the discovered value, wherever it stands


def discovered(make_docs, seeds, texts):
    """Per text, the values found by patterns of the seeds."""
    pairs = [(1000 + i, t) for i, t in enumerate(seeds)] + list(enumerate(texts))
    got = {r["id"]: r["spans"] for r in P.scan(make_docs(pairs)).collect()}
    return [[t[s["start"]:s["end"]] for s in got[i] if not s["rule"]] for i, t in enumerate(texts)]


def test_a_candidate_before_is_the_context(make_docs):
    phones = [f"{i} +1 555 {1000 + i} {2000 + i} and more" for i in range(30)]
    assert discovered(make_docs, phones, ["1 5551234567", "x 2: 5559876543"]) == [["5551234567"], []]
    mails = [f"a{i}@b.co name{i}@host{i}.org end" for i in range(30)]
    assert discovered(make_docs, mails, ["a@b.co bob@localhost", "to bob2@localhost"]) == [["bob@localhost"], []]


def test_a_label_within_the_token_is_the_context(make_docs):
    phones = [f"see Phone2:+1 555 {1000 + i} {2000 + i} and a=x:+2 555 {1000 + i} {2000 + i}" for i in range(30)]
    texts = ["call phone7:5551234567, now", "id9 \u00e9 a=x:5559876543", "see 5552223334", "x:5552223335", "ph:5552223336"]
    assert discovered(make_docs, phones, texts) == [["5551234567"], ["5559876543"], [], [], []]


def test_copies_add_no_weight(make_docs):
    pairs = [(i, "see ref: +1 555 1234 567 now") for i in range(50)] + [(90, "see ref: 5559876543 now")]
    got = {r["id"]: r["spans"] for r in P.scan(make_docs(pairs)).collect()}
    assert got[90] == []


def test_empty(empty_docs):
    assert P.scan(empty_docs).count() == 0


def test_a_text_full_of_findings(make_docs):
    text = "1.2.3.4 x12 " * 5000
    spans = P.scan(make_docs([(1, text)])).collect()[0]["spans"]
    assert [(s["kind"], s["start"], s["end"]) for s in spans if s["rule"]] == brute(text)
