import base64
import hashlib
import os
from collections import Counter, defaultdict

import pytest
import zstandard

from tidemark.llm import warc as W

SCHEMA = "page_id long, url string, html string, uid string, digest string, HTML string"


def rows():
    out = [(i, f"http://h/{i}?a=b c\r\nX: y", f"<p>{i % 5}</p>" * (i + 1 if i % 2 else 1), "u", None, "z") for i in range(40)]
    out += [(41, None, None, None, None, None), (42, "u", "", "u", "d", "z"), (None, "n", "<p>0</p>", "u", "d", "z"),
            (7, "again", "same", "u", "d", "z"), (7, "again", "same", "u", "d", "z"), (43, "é", "été 日本 \U0001f600", None, None, None),
            (44, "long", "x" * 300_000 + "\r\n\r\nWARC/1.1\r\n", "u", "d", "z"), (None,) * 6]
    return out


def brute(pages, least=0):
    groups = defaultdict(list)
    for r in pages:
        groups[(r[2] or "").encode()].append(r[0])
    out = Counter()
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        best = max(ids, key=lambda i: (i is not None, i or 0))
        responses = 1 if len(payload) >= least else len(ids)
        for i in ids:
            if responses and (i == best or len(payload) < least):
                responses -= 1
                out[(i, len(payload), digest, "response", None)] += 1
            else:
                out[(i, len(payload), digest, "revisit", best)] += 1
    return out


def number(v):
    return None if v is None else int(v)


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    pages = rows()
    index = W.write_archives(spark.createDataFrame(pages, SCHEMA), frame_bytes=2000, bundle_bytes=3000,
                             revisit_least=least)
    back = W.read_archives(index, payloads=True).collect()
    got = Counter((number(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"]))
                  for r in back)
    assert got == brute(pages, least)
    payloads = {r["payload_digest"]: bytes(r["payload"]) for r in back if r["record_type"] == "response"}
    assert sorted(payloads.values()) == sorted({(r[2] or "").encode() for r in pages})
    assert Counter(r["url"] for r in back) == Counter(r[1] for r in pages)
    assert len({r["record_id"] for r in back}) == len(pages)


def test_index_leads_to_records(spark):
    index = W.write_archives(spark.createDataFrame(rows(), SCHEMA), frame_bytes=2000)
    entries = index.collect()
    records = {r["record_id"]: bytes(r["record"]) for r in W.fetch_records(index).collect()}
    assert len(records) == len(entries)
    for e in entries:
        data = records[e["record_id"]]
        assert len(data) == e["length"] and data.startswith(b"WARC/1.1\r\n")
        assert f"WARC-Record-ID: {e['record_id']}\r\n".encode() in data[:400]


def test_frames_are_independent_and_the_bundle_is_plain_zstandard(tmp_path):
    w = W.BundleWriter(f"file://{tmp_path}", "a.warc.zst", 1000)
    blocks = [os.urandom(300) for _ in range(20)]
    places = [w.add(W.record([("WARC-Type", "resource")], b)) for b in blocks]
    w.close()
    table = W.seek_table(w.uri)
    assert len(table) > 5 and all(p <= 1000 for _, _, p in table)
    for (frame, offset), block in zip(places, blocks):
        plain = W.read_frame(w.uri, *table[frame])
        assert [b for at, _, _, b in W.parse_records(plain) if at == offset] == [block]
    raw = (tmp_path / "a.warc.zst").read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert [f["WARC-Type"] for _, _, f, _ in W.parse_records(whole)] == ["warcinfo"] + ["resource"] * 20


def test_damage_is_noticed(tmp_path):
    w = W.BundleWriter(f"file://{tmp_path}", "b.warc.zst", 1000)
    w.close()
    raw = bytearray((tmp_path / "b.warc.zst").read_bytes())
    raw[-1] ^= 1
    (tmp_path / "b.warc.zst").write_bytes(raw)
    with pytest.raises(ValueError):
        W.seek_table(w.uri)


def test_empty(spark):
    index = W.write_archives(spark.createDataFrame([], SCHEMA))
    assert index.count() == 0 and W.read_archives(index).count() == 0
