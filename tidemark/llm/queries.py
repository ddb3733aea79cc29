"""The registered queries of the operators: thin digests in the contract's columns."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, decontaminate, exact_dedup, licenses, periodic, pii, quality, resampling, secret_scan,
                          sharding, simhash, toxicity, warc)

SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, links at 2 or fewer differing bits."""
    out = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score")


def span_text(spans: str, kinds: tuple[str, ...]):
    """Spans as kind:start:end, comma-joined, in their order."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.scan(table(spark, sf_dir, "documents")).withColumn("base", F.filter("spans", lambda s: s["rule"]))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)").alias(f"n_{name}")
              for k, name in enumerate(pii.KINDS)]
    return out.select(F.col("id").alias("doc_id"), *counts,
                      F.sha2(span_text("base", pii.KINDS), 256).alias("base_sha256"),
                      span_text("spans", pii.KINDS).alias("spans"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents"))
    out = out.withColumn("base", F.filter("spans", lambda s: s["kind"] < 3))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)").alias(f"n_{name}")
              for k, name in enumerate(secret_scan.KINDS[:3])]
    return out.select(F.col("id").alias("doc_id"), *counts,
                      F.sha2(span_text("base", secret_scan.KINDS), 256).alias("base_sha256"),
                      span_text("spans", secret_scan.KINDS).alias("spans"), "model")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return out.select(F.col("id").alias("doc_id"), "held_out", "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


def tokenizer_path(name: str) -> str:
    """A public tokenizer file: below $TIDEMARK_TOKENIZERS, else of the installed collection."""
    folder = os.environ.get("TIDEMARK_TOKENIZERS")
    return os.path.join(folder, name) if folder else public_tokenizers().path(name)


def public_tokenizers():
    import public_tokenizers as collection

    return collection


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))
    out = bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers().PATTERN, decoded=True)
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(bpe.ids_text("ids"), 256).alias("ids_sha256"),
                      F.sha2("bytes", 256).alias("decoded_sha256"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``key``: 2 regions x 2 racks x 2 shards, grown by one shard."""
    out = sharding.assign_shards(table(spark, sf_dir, "documents"), sharding.default_tree(SHARDS),
                                 sharding.default_tree(SHARDS, grown=1))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
                      "shard", "slot", "grown_shard")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = warc.read_archives(warc.write_archives(pages))
    id_type = pages.schema["page_id"].dataType
    return out.select(F.col("page_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest",
                      "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold: 5-word shingles, containment 0.8 or more."""
    out = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "item_id", "shared", "containment")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents with 20 words or more, drawn towards the benchmark texts."""
    out = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def with_repeats(docs: DataFrame) -> DataFrame:
    """The contract's input: ``doc_id, text``, where one text in ten ends in a repeated stretch.

    With n words, h the CRC-32 of the identifier, g = h div 10, a = g % n and
    p = 1 + (n - a) div (3 + g % 8), word i >= a becomes word a + (i - a) % p if h % 10 = 0.
    Rows without words or identifier stay as they are.
    """
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    marked = rows.where("h % 10 = 0").select("doc_id", "text", F.expr("h div 10").alias("g"), F.filter(
        F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"))
    marked = marked.withColumn("n", F.coalesce(F.size("w"), F.lit(0)).cast("long"))
    marked = marked.withColumn("a", F.expr("g % greatest(n, 1)"))
    marked = marked.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    changed = F.expr("array_join(concat(slice(w, 1, int(a)), slice(flatten(array_repeat("
                     "slice(w, int(a) + 1, int(p)), int((n - a) div p) + 1)), 1, int(n - a))), ' ')")
    marked = marked.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))
    return rows.where("h is null or h % 10 <> 0").select("doc_id", "text").unionByName(marked)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    top = F.get(F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    out = out.withColumn("top", top)
    return out.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "top.start",
                      (-F.col("top.shorter")).alias("length"), "top.period",
                      F.expr("1000 * -top.shorter div top.period").alias("exponent_milli"),
                      F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "held_out", "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_licenses": op2_licenses,
        "op3_pii": op3_pii,
        "op4_secrets": op4_secrets,
        "op5_quality": op5_quality,
        "op6_bpe": op6_bpe,
        "op7_sharding": op7_sharding,
        "op8_warc": op8_warc,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_decontamination": op10_decontamination,
        "op11_resampling": op11_resampling,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_toxicity": op13_toxicity,
    }


def _draw(name: str, weight: float) -> str:
    return (f"(-ln((('0x' || substr(md5('{name}|' || k), 1, 13))::BIGINT::DOUBLE + 0.5) "
            f"/ 4503599627370496.0) / {weight}.0)")


def _descend(regions: list[tuple[str, float]]) -> str:
    """SQL of the descent through 2 x 2 x 2 shards, and a ninth alone in its region."""
    def pair(a: str, b: str, w: float, x: str, y: str) -> str:
        return f"CASE WHEN {_draw(a, w)} <= {_draw(b, w)} THEN {x} ELSE {y} END"

    racks = [pair(f"shard{2 * r}", f"shard{2 * r + 1}", 1, str(2 * r), str(2 * r + 1)) for r in range(4)]
    inner = [pair(f"rack{2 * r}", f"rack{2 * r + 1}", 2, racks[2 * r], racks[2 * r + 1]) for r in range(2)]
    out = pair("region0", "region1", 4, inner[0], inner[1])
    for name, weight in regions:
        out = (f"CASE WHEN {_draw(name, weight)} < least({_draw('region0', 4)}, {_draw('region1', 4)}) "
               f"THEN 8 ELSE {out} END")
    return out


OP7_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
               lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, 'null') AS k FROM documents),
s AS (SELECT doc_id, strlen(d.t)::BIGINT + 1 AS size,
             xor(list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(regexp_extract_all(hex(encode(d.t)), '..'), lambda x: ('0x' || x)::BIGINT)),
                 lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
             ({_descend([])})::INTEGER AS shard,
             ({_descend([("grown-region8", 1)])})::INTEGER AS grown_shard
      FROM d, crc)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot
FROM s
"""

def _license_sql() -> str:
    """Every block against every template, by list functions."""
    every = licenses.PHRASES + licenses.NOTICES
    span = max(len(t.words) for t in every)
    rows = ", ".join(f"({i}, '{t.label}', {t.phrase}, {t.words}, {licenses.need(t)})" for i, t in enumerate(every))
    return f"""
WITH t(template, label, phrase, words, need) AS (VALUES {rows}),
d AS (SELECT doc_id, row_number() OVER () AS uid,
        regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT uid, start, w[start + 1 : start + {2 * span}] AS block
      FROM (SELECT uid, w, unnest(range(0, greatest(len(w), 1)::BIGINT, {span})) AS start FROM d)),
m AS (SELECT uid, start, label, phrase,
             len(list_intersect(list_distinct(words), list_distinct(block))) AS shared,
             len(list_distinct(words)) AS size, need,
             list_transform(list_filter(range({span}), lambda p: block[p + 1 : p + len(words)] = words),
                            lambda p: start + p) AS places
      FROM b, t),
f AS (SELECT * FROM m WHERE shared >= need AND (NOT phrase OR len(places) > 0)),
h AS (SELECT uid, max(shared / size) AS score,
             coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
             coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels,
             coalesce(sum(len(places)) FILTER (phrase), 0)::BIGINT AS n_base,
             min(list_min(places)) FILTER (phrase) AS first_word,
             max(list_max(places)) FILTER (phrase) AS last_word
      FROM f GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN h USING (uid)
"""


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS best FROM p)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM r
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, least(5, len(w)) AS n,
             unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2),
                                   lambda p: array_to_string(w[p : p + least(5, len(w)) - 1], ' '))) AS s
      FROM b WHERE len(w) > 0),
s AS (SELECT DISTINCT id, n, unnest(list_transform(range(1, len(w) - n + 2),
                                     lambda p: array_to_string(w[p : p + n - 1], ' '))) AS s
      FROM d, (SELECT DISTINCT n FROM i)),
c AS (SELECT item_id, count(*) AS size FROM i GROUP BY item_id)
SELECT id AS doc_id, item_id, count(*) AS shared, count(*) / any_value(size) AS containment
FROM i JOIN s USING (n, s) JOIN c USING (item_id)
GROUP BY id, item_id HAVING count(*) >= ceil(0.8 * any_value(size) - 1e-9)
"""


OP11_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
               lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, row_number() OVER () AS uid, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT uid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
names AS MATERIALIZED (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT,
                 list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: ('0x' || x)::BIGINT)),
                 lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
          FROM (SELECT f FROM df UNION SELECT f FROM bf), crc),
s AS (SELECT bucket, count(*) AS s FROM df JOIN names USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN names USING (f) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM df)::DOUBLE AS ns, (SELECT count(*) FROM bf)::DOUBLE AS nt),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (ns + 10000) / ((coalesce(s, 0) + 1.0::DOUBLE) * (nt + 10000))))::BIGINT AS gain
      FROM s FULL JOIN t USING (bucket), n),
w AS (SELECT uid, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM df JOIN names USING (f) JOIN g USING (bucket) GROUP BY uid),
h AS (SELECT doc_id, uid, len(w) AS n_words,
             (('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS u FROM d),
r AS (SELECT doc_id, uid, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln(u)))::BIGINT AS score FROM h LEFT JOIN w USING (uid)),
o AS (SELECT uid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, uid) AS rank, count(*) OVER () AS n
      FROM r WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM r LEFT JOIN o USING (uid)
"""


def oracles() -> dict[str, str]:
    return {"op2_licenses": _license_sql(), "op7_sharding": OP7_SQL, "op8_warc": OP8_SQL, "op9_exact_dedup": OP9_SQL,
            "op10_decontamination": OP10_SQL, "op11_resampling": OP11_SQL}
