"""License scans: an exact set-similarity join of text blocks with license templates.

Words are maximal runs of letters and digits (any character above ASCII counts as one),
A-Z lower-cased.  A text is cut into overlapping blocks of ``2 L`` words, one every ``L``
words, where L is the longest template: every place of a template lies whole in a block.

* Global order: the template words are counted over all documents; words are ordered from
  rare to frequent.  Words of no template never count towards an overlap and are dropped
  from the blocks.
* A template T with threshold c needs an overlap of a = ceil(c |T|) words.  Length filter:
  |B| >= a.  Prefix filter: T and B share a word among the |T| - a + 1 rarest of T and the
  |B| - a + 1 rarest of B.  Positional filter: with the first shared word at positions i
  and j, 1 + min(|T| - i, |B| - j) >= a.
* Pairs that pass are verified with the whole word sets.  Phrases (threshold 1) are then
  located: places where their words stand consecutively.

The template table is a parameter of fixed size and is the only side that is broadcast.
Documents without a rare template word are left out by the scan; the others are exploded to
(row, block) keys, so one long document is spread over the cluster like many short ones.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, take, text_of

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CHAR = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
WORD = CHAR + "+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split(" ")


#: Phrases that are located word by word.
PHRASES = (
    Template("mit", "mit license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
)
#: Notices that are found by containment; short ones need all their words.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
                    "and associated documentation files to deal in the software without restriction"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of "
                       "the license at www apache org licenses"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
                    "gnu general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc-by-nc", "licensed under cc by nc", 1.0),
    Template("cc-by", "licensed under a creative commons attribution license", 1.0),
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), NOT_WORD), lambda w: w != "")


def word_order(texts: DataFrame, vocabulary: set[str]) -> list[str]:
    """The vocabulary from rare to frequent over all texts (counts; ties by word)."""
    words = texts.select(F.explode(F.split(F.lower("text"), NOT_WORD)).alias("w"))
    counts = {r["w"]: r["n"] for r in words.where(F.col("w").isin(sorted(vocabulary))).groupBy("w")
              .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most the template words
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def need(t: Template) -> int:
    return math.ceil(t.threshold * len(set(t.words)) - 1e-9)


def scan(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_words, places, labels, base_labels, n_base, first_word,
    last_word, score``.

    ``places`` lists (label, word) of every phrase place, in text order; ``n_base``,
    ``first_word`` and ``last_word`` count them and give their first and last word (null
    without one); ``base_labels`` are their labels and ``labels`` those of all templates met
    (sorted arrays); ``score`` is the largest containment of a template met, else 0.  Null
    texts count as empty (no words, no labels).  Repeated rows are scanned each for itself;
    an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = take(docs, id=id_col, text=text_col).select("id", text_of("text").alias("text"))
    rank = {w: i for i, w in enumerate(word_order(rows, {w for t in templates for w in t.words}))}
    longest = max(len(t.words) for t in templates)
    table = []
    for number, t in enumerate(templates):
        tokens = sorted({rank[w] for w in t.words})
        table += [(number, t.label, t.phrase, [rank[w] for w in t.words], tokens, len(tokens), need(t), i + 1, token)
                  for i, token in enumerate(tokens[:len(tokens) - need(t) + 1])]
    prefixes = spark.createDataFrame(
        table, "template int, label string, phrase boolean, phrase_tokens array<int>, t_tokens array<int>, "
               "t_size int, need int, i int, token int")
    ranks = spark.createDataFrame(list(rank.items()), "w string, token int")
    rare = sorted({w for w in rank if any(r[-1] == rank[w] for r in table)})
    holds_rare = F.col("text").rlike(f"(?i)(?<!{CHAR})(?:{'|'.join(re.escape(w) for w in rare)})(?!{CHAR})")
    seen = materialize(rows.select("id", F.monotonically_increasing_id().alias("uid"),
                                   F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
                                   F.when(holds_rare, F.col("text")).alias("text")), "license-rows")

    words = seen.where("text is not null").select("uid", words_of(F.col("text")).alias("all"))
    blocks = words.select("uid", "all", F.explode(F.expr(
        f"sequence(0, greatest(size(all) - 1, 0), {longest})")).alias("start"))
    words = blocks.select("uid", "start", F.posexplode(F.expr(f"slice(all, start + 1, {2 * longest})"))
                          .alias("at", "w"))
    tokens = (words.join(F.broadcast(ranks), "w").groupBy("uid", "start")
              .agg(F.sort_array(F.collect_list(F.struct(F.expr("start + at").alias("at"), "token"))).alias("seen"))
              .withColumn("tokens", F.expr("array_sort(array_distinct(seen.token))")))
    placed = tokens.select("uid", "start", "tokens", F.size("tokens").alias("b_size"),
                           F.posexplode("tokens").alias("j0", "token"))
    met = (placed.join(F.broadcast(prefixes), "token")
           .where("b_size >= need and j0 + 1 <= b_size - need + 1")
           .groupBy("uid", "start", "template")
           .agg(F.min("i").alias("i"), F.min(F.col("j0") + 1).alias("j"))
           .join(F.broadcast(prefixes.select("template", "label", "phrase", "phrase_tokens", "t_tokens", "t_size", "need")
                             .distinct()), "template")
           .join(tokens, ["uid", "start"])
           .where("1 + least(t_size - i, size(tokens) - j) >= need")
           .withColumn("shared", F.size(F.array_intersect("t_tokens", "tokens")))
           .where("shared >= need"))
    found = met.withColumn("places", F.expr(f"""
        case when phrase then transform(filter(sequence(0, size(seen) - 1), k -> seen[k].at < start + {longest}
            and slice(seen, k + 1, size(phrase_tokens)) =
                transform(phrase_tokens, (t, n) -> struct(seen[k].at + n as at, t as token))),
            k -> struct(seen[k].at as word, label)) end"""))
    found = found.where("not phrase or size(places) > 0")
    hits = found.groupBy("uid").agg(
        F.sort_array(F.flatten(F.collect_list("places"))).alias("places"),
        F.sort_array(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.max(F.col("shared") / F.col("t_size")).alias("score"))
    none = F.array().cast("array<string>")
    return (seen.select("id", "uid", "n_words").join(hits, "uid", "left")
            .select("id", "n_words", F.coalesce("places", F.array().cast(hits.schema["places"].dataType))
                    .alias("places"),
                    F.coalesce("labels", none).alias("labels"), F.coalesce("base_labels", none).alias("base_labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score"))
            .withColumns({"n_base": F.size("places").cast("long"),
                          "first_word": F.expr("array_min(transform(places, p -> cast(p.word as bigint)))"),
                          "last_word": F.expr("array_max(transform(places, p -> cast(p.word as bigint)))")}))
