"""Personal data: rules, and identifiers found by bootstrapped context patterns.

Everything is Spark SQL.

1. One scan of the texts collects, per kind, the matches of the rule and the text between
   them; offsets are running sums over these pieces (a window per text and kind).  Rules:
   email, ip (parts at most 255), card (16 to 19 digits that pass Luhn), phone (8 to 15
   digits).  The same scan collects candidates: tokens with a digit or an at sign, and the
   parts of them after a colon or an equals sign that have the form of a kind.
2. Rule findings are the seed entities.  The word that ends before an entity, in the text
   itself and for seeds and candidates alike, is its lexical pattern (the label within a
   token, otherwise the word before the token, whether that is a candidate or not);
   patterns and distinct values form a bipartite graph (copies of a text add no weight).
3. Rounds: a pattern's confidence for a kind is the summed score of its values of that kind
   over the number of its values plus ``SMOOTH``; an unknown value of fitting form scores
   one minus the product of its patterns' doubts.  Values with a score of at least ``accept``
   join the entities of the next round.
4. Candidates with an accepted value are reported beside the rule findings.

The graph has one edge per distinct (pattern, value).  Counts and sums are combined before
the shuffle; joins are on values or patterns with one row per key on one side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, take, text_of

KINDS = ("email", "ip", "card", "phone")
TOKEN = len(KINDS)

#: The rules; possessive groups and look-behinds only keep the matcher linear, the matches
#: are those of the plain patterns.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+",
)
#: What a text must hold for a match to be possible.
GUARDS = ("@", r"[0-9][.][0-9]", "[0-9][- ]?[0-9]", r"[+][0-9]", "[0-9@]")
#: What the gap before a token is stripped of at its end.
BLANK = " \t\n\x0b\f\r"
#: Parts of a token after a separator.  A value of a kind other than email has at most 7 more of
#: them; an email's part starts at the last one before its at sign.
PARTS = (*(rf"[:=]([^:=]*(?:[:=][^:=]*){{{k}}})$" for k in range(8)), r"[:=]([^@:=]+@[^@]+)$")
LEAD = r"^[^0-9A-Za-z+(@]*"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CONTEXT = 48
SMOOTH = 2.0


def pieces(text: str, kind: int) -> Column:
    """Array of (kind, gap, value, ctx): every match with the length of the text since the
    previous one and, for tokens, the end of that text without blanks."""
    regex = PATTERNS[kind]
    hits = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    empty = F.array().cast("array<struct<kind:int,gap:int,value:string,ctx:string>>")
    return F.when(F.col(text).rlike(GUARDS[kind]), F.zip_with(
        F.slice(F.split(text, regex, -1), 1, F.size(hits)), hits,
        lambda p, h: F.struct(F.lit(kind).alias("kind"), F.length(p).alias("gap"), h.alias("value"),
                              (F.right(F.rtrim(p, F.lit(BLANK)), F.lit(CONTEXT)) if kind == TOKEN else F.lit(None))
                              .cast("string").alias("ctx")))).otherwise(empty)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def term(i: Column) -> Column:
        d = F.substring(number, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda acc, i: acc + term(i)) % 10 == 0


def valid(kind: Column, value: Column) -> Column:
    number = digits(value)
    return (F.when(kind == 0, F.lit(True))
            .when(kind == 1, value.rlike(rf"^(?:{BYTE}[.]){{3}}{BYTE}$"))
            .when(kind == 2, F.length(number).between(16, 19) & luhn(F.when(F.length(number).between(16, 19), number)
                                                                     .otherwise(F.lit("0"))))
            .when(kind == 3, F.length(number).between(8, 15)).otherwise(True))


def fits(kind: int, value: Column) -> Column:
    """Whether a token has the form of a kind."""
    n = F.length(digits(value))
    number = value.rlike(r"^[+(]?[0-9][0-9().-]*$")
    return (value.rlike(r"^[^@\s]+@[^@\s]+$"), value.rlike(r"^[0-9A-Fa-f]*(?:[.:][0-9A-Fa-f]+){3,7}$"),
            number & n.between(13, 19), number & n.between(7, 15))[kind]


def candidates(start: Column, value: Column, word: Column) -> Column:
    """Array of (start, end, value, ctx): a token and its parts that have the form of a kind, trimmed.

    ``word`` is the word before the token, ``ctx`` the one that ends where the value starts.
    """
    def trimmed(part: Column) -> Column:
        first = F.length(value) - F.length(part) + F.length(F.regexp_extract(part, LEAD, 0))
        last = F.length(value) - F.length(F.regexp_extract(value, r"[^0-9A-Za-z]*$", 0))
        return F.struct(
            (start + first).alias("start"), (start + last).alias("end"),
            F.substring(value, first + 1, last - first).alias("value"),
            F.when(first > 0, F.right(F.substring(value, F.lit(1), first), F.lit(CONTEXT))).otherwise(word).alias("ctx"))

    def formed(c: Column) -> Column:
        out = F.lit(False)
        for k in range(len(KINDS)):
            out = out | fits(k, c["value"])
        return out

    whole = F.array(trimmed(value))
    parts = F.transform(F.array(*[F.regexp_extract(value, p, 1) for p in PARTS]), trimmed)
    return F.when(value.rlike("[:=]"), F.array_distinct(F.concat(whole, F.filter(parts, formed)))).otherwise(whole)


def occurrences(seen: DataFrame) -> DataFrame:
    """``uid, kind, start, end, value, ctx`` of rule findings and of candidates that touch none."""
    rows = seen.select("uid", F.posexplode("found").alias("pos", "f")).select("uid", "pos", "f.*")
    order = Window.partitionBy("uid", "kind").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(so_far).cast("int")
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    token = F.col("kind") == TOKEN
    # the word before a token: the last of the gap, or the token before it if the gap is blank
    last = F.right(F.lag("value").over(order), F.lit(CONTEXT))
    rows = rows.withColumn("ctx", F.when(token, F.coalesce(
        F.when(F.col("ctx") != "", F.regexp_extract("ctx", r"(\S+)$", 1)), last, F.lit(""))))
    rows = rows.where(valid(F.col("kind"), F.col("value")))
    # a rule finding starts within a token, which has the text to the left of it
    upto = (Window.partitionBy("uid").orderBy("start", F.desc("kind"))
            .rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("host", F.last(F.when(token, F.struct("start", "value", "ctx")), True).over(upto))
    inner = F.substring(F.col("host.value"), F.lit(1), F.col("start") - F.col("host.start"))
    rows = rows.withColumn("ctx", F.when(F.col("start") > F.col("host.start"), F.right(inner, F.lit(CONTEXT)))
                           .otherwise(F.col("host.ctx"))).drop("host")
    same = F.array(F.struct("start", "end", "value", "ctx"))
    rows = rows.select("uid", "kind", F.explode(F.when(token, candidates(
        F.col("start"), F.col("value"), F.col("ctx"))).otherwise(same)).alias("c"))
    rows = rows.select("uid", "kind", "c.*").where("start < end")
    rule = ~(F.col("kind") == TOKEN)
    # both directions as running frames: a frame that shrinks towards the end is computed anew for every row
    earlier = Window.partitionBy("uid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = (Window.partitionBy("uid").orderBy(F.desc("start"), F.desc("kind"))
             .rowsBetween(Window.unboundedPreceding, -1))
    before = F.max(F.when(rule, F.col("end"))).over(earlier)
    after = F.min(F.when(rule, F.col("start"))).over(later)
    rows = rows.withColumn("before", before).withColumn("after", after)
    return rows.where(rule | (F.coalesce(F.col("before") <= F.col("start"), F.lit(True))
                              & F.coalesce(F.col("after") >= F.col("end"), F.lit(True)))).drop("before", "after")


def left_word(ctx: Column) -> Column:
    """The word that ends before an entity, lower-cased; numbers and addresses by their kind."""
    word = F.lower(ctx)
    return F.when(word == "", "^").when(word.contains("@"), "<mail>").otherwise(F.regexp_replace(word, "[0-9]+", "0"))


def bootstrap(occ: DataFrame, rounds: int, accept: float) -> DataFrame:
    """``value, kind, score`` of the discovered values."""
    edges = materialize(occ.select(left_word(F.col("ctx")).alias("pattern"), "value", "kind").distinct(), "pii-edges")
    seeds = edges.where(F.col("kind") < TOKEN).select("value", "kind", F.lit(1.0).alias("score")).distinct()
    graph = edges.select("pattern", "value").distinct()
    unknown = edges.where(F.col("kind") == TOKEN).select("pattern", "value").distinct()
    size = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    found = None
    for _ in range(rounds):
        known = seeds if found is None else seeds.unionByName(found)
        confidence = (graph.join(known, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("held"))
                      .join(size, "pattern")
                      .select("pattern", "kind", F.round(F.least(F.col("held") / (F.col("n") + SMOOTH), F.lit(0.999)), 9)
                              .alias("confidence")))
        fit = F.lit(False)
        for k in range(len(KINDS)):
            fit = fit | ((F.col("kind") == k) & fits(k, F.col("value")))
        scored = (unknown.join(confidence, "pattern").where(fit).groupBy("value", "kind")
                  .agg(F.round(1 - F.exp(F.sum(F.log1p(-F.col("confidence")))), 6).alias("score"))
                  .where(F.col("score") >= accept))
        best = scored.groupBy("value").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
        found = materialize(best.select("value", (-F.col("b.k")).alias("kind"), F.col("b.score").alias("score")),
                            "pii-found")
    return found


def scan(docs: DataFrame, rounds: int = 3, accept: float = 0.8, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, spans`` with (kind, start, end, rule, score), by kind, then start.

    Offsets are code points, ends exclusive; ``rule`` tells rule findings (score 1) from
    discovered ones.  Null texts count as empty.  Repeated rows are scanned each for itself;
    an empty table gives an empty result; other columns are ignored.
    """
    rows = take(docs, id=id_col, text=text_col).select("id", text_of("text").alias("text"))
    seen = materialize(rows.select("id", F.monotonically_increasing_id().alias("uid"), F.concat(
        *[pieces("text", k) for k in range(TOKEN + 1)]).alias("found")), "pii-rows")
    occ = materialize(occurrences(seen.where(F.size("found") > 0)), "pii-occurrences")
    found = bootstrap(occ, rounds, accept)
    rule = occ.where(F.col("kind") < TOKEN).select("uid", "kind", "start", "end", F.lit(True).alias("rule"),
                                                   F.lit(1.0).alias("score"))
    more = (occ.where(F.col("kind") == TOKEN).drop("kind").join(found, "value")
            .select("uid", "kind", "start", "end", F.lit(False).alias("rule"), "score"))
    spans = rule.unionByName(more).groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", "end", "rule", "score"))).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return seen.select("id", "uid").join(spans, "uid", "left").select("id", F.coalesce("spans", none).alias("spans"))
