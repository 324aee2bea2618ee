"""Personal data: base patterns, and bootstrapped contextual extraction.

Base matches of e-mail, IP, card and phone are the seeds. The words before
and after an identifier-like string (four digits or more, or an @) form lexical patterns: both
words, the one before alone, and the one after alone. Patterns
and the strings found in them, distinct texts only, make a graph with a link
per pattern and string, which is scored in turns:

- a pattern's confidence for a kind is the share of its distinct strings
  that count as that kind, with one doubtful string added;
- a string counts as a kind as much as its best pattern for it (seeds: fully).

A string that counts with ``MIN_CONFIDENCE`` is a seed in the next turn, so it can bring in
patterns. After ``ROUNDS`` turns, patterns of at least ``MIN_SEEDS`` distinct seeds and
``MIN_CONFIDENCE`` add the other strings found in them as spans of their kind.
All of it is column functions, joins and sums of partial sums; links are
pre-aggregated, so a frequent pattern or string is one row per partner.

Defined cases: null or empty text has no spans. Equal texts get equal spans, and
count once in the graph. A failing base match is dropped, and none is sought
within it. Spans that overlap a base span are not added.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.llm import common, spans
from ovenplan.session import materialize

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
#: A pattern of s seeds tends to a confidence of s / (s + 1) on its own: with fewer than five seeds
#: it stays under 0.8 or just reaches it, so the two bounds agree.
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.8

# The base patterns, written so that no group repeats without bound: a long run
# of matches of a group would exhaust a task's stack, a run of a class does not.
# A match starts at the start of its run or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
    r"[A-Za-z0-9.-]+?(?=\.\.|\.?+(?![A-Za-z0-9.-]))"
)
IP = r"[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Identifier-like strings, without outer marks: 5 to 64 characters, no white space, a digit or @ among the first 25.
CANDIDATE = r"(?<![\p{L}\p{N}@])(?=[\p{L}.,:_+()/-]{0,24}[0-9@])[\p{L}\p{N}+(][\p{L}\p{N}@._+()/-]{4,63}(?<![._+(/-])(?![\p{L}\p{N}@])"
_LUHN_DOUBLE = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))
    doubled = F.array(*map(F.lit, _LUHN_DOUBLE))

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(F.element_at(doubled, d + 1))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """The base spans by kind as listed, then start."""
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    email = spans.matches(text, EMAIL, "email", ~F.contains(text, F.lit("@")))
    ip = F.filter(spans.matches(text, IP, "ip"), lambda s: s["value"].rlike(rf"^{part}(?:\.{part}){{3}}$"))
    card = F.filter(spans.matches(text, CARD, "card"), lambda s: _luhn(s["value"]))
    phone = F.filter(
        spans.matches(text, PHONE, "phone", ~F.contains(text, F.lit("+"))),
        lambda s: F.length(_digits(s["value"])).between(8, 15),
    )
    return F.concat(email, ip, card, phone)


def _patterns(text: Column, span: Column) -> Column:
    """The words around a span, both and each alone, lower-cased, numbers as 0."""
    before = F.regexp_extract(F.substring(text, F.greatest(span["start"] - 39, F.lit(1)), F.least(span["start"], F.lit(40))), r"(\S+)\s*$", 1)
    after = F.regexp_extract(F.substring(text, span["end"] + 1, F.lit(40)), r"^\s*(\S+)", 1)
    both = F.regexp_replace(F.lower(F.concat_ws(" _ ", before, after)), "[0-9]+", "0")
    left, right = F.substring_index(both, " _ ", 1), F.substring_index(both, " _ ", -1)
    alone = F.array(F.when(left != "", F.concat(left, F.lit(" _"))), F.when(right != "", F.concat(F.lit("_ "), right)))
    return F.array_compact(F.concat(F.array(both), alone))


def found_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, key, base, other): base spans and identifier-like strings beside them, with their patterns."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text")))
    other = F.filter(spans.matches(F.col("text"), CANDIDATE, ""), lambda s: (F.length(_digits(s["value"])) >= 4) | F.contains(s["value"], F.lit("@")))
    rows = rows.withColumn("other", F.filter(other, lambda s: spans.apart(s, F.col("base"))))

    def placed(column):
        return F.transform(
            column,
            lambda s: F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                _patterns(F.col("text"), s).alias("patterns"),
            ),
        )

    return rows.select(
        "doc_id", spans.text_key(F.col("text")).alias("key"), placed("base").alias("base"), placed("other").alias("other")
    )


def confident_patterns(rows: DataFrame, rounds: int, min_seeds: int, min_confidence: float) -> DataFrame:
    """(pattern, kind, confidence) that the graph of patterns and strings supports."""
    texts = rows.filter("size(base) > 0 or size(other) > 0").dropDuplicates(["key"])
    each = texts.select(F.explode(F.concat("base", "other")).alias("s")).select(F.explode("s.patterns").alias("pattern"), "s.value", "s.kind")
    links = materialize(each.distinct(), "pii-links")
    size = materialize(links.groupBy("pattern").agg(F.count("*").alias("n")), "pii-patterns")
    seeds = materialize(links.filter("kind <> ''").groupBy("pattern", "kind").agg(F.count("*").alias("seeds")), "pii-seeds")
    unknown = materialize(links.filter("kind = ''").select("pattern", "value"), "pii-unknown")
    found = seeds.withColumns({"gained": F.lit(0.0), "more": F.lit(0)})
    for i in range(rounds + 1):
        # Strings that are sure by now count as seeds, so patterns can enter in later rounds.
        score = found.filter(F.col("seeds") + F.col("more") >= min_seeds).join(size, "pattern")
        score = score.withColumn("confidence", (F.col("seeds") + F.col("gained")) / (F.col("n") + 1))
        if i == rounds:
            break
        score = materialize(score.select("pattern", "kind", "confidence"), "pii-scores")
        belief = unknown.join(score, "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("belief"))
        belief = materialize(belief, "pii-beliefs")
        gained = unknown.join(belief, "value").groupBy("pattern", "kind").agg(
            F.sum("belief").alias("gained"), F.count_if(F.col("belief") >= min_confidence).alias("more")
        )
        found = seeds.join(gained, ["pattern", "kind"], "full").na.fill(0, ["seeds", "gained", "more"])
    return score.filter(F.col("confidence") >= min_confidence).select("pattern", "kind", "confidence")


def personal_data(
    docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """(doc_id, key, base, spans): base spans, and all spans by kind as listed, then start."""
    rows = materialize(found_rows(docs), "pii-rows")
    sure = materialize(confident_patterns(rows, rounds, min_seeds, min_confidence), "pii-confident")
    best = sure.groupBy("pattern").agg(
        F.max("confidence").alias("confidence"), F.max_by("kind", F.struct("confidence", "kind")).alias("as_kind")
    )
    texts = rows.filter("size(other) > 0").select("key", "other").dropDuplicates(["key"])
    more = texts.select("key", F.explode("other").alias("s")).select("key", "s.*").withColumn("pattern", F.explode("patterns"))
    more = more.join(best, "pattern").groupBy("key", "start", "end", "value").agg(
        F.max_by("as_kind", F.struct("confidence", "as_kind")).alias("as_kind")
    )
    more = more.groupBy("key").agg(
        F.collect_list(F.struct(F.col("as_kind").alias("kind"), "start", "end", "value")).alias("more")
    )
    both = spans.joined_by_text(rows.select("doc_id", "key", "base"), more, "pii-more")
    base = F.col("base").cast(f"array<struct<kind:string,start:int,end:int,value:string,patterns:array<string>>>")
    base = F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    ranked = lambda a, b: (
        F.when(_rank(a) < _rank(b), -1).when(_rank(a) > _rank(b), 1).otherwise(a["start"] - b["start"])
    )
    every = F.when(F.col("more").isNull(), base).otherwise(F.array_sort(F.concat(base, "more"), ranked))
    return both.select("doc_id", "key", base.alias("base"), every.alias("spans"))


def _rank(span: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), span["kind"])


def masked(text: Column, found: Column) -> Column:
    """``text`` with its spans as <kind>; overlapping spans are masked as one, of the first one's kind."""
    in_order = F.array_sort(found, lambda a, b: F.when(a["start"] == b["start"], b["end"] - a["end"]).otherwise(a["start"] - b["start"]))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        new = F.struct(
            s["end"].alias("at"),
            F.concat(
                acc["parts"],
                F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">"))),
            ).alias("parts"),
        )
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))
        return F.when(s["start"] >= acc["at"], new).otherwise(longer)

    rest = lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(found) > 0, F.aggregate(in_order, start, step, rest)).otherwise(text)


def mask_documents(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, personal data in the texts masked."""
    found = personal_data(docs).filter("size(spans) > 0").dropDuplicates(["key"]).select("key", "spans")
    names = docs.columns
    keyed = docs.select(F.struct(*[docs[n] for n in names]).alias("row"), docs["doc_id"].alias("doc_id"))
    keyed = keyed.withColumn("key", spans.text_key(F.coalesce("row.text", F.lit(""))))
    both = spans.joined_by_text(keyed, found, "pii-found")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(masked(F.col("row.text"), F.col("spans")))
    return both.withColumn("text", text).select(*[F.col("text") if n == "text" else F.col("row")[n].alias(n) for n in names])


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = personal_data(common.read(spark, sf_dir, "documents", "doc_id", "text"))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(
        "doc_id",
        *map(of, KINDS),
        F.sha2(F.encode(spans.digest(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        spans.digest(F.col("spans")).alias("spans"),
    )
