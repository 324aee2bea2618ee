"""Secret scans with corpus-wide ownership frequency.

Base patterns (assignments to secret-like names, access keys, long hex strings) and
random-looking strings give candidates. A candidate's value is counted over the
corpus by distinct repositories (doc_id) and distinct owners (source). Values of
more than ``max_owners`` owners are widely copied examples; the others are specific to
an owner and look live. Random-looking strings specific to an owner are added as
spans of kind ``live``, beside the base spans; ``n_live`` and ``n_copied`` count
a text's candidates of either sort.

Counting goes by (value, owner, repository), then (value, owner), then value, with
partial sums, so a value copied everywhere is never one task's rows.

Defined cases: null or empty text has no spans. A null source is one owner, a null
doc_id one repository; repeated rows are one repository. Equal texts get equal
spans. A failing base match is dropped, and none is sought within it. An empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.llm import common, spans
from ovenplan.session import materialize

KINDS = ["assign", "access", "hex", "live"]
MAX_OWNERS = 2
HOT_VALUES = 10_000

ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
#: Long strings of letters and digits.
RANDOM = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}"
MIN_DIGITS = 4
MIN_DISTINCT = 10


def base_spans(text: Column) -> Column:
    """The base spans, by start, then kind as listed; the value is the secret itself."""
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    assign = F.transform(
        spans.matches(text, ASSIGN, "assign", ~text.rlike("[:=]")),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), value(s).alias("value")),
    )
    assign = F.filter(assign, lambda s: F.length(s["value"]) >= 6)
    access = spans.matches(text, ACCESS, "access", ~F.contains(text, F.lit("AKIA")))
    return in_order(F.concat(assign, access, spans.matches(text, HEX, "hex")))


def in_order(found: Column) -> Column:
    rank = lambda s: s["start"] * len(KINDS) + F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    return F.array_sort(found, lambda a, b: (rank(a) - rank(b)).cast("int"))


def random_looking(text: Column, base: Column) -> Column:
    """Strings of many different letters and digits, apart from the base spans."""
    distinct = lambda v: F.size(F.array_distinct(F.split(v, "")))
    digits = lambda v: F.length(F.regexp_replace(v, "[^0-9]", ""))
    return F.filter(
        spans.matches(text, RANDOM, "live"),
        lambda s: (digits(s["value"]) >= MIN_DIGITS) & (distinct(s["value"]) >= MIN_DISTINCT) & spans.apart(s, base),
    )


def ownership(rows: DataFrame) -> DataFrame:
    """(value, n_repos, n_owners) of the hashed candidate values of ``rows`` (doc_id, source, value)."""
    each = rows.groupBy("value", "source", "doc_id").agg(F.count("*").alias("n"))
    owned = each.groupBy("value", "source").agg(F.count("*").alias("n_repos"))
    return owned.groupBy("value").agg(F.sum("n_repos").alias("n_repos"), F.count("*").alias("n_owners"))


def secrets(docs: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """(doc_id, key, base, spans, n_live, n_copied): base spans, and all spans by start, then kind."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "source", text.alias("text")).withColumn("base", base_spans(F.col("text")))
    rows = rows.withColumn("other", random_looking(F.col("text"), F.col("base")))
    hashed = lambda c: F.transform(
        c,
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.sha2(F.encode(s["value"], "UTF-8"), 256).alias("value"),
        ),
    )
    rows = rows.select("doc_id", "source", spans.text_key(F.col("text")).alias("key"), hashed("base").alias("base"), hashed("other").alias("other"))
    rows = materialize(rows, "secret-rows")
    holding = rows.filter("size(base) > 0 or size(other) > 0")
    values = holding.select("doc_id", "source", F.explode(F.array_distinct(F.transform(F.concat("base", "other"), lambda s: s["value"]))).alias("value"))
    owned = materialize(ownership(values), "secret-owners")
    each = holding.dropDuplicates(["key"]).select("key", F.explode(F.concat("base", "other")).alias("s"))
    each = materialize(each.select("key", "s.*"), "secret-candidates")
    hot = owned.orderBy(F.desc("n_repos"), "value").limit(HOT_VALUES)
    each = common.salted_join(each, owned, "value", hot, F.xxhash64("key"))
    live = F.col("n_owners") <= max_owners
    place = F.struct("kind", "start", "end", "value")
    found = each.groupBy("key").agg(
        F.collect_list(F.when(live & (F.col("kind") == "live"), place)).alias("more"),
        F.countDistinct(F.when(live, F.col("value"))).alias("n_live"),
        F.countDistinct(F.when(~live, F.col("value"))).alias("n_copied"),
    )
    both = spans.joined_by_text(rows.select("doc_id", "key", "base"), found, "secret-found")
    every = F.when(F.size("more") > 0, in_order(F.concat("base", "more"))).otherwise(F.col("base"))
    return both.select(
        "doc_id", "key", "base", every.alias("spans"), F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied")
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets(common.read(spark, sf_dir, "documents", "doc_id", "source", "text"))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(
        "doc_id",
        *map(of, KINDS[:3]),
        F.sha2(F.encode(spans.digest(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        spans.digest(F.col("spans")).alias("spans"),
        "n_live",
        "n_copied",
    )
