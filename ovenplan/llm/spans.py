"""Spans of patterns in texts, found with column functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ovenplan.llm import common
from ovenplan.session import materialize

SPAN = "struct<kind:string,start:int,end:int,value:string>"
HOT_TEXTS = 10_000


def matches(text: Column, pattern: str, kind: str, unless: Column | None = None) -> Column:
    """Array of SPAN: the leftmost non-overlapping matches of ``pattern``, in code points.

    The text between matches (a split) and the matches, in turn, give the places.
    ``unless``: a cheap condition under which the text surely has no match.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    # A match at the very start has an empty part before it.
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["0"]) + F.length(x["1"])).alias("at"),
        F.concat(
            acc["spans"],
            F.array(
                F.struct(
                    F.lit(kind).alias("kind"),
                    (acc["at"] + F.length(x["0"])).alias("start"),
                    (acc["at"] + F.length(x["0"]) + F.length(x["1"])).alias("end"),
                    x["1"].alias("value"),
                )
            ),
        ).alias("spans"),
    )
    parts = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda a, b: F.struct(a.alias("0"), b.alias("1")))
    spans = F.when(F.size(found) > 0, F.aggregate(parts, start, step, lambda acc: acc["spans"]))
    spans = F.coalesce(spans, F.array().cast(f"array<{SPAN}>"))
    return spans if unless is None else F.when(unless, F.array().cast(f"array<{SPAN}>")).otherwise(spans)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def apart(span: Column, others: Column) -> Column:
    """Whether ``span`` overlaps none of ``others``."""
    return ~F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def text_key(text: Column) -> Column:
    """Names a text, so that equal texts are handled once."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def joined_by_text(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``rows`` (one column ``key``) with the column of ``found`` (one row per ``key``), null where it has none.

    Of a text copied very often the rows are dealt to several tasks.
    """
    found = materialize(found, name)
    hot = rows.join(found.select("key"), "key", "left_semi").groupBy("key").count()
    hot = hot.orderBy(F.desc("count"), "key").limit(HOT_TEXTS)
    return common.salted_join(rows, found, "key", hot, F.xxhash64("doc_id"))
