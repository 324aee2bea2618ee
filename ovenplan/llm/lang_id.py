"""Language ID: words first, then shorter and shorter character n-grams.

Words are runs of letters, lower-cased. The texts are counted once, by language and word; one table
holds, for each word, how often the texts to predict have it and how often each language was
seen with it. N-grams of one to five characters are counted from that table. All counts of all
languages stay in tables. Words that no language has go by a number through the n-gram
joins, the longest n-grams first. The documents' words are joined to what was found; the
most frequent words' entries (``CACHE_ENTRIES``) are broadcast to save that join. Only what belongs
to a language as a whole is one array.

A known word adds its log frequency in each language. Of an unseen word the
longest n-grams that are known count instead: the mean of their log frequencies.
The language of the highest sum wins; score is its share of the likelihoods.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is any
text when nothing was learned. Without any known n-gram, and in ties, the
language with the most training rows wins, then the first by name. Rows with a null
lang or text teach nothing; a null doc_id is not held out. Equal texts get equal
predictions, and repeated rows teach as often as they occur. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.llm import common, spans
from ovenplan.session import Scratch

LONGEST = 5
#: Entries (of a word and a language) of the most frequent words that are broadcast, the words, and the bytes of one at most.
CACHE_ENTRIES = 1_000_000
CACHE_WORDS = 100_000
CACHE_WORD_BYTES = 256
SMOOTHING = 0.5
UNKNOWN = "und"
#: Distinct keys that a task counts before it hands them on.
FLUSH = 400_000
_WORDS = re.compile(r"[^\W\d_]+")

ENTRY = "struct<at:int,d:double>"
ENTRIES = f"array<{ENTRY}>"
#: What a word of the documents is.
NOTHING, KNOWN, BY_GRAMS = 0, 1, 2
#: In sums of entries, the places that count the n-grams found or the words of either sort.
HITS = -1


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def words_of(token: str) -> list[str]:
    """The words of a lower-cased token (a run without white space)."""
    if token.isalpha():
        return [token]
    return [w for w in _WORDS.findall(token) if any(map(str.isalpha, w))]


def grams_of(word: str, n: int) -> list[str]:
    """The n-grams of a word, its ends marked by a space."""
    word = f" {word} "
    return [word[i : i + n] for i in range(len(word) - n + 1)]


def _counted(df: DataFrame, fill, key: str, named=lambda counter: counter) -> DataFrame:
    """(at, asked, key, n): what ``fill(counters, batch)`` counts by (at, asked), in bounded partial sums of each task.

    ``named`` turns what was counted into counts by key.
    """

    def task(batches):
        counters = defaultdict(Counter)

        def out():
            for (at, asked), counter in counters.items():
                found = named(counter)
                size = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([at] * size, pa.int32()), pa.array([asked] * size, pa.bool_()),
                        pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64()),
                    ],
                    ["at", "asked", key, "n"],
                )
            counters.clear()

        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                fill(counters, batch.slice(i, 1000))
                if sum(map(len, counters.values())) > FLUSH:
                    yield from out()
        yield from out()

    return df.mapInArrow(task, f"at int, asked boolean, {key} string, n long")


def _by_key(parts: DataFrame, key: str) -> DataFrame:
    """(key, times, seen): how often it was asked for, and (at, n) of each language seen with it.

    One shuffle: the sums by language keep the partitioning by key.
    """
    sums = parts.repartition(key).groupBy(key, "at").agg(
        F.sum(F.when(F.col("asked"), F.col("n")).otherwise(0)).alias("times"), F.sum("n").alias("n")
    )
    seen = F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "n")))
    return sums.groupBy(key).agg(F.sum("times").alias("times"), seen.alias("seen"))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, times, seen) of all ``rows`` (text, at, asked); at: the number of the language that a row teaches, or null."""

    def fill(counters, batch):
        columns = (batch.column(c).to_pylist() for c in ("text", "at", "asked"))
        for text, at, asked in zip(*columns, strict=True):
            counters[at, asked].update(text.lower().split())

    def words(tokens):
        found = Counter()
        for token, n in tokens.items():
            for word in words_of(token):
                found[word] += n
        return found

    return _by_key(_counted(rows.filter("text is not null"), fill, "word", words), "word")


def gram_counts(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(gram, seen) from (word, seen)."""

    def fill(counters, batch):
        once = defaultdict(list)
        for word, at, count in zip(*(batch.column(c).to_pylist() for c in ("word", "at", "n")), strict=True):
            grams = [grams_of(word, n) for n in range(1, longest + 1)]
            if count == 1:
                once[at].extend(grams)
            else:
                counter = counters[at, False]
                for gram in chain.from_iterable(grams):
                    counter[gram] += count
        for at, grams in once.items():
            counters[at, False].update(chain.from_iterable(grams))

    return _by_key(_counted(words.select("word", F.inline("seen")), fill, "gram"), "gram").drop("times")


def _entries(seen: Column) -> Column:
    """Of each language seen, its number and how far the log frequency lies above an unseen one's."""
    return F.transform(seen, lambda s: F.struct(s["at"].alias("at"), F.log((s["n"] + SMOOTHING) / SMOOTHING).alias("d")))


def _unseen_logs(table: DataFrame, languages: int) -> np.ndarray:
    """Log frequency in each language of what it was not seen with."""
    total = {r["at"]: r.n for r in table.select(F.inline("seen")).groupBy("at").agg(F.sum("n").alias("n")).collect()}
    distinct = table.filter("size(seen) > 0").count()
    size = np.array([total.get(at, 0) for at in range(languages)], dtype=float) + SMOOTHING * (distinct + 1)
    return np.log(SMOOTHING / size)


def _summed(rows: DataFrame, key: str) -> DataFrame:
    """(key, entries) from rows (key, entries): sums by language, in one shuffle."""
    sums = rows.repartition(key).select(key, F.inline("entries")).groupBy(key, "at").agg(F.sum("d").alias("d"))
    return sums.groupBy(key).agg(F.collect_list(F.struct("at", "d")).cast(ENTRIES).alias("entries"))


def _with(entries: Column, at: Column, d: Column) -> Column:
    """``entries`` and one more."""
    return F.concat(entries, F.array(F.struct(at.cast("int").alias("at"), d.cast("double").alias("d"))))


def _own_grams(words: DataFrame, n: int) -> DataFrame:
    """(id, gram) of each place of ``words`` (id, word), in time linear in a word's length."""

    def task(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                ids, grams = [], []
                part = batch.slice(i, 1000)
                for number, word in zip(part.column("id").to_pylist(), part.column("word").to_pylist(), strict=True):
                    own = [g for g in grams_of(word, n) if g != " "]
                    ids += [number] * len(own)
                    grams += own
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(grams, pa.string())], ["id", "gram"])

    return words.select("id", "word").mapInArrow(task, "id long, gram string")


def by_grams(unseen: DataFrame, grams: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """(word, times, kind, entries) of ``unseen`` (id, word, times), in parts, by (gram, entries) of all n-grams learned."""
    parts, todo = [], unseen
    for n in range(LONGEST, 0, -1):
        own = _own_grams(todo, n)
        hits = own.join(grams.filter(F.length("gram") == n), "gram").select("id", _with(F.col("entries"), F.lit(HITS), F.lit(1)).alias("entries"))
        number = F.filter("entries", lambda e: e["at"] == HITS)[0]["d"]
        mean = F.transform(
            F.filter("entries", lambda e: e["at"] != HITS),
            lambda e: F.struct(e["at"].alias("at"), (e["d"] / F.col("number")).alias("d")),
        )
        found = _summed(hits, "id").withColumn("number", number).select("id", mean.cast(ENTRIES).alias("entries"))
        tried = scratch.write(todo.join(found, "id", "left"), f"tried-{n}")
        parts.append(tried.filter("entries is not null").select("word", "times", F.lit(BY_GRAMS).alias("kind"), "entries"))
        todo = tried.filter("entries is null").select("id", "word", "times")
    return [*parts, todo.select("word", "times", F.lit(NOTHING).alias("kind"), F.array().cast(ENTRIES).alias("entries"))]


class Cache:
    """Kinds and entries of the most frequent words, one after the other."""

    def __init__(self, table: pa.Table):
        entries = table.column("entries").combine_chunks()
        entries = entries.combine_chunks() if isinstance(entries, pa.ChunkedArray) else entries
        self.number = {w: i for i, w in enumerate(table.column("word").to_pylist())}
        self.kind = table.column("kind").to_numpy()
        flat = entries.flatten()
        self.sizes = np.array(entries.value_lengths().to_pylist(), dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.at = flat.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
        self.d = flat.field("d").to_numpy(zero_copy_only=False)

    def entries_of(self, rows: np.ndarray, numbers: np.ndarray, times: np.ndarray, n_rows: int, languages: int) -> pa.Array:
        """Sums by row and language of the entries of words (row, number, times)."""
        sizes = self.sizes[numbers]
        place = np.arange(sizes.sum()) + np.repeat(self.starts[numbers] - (np.cumsum(sizes) - sizes), sizes)
        cell = np.repeat(rows, sizes) * max(languages, 1) + self.at[place]
        own, to = np.unique(cell, return_inverse=True)
        sums = np.bincount(to, self.d[place] * np.repeat(times, sizes), len(own))
        at, row = own % max(languages, 1), own // max(languages, 1)
        ends = np.searchsorted(row, np.arange(n_rows + 1))
        flat = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums)], ["at", "d"])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)


def identify(docs: DataFrame, learned: DataFrame | Column, cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, by all words, n-grams and languages of ``learned``.

    ``learned``: rows (text, lang), or which rows of ``docs``, that then have a column lang, teach.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lang")
    own = isinstance(learned, Column)
    taught = (docs.filter(learned) if own else learned).filter("text is not null and lang is not null")
    languages = [r.lang for r in taught.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    numbered = F.broadcast(spark.createDataFrame(list(zip(languages, range(len(languages)), strict=True)), "lang string, at int"))
    if own:
        texts = docs.select("text", F.when(learned, F.col("lang")).alias("lang"), F.lit(True).alias("asked"))
    else:
        texts = docs.select("text", F.lit(None).cast("string").alias("lang"), F.lit(True).alias("asked"))
        texts = texts.unionAll(taught.select("text", "lang", F.lit(False).alias("asked")))
    docs = docs.select("doc_id", "text")
    words = scratch.write(word_counts(texts.join(numbered, "lang", "left").select("text", "at", "asked")), "words")
    grams = scratch.write(gram_counts(words), "grams")
    logs = (_unseen_logs(words, len(languages)), _unseen_logs(grams, len(languages)))
    unseen = words.filter("times > 0 and size(seen) = 0").select(F.monotonically_increasing_id().alias("id"), "word", "times")
    unseen = scratch.write(unseen, "unseen")
    table = words.filter("times > 0 and size(seen) > 0").select("word", "times", F.lit(KNOWN).alias("kind"), _entries(F.col("seen")).alias("entries"))
    for part in by_grams(unseen, grams.select("gram", _entries(F.col("seen")).alias("entries")), scratch):
        table = table.unionAll(part)
    scratch.drop("unseen", "grams")
    hot = table.filter(F.octet_length("word") <= CACHE_WORD_BYTES).orderBy(F.desc("times"), "word")
    hot = hot.limit(min(CACHE_WORDS, cache_entries // max(len(languages), 1)))
    sent = spark.sparkContext.broadcast((Cache(hot.select("word", "kind", "entries").toArrow()), languages, logs))

    def counted(batch):
        cache, languages, _ = sent.value
        number, split = cache.number, {}
        keys, letters, rare, sizes = [], [], [], []
        numbers: list[int] = []
        times: list[int] = []
        for text in batch.column("text").to_pylist():
            before, others = len(numbers), Counter()
            for token, n in Counter((text or "").lower().split()).items():
                at = number.get(token)
                if at is not None:
                    numbers.append(at)
                    times.append(n)
                    continue
                if (parts := split.get(token)) is None:
                    parts = split[token] = words_of(token)
                for word in parts:
                    at = number.get(word)
                    if at is None:
                        others[word] += n
                    else:
                        numbers.append(at)
                        times.append(n)
            keys.append(hashlib.blake2b(repr(text).encode(), digest_size=16).digest())
            letters.append(len(numbers) > before or bool(others))
            sizes.append(len(numbers) - before)
            rare.append(list(others.items()))
        n_rows = len(keys)
        at, n = np.array(numbers, dtype=np.int64), np.array(times, dtype=float)
        row = np.repeat(np.arange(n_rows), sizes)
        kinds = np.bincount(row * 3 + cache.kind[at], n, n_rows * 3).reshape(n_rows, 3).astype(np.int64)
        return [
            batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(letters, pa.bool_()), pa.array(kinds[:, KNOWN]), pa.array(kinds[:, BY_GRAMS]),
            cache.entries_of(row, at, n, n_rows, len(languages)),
            pa.array(rare, pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))),
        ]

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = common.map_batches(
        docs,
        counted,
        f"doc_id {kind}, key binary, letters boolean, known long, by_grams long, own {ENTRIES}, rare array<struct<word:string,times:bigint>>",
    )
    rows = scratch.write(rows, "rows")
    # Equal texts have one key; their words are looked up once, by a number that is shorter to shuffle.
    rare = rows.filter("size(rare) > 0").select("key", "rare").dropDuplicates(["key"])
    rare = scratch.write(rare.withColumn("id", F.monotonically_increasing_id()), "rare")
    pairs = rare.select("id", F.inline("rare")).join(table.select("word", "kind", "entries"), "word")
    weighed = F.transform("entries", lambda e: F.struct(e["at"].alias("at"), (e["d"] * F.col("times")).alias("d")))
    # Places -1, -2 and -3 count the words of each kind.
    sums = _summed(pairs.select("id", _with(weighed, F.lit(-1) - F.col("kind"), F.col("times")).alias("entries")), "id")
    sums = scratch.write(sums, "sums")
    scratch.drop("words", *(f"tried-{n}" for n in range(1, LONGEST + 1)))
    found = sums.join(rare.select("id", "key"), "id").select("key", "entries")
    both = spans.joined_by_text(rows.drop("rare"), found, "lang-found").select("doc_id", "letters", "known", "by_grams", "own", "entries")

    def pick(batch):
        _, languages, logs = sent.value
        preds, scores = [], []
        for r in batch.to_pylist():
            if not languages or not r["letters"]:
                preds.append(UNKNOWN)
                scores.append(0.0)
                continue
            number = {KNOWN: r["known"], BY_GRAMS: r["by_grams"], NOTHING: 0}
            total = np.zeros(len(languages))
            for e in [*r["own"], *(r["entries"] or [])]:
                if e["at"] < 0:
                    number[-1 - e["at"]] += e["d"]
                else:
                    total[e["at"]] += e["d"]
            total += number[KNOWN] * logs[0] + number[BY_GRAMS] * logs[1]
            total = np.round(total, 9)  # sums in another order are still ties
            best = int(total.argmax())
            preds.append(languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return [batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())]

    return common.map_batches(both, pick, f"doc_id {kind}, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 3, 1)
    return identify(docs, ~out).withColumn("held_out", out)
