import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ovenplan.llm import lang_id
from tests.conftest import SF_MID


def words(text):
    """Runs of letters (by Unicode category, numbers like Ⅷ excepted) of the lower-cased text."""
    out = []
    for token in (text or "").lower().split():
        run = ""
        for c in token + " ":
            if c.isalnum() and not c.isdecimal():
                run += c
            elif run:
                out.append(run)
                run = ""
    return [w for w in out if any(c.isalpha() for c in w)]


def brute(asked, learned):
    """(lang, score) of each text by all words and n-grams of ``learned`` (text, lang)."""
    rows = Counter(lang for text, lang in learned if text is not None and lang is not None)
    languages = sorted(rows, key=lambda lang: (-rows[lang], lang))
    by_word, by_gram = defaultdict(Counter), defaultdict(Counter)
    for text, lang in learned:
        if lang is not None:
            for w in words(text):
                by_word[w][lang] += 1
                marked = f" {w} "
                for n in range(1, 6):
                    for i in range(len(marked) + 1 - n):
                        by_gram[marked[i : i + n]][lang] += 1
    total = {id(t): Counter() for t in (by_word, by_gram)}
    for t in (by_word, by_gram):
        for c in t.values():
            total[id(t)].update(c)

    def log(table, key, lang):
        return math.log((table[key][lang] + 0.5) / (total[id(table)][lang] + 0.5 * (len(table) + 1)))

    def weigh(word, lang):
        if word in by_word:
            return log(by_word, word, lang)
        for n in range(5, 0, -1):
            marked = f" {word} "
            grams = [marked[i : i + n] for i in range(len(marked) + 1 - n)]
            grams = [g for g in grams if g in by_gram and g != " "]
            if grams:
                return sum(log(by_gram, g, lang) for g in grams) / len(grams)
        return 0.0

    out = []
    for text in asked:
        if not languages or not words(text):
            out.append(("und", 0.0))
            continue
        count = Counter(words(text))
        sums = [round(sum(n * weigh(w, lang) for w, n in count.items()), 9) for lang in languages]
        best = sums.index(max(sums))
        out.append((languages[best], 1 / sum(math.exp(s - sums[best]) for s in sums)))
    return out


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:-1] == w[:-1] and g[-1] == pytest.approx(w[-1], abs=1e-6)


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang").collect()}
    got = lang_id.op9_language_id(spark, SF_MID).collect()
    assert sorted(r.doc_id for r in got) == sorted(langs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [langs[r.doc_id] == r.lang_pred for r in got if r.held_out]
    assert sum(held) >= 0.98 * len(held)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").collect()
    learned = [(r.text, r.lang) for r in docs if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    want = [(r.doc_id, *p) for r, p in zip(docs, brute([r.text for r in docs], learned), strict=True)]
    got = lang_id.op9_language_id(spark, SF_MID).orderBy("doc_id").collect()
    same([(r.doc_id, r.lang_pred, r.score) for r in got], want)


def test_edge_cases(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (2, "le chat et le chien", "fr"), (None, "the end", "en")]
    rows += [(3, None, "en"), (4, "teaches nothing", None), (5, "", "fr")]
    learned = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("at", F.lit("x"))
    ask = [(1, "the dogs"), (2, "LE CHIEN"), (3, None), (4, ""), (5, "12 + 3 = ²"), (6, "日本"), (7, "chats"), (8, "Ⅷ ½"), (9, "the " * 50_000)]
    ask += [(10, "q" * 100_000), (11, "x" * 300), (12, "cat,dog THEX 12"), (12, "cat,dog THEX 12"), (None, "the")]
    asked = spark.createDataFrame(ask, "doc_id long, text string")
    for name in ("lang_pred", "at", "asked", "key", "times", "entries", "lang"):
        asked = asked.withColumn(name, F.lit(1))
    want = sorted(((i or -1, *p) for (i, _), p in zip(ask, brute([t for _, t in ask], [r[1:] for r in rows]), strict=True)))
    for entries in (4, 1_000_000):
        got = sorted((r.doc_id or -1, r.lang_pred, r.score) for r in lang_id.identify(asked, learned, entries).collect())
        same(got, want)
    assert {i: p for i, p, _ in want}[2] == "fr" and {i: p for i, p, _ in want}[8] == "und"
    assert {r.lang_pred for r in lang_id.identify(asked, learned.filter("false")).collect()} == {"und"}
    assert lang_id.identify(asked.filter("false"), learned).collect() == []
    assert lang_id.identify(learned.filter("false"), F.lit(True)).collect() == []


def test_many_languages(spark):
    """Words are known, broadcast or joined, in more than 100 languages."""
    name = lambda i: "".join(chr(97 + int(c)) for c in f"{i:03d}")
    rows = [(i, f"common words {name(i) * 2} and {name(i)}x{name(i)}, {'rare' if i == 89 else 'usual'}", f"l{i:03d}") for i in range(130)]
    rows += [(1000 + i, t, "l000") for i, t in enumerate(["common words here", "usual things", "and more"] * 5)]
    ask = [(i, t) for i, t, _ in rows] + [(2000, "rare aabbzz"), (2001, "rare"), (2002, None), (2003, "12 3"), (2004, "日本"), (2005, name(77) * 3), (2001, "rare")]
    learned = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = spark.createDataFrame(ask, "doc_id long, text string")
    want = sorted((i, *p) for (i, _), p in zip(ask, brute([t for _, t in ask], [r[1:] for r in rows]), strict=True))
    for entries in (0, 1000):
        got = sorted((r.doc_id, r.lang_pred, r.score) for r in lang_id.identify(asked, learned, entries).collect())
        same(got, want)
    assert dict((g[0], g[1]) for g in want)[2001] == "l089"
    # Which rows teach may also be a condition on the rows themselves.
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in lang_id.identify(learned, F.col("doc_id") >= 0).collect())
    same(got, [w for w in want if w[0] < 2000])
