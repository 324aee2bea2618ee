import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ovenplan.llm import periodic
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string"


def brute(w):
    """Every lag's whole diagonal; the smallest period by trying all."""
    found = []
    for d in range(1, len(w) // 4 + 1):
        i = d
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - d]:
                j += 1
            s, n = i - d, j - i + d
            smaller = any(all(w[x] == w[x - q] for x in range(s + q, s + n)) for q in range(1, d)) if j > i else True
            if n >= max(6, 4 * d) and not smaller:
                found.append((s, n, d))
            i = max(j, i + 1)
    return sorted(found)


def search(texts):
    return periodic.find_runs(
        np.array([x for t in texts for x in t], dtype=np.int64), np.array([len(t) for t in texts], dtype=np.int64)
    )


repeats = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 9)), max_size=8)


@given(st.lists(repeats, max_size=5))
@settings(max_examples=150, deadline=None)
def test_runs_against_brute_force(made):
    texts = [[x for unit, n in text for x in unit * n] for text in made]
    assert search(texts) == [brute(t) for t in texts]


def test_long_periods_against_brute_force():
    rng = random.Random(2)
    for _ in range(20):
        p = rng.randint(3, 70)
        unit = [0] * rng.randint(0, p) + [rng.randrange(3) for _ in range(p)]
        text = [rng.randrange(3) for _ in range(rng.randint(0, 9))] + (unit * 5)[: rng.randint(3 * p, 5 * p)] + [7, 7]
        assert search([text, unit]) == [brute(text), brute(unit)]


@pytest.mark.parametrize(
    "unit, n, first",
    [([0], 1_000_000, (0, 1_000_000, 1)), ([0, 1], 500_000, (0, 1_000_000, 2)), ([0] * 1000 + [1], 1000, (0, 1000, 1))],
)
def test_very_long_texts_take_little_time(unit, n, first):
    found = search([unit * n])[0]
    assert found[0] == first
    assert len(found) == (1 if len(unit) < 3 else 1001)


def test_equal_hashes_do_no_harm(monkeypatch):
    monkeypatch.setattr(periodic, "_mix", lambda h: h % np.uint64(3))
    rng = random.Random(4)
    texts = [[rng.randrange(4) for _ in range(rng.randint(0, 60))] * rng.randint(1, 5) for _ in range(6)]
    found = search(texts)
    # A hash in common may hide words that repeat within half a scale, never add a run.
    assert all(set(f) <= set(brute(t)) for f, t in zip(found, texts, strict=True))


def expected(doc_id, text):
    words = re.findall(r"[^ \t-\r]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = [
        hashlib.sha256(x.encode()).hexdigest()
        for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(w for i, w in enumerate(words) if i not in dropped))
    ]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text.split()) < 1500]
    got = {r.doc_id: tuple(r) for r in periodic.op12_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(rows) and len(short) > 0.9 * len(rows)
    for r in short:
        assert got[r.doc_id] == expected(r.doc_id, r.text)
    assert sum(t[1] > 0 for t in got.values()) > 3


def test_edge_cases(spark, tmp_dir):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c d e f"), (5, "x y " * 9), (5, "x y " * 9), (6, "z " * 20_000)]
    rows += [(7, "a a a a a a b b b b b b"), (8, "a\x85b c a\x85b c"), (9, "ñ " * 5), (10, "ñ " * 6)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("runs", "collapsed", "best", "start"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    got = periodic.op12_periodic_runs(spark, tmp_dir)
    assert [c for c, _ in got.dtypes] == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    want = [expected(*r) for r in rows if r[0] != 6]
    assert sorted((tuple(r) for r in got.collect() if r.doc_id != 6), key=str) == sorted(want, key=str)
    assert [r[1:6] for r in got.collect() if r.doc_id == 6] == [(1, 0, 20_000, 1, 20_000_000)]
    plain = {r.doc_id: r for r in periodic.with_runs(docs).collect()}
    assert plain[5].collapsed == "x y" and [tuple(x) for x in plain[7].runs] == [(0, 6, 1), (6, 6, 1)]
    assert plain[6].collapsed == "z" and plain[9].runs == [] and plain[1].collapsed == ""


def test_null_id_and_empty_table(spark):
    null = periodic.with_runs(spark.createDataFrame([(None, "a " * 8)], SCHEMA)).first()
    assert null.doc_id is None and null.collapsed == "a"
    assert periodic.planted_words(None, [b"a"] * 9) == [b"a"] * 9
    assert periodic.with_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_batches_of_words(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_WORDS", 7)
    rows = [(i, "a b " * i) for i in range(30)]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.with_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: brute((["a", "b"]) * i) for i in range(30)}
