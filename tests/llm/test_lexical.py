import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ovenplan.llm import lexical
from tests.conftest import SF_MID

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=10):
    split = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in split if c), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, c in split:
            n, score = sum(c.values()), 0
            for t, times in Counter(terms(text)).items():
                if t in c:
                    m = 100 - 75 + (75 * n * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, r, doc_id, -s) for r, (s, _, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(rows, key=str)


def ranked(spark, docs, items, **kw):
    found = lexical.rank_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **kw)
    return sorted((tuple(r) for r in found.collect()), key=str)


@given(st.text(st.sampled_from("aZ09 é_-.\x7f\x80漢\n"), max_size=30))
@settings(max_examples=200, deadline=None)
def test_terms(text):
    assert [t.decode() for t in lexical.terms_of(text)] == terms(text)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    rel = con.sql(lexical.ORACLE)
    got = lexical.op13_ranked_search(spark, SF_MID)
    assert rel.columns == got.columns
    assert sorted(rel.fetchall()) == sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("bucket", [3, 64])
def test_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    rng = random.Random(bucket)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 60}"
    docs = [(i, " ".join(word() for _ in range(int(rng.paretovariate(0.8)) % 80))) for i in range(300)]
    docs += [(1000 + i, "w1 w2 copy of w3 w3") for i in range(150)]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 12)))) for i in range(15)] + [(99, "w3 copy w3")]
    assert ranked(spark, docs, items) == brute(docs, items)
    assert ranked(spark, docs, items, k=3) == brute(docs, items, 3)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "--- ..."), (4, "Rare RARE rare"), (5, "rare"), (5, "rare"), (None, "rare"), (6, "x " * 50_000)]
    docs += [(7, "ÉTÉ été"), (8, "x_y")]
    items = [(1, "rare x"), (2, None), (3, "!!"), (4, "unseen"), (5, "été ÉTÉ"), (1, "rare x"), (None, "y")]
    assert ranked(spark, docs, items) == brute(docs, items)
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == [] and ranked(spark, [(1, None)], items) == []


def test_term_of_every_document(spark):
    docs = [(i, "same " * (i + 1)) for i in range(5)]
    assert ranked(spark, docs, [(1, "same")]) == brute(docs, [(1, "same")])


def test_short_vectors_beside_long_ones(spark):
    docs = [(0, "tiny " + "filler " * 40_000)] + [(i, f"big{i} rare{i} one{i}") for i in range(1, 60)]
    items = [(1, "tiny"), (2, " ".join(f"big{i} rare{i}" for i in range(60)))]
    assert ranked(spark, docs, items) == brute(docs, items)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], DOCS)
    items = spark.createDataFrame([(1, "b c")], ITEMS)
    for name in ("n", "terms", "tf", "length", "impacts", "row", "part", "query", "score", "rank", "item_id", "block"):
        docs = docs.withColumn(name, F.lit("clash"))
        items = items if name == "item_id" else items.withColumn(name, F.lit("clash"))
    got = lexical.rank_documents(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute([(1, "a b"), (2, "b c")], [(1, "b c")])


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 20)
    docs = [(i, f"a{i % 5} b{i % 3} c") for i in range(40)]
    items = [(i, f"a{i} b{i} c{i}") for i in range(6)]
    assert ranked(spark, docs, items) == brute(docs, items)


vectors = st.lists(st.dictionaries(st.integers(0, 7), st.integers(1, 50), min_size=1), min_size=1, max_size=30)


@given(vectors, st.dictionaries(st.integers(0, 9), st.integers(1, 40), min_size=1), st.integers(1, 4000))
@settings(max_examples=300, deadline=None)
def test_bucket_keeps_every_row_at_the_bound(rows, query, bound):
    weight = {t: 3 + t for t in range(10)}
    rows = sorted(rows, key=lambda r: -sum(weight[t] * x * x for t, x in r.items()))
    length = np.array([math.sqrt(sum(weight[t] * x * x for t, x in r.items())) for r in rows])
    starts = np.cumsum([0] + [len(r) for r in rows])
    flat = [(t, r[t]) for r in rows for t in sorted(r)]
    bucket = lexical.Bucket(list(range(len(rows))), length, starts, *(np.array(c, dtype=np.int64) for c in zip(*flat, strict=True)))
    asked = np.array(sorted(query), dtype=np.int64)
    own = np.array([query[t] * weight[t] for t in sorted(query)], dtype=np.int64)
    norm = math.sqrt(sum(c * c * weight[t] for t, c in query.items()))
    want = [(i, sum(r.get(t, 0) * c * weight[t] for t, c in query.items())) for i, r in enumerate(rows)]
    assert bucket.best(asked, own, norm, bound) == [(i, s) for i, s in want if s >= bound]
