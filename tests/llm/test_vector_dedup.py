import math

import numpy as np
from pyspark.sql import functions as F

from ovenplan.llm import common, vector_dedup
from tests.conftest import SF_MID

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(vec_id, n_links, component_id, kept), by comparing all pairs of rows."""
    usable = [v is not None and len(v) and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0 and y is not None for _, v, y in rows]
    links, a, b = [0] * len(rows), [], []
    unit = [np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)) if u else None for u, (_, v, _) in zip(usable, rows, strict=True)]
    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                a.append(i)
                b.append(j)
    root = common.local_roots(len(rows), np.array(a, dtype=int), np.array(b, dtype=int))
    least = {}
    for (i, _, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(least.get(r, math.inf), i)
    return sorted(((i, n, least.get(r), i == least.get(r)) for (i, _, _), n, r in zip(rows, links, root, strict=True)), key=str)


def result(df, **options):
    return sorted((tuple(r) for r in vector_dedup.near_duplicates(df, **options).collect()), key=str)


def float32(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted((tuple(r) for r in vector_dedup.op3_vector_near_dedup(spark, SF_MID).collect()), key=str) == brute(rows)


def test_edge_cases(spark):
    e = [1.0, 0.0, 0.0, 0.0]
    rows = [(1, e, 0), (2, e, 0), (2, e, 0), (3, e, 1), (4, e, None), (5, None, 0), (6, [], 0), (7, [0.0] * 4, 0), (8, [1.0, None, 0.0, 0.0], 0)]
    rows += [(9, [math.nan, 0, 0, 0], 0), (10, [math.inf, 0, 0, 0], 0), (11, [2.0, -0.0, 0, 0], 0), (12, [1e30, 0, 0, 0], 0), (13, [-1.0, 0, 0, 0], 0)]
    rows += [(14, [1.0, 0, 0], 0), (15, [1.0, 0.1, 0, 0], 0), (16, [1.0, 0.25, 0, 0], 0), (None, [0, 0, 1.0, 0], 0), (17, [0, 0, 1.0, 0], 0)]
    rows = [(i, float32(v), y) for i, v, y in rows]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("n", F.lit("x"))
    assert result(df) == brute(rows)
    assert result(df.filter("false")) == []
    assert result(df.filter("vec_id = 5")) == [(5, 0, 5, True)]
    assert result(spark.createDataFrame([(None, e, 0)], SCHEMA))[0][1] == 0


def test_recall_of_random_pairs_and_dealt_buckets(spark):
    """Isolated pairs near the threshold, and a group of near copies dealt into slots."""
    rng = np.random.default_rng(2)
    rows, centre = [], rng.normal(size=64)
    for i in range(400):
        v = rng.normal(size=64)
        w = v + rng.normal(size=64) * rng.uniform(0.12, 0.2)
        rows += [(2 * i, v, 0), (2 * i + 1, w, 0)]
    rows += [(1000 + i, centre + 0.1 * rng.normal(size=64), 1) for i in range(150)]
    rows = [(i, float32(v), y) for i, v, y in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    want, got = brute(rows), result(df)
    n = sum(r[1] for r in want)
    assert n > 10_000 and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    pairs = [(g, w) for g, w in zip(got, want, strict=True) if w[0] < 1000 and w[1]]
    assert sum(g[1] for g, _ in pairs) >= 0.97 * sum(w[1] for _, w in pairs)
    assert result(df, bucket_rows=20) == got
