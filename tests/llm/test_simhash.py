import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ovenplan.llm import common, simhash
from tests.conftest import SF_MID


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", words) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Component number of each fingerprint (linked at three bits or fewer)."""
    values = np.array(fps, dtype=np.uint64)
    root = np.arange(len(values))
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3)
        root = common.local_roots(len(values), np.full(len(near), i), near, root)
    return root


def check(rows, got):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(fps)
    ids = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        ids.setdefault(r, []).append(doc_id)
    want = [
        (d, f"{fp:016x}", min((x for x in ids[r] if x is not None), default=None))
        for (d, _), fp, r in zip(rows, fps, root, strict=True)
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


def run(df, **options):
    rows = simhash.near_duplicates(df, **options)
    rows = rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    return [tuple(r) for r in rows.collect()]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, [tuple(r) for r in simhash.op10_simhash_near_dedup(spark, SF_MID).collect()])


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "a"), (None, "a"), (None, "alone here")]
    rows += [(7, "same id"), (7, "same id"), (7, "other text of the same id"), (8, "w1 w2 w3 " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, run(df))
    check(rows, run(df.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))))
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []


def test_links_of_planted_fingerprints(spark):
    """Chains of near fingerprints, with shards small enough to be dealt into slots."""
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(400)}
    for f in list(fps)[:60]:
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
            fps.add(f)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    for shard_rows in (50_000, 40):
        links = simhash.fingerprint_links(nodes, 3, shard_rows)
        at = {int(np.uint64(f).view(np.int64)): i for i, f in enumerate(fps)}
        pairs = np.array([(at[r.u], at[r.v]) for r in links.collect()])
        got = common.local_roots(len(fps), pairs[:, 0], pairs[:, 1])
        assert (got == brute_components(fps)).all()
    member = {at[r.node]: at[r.root] for r in common.connected_components(links, "t").collect()}
    signed = sorted(at, key=lambda x: x)
    smallest = {}
    for v in signed:
        smallest.setdefault(got[at[v]], at[v])
    assert all(member[i] == smallest[got[i]] for i in member)
    assert set(member) == {i for i in range(len(fps)) if (got == got[i]).sum() > 1}
