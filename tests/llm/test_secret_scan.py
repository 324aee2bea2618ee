import hashlib
import re

from pyspark.sql import functions as F

from ovenplan.llm import secret_scan, spans
from tests.conftest import SF_MID

PATTERNS = {
    "assign": r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def brute(text):
    found = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            if {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[kind]():
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda f: (f[1], list(PATTERNS).index(f[0])))


def joined(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()}
    got = secret_scan.op7_secret_scan(spark, SF_MID).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for x, _, _ in want) for k in PATTERNS]
        assert set(joined(want).split(",")) <= set(r.spans.split(","))


EDGES = [
    None, "", 'PassWord: "hunter2x"', "password:short", "token==abcdef", "api_key = 'x.y=z-1' apikey=abcdefg API_KEY:1234567", "ſecret: abcdefg toKen: abcdefg",
    "é token = " + "deadbeef" * 4, "AKIA" + "A1" * 8, "AKIAAKIA" + "B" * 11, "AKIAAKIA" + "B" * 12, "xAKIA" + "Z" * 40, "0123456789abcdef01234567g0123456789abcdef0123456",
    "secret secret: token: abcdef", "passwd" + " " * 4000 + "=" + " " * 4000 + "abcdef", "f" * 60_000, "token:" + "a=" * 20_000, "token=abcdefg " * 500,
]


def run(df, **options):
    got = secret_scan.secrets(df, **options)
    return got.select("doc_id", spans.digest(F.col("base")), spans.digest(F.col("spans")), "n_live", "n_copied").collect()


def test_edge_cases(spark):
    rows = [(i, "s", t) for i, t in enumerate(EDGES)] + [(None, None, "token=abcdefg"), (0, "s", "token=abcdefg"), (0, "s", "token=abcdefg")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("value", F.lit(1)).withColumn("n_live", F.lit("x"))
    want = sorted(((i, joined(brute(t))) for i, _, t in rows), key=str)
    assert sorted((tuple(r)[:2] for r in run(df)), key=str) == want
    assert run(df.filter("false")) == []


def test_ownership(spark):
    example, live = "q7Zk29xLmP0vTb4RwY8s", "hT5nB3cXe9Ua1Jd7Kf2G"
    rows = [(i, f"src{i % 5}", f"text {i} sample {example} end") for i in range(20)]
    rows += [(100 + i, "src1", f"text {i} mine {live} end") for i in range(3)] + [(200, None, f"a token = {example}")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r[0]: tuple(r)[1:] for r in run(df)}
    assert got[0] == ("", "", 0, 1) and got[100] == ("", "live:12:32", 1, 0)
    assert got[200] == ("assign:2:30", "assign:2:30", 0, 1)
    values = df.select("doc_id", "source", F.regexp_extract("text", "[A-Za-z0-9]{20}", 0).alias("value"))
    assert {tuple(r) for r in secret_scan.ownership(values).collect()} == {(example, 21, 6), (live, 3, 1)}
