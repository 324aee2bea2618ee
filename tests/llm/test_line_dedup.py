import hashlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from ovenplan.llm import line_dedup
from tests.conftest import SF_MID

WS = " \t\n\x0b\x0c\r"
LONG = "this line is long enough to count"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc_id)
    keep = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 3}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in keep or keep[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    df = line_dedup.dedup_lines(df)
    rows = df.select("doc_id", "_n_lines", "_n_dropped", F.sha2(F.encode("text", "UTF-8"), 256)).collect()
    return sorted([tuple(r) for r in rows], key=str)


def test_edge_cases(spark):
    rows = [
        (1, f"{LONG}\nown line of the first document\n{LONG}"),
        (2, f"  {LONG.upper()}\t\r\nshort"),
        (3, f"{LONG}\n"),
        (4, None),
        (5, ""),
        (None, LONG),
        (6, "twenty ümläut chars ä\nx"),
        (7, "twenty ümläut chars ä"),
        (8, "TWENTY ümläut chars ä\n" + "word " * 50_000),
        (9, "only in two documents, this"),
        (10, "only in two documents, this"),
        (10, "only in two documents, this"),
        (3, f"{LONG}\n"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == brute(rows)
    wide = df.withColumn("keep", F.lit(1)).withColumn("key", F.lit("x")).withColumn("n", F.lit(None).cast("int"))
    assert line_dedup.dedup_lines(wide).columns == [*wide.columns, "_n_lines", "_n_dropped"]
    assert result(wide) == brute(rows)


def test_columns_with_the_names_used_inside(spark):
    rows = [(i, f"{LONG}\nown {i}") for i in range(5)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("_id", "id", "_lost", "lost", "_n_lines", "_n_dropped", "row", "keep", "key", "n"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    plain = line_dedup.dedup_lines(df, counts=False)
    assert plain.columns == df.columns
    got = {r.doc_id: r for r in plain.collect()}
    assert got[4].text == f"{LONG}\nown 4" and got[0].text == "own 0" and got[None].text == ""
    assert all(r[n] == f"own {n}" for r in got.values() for n in df.columns[2:])
    assert result(df) == brute(rows)


def test_saturated_filter_gives_the_same_result(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").filter("doc_id < 200")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    small = line_dedup.dedup_lines(docs, max_bits=1 << 16)
    assert sorted(tuple(r) for r in small.select("doc_id", "_n_dropped").collect()) == [
        (r[0], r[2]) for r in sorted(brute(rows), key=lambda r: r[0])
    ]


def test_empty_table(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []


def test_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_MID}/documents.parquet')")
    want = sorted(con.sql(line_dedup.ORACLE).fetchall())
    assert sorted(tuple(r) for r in line_dedup.op2_line_dedup(spark, SF_MID).collect()) == want
