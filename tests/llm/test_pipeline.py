import re
from collections import defaultdict

import corpus_pipeline
from ovenplan.llm import simhash
from tests.conftest import SF_MID
from tests.llm import test_line_dedup, test_packing, test_pii, test_quality, test_simhash


def read(path_or_df):
    return sorted((tuple(r) for r in path_or_df.collect()), key=str)


def test_stages_against_brute_force(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    names, kept = docs.columns, {}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF_MID)
        out.write.parquet(f"{tmp_dir}/{k}")
        docs = spark.read.parquet(f"{tmp_dir}/{k}")
        if k < 4:
            assert docs.columns == names
            kept = {r.doc_id: r for r in docs.collect()}
            assert all(r.n_chars == len(r.text) for r in kept.values())
        if name == "quality rules":
            assert all(kept[i] == before[i] for i in kept)
            assert not any(test_quality.brute(r.text)[5] for r in kept.values())
            good = [r.doc_id for r in spark.read.parquet(f"{SF_MID}/labels.parquet").filter("quality = 1").collect()]
            good = [i for i in good if not test_quality.brute(before[i].text)[5]]
            assert sum(i in kept for i in good) >= 0.98 * len(good)
        elif name == "line dedup":
            want = {r[0]: r[1:] for r in test_line_dedup.brute([(i, r.text) for i, r in before.items()])}
            assert set(kept) == set(before)
            for i, r in kept.items():
                assert test_line_dedup.hashlib.sha256(r.text.encode()).hexdigest() == want[i][2]
        elif name == "SimHash near-dedup":
            ids = sorted(before)
            root = test_simhash.brute_components([test_simhash.brute_fingerprint(before[i].text) for i in ids])
            groups = defaultdict(list)
            for i, g in zip(ids, root, strict=True):
                groups[g].append(i)
            assert sorted(kept) == sorted(min(g) for g in groups.values())
            assert all(kept[i] == before[i] for i in kept)
        elif name == "PII":
            assert set(kept) == set(before)
            for i, r in kept.items():
                assert not test_pii.brute(r.text)
                if not test_pii.brute(before[i].text):
                    assert re.sub("<(email|ip|card|phone)>", "", r.text) == r.text or "<" in before[i].text
        else:
            test_packing.check([(i, r.text) for i, r in before.items()], out.collect())
    run = corpus_pipeline.run(spark, SF_MID).drop("sequence_id", "offset")
    assert read(run) == read(docs.drop("sequence_id", "offset"))


def test_one_of_each_group_keeps_a_single_row(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "x y z"), (None, "x y z"), (3, None), (4, ""), (5, "own text here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "'k' as root", "doc_id as least")
    got = simhash.one_of_each_group(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in got.filter("doc_id is not null").collect()) == [(1, "a b c d"), (3, None), (5, "own text here")]
    assert got.filter("doc_id is null").count() == 1
    assert simhash.one_of_each_group(df.filter("false")).collect() == []
