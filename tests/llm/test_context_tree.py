import functools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ovenplan.llm import context_tree
from tests.conftest import SF_MID


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", lowered) if w]


def brute_base(rows, train):
    counts = Counter(t for (_, text), use in zip(rows, train, strict=True) if use for t in [*words(text), "\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        tokens = [*words(text), "\n"]
        out.append((doc_id, len(tokens), sum(counts[t] > 0 for t in tokens), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)))
    return out


class BruteTree:
    """Context-tree weighting with a dictionary of nodes, by its definition."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, defaultdict(lambda: [0, 0])
        for text in texts:
            for context, node, bit in self.steps(text):
                for d in range(depth + 1):
                    self.n[context[depth - d :], node][bit] += 1
        self.children = defaultdict(list)
        for context, node in self.n:
            if context:
                self.children[context[1:], node].append((context, node))

    def steps(self, text):
        data = b"\n" * self.depth + "".join(w + " " for w in words(text)).encode() + b"\n"
        for i in range(self.depth, len(data)):
            node = 1
            for j in range(7, -1, -1):
                bit = data[i] >> j & 1
                yield data[i - self.depth : i], node, bit
                node = 2 * node + bit

    def own(self, key):
        a, b = self.n[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, key):
        if len(key[0]) == self.depth:
            return self.own(key)
        return np.logaddexp(self.own(key), self.below(key)) - math.log(2)

    def below(self, key):
        return sum(self.weighted(c) for c in self.children[key])

    def score(self, text):
        total = 0.0
        for context, node, bit in self.steps(text):
            p = None
            for d in range(self.depth, -1, -1):
                key = (context[self.depth - d :], node)
                if key in self.n:
                    a = (self.n[key][bit] + 0.5) / (sum(self.n[key]) + 1)
                    w = 1.0 if p is None or d == self.depth else 1 / (1 + math.exp(min(self.below(key) - self.own(key), 700)))
                    p = a if p is None else w * a + (1 - w) * p
            total += math.log10(0.5 if p is None else p)
        return total


TEXTS = [None, "", " \n", "The cat", "the  CAT\tsat", "the cat sat on the mat", "a dog", "É à la mode", "the cat", "the cat"]


def test_against_brute_force(spark):
    rows = [(i if i != 6 else None, t) for i, t in enumerate(TEXTS)] + [(3, "The cat")]
    train = [i is None or i % 4 != 1 for i, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("n", F.lit(1))
    use = F.coalesce(F.col("doc_id") % 4 != 1, F.lit(True))
    got = sorted((tuple(r) for r in context_tree.score_documents(df, use, depth=3).collect()), key=str)
    want = sorted(brute_base(rows, train), key=str)
    tree = BruteTree([t for (_, t), u in zip(rows, train, strict=True) if u], 3)
    scores = {(i, len(words(t)) + 1): tree.score(t) for i, t in rows}
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])
    assert [g[5] for g in got] == pytest.approx([scores[g[:2]] for g in got], rel=1e-4)


def test_no_training_text(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in context_tree.score_documents(df, F.lit(False)).collect())
    assert [(r[0], r[2], r[3], r[4]) for r in got] == [(1, 0, 0, 0.0), (2, 0, 0, 0.0)]
    assert got[0][5] == pytest.approx(-32 * math.log10(2)) and got[0][6] == pytest.approx(8)
    assert context_tree.score_documents(df.filter("false"), F.lit(True)).collect() == []


def test_probabilities_add_up():
    """Over all bytes that may follow a context, seen or not."""
    rng = np.random.default_rng(1)
    key = np.unique(rng.integers(0, 3, 40) << 8 | rng.integers(0, 256, 40))
    every = (np.arange(4)[:, None] << 8 | np.arange(256)).ravel()
    n = np.where(np.isin(every, key), rng.integers(1, 9000, len(every)), 0)
    total = np.zeros(len(every))
    for _, bit, place, tree in context_tree._byte_trees(every, n, 1):
        some = rng.uniform(0.1, 0.5, len(tree.key)), rng.uniform(0.1, 0.5, len(tree.key))
        p = tree.down(*some)[0][place]
        total += np.log2(np.where(bit == 1, p, 1 - p))
    assert (2**total).reshape(4, 256).sum(axis=1) == pytest.approx(np.ones(4))


def test_packing_and_grams(monkeypatch):
    values = np.array([0, 1, -5, 1 << 62], dtype=np.int64)
    assert context_tree.unpack(context_tree.pack(values)).tolist() == values.tolist()
    streams = [b"ab \n", b"\n", "é \n".encode()]
    whole = [(g, o) for grams, owners in context_tree.grams_of(streams, 2) for g, o in zip(grams.tolist(), owners.tolist(), strict=True)]
    want = []
    for number, stream in enumerate(streams):
        data = b"\n\n" + stream
        want += [(data[i - 1] << 16 | data[i - 2] << 8 | data[i], number) for i in range(2, len(data))]
    assert whole == want
    monkeypatch.setattr(context_tree, "PLACES", 3)  # a text is cut into blocks, its contexts are not
    assert want == [(g, o) for grams, owners in context_tree.grams_of(streams, 2) for g, o in zip(grams.tolist(), owners.tolist(), strict=True)]


def test_empty_and_very_long(spark, monkeypatch):
    """One word of 300,000 characters beside a null and an empty text; small blocks, tasks pass on what they hold."""
    monkeypatch.setattr(context_tree, "PLACES", 5000)
    monkeypatch.setattr(context_tree, "FLUSH_GRAMS", 300)
    df = spark.createDataFrame([(1, "xyz" * 100_000), (2, None), (3, ""), (1, "xyz" * 100_000)], "doc_id long, text string")
    got = sorted(tuple(r) for r in context_tree.score_documents(df, F.lit(True)).collect())
    assert got[0] == got[1] and got[2][1:] == got[3][1:] and got[0][1] == 2
    assert got[0][6] < 0.01


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    got = {r.doc_id: r for r in context_tree.op1_lm_scoring(spark, SF_MID).collect()}
    assert len(got) == len(rows)
    for (i, tokens, known, n, base), use in zip(brute_base(rows, train), train, strict=True):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, n, not use)
        assert r.base_score == pytest.approx(base)
    held = [r for r in got.values() if r.held_out]
    assert np.mean([r.bits_per_byte for r in held]) < 4  # bytes in the table's alphabet take over five bits
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_contexts_count(spark, monkeypatch):
    """Every node of rare words counts, in full precision, and with hardly any broadcast cache."""
    monkeypatch.setattr(context_tree, "HOT_TOKENS", 0)
    monkeypatch.setattr(context_tree, "CACHE", 3)
    rng = np.random.default_rng(3)
    long = [" ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 9)) for _ in range(500)) for _ in range(4)]
    rows = list(enumerate(long)) + [(100, long[3][:300]), (101, "zzz unseen " + long[1][:99])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in context_tree.score_documents(df, F.col("doc_id") < 100).collect()}
    tree = BruteTree(long, context_tree.DEPTH)
    tree.below = functools.cache(tree.below)
    for i, text in [rows[0], *rows[-2:]]:
        assert got[i] == pytest.approx(tree.score(text), rel=1e-9)


def test_the_tree_table_frees_its_shuffle_files(spark, monkeypatch):
    from ovenplan import session

    docs = spark.createDataFrame([(i, f"some words {i} of text") for i in range(40)], "doc_id long, text string")
    freed, before = [], session.write_once
    monkeypatch.setattr(context_tree, "write_once", lambda df, path: freed.append(path) or before(df, path))
    assert context_tree.score_documents(docs, F.col("doc_id") % 2 == 0).count() == 40
    assert len(freed) == 1 and "tree-grams" in freed[0]


def test_grams_sorted_in_small_lots_give_the_same_counts(spark, monkeypatch):
    # In the session's own process: the limits hold where the plan's function is made and run.
    import pyarrow as pa

    rows = [(f"a few words {i % 7} and a few more {i}", i % 3 > 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "text string, learned boolean")
    tasks = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task) or self)
    context_tree.gram_pieces(docs, 3, 4)
    batch = pa.RecordBatch.from_pylist([dict(text=t, learned=known) for t, known in rows])

    def counts():
        found = {}
        for out in tasks[0](iter([batch, batch])):
            for key, n, times in zip(*(context_tree.unpack(out.column(c)[0].as_py()) for c in ("keys", "n", "times")), strict=True):
                a, b = found.get(int(key), (0, 0))
                found[int(key)] = a + int(n), b + int(times)
        return found

    whole = counts()
    monkeypatch.setattr(context_tree, "PLACES", 100)
    for limit in (50, 500):
        monkeypatch.setattr(context_tree, "FLUSH_GRAMS", limit)
        assert counts() == whole
    assert sum(b for _, b in whole.values()) == 2 * sum(len(context_tree.stream_of(context_tree.words_of(t))) for t, _ in rows)


def test_frequent_grams_are_found_by_hash_and_others_are_not():
    rng = np.random.default_rng(3)
    every = np.unique(np.concatenate([rng.integers(-(1 << 62), 1 << 62, 3000), np.arange(0, 1 << 40, 1 << 30), [0, -1]]))
    rng.shuffle(every)
    for n in (0, 1, 2, 1500):
        keys, values = every[:n], rng.random(n)
        found, missing = context_tree.look_up(context_tree.hashed(keys), keys, values, every)
        assert missing.tolist() == list(range(n, len(every)))
        assert found.tolist() == [*values, *[0.0] * (len(every) - n)]


def test_word_lists_are_the_words_of_each_text():
    import pyarrow as pa

    texts = [None, "", "  ", " A b\t\x0b\x0cC\r\nd ", "x\x1cy\x85Z\xa0q", "ÀB\x00 c", "one"]
    want = [[w.decode() for w in context_tree.words_of(t)] for t in texts]
    lists = context_tree.word_lists(pa.array(["skipped", *texts], pa.string()).slice(1))
    assert lists.to_pylist() == want
    names, codes, owners = context_tree.coded_words(lists)
    assert [(i, names[c].as_py()) for i, c in zip(owners, codes)] == [(i, w) for i, own in enumerate(want) for w in own]


def test_tables_go_once_nothing_reads_them(spark, tmp_path, monkeypatch):
    from ovenplan import session

    monkeypatch.setattr(session, "checkpoint_root", lambda spark: f"file://{tmp_path}")
    docs = spark.createDataFrame([(i, f"some words {i} of text") for i in range(40)], "doc_id long, text string")
    assert context_tree.score_documents(docs, F.col("doc_id") % 2 == 0).count() == 40
    left = {p.name for p in tmp_path.glob("lm-scoring-*/*")}
    assert left == {"scored-rows", "rare-words", "rare-grams"}


def test_counting_words_holds_no_memory_afterwards(spark, monkeypatch):
    # In the session's own process: the limits hold where the plan's function is made and run.
    import pyarrow as pa

    docs = spark.createDataFrame([("a", True)], "text string, learned boolean")
    tasks = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task) or self)
    monkeypatch.setattr(type(docs), "groupBy", lambda self, *_: self, raising=False)
    monkeypatch.setattr(type(docs), "agg", lambda self, *_: self, raising=False)
    context_tree.token_counts(docs)
    rows = [(f"a few words {i % 7} and a few more {i}", i % 3 > 0) for i in range(60)]
    batch = pa.RecordBatch.from_pylist([dict(text=t, learned=known) for t, known in rows])
    want = Counter(w.decode() for t, _ in rows for w in context_tree.words_of(t))
    own = Counter(w.decode() for t, known in rows if known for w in context_tree.words_of(t))
    for limit in (10, 50, 10_000):
        monkeypatch.setattr(context_tree, "FLUSH", limit)
        monkeypatch.setattr(context_tree, "PLACES", 100)
        n, times, most = Counter(), Counter(), 0
        for out in tasks[0](iter([batch])):
            most = max(most, out.num_rows)
            for r in out.to_pylist():
                n[r["token"]] += r["n"]
                times[r["token"]] += r["times"]
        assert (times, +n) == (want, own)
        assert most <= 2 * limit + 100
