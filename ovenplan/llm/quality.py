"""Quality rules with an isolation forest over rule statistics.

Every text gives counts (words, symbols, repeated lines, words in repeated
windows) and ratios of them. A forest of random trees is grown on a bounded
sample of rows labelled good (``sample_rows``; all documents where none are
labelled): each tree splits ``tree_rows`` of them at random places of random
statistics, up to their spread beyond their range, down to ``log2(tree_rows)`` splits.
A text that few splits set apart is anomalous: score 2 ** (-mean path / usual path).

The threshold is calibrated on all labelled rows, by score in thousandths: the
highest that gains most, counting the share of bad rows rejected less
``GOOD_WEIGHT`` times that of good rows, of which it may reject ``good_loss``. Without bad or good rows the forest rejects nothing.

Defined cases: null text has no words. A document fails the base rules with
fewer than 50 words or over half its words in repeated windows, and is then
rejected whatever its score. A doc_id labelled more than once counts as bad if
any label says so; labels null or without a document are not used. Equal texts
get equal verdicts. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ovenplan.llm import common
from ovenplan.session import materialize

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Bound of the labelled rows that the forest is grown on.
SAMPLE_ROWS = 8192
TREES = 128
TREE_ROWS = 256
GOOD_LOSS = 0.005
#: A good share rejected costs as much as so many times that share of the bad ones missed.
GOOD_WEIGHT = 5
STEPS = 1000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE_COUNTS = ["n_lines", "n_capitals", "n_marks", "n_distinct"]
ALL_COUNTS = COUNTS + MORE_COUNTS
_CAPITALS, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!?"
#: Least spread of each statistic below: how far beyond the sample's values a text must be to stand out.
LEAST_SPREAD = np.array([0.5, 0.05, 0.1, 0.1, 0.05, 0.05, 0.25])


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words within 3-word windows found twice or more, and the number of distinct words."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(ids) < 4:
        return 0, len(number)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    order = np.argsort(windows := pairs[:-1] * len(number) + ids[2:], kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    starts = np.zeros(len(windows), dtype=bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for i in range(3):
        covered[i : len(ids) - 2 + i] |= starts
    return int(covered.sum()), len(number)


def text_counts(text: str | None) -> tuple[int, ...]:
    """ALL_COUNTS of one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    seen, dups = set(), 0
    lines = raw.split(b"\n")
    for line in lines:
        if line in seen:
            dups += bool(line.strip(common.ASCII_WS))
        else:
            seen.add(line)
    repeated, distinct = repeated_words(words)
    return (
        len(words),
        len(text) - sum(raw.count(c) for c in common.ASCII_WS),
        sum(text.count(c) for c in SYMBOLS),
        dups,
        repeated,
        len(lines),
        len(raw) - len(raw.translate(None, _CAPITALS)),
        len(raw) - len(raw.translate(None, _MARKS)),
        distinct,
    )


def statistics(counts: np.ndarray) -> np.ndarray:
    """Rule statistics, one row per text, from ALL_COUNTS (one row per text)."""
    c = dict(zip(ALL_COUNTS, counts.T.astype(np.float64), strict=True))
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack(
        [
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            c["n_repeat_words"] / words,
            c["n_capitals"] / chars,
            c["n_marks"] / words,
            np.log(words) - np.log(np.maximum(c["n_distinct"], 1)),
        ],
        axis=1,
    )


def usual_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), n > 1)


class Forest:
    """Random split trees, each in heap order: children of node i are 2i + 1 and 2i + 2."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.depth = max(1, int(np.ceil(np.log2(max(2, min(tree_rows, len(rows)))))))
        size = 2 ** (self.depth + 1) - 1
        self.feature = np.full((trees, size), -1)
        self.cut = np.zeros((trees, size))
        self.path = np.zeros((trees, size))
        self.spread = np.maximum(rows.std(axis=0), LEAST_SPREAD[: rows.shape[1]])
        self.usual = float(usual_path(min(tree_rows, len(rows)))) or 1.0
        for t in range(trees):
            own = rows[rng.permutation(len(rows))[:tree_rows]]
            self._grow(rng, t, 0, own, 0)

    def _grow(self, rng, t: int, node: int, rows: np.ndarray, depth: int) -> None:
        self.path[t, node] = depth + float(usual_path(len(rows)))
        if depth == self.depth or len(rows) < 2:
            return
        f = rng.integers(rows.shape[1])
        # Beyond the range of the rows, so that a text outside of it may part from all of them at once.
        cut = rng.uniform(rows[:, f].min() - self.spread[f], rows[:, f].max() + self.spread[f])
        self.feature[t, node], self.cut[t, node] = f, cut
        below = rows[:, f] < cut
        self._grow(rng, t, 2 * node + 1, rows[below], depth + 1)
        self._grow(rng, t, 2 * node + 2, rows[~below], depth + 1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; higher is more anomalous."""
        total = np.zeros(len(rows))
        at = np.arange(len(rows))
        for t in range(len(self.feature)):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                f = self.feature[t, node]
                down = 2 * node + 1 + (rows[at, f] >= self.cut[t, node])
                node = np.where(f >= 0, down, node)
            total += self.path[t, node]
        return 2.0 ** (-total / len(self.feature) / self.usual)


class Verdicts:
    """A fitted forest with its threshold."""

    def __init__(self, forest: Forest | None, threshold: float):
        self.forest, self.threshold = forest, threshold

    def __call__(self, counts: np.ndarray) -> dict[str, np.ndarray]:
        words, repeated = counts[:, 0], counts[:, ALL_COUNTS.index("n_repeat_words")]
        failed = (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * words)
        score = self.forest.score(statistics(counts)) if self.forest else np.zeros(len(counts))
        return {"base_failed": failed, "score": score, "kept": ~failed & (score < self.threshold)}


def count_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, ALL_COUNTS) of every row."""

    def count(batch):
        found = np.array([text_counts(t) for t in batch.column("text").to_pylist()], dtype=np.int64)
        return [batch.column("doc_id"), *found.T]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_batches(
        docs.select("doc_id", "text"), count, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in ALL_COUNTS)
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ALL_COUNTS], axis=1)


def fit(counted: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, good_loss: float = GOOD_LOSS) -> Verdicts:
    """Forest and threshold from the counts of all documents and the labelled rows."""
    labels = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = materialize(counted.join(labels, "doc_id"), "quality-labelled")
    # Rows that the base rules reject need no verdict, and say nothing of the others.
    known = known.filter(
        f"n_words >= {MIN_WORDS} and 100 * n_repeat_words <= {MAX_REPEATED_PERCENT} * n_words"
    )

    def sample(df):
        df = df.orderBy(F.xxhash64("doc_id"), *ALL_COUNTS).limit(sample_rows).select(*ALL_COUNTS)
        return np.array(df.collect(), dtype=np.int64).reshape(-1, len(ALL_COUNTS))

    rows = sample(known.filter("quality > 0"))
    if len(rows) < 2:
        rows = sample(counted)
    if len(rows) < 2:
        return Verdicts(None, np.inf)
    forest = Forest(statistics(rows))

    def graded(batch):
        score = forest.score(statistics(_matrix(batch)))
        return [np.floor(score * STEPS).astype(np.int64), batch.column("quality").to_numpy(zero_copy_only=False) > 0]

    steps = common.map_batches(known.select("quality", *ALL_COUNTS), graded, "step long, good boolean")
    by = np.zeros((2, STEPS + 2))
    for r in steps.groupBy("step", "good").count().collect():  # two rows per step at most
        by[int(r["good"]), r["step"]] += r["count"]
    bad, good = by[:, ::-1].cumsum(axis=1)[:, ::-1]  # rejected with a threshold at each step
    if not bad[0] or not good[0]:
        return Verdicts(forest, np.inf)
    gain = np.where(good <= good_loss * good[0], bad / bad[0] - GOOD_WEIGHT * good / good[0], -np.inf)
    return Verdicts(forest, int(np.flatnonzero(gain == gain.max())[-1]) / STEPS)


def judged(counted: DataFrame, verdicts: Verdicts) -> DataFrame:
    """``counted`` with base_failed, score and kept."""
    names = counted.columns

    def judge(batch):
        return {n: batch.column(n) for n in names} | verdicts(_matrix(batch))

    out = T.StructType([*counted.schema.fields]).add("base_failed", "boolean").add("score", "double").add("kept", "boolean")
    return common.map_batches(counted, judge, out)


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    verdicts = fit(materialize(count_rules(docs), "quality-counts"), labels)
    names = docs.columns

    def keep(batch):
        counts = np.array([text_counts(t) for t in batch.column("text").to_pylist()], dtype=np.int64)
        kept = pa.array(verdicts(counts)["kept"])
        return {n: batch.column(n).filter(kept) for n in names}

    return common.map_batches(docs, keep, docs.schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = materialize(count_rules(common.read(spark, sf_dir, "documents", "doc_id", "text")), "quality-counts")
    verdicts = fit(counted, common.read(spark, sf_dir, "labels", "doc_id", "quality"))
    return judged(counted, verdicts).select("doc_id", *COUNTS, "base_failed", "kept", "score")
