"""Runs of words that repeat with a period, by sparse diagonals.

Words are compared with earlier occurrences of themselves. The pair (word i, word
i - d) lies on the diagonal of lag d; while consecutive words match, the
diagonal's match length grows, and where it ends after m matches, words
i - m - d .. i - 1 have period d. A run is kept if it has at least ``REPEATS`` periods
and ``LEAST`` words and d is its smallest period.

A word of a long text has too many earlier occurrences to follow each, so a lag is
taken up from an occurrence that can still become a run and carries little:

* Lags of 1 to 3 words are followed on their whole diagonals.
* A lag d with k <= d < 2k (k = 4, 8, 16, ...) is taken up from occurrences of the
  k words from i on. A run of four periods repeats them at i - d and i - 2d, so an
  occurrence without that second one is passed over.
* If the same k words occur less than k / 2 + 1 words apart, they have a period of
  k / 2 at most themselves, and are passed over. Some k words within any one period of
  the run have no such period: otherwise neighbours, which share k - 1
  words, would have the same one, and so would the whole run, against d being smallest.
  The others occur at most three times within 2k words.

So no run is lost, and a scale takes up at most three lags per word. Each is
followed to both ends of its diagonal once, word by word: a run reported is a run. The
k words are named by 64-bit hashes. Two different stretches of one text with the same
hash could hide a run; for a text of a million words the odds of such a pair are 3e-8 a scale.

Defined cases: null, empty and blank text has no words and no run. Rows are taken one
by one, so repeated rows give repeated results. Ties of the greatest exponent go to
the smallest start, then period. An empty table gives no rows. Columns beside doc_id
and text are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.llm import common

#: Periods and words that a run has at least.
REPEATS, LEAST = 4, 6
#: Longest lag that is followed on its whole diagonal.
DENSE = 3
#: Words, or more by one document, that are searched together.
BATCH_WORDS = 500_000

Run = tuple[int, int, int]  # start, length, period


def planted_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic passage in every tenth document (by checksum of its id), as the query's input asks."""
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def _prime_factors(n: int) -> list[int]:
    found, f = [], 2
    while f * f <= n:
        if n % f == 0:
            found.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return found + [n] * (n > 1)


def _matched(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements are equal from the start on; looks at twice as many each time."""
    n = min(len(a), len(b))
    a, b, at, step = a[:n], b[:n], 0, 32
    while at < n:
        apart = np.flatnonzero(a[at : at + step] != b[at : at + step])
        if len(apart):
            return at + int(apart[0])
        at, step = at + step, 2 * step
    return n


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _dense_diagonal(words: np.ndarray, d: int, least: int) -> list[tuple[int, int]]:
    """(first, end) of each stretch of ``least`` words or more that equal the word d before."""
    apart = np.flatnonzero(words[d:] != words[: max(0, len(words) - d)]) + d
    apart = np.concatenate(([d - 1], apart, [len(words)]))
    long = np.flatnonzero(np.diff(apart) > least)
    return [(int(apart[i]) + 1, int(apart[i + 1])) for i in long]


def _earlier(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) by lag, then position: lags from k to 2k - 1 at which the hash occurs before, and at twice the lag."""
    # Few hashes occur three times: leave the others out before sorting.
    slots = (h & np.uint64((1 << max(10, len(h).bit_length() + 2)) - 1)).astype(np.int64)
    at = np.flatnonzero(np.bincount(slots)[slots] >= 3)
    at = at[np.argsort(h[at], kind="stable")]
    same = h[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = same[1:] != same[:-1]
    # Occurrences k / 2 apart or less end a chain.
    near = np.zeros(len(at), dtype=bool)
    near[1:] = ~new[1:] & (2 * (at[1:] - at[:-1]) <= k)
    found_i, found_d = [], []
    follows, chain = ~new & ~near, np.ones(len(at), dtype=bool)
    for back in (1, 2, 3):
        step = np.zeros(len(at), dtype=bool)
        step[back:] = follows[1 : len(at) - back + 1]
        chain &= step
        i = np.flatnonzero(chain)
        d = at[i] - at[i - back]
        i, d = at[i][(d >= k) & (d < 2 * k)], d[(d >= k) & (d < 2 * k)]
        twice = i - 2 * d
        keep = (twice >= 0) & (h[i] == h[np.maximum(twice, 0)])
        found_i.append(i[keep])
        found_d.append(d[keep])
    i, d = np.concatenate(found_i), np.concatenate(found_d)
    order = np.lexsort((i, d))
    return i[order], d[order]


def _follow(words: np.ndarray, i: np.ndarray, d: np.ndarray) -> list[Run]:
    """The runs on the diagonals that (position, lag) lie on; each diagonal's stretch is followed once."""
    head = np.ones(len(i), dtype=bool)
    head[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1] + 1)
    found, lag, end = [], 0, 0
    for at, own in zip(i[head].tolist(), d[head].tolist(), strict=True):
        if own == lag and at < end:
            continue
        lag, end = own, at + _matched(words[at:], words[at - own :])
        first = at - _matched(words[own:at][::-1], words[: at - own][::-1])
        if end - first >= max((REPEATS - 1) * lag, LEAST - lag):
            found.append((first - lag, end - first + lag, lag))
    return found


def _is_smallest(words: np.ndarray, run: Run) -> bool:
    """No divisor of the run's period is a period of it."""
    start, _, d = run
    parts = [d // f for f in _prime_factors(d)]
    return all((words[start : start + d] != words[start + q : start + q + d]).any() for q in parts)


def find_runs(words: np.ndarray, lengths: np.ndarray) -> list[list[Run]]:
    """Of each text, its (start, length, period) by start, then period.

    ``words`` holds the texts one after the other, equal words as equal numbers of at
    least 0; ``lengths`` are their numbers of words.
    """
    # A mark of its own after each text: no match goes across.
    texts = np.arange(len(lengths))
    words = np.insert(words, np.cumsum(lengths), -1 - texts)
    starts = np.cumsum(lengths + 1) - lengths - 1
    found: set[Run] = set()
    for d in range(1, DENSE + 1):
        for first, end in _dense_diagonal(words, d, max((REPEATS - 1) * d, LEAST - d)):
            found.add((first - d, end - first + d, d))
    # Hashes of k words from each position on, of the texts that are long enough for lag k.
    k, at, size = 1, np.arange(len(words)), np.repeat(lengths, lengths + 1)
    h = _mix(words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.repeat(texts.astype(np.uint64), lengths + 1))
    while len(at):
        keep = size >= REPEATS * 2 * k
        at, size, h = at[keep], size[keep], h[keep]
        at, size, h = at[:-k], size[:-k], _mix(h[:-k] * np.uint64(0x94D049BB133111EB) + h[k:])
        k *= 2
        if k > DENSE:
            i, d = _earlier(h, k)
            found.update(_follow(words, at[i], d))
    of = [[] for _ in lengths]
    for run in sorted(found):
        if _is_smallest(words, run):
            text = int(np.searchsorted(starts, run[0], side="right")) - 1
            of[text].append((run[0] - int(starts[text]), run[1], run[2]))
    return of


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of the n words no run holds after its first period."""
    steps = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) == 0


def words_of(_: object, text: str | None) -> list[bytes]:
    """The runs of characters other than ASCII white space, in UTF-8."""
    return (text or "").encode().split()


def _search(texts: list[list[bytes]]) -> list[list[Run]]:
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(lengths.sum()))
    return find_runs(words, lengths)


def with_runs(docs: DataFrame, words: Callable[[object, str | None], list[bytes]] = words_of) -> DataFrame:
    """(doc_id, runs, collapsed): every run as (start, length, period) by start, then period, and the text without repeats.

    ``words`` gives a row's words from its doc_id and text. The collapsed text joins
    the kept words by one space: each run leaves its first period.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    names = ["doc_id", "runs", "collapsed"]

    def block(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = _search(texts)
        kept = [" ".join(map(bytes.decode, compress(t, kept_words(len(t), r).tolist()) if r else t)) for t, r in zip(texts, runs, strict=True)]
        runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs]
        return pa.RecordBatch.from_arrays([ids, pa.array(runs, pa.list_(run)), pa.array(kept, pa.string())], names=names)

    def task(batches):
        for batch in batches:
            first, n, texts = 0, 0, []
            ids = batch.column("doc_id")
            for i, (doc_id, text) in enumerate(zip(ids.to_pylist(), batch.column("text"), strict=True)):
                texts.append(words(doc_id, text.as_py()))
                n += len(texts[-1])
                if n >= BATCH_WORDS or i == batch.num_rows - 1:
                    yield block(ids.slice(first, len(texts)), texts)
                    first, n, texts = i + 1, 0, []

    schema = f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(task, schema)


def longest_first(a: Column, b: Column) -> Column:
    """Order of runs: greatest length / period, then smallest start, then period."""
    ahead, behind = a["length"] * b["period"], b["length"] * a["period"]
    first = (ahead > behind) | ((ahead == behind) & (F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"])))
    return F.when(first, -1).otherwise(1)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    found = with_runs(docs, lambda doc_id, text: planted_words(doc_id, words_of(doc_id, text)))
    best = F.get(F.array_sort("runs", longest_first), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("*", F.when(F.size("runs") > 0, best).alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
