"""Ranked lexical search with buckets of documents by the length of their impact vectors.

A document is a vector with one coordinate per query term it holds, the term's
impact there; a query is the vector of its terms' weights. A score is their inner
product, in 64-bit integers.

1. Every whole text is split into terms once; the number of terms and the counts
   of those that occur in some query are written to the shared folder.
2. Document frequencies give the weights, and they the impacts. Half of a weight's
   logarithm goes to either side, so a vector's length is sqrt(sum(weight * impact**2)).
   The vectors are range-partitioned and sorted by length, longest first; rows of
   equal length are told apart by their number, so copies spread over partitions.
3. The first partition alone is searched: the k-th best score there is a lower bound
   for each query, known to all tasks.
4. All vectors are searched in buckets of ``BUCKET`` rows. By Cauchy-Schwarz a query
   looks only at rows with length(query) * length(row) at or above its bound, and
   passes over the rest of the bucket, or all of it. Inside, the largest impact of
   each term bounds its coordinate: rows that hold only terms whose bounds sum to
   less than the query's bound cannot reach it and are not looked up; of the others the
   known part plus the bounds of the rest must reach it. Survivors are scored in
   integers, and the k-th best so far raises the task's bound.
5. Of each query the k best of all tasks remain.

Rows at the bound are kept, so ties are decided by doc_id alone and the result is exact.
Queries are taken in blocks of at most ``BLOCK_BYTES`` of text, or one longer item; a
block's terms are held by each task.

Defined cases: null, empty or term-free text has no terms; such documents count
for nothing and such items return nothing. Rows are ranked one by one, so repeated
rows each take a rank; of equal scores a null doc_id comes last. Repeated items are
ranked each. An empty table of either gives no rows. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ovenplan.llm import common
from ovenplan.session import materialize

TOP = 10
#: Rows that are searched together.
BUCKET = 4096
#: Bytes of query texts whose terms are held at once.
BLOCK_BYTES = 16_000_000

_PLAIN = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c if c > 127 else bytes([c]).lower()[0] if c in _PLAIN else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The maximal stretches of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased, in UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, values) of a list column without nulls; starts has one more entry than rows."""
    starts = column.offsets.to_numpy()
    return starts - starts[0], column.values.slice(starts[0], starts[-1] - starts[0]).to_numpy()


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf): each row's number of terms, and counts of those in ``vocabulary`` by ascending number."""
    kind, size = docs.schema["doc_id"].dataType.simpleString(), len(vocabulary)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batch):
        find, lengths, ids = held.value.get, [], []
        for text in batch.column("text"):
            words = terms_of(text.as_py())
            lengths.append(len(words))
            own = np.fromiter([i for i in map(find, words) if i is not None], np.int64)
            ids.append(own + len(ids) * size)
        keys, tf = np.unique(np.concatenate(ids), return_counts=True)
        starts = np.searchsorted(keys // size, np.arange(len(ids) + 1)).astype(np.int32)
        terms = pa.array((keys % size).astype(np.int32))
        lists = [pa.ListArray.from_arrays(starts, x) for x in (terms, pa.array(tf.astype(np.int64)))]
        return [batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists]

    schema = f"doc_id {kind}, n long, terms array<int>, tf array<bigint>"
    return common.map_batches(docs.select("doc_id", "text"), count, schema)


def weights(table: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """(weight of each term, documents with terms, all terms); the terms are those of one block of queries."""
    n, length = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, dtype=np.int64)
    for term, count in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[term] = count
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64), n, length


def impact_vectors(table: DataFrame, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, length, terms, impacts) of the rows that hold a term of weight, as in steps 1 and 2."""
    kind = table.schema["doc_id"].dataType.simpleString()

    def vectors(batch):
        starts, terms = _flat(batch.column("terms"))
        _, tf = _flat(batch.column("tf"))
        m = 100 - 75 + (75 * batch.column("n").to_numpy() * n_docs) // n_terms
        impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(starts)))
        # No row is without terms here.
        length = np.sqrt(np.add.reduceat(weight[terms] * impacts.astype(np.float64) ** 2, starts[:-1]))
        return [batch.column("doc_id"), pa.array(length), batch.column("terms"), pa.ListArray.from_arrays(starts, pa.array(impacts.astype(np.int32)))]

    schema = f"doc_id {kind}, length double, terms array<int>, impacts array<int>"
    return common.map_batches(table.where("size(terms) > 0"), vectors, schema, rows=10_000).where("length > 0")


class Bucket:
    """Rows by length, longest first, with the rows of each term."""

    def __init__(self, ids: list, length: np.ndarray, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.ids, self.length, self.starts, self.terms, self.impacts = ids, length, starts, terms, impacts
        row = np.repeat(np.arange(len(ids)), np.diff(starts))
        order = np.argsort(terms, kind="stable")
        self.rows, self.values = row[order], impacts[order]
        self.held, self.at = np.unique(terms[order], return_index=True)
        self.most = np.maximum.reduceat(self.values, self.at) if len(order) else self.values
        self.at = np.append(self.at, len(order))

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Bucket:
        order = np.argsort(-batch.column("length").to_numpy(), kind="stable")
        batch = batch.take(pa.array(order))
        starts, terms = _flat(batch.column("terms"))
        impacts = _flat(batch.column("impacts"))[1].astype(np.int64)
        return cls(batch.column("doc_id").to_pylist(), batch.column("length").to_numpy(), starts, terms, impacts)

    def best(self, terms: np.ndarray, weight: np.ndarray, length: float, bound: int) -> list[tuple[int, int]]:
        """(row, score) of every row that scores ``bound`` or more, a positive number."""
        # Lengths are rounded: the slack keeps rows at the bound.
        rows = int(np.searchsorted(-self.length, -bound / (length * (1 + 1e-6)), side="right"))
        if not rows:
            return []
        place = np.searchsorted(self.held, terms)
        here = (place < len(self.held)) & (self.held[np.minimum(place, len(self.held) - 1)] == terms)
        place, weight_here = place[here], weight[here]
        most = weight_here * self.most[place]
        order = np.argsort(most)
        sums = np.cumsum(most[order])
        # Terms whose bounds, smallest first, sum to less than the bound can't reach it without the others.
        rest = int(np.searchsorted(sums, bound))
        if rest == len(order):
            return []
        below = int(sums[rest - 1]) if rest else 0
        needed = order[rest:]
        parts = [slice(self.at[p], self.at[p + 1]) for p in place[needed]]
        row = np.concatenate([self.rows[s] for s in parts])
        value = np.concatenate([self.values[s] * w for s, w in zip(parts, weight_here[needed], strict=True)])
        # Whole numbers below 2**53: exact as doubles.
        known = np.bincount(row[row < rows], value[row < rows], minlength=rows)
        survivors = np.flatnonzero((known > 0) & (known + below >= bound))
        dense = np.zeros(int(max(terms.max(), self.held[-1])) + 1, dtype=np.int64)
        dense[terms] = weight
        found = []
        for r in survivors.tolist():
            own = slice(self.starts[r], self.starts[r + 1])
            score = int((dense[self.terms[own]] * self.impacts[own]).sum())
            if score >= bound:
                found.append((r, score))
        return found


def _order(found: tuple) -> tuple:
    score, doc_id = found
    return -score, doc_id is None, 0 if doc_id is None else doc_id


def search(vectors: DataFrame, queries: list[Counter], weight: np.ndarray, bounds: list[int], k: int) -> DataFrame:
    """(query, doc_id, score): of each partition at most k rows per query, all that can be among the k best."""
    kind = vectors.schema["doc_id"].dataType.simpleString()
    parts = []
    for q in queries:
        terms = np.array(sorted(q), dtype=np.int64)
        own = weight[terms] * np.array([q[t] for t in terms.tolist()], dtype=np.int64)
        # The query's share of the weights: count * sqrt(weight).
        length = math.sqrt(sum(q[t] ** 2 * int(weight[t]) for t in terms.tolist()))
        parts.append((terms[own > 0], own[own > 0], length))
    held = vectors.sparkSession.sparkContext.broadcast((parts, bounds))

    def task(batches):
        parts, bounds = held.value
        bounds, best = list(bounds), [[] for _ in parts]
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                bucket = Bucket.of(batch.slice(at, BUCKET))
                for q, (terms, own, length) in enumerate(parts):
                    found = bucket.best(terms, own, length, bounds[q]) if len(terms) else []
                    if found:
                        best[q] = sorted(best[q] + [(score, bucket.ids[r]) for r, score in found], key=_order)[:k]
                        if len(best[q]) == k:
                            bounds[q] = max(bounds[q], best[q][-1][0])
        rows = [(q, doc_id, score) for q, own in enumerate(best) for score, doc_id in own]
        if rows:
            q, doc_id, score = zip(*rows, strict=True)
            ids = pa.array(doc_id, id_type)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), ids, pa.array(score, pa.int64())], names=["query", "doc_id", "score"])

    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    return vectors.mapInArrow(task, f"query int, doc_id {kind}, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best_first = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def _ranked_block(docs: DataFrame, texts: list[str | None], k: int) -> DataFrame:
    """(query, rank, doc_id, score) for a block of query texts, numbered from 0."""
    split = [terms_of(t) for t in texts]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*split)))}
    queries = [Counter(vocabulary[t] for t in terms) for terms in split]
    table = materialize(term_counts(docs, vocabulary), "term-counts")
    weight, n_docs, n_terms = weights(table, len(vocabulary))
    vectors = impact_vectors(table, weight, n_docs, max(n_terms, 1))
    vectors = vectors.withColumn("row", F.monotonically_increasing_id())
    # Rows of equal length are dealt by their number.
    vectors = vectors.repartitionByRange(F.col("length").desc(), "row").sortWithinPartitions(F.col("length").desc(), "row")
    vectors = materialize(vectors.select("*", F.spark_partition_id().alias("part")), "impact-vectors").drop("row")
    first = search(vectors.where("part = 0").drop("part"), queries, weight, [1] * len(queries), k)
    bounds = [1] * len(queries)
    # At most k rows per query of the block and partition read.
    for query, bound in _ranked(first, k).where(F.col("rank") == k).select("query", "score").collect():
        bounds[query] = bound
    return _ranked(search(vectors.drop("part"), queries, weight, bounds, k), k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, those above 0."""
    kinds = [docs.schema["doc_id"].dataType, items.schema["item_id"].dataType]
    spark = docs.sparkSession
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("s")).first().s
    blocks = 1 if size <= BLOCK_BYTES else -(-2 * size // BLOCK_BYTES)
    numbered = items.select("item_id", "text")
    if blocks > 1:
        numbered = materialize(numbered.withColumn("block", F.expr(f"pmod(xxhash64(item_id, text), {blocks})")), "items")
    found = []
    for block in range(blocks):
        own = (numbered.where(F.col("block") == block) if blocks > 1 else numbered).select("item_id", "text").collect()
        if own and any(terms_of(r.text) for r in own):
            names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(own)], f"query int, item_id {kinds[1].simpleString()}")
            ranked = _ranked_block(docs, [r.text for r in own], k)
            found.append(ranked.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {kinds[1].simpleString()}, rank int, doc_id {kinds[0].simpleString()}, score long")
    return reduce(DataFrame.unionAll, found)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    return rank_documents(docs, common.read(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), q AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark
), size AS (
  SELECT count(*) FILTER (WHERE len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d
), asked AS (
  SELECT i, term, count(*) AS times FROM (SELECT i, unnest(t) AS term FROM q) GROUP BY i, term
), counts AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, size GROUP BY term, n_docs
), impact AS (
  SELECT r, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(t) * n_docs) // n_terms)) AS x
  FROM counts JOIN d USING (r), size
), scored AS (
  SELECT i, r, sum(times * w * x)::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN impact USING (term) GROUP BY i, r
), ranked AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored JOIN q USING (i) JOIN d USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
