"""SimHash near-dedup by a binary trie self-join.

A text's fingerprint takes one bit per position from the XXH64 hashes (seed 42)
of its word shingles: 1 where more than half of them, repeats included, have it.
Fingerprints link at ``max_bits`` differing bits or fewer.

Equal fingerprints are one node, so copies never meet in a join. Each distinct
fingerprint goes to one shard per block of bits (``max_bits`` + 1 blocks): linked
fingerprints agree in at least one whole block, and there they share a shard.
A shard is a binary trie over its fingerprints, sorted, with a node as a range.
Pairs of nodes go down together from (root, root), add up differing bits, and
are dropped once the sum exceeds ``max_bits``; small pairs of nodes are compared
outright. A task returns a spanning forest of its links, never all pairs.
Shards with more than ``shard_rows`` fingerprints are dealt into slots, one task
per pair of slots, which join two tries. At most blocks * 2**16 shards exist,
so the list of large ones may be broadcast.

Defined cases: null or empty text (no words) has fingerprint zero, linked like any
other; fewer words than a shingle are one shingle. A repeated doc_id is one node
per distinct fingerprint; a null doc_id is never the smallest of a component
unless alone, when component_id is null. Other columns pass through.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ovenplan.llm import common
from ovenplan.session import materialize

SHINGLE = 3
MAX_BITS = 3
SHARD_ROWS = 50_000
HOT_FINGERPRINTS = 10_000
#: Node pairs handled at once, and the pair size below which fingerprints are compared outright.
FRONTIER = 1 << 18
LEAF_PAIRS = 64

_seeded = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, as an unsigned integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return _seeded(b" ".join(words))
    grams = zip(*(words[i:] for i in range(shingle)), strict=False)
    hashes = np.fromiter(map(_seeded, map(b" ".join, grams)), dtype="<u8", count=len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, column: str = "_fp") -> DataFrame:
    """``docs`` with its fingerprints as a signed long."""
    names = docs.columns

    def add(batch):
        found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
        return {n: batch.column(n) for n in names} | {column: np.array(found, dtype=np.uint64).view(np.int64)}

    return common.map_batches(docs, add, T.StructType([*docs.schema.fields]).add(column, "long"))


def _shards(nodes: DataFrame, blocks: int, shard_rows: int) -> DataFrame:
    """(block, value, a, b, slot, fp): the tasks (block, value, a, b) of each fingerprint."""
    width = 64 // blocks
    mask = (1 << width) - 1
    placed = nodes.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask)).alias("value"))
                    for i in range(blocks)
                ]
            )
        ).alias("s"),
        "fp",
    ).select("s.block", "s.value", "fp")
    sizes = placed.groupBy("block", "value").agg(F.count("*").alias("n")).filter(F.col("n") > shard_rows)
    sizes = sizes.select("block", "value", F.ceil(F.col("n") / shard_rows).cast("int").alias("slots"))
    placed = placed.join(F.broadcast(sizes), ["block", "value"], "left").withColumn(
        "slot", F.coalesce(F.pmod(F.xxhash64("fp"), F.col("slots")).cast("int"), F.lit(0))
    )
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slots") - 1, F.lit(0))))
    placed = placed.select("block", "value", "slot", "fp", other.alias("o"))
    return placed.select(
        "block", "value", F.least("slot", "o").alias("a"), F.greatest("slot", "o").alias("b"), "slot", "fp"
    )


def trie_links(left: np.ndarray, right: np.ndarray, same: bool, max_bits: int):
    """Blocks of index pairs (into ``left``, ``right``) that differ in ``max_bits`` bits or fewer.

    ``left`` and ``right`` are sorted unsigned fingerprints, each the leaves of a
    binary trie; ``same`` tells that they are one trie, joined with itself.
    """
    todo = [(np.array([[0, len(left), 0, len(right), 0]], dtype=np.int64), 63)]
    while todo:
        pairs, bit = todo.pop()
        if len(pairs) > FRONTIER:
            todo += [(pairs[FRONTIER:], bit), (pairs[:FRONTIER], bit)]
            continue
        n, m = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        small = (n * m <= LEAF_PAIRS) | (bit < 0)
        if small.any():
            yield from _compare(left, right, pairs[small], same, max_bits)
        pairs = pairs[~small]
        if not len(pairs):
            continue
        # Children of a node: where its range turns from bit 0 to bit 1.
        cut_a = _turn(left, pairs[:, 0], pairs[:, 1], bit)
        cut_b = _turn(right, pairs[:, 2], pairs[:, 3], bit)
        a0, a1, b0, b1, err = pairs.T
        down = [
            np.stack([a0, cut_a, b0, cut_b, err], 1),
            np.stack([cut_a, a1, cut_b, b1, err], 1),
            np.stack([a0, cut_a, cut_b, b1, err + 1], 1),
        ]
        mirror = np.stack([cut_a, a1, b0, cut_b, err + 1], 1)
        # Of a node paired with itself, (child 1, child 0) is (child 0, child 1) again.
        down.append(mirror[(a0 != b0) | (a1 != b1)] if same else mirror)
        pairs = np.concatenate(down)
        pairs = pairs[(pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2]) & (pairs[:, 4] <= max_bits)]
        if len(pairs):
            todo.append((pairs, bit - 1))


def _turn(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    first = values[lo] >> np.uint64(bit + 1) << np.uint64(bit + 1) if bit < 63 else np.zeros(len(lo), np.uint64)
    return np.clip(np.searchsorted(values, first | np.uint64(1 << bit)), lo, hi)


def _compare(left, right, pairs, same, max_bits):
    n, m = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
    many = np.cumsum(n * m)
    start = 0
    while start < len(pairs):
        base = many[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(many, base + (1 << 22), side="right")))
        size = (n * m)[start:end]
        which = np.repeat(np.arange(start, end), size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        i, j = pairs[which, 0] + k // m[which], pairs[which, 2] + k % m[which]
        near = np.bitwise_count(left[i] ^ right[j]) <= max_bits
        if same:
            near &= i < j
        yield i[near], j[near]
        start = end


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(u, v): links whose components are those of all pairs of near fingerprints ``fp``."""
    tasks = _shards(nodes, max_bits + 1, shard_rows)
    keys = ["block", "value", "a", "b"]

    def shard(key, fps, slots):
        """Spanning forest of one shard's links."""
        order = np.argsort(fps)
        fps, slots = fps[order], slots[order]
        same = key[2] == key[3]
        if same:
            left = right = np.arange(len(fps))
        else:
            left, right = np.flatnonzero(slots == key[2]), np.flatnonzero(slots == key[3])
        root = np.arange(len(fps))
        for i, j in trie_links(fps[left], fps[right], same, max_bits):
            root = common.local_roots(len(fps), left[i], right[j], root)
        member = np.flatnonzero(root != np.arange(len(fps)))
        return fps[member].view(np.int64), fps[root[member]].view(np.int64)

    def run(batches):
        """Shards follow one another in a sorted partition; one is held at a time."""
        held, at = [], None
        for batch in batches:
            columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            slots = batch.column("slot").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
            edges = [0, *cuts.tolist(), len(fps)]
            us, vs = [], []
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                key = tuple(columns[:, lo])
                if key != at:
                    _flush(held, at, us, vs)
                    held, at = [], key
                held.append((fps[lo:hi], slots[lo:hi]))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
        us, vs = [], []
        _flush(held, at, us, vs)
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    def _flush(held, key, us, vs):
        if sum(len(f) for f, _ in held) > 1:
            u, v = shard(key, np.concatenate([f for f, _ in held]), np.concatenate([s for _, s in held]))
            if len(u):
                us.append(u)
                vs.append(v)

    placed = tasks.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "u long, v long")


def fingerprint_classes(rows: DataFrame, max_bits: int, shard_rows: int) -> DataFrame:
    """(fp, root, least, n_rows, n_least) of the distinct fingerprints of ``rows`` (doc_id, fp).

    ``least`` is the smallest doc_id with the fingerprint, on ``n_least`` of its rows.
    """
    each = rows.groupBy("fp", "doc_id").agg(F.count("*").alias("n"))
    classes = each.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")).alias("m"), F.sum("n").alias("n_rows")
    )
    classes = classes.select("fp", F.col("m.doc_id").alias("least"), F.col("m.n").alias("n_least"), "n_rows")
    classes = materialize(classes, "simhash-classes")
    links = fingerprint_links(classes.select("fp"), max_bits, shard_rows)
    member = common.connected_components(links, "simhash-links").withColumnRenamed("node", "fp")
    return materialize(
        classes.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-members"
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(doc_id, fp, component_id, n_rows): the class of each row; n_rows counts the rows of its fingerprint."""
    rows = with_fingerprint(docs.select("doc_id", "text"), shingle, "fp").select("doc_id", "fp")
    rows = materialize(rows, "simhash")
    classes = fingerprint_classes(rows, max_bits, shard_rows)
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(classes.join(least, "root").select("fp", "component_id", "n_rows"), "simhash-named")
    hot = named.orderBy(F.desc("n_rows"), "fp").limit(HOT_FINGERPRINTS)
    return common.salted_join(rows, named, "fp", hot, F.xxhash64("doc_id"))


def one_of_each_group(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id.

    Of rows that share both that doc_id and the fingerprint any one stays.
    """
    rows = materialize(with_fingerprint(docs.select("doc_id", "text"), shingle, "fp").select("doc_id", "fp"), "simhash")
    classes = fingerprint_classes(rows, max_bits, shard_rows)
    chosen = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp", "n_least")).alias("m")
    chosen = classes.groupBy("root").agg(chosen).select(
        F.col("m.fp").alias("_fp"), F.col("m.least").alias("_least"), (F.col("m.n_least") > 1).alias("_many")
    )
    chosen = materialize(chosen, "simhash-chosen")
    hot = rows.groupBy(F.col("fp").alias("_fp")).count().orderBy(F.desc("count"), "_fp").limit(HOT_FINGERPRINTS)
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = with_fingerprint(docs.select("doc_id", "text", whole), shingle).select("doc_id", "row", "_fp")
    kept = common.salted_join(keyed, chosen, "_fp", hot, F.xxhash64("doc_id"))
    kept = kept.filter(F.col("_many").isNotNull() & F.col("doc_id").eqNullSafe(F.col("_least")))
    one = kept.filter("not _many").unionAll(kept.filter("_many").dropDuplicates(["doc_id", "_fp"]))
    return one.select("row.*")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(common.read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
