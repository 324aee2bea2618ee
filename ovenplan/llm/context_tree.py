"""LM scoring by context-tree weighting over bytes.

A text is its lower-cased words, each followed by a space, and an end byte. Each byte
is eight binary decisions; a decision's context is the bits of its byte so far and
the ``DEPTH`` bytes before, of which a node at depth d sees the last d. Contexts cross words;
before a text stand end bytes. Every node estimates its next bit
by Krichevsky-Trofimov, and weighs its estimate against those of the deeper nodes:

    Pw = 1/2 Pe + 1/2 product of the children's Pw,   weight of its own = 1/2 Pe / Pw

where Pe is the KT probability of all bits counted at the node, over all training text. Of a
decision's nodes the deepest one seen takes the weight that is left, so the probabilities of a
decision always add up to one. No node is left out.

A gram is a byte with its context, packed into a long, the nearest byte of the context first:
the grams below a node of the tree share a prefix. Tasks count the grams of their texts, those
to be scored only with count 0. The grams that share the nearest ``TOP`` bytes meet in one bucket,
where the deeper levels are worked out; of these bytes there are at most 256**TOP, whatever the
input. The levels above are worked out for each of the 255 bit prefixes apart, which no node
joins. Buckets, counts and log probabilities travel packed, a row per bucket and task.

A text's code length is the sum over its grams. The ``CACHE`` grams with most places, found by a
count of grams by number of places, are broadcast; all others are asked for by bucket.

The unigram base counts whole words in the same training text. The counts of the
``HOT_TOKENS`` most frequent words are broadcast (words over ``LONG_WORD`` bytes by their digest);
all others are joined.

Defined cases: null or empty text is the end alone. A null doc_id is not held out. With
no training text every bit has probability 1/2 and base_score is 0. Rows with
equal doc_id and text get equal scores. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ovenplan.llm import common
from ovenplan.llm.lang_id import held_out
from ovenplan.session import Scratch, remove, shared_dir, write_once

DEPTH = 7
TOP = 3
CACHE = 1 << 21
HOT_TOKENS = 131_072
LONG_WORD = 64
#: Words that a task counts before it passes them on; grams likewise, and places looked at together.
FLUSH = 250_000
FLUSH_GRAMS = 1_000_000
PLACES = 1 << 20
BLOCK_ROWS = 2000
LOOKED_UP = 1 << 16
#: Buckets for each shuffle partition.
BUCKETS = 2
END = b"\n"
PACKED = "binary"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def stream_of(words: list[bytes]) -> bytes:
    return b" ".join([*words, END])


def word_lists(texts: pa.Array) -> pa.ListArray:
    """``words_of`` each text, as strings."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy())
    # White space at the ends of a text leaves an empty string there.
    full = pc.not_equal(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[np.concatenate([[0], ends])]
    return pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(full))


def coded_words(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(names, codes, owners): the distinct words, and of each word its place among them and the number of its list."""
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())


# ---- grams ---------------------------------------------------------------------------------------


def grams_of(streams: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, owners): each byte of the streams with its context, and the number of its stream; ``PLACES`` at a time."""
    before = END * depth
    data = np.frombuffer(b"".join(before + s for s in streams), dtype=np.uint8)
    sizes = np.array([len(s) for s in streams], dtype=np.int64) + depth
    starts = np.cumsum(sizes) - sizes
    inner = np.ones(len(data), dtype=bool)
    for k in range(depth):
        inner[starts + k] = False
    owner = np.repeat(np.arange(len(streams)), sizes)
    for a in range(depth, len(data), PLACES):
        part = data[a - depth : a + PLACES].astype(np.int64)
        n = len(part) - depth
        gram = np.zeros(n, dtype=np.int64)
        for k in range(1, depth + 1):
            gram = (gram << 8) | part[depth - k : depth - k + n]
        gram = (gram << 8) | part[depth:]
        at = np.flatnonzero(inner[a : a + n])
        yield gram[at], owner[a : a + n][at]


def bucket_of(prefix: np.ndarray, buckets: int) -> np.ndarray:
    mixed = prefix.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def by_bucket(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The order of the buckets; within one as given. Numbers of 16 bits are sorted by digits, in a fraction of the time."""
    return np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")


def pack(values: np.ndarray) -> bytes:
    """Eight-byte values, first bytes first, compressed: sorted keys and small counts take about a byte or two."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def merged(keys: list[np.ndarray], *values: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values."""
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    sums = (np.add.reduceat(np.concatenate(v)[order], first) if len(key) else np.concatenate(v) for v in values)
    return (key[first], *sums)


def slices(sorted_numbers: np.ndarray) -> Iterator[tuple[int, slice]]:
    if len(sorted_numbers):
        cuts = np.flatnonzero(np.diff(sorted_numbers)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(sorted_numbers)], strict=True):
            yield int(sorted_numbers[a]), slice(a, b)


def gram_pieces(docs: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(bucket, keys, n, times) of the grams of ``docs`` (text, learned), a row per task and bucket: n in learned rows, times in all."""
    cut = 8 * (depth - min(TOP, depth)) + 8

    def task(batches):
        parts, size = [], 0

        def out(key, n, times):
            bucket = bucket_of(key >> cut, buckets)
            order = by_bucket(bucket, buckets)
            for number, at in slices(bucket[order]):
                own = order[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), *(pa.array([pack(v[own])], pa.binary()) for v in (key, n, times))],
                    ["bucket", "keys", "n", "times"],
                )

        for learned, streams in _streams(batches):
            for grams, _ in grams_of(streams, depth):
                key, times = np.unique(grams, return_counts=True)
                parts.append((key, times if learned else np.zeros_like(times), times))
                size += len(key)
                if size > 2 * FLUSH_GRAMS:
                    parts = [merged(*zip(*parts, strict=True))]
                    size = len(parts[0][0])
                    if size > FLUSH_GRAMS:
                        yield from out(*parts.pop())
                        size = 0
        if parts:
            yield from out(*merged(*zip(*parts, strict=True)))

    return docs.select("text", "learned").mapInArrow(task, f"bucket int, keys {PACKED}, n {PACKED}, times {PACKED}")


def _streams(batches) -> Iterator[tuple[bool, list[bytes]]]:
    """Learned and other texts, each about ``PLACES`` bytes at a time or one longer text."""
    held: dict[bool, list[bytes]] = {True: [], False: []}
    sizes = {True: 0, False: 0}
    for batch in batches:
        for text, learned in zip(batch.column("text"), batch.column("learned").to_pylist(), strict=True):
            stream = stream_of(words_of(text.as_py()))
            held[learned].append(stream)
            sizes[learned] += len(stream)
            if sizes[learned] >= PLACES:
                yield learned, held[learned]
                held[learned], sizes[learned] = [], 0
    for learned, streams in held.items():
        if streams:
            yield learned, streams


# ---- the tree ------------------------------------------------------------------------------------

_WHOLE = np.array([math.lgamma(i + 1) for i in range(4096)])
_HALF = np.array([math.lgamma(i + 0.5) for i in range(4096)])


def _log_gamma(table: np.ndarray, add: float, n: np.ndarray) -> np.ndarray:
    """log Gamma(n + add) of whole n: from the table, or by Stirling's series."""
    out = table[np.minimum(n, len(table) - 1)]
    far = np.flatnonzero(n >= len(table))
    x = n[far] + add
    out[far] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log KT probability of n0 zeros and n1 ones."""
    return _log_gamma(_HALF, 0.5, n0) + _log_gamma(_HALF, 0.5, n1) - _log_gamma(_WHOLE, 1, n0 + n1) - math.log(math.pi)


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    # Counts are whole below 2**53.
    return np.bincount(at, values, n).astype(values.dtype, copy=False)


class Levels:
    """The nodes of some levels for one place of the byte's bits, from the deepest level up.

    ``key``: contexts of the deepest level, then the ``bits`` bits so far. ``w``: log Pw of the nodes
    of the deepest level, or none if their own estimate is all they have.
    """

    def __init__(self, key: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None, bits: int, levels: int):
        self.rows = []
        for level in range(levels):
            own = log_kt(n0, n1)
            w = own if below is None else np.logaddexp(own, below) - math.log(2)
            up = None
            if level + 1 < levels:
                parents, up = np.unique(((key >> (bits + 8)) << bits) | (key & ((1 << bits) - 1)), return_inverse=True)
            self.rows.append((n0, n1, own, below, up))
            if up is not None:
                n0, n1, below = (_sums(up, v, len(parents)) for v in (n0, n1, w))
                key = parents
        #: Of the topmost level.
        self.key, self.n0, self.n1, self.w = key, n0, n1, w

    def down(self, put: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(p, put, rest) of the deepest level: probability of a 1 if the node is the deepest one, and what it hands down.

        Given are, of the topmost level, what the nodes above put into the mixture and the weight that they leave. A node
        not seen in training takes over the probability of the one above.
        """
        p = None
        for n0, n1, own, below, up in reversed(self.rows):
            if p is not None:
                seen = n0 + n1 > 0
                put, rest = np.where(seen, put[up], p[up]), np.where(seen, rest[up], 0.0)
            p = put + rest * (n1 + 0.5) / (n0 + n1 + 1)
            if below is not None:
                odds = np.clip(below - own, -700, 700)
                put, rest = put + (p - put) / (1 + np.exp(odds)), rest / (1 + np.exp(-odds))
        return p, put, rest


def _byte_trees(key: np.ndarray, n: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, Levels]]:
    """(j, bit, place, levels from ``TOP`` down) for each bit j of the grams' bytes; place: the deepest node of each gram."""
    top = min(TOP, depth)
    for j in range(8):
        bit = (key >> (7 - j)) & 1
        # Grams are sorted, so the nodes are as well.
        node = key >> (8 - j)
        first = np.concatenate([[True], node[1:] != node[:-1]])
        place = np.cumsum(first) - 1
        start = np.flatnonzero(first)
        n0, n1 = np.add.reduceat(n * (1 - bit), start), np.add.reduceat(n * bit, start)
        yield j, bit, place, Levels(node[start], n0, n1, None, j, depth - top + 1)


def _marked(key: np.ndarray, bits: int) -> np.ndarray:
    """Context, then a 1 and the bits so far in one byte."""
    return ((key >> bits) << 8) | (1 << bits) | (key & ((1 << bits) - 1))


def tree_grams(pieces: DataFrame, depth: int) -> DataFrame:
    """(bucket, keys, n, times, nodes): the grams of each bucket, and its nodes at depth ``TOP`` with counts and log Pw."""

    def task(batches):
        bucket, parts, size = None, [], 0

        def out():
            key, n, times = merged(*zip(*parts, strict=True))
            nodes = [(_marked(t.key, j), t.n0, t.n1, t.w) for j, _, _, t in _byte_trees(key, n, depth)]
            nodes = [np.concatenate(v) for v in zip(*nodes, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), *(pa.array([pack(v)], pa.binary()) for v in (key, n, times, *nodes))],
                ["bucket", "keys", "n", "times", "nodes", "n0", "n1", "w"],
            )

        for batch in batches:
            for r in range(batch.num_rows):
                number = batch.column("bucket")[r].as_py()
                if parts and number != bucket:
                    yield out()
                    parts, size = [], 0
                bucket = number
                parts.append(tuple(unpack(batch.column(c)[r].as_buffer()) for c in ("keys", "n", "times")))
                size += len(parts[-1][0])
                if size > 2 * FLUSH_GRAMS + len(parts[0][0]):
                    parts = [merged(*zip(*parts, strict=True))]
                    size = len(parts[0][0])
        if parts:
            yield out()

    ordered = pieces.repartition("bucket").sortWithinPartitions("bucket")
    names = ("keys", "n", "times", "nodes", "n0", "n1", "w")
    return ordered.mapInArrow(task, "bucket int, " + ", ".join(f"{c} {PACKED}" for c in names))


def top_levels(grams: DataFrame, depth: int) -> DataFrame:
    """(bucket, key, put, rest): what the levels above ``TOP`` put into the mixture of each node there, and leave."""
    top = min(TOP, depth)

    def spread(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                key, n0, n1 = (unpack(batch.column(c)[r].as_buffer()) for c in ("nodes", "n0", "n1"))
                w = unpack(batch.column("w")[r].as_buffer(), np.float64)
                bucket = np.full(len(key), batch.column("bucket")[r].as_py(), dtype=np.int32)
                columns = [bucket, (key & 255).astype(np.int32), key >> 8, n0, n1, w]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "bits", "context", "n0", "n1", "w"])

    def above(table: pa.Table) -> pa.Table:
        bits, context, n0, n1, w = (table.column(c).to_numpy() for c in ("bits", "context", "n0", "n1", "w"))
        parents, up = np.unique(context >> 8, return_inverse=True)
        tree = Levels(parents, *(_sums(up, v, len(parents)) for v in (n0, n1, w)), 0, top)
        seen = tree.n0 + tree.n1 > 0
        p, put, rest = tree.down(np.where(seen, 0.0, 0.5), np.where(seen, 1.0, 0.0))
        seen = n0 + n1 > 0
        key = (context << 8) | bits
        columns = [table.column("bucket"), key, np.where(seen, put[up], p[up]), np.where(seen, rest[up], 0.0)]
        return pa.table(columns, names=["bucket", "key", "put", "rest"])

    rows = grams.select("bucket", "nodes", "n0", "n1", "w").mapInArrow(
        spread, "bucket int, bits int, context long, n0 long, n1 long, w double"
    )
    return rows.groupBy("bits").applyInArrow(above, "bucket int, key long, put double, rest double")


def gram_bits(grams: DataFrame, depth: int) -> DataFrame:
    """(bucket, keys, bits, times): log2 probability of the byte of each gram, seen in training or not."""
    nodes = top_levels(grams, depth).groupBy("bucket").agg(F.collect_list(F.struct("key", "put", "rest")).alias("given"))

    def task(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                key, n = (unpack(batch.column(c)[r].as_buffer()) for c in ("keys", "n"))
                given = batch.column("given")[r].values
                at, put, rest = (given.field(c).to_numpy(zero_copy_only=False) for c in ("key", "put", "rest"))
                order = np.argsort(at)
                at, put, rest = at[order], put[order], rest[order]
                total = np.zeros(len(key))
                for j, bit, place, tree in _byte_trees(key, n, depth):
                    own = np.searchsorted(at, _marked(tree.key, j))
                    p = tree.down(put[own], rest[own])[0][place]
                    total += np.log2(np.where(bit == 1, p, 1 - p))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("bucket").slice(r, 1), batch.column("keys").slice(r, 1), pa.array([pack(total)], pa.binary()), batch.column("times").slice(r, 1)],
                    ["bucket", "keys", "bits", "times"],
                )

    both = grams.select("bucket", "keys", "n", "times").join(nodes, "bucket")
    return both.mapInArrow(task, f"bucket int, keys {PACKED}, bits {PACKED}, times {PACKED}")


def frequent_grams(bits: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and bits of the grams with most places, ``most`` at most, about in the order of their places."""

    def class_of(times: pa.Scalar) -> np.ndarray:
        return (8 * np.log2(unpack(times.as_buffer()))).astype(np.int64)

    def classes(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                of = class_of(batch.column("times")[r])
                own, n = np.unique(of, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n)], ["class", "n"])

    rows = bits.select("times").mapInArrow(classes, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    least, total = 513, 0
    for row in sorted(rows, reverse=True):
        total += row.n
        if total > most:
            break
        least = row["class"]

    def chosen(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                of = class_of(batch.column("times")[r])
                own = of >= least
                key = unpack(batch.column("keys")[r].as_buffer())[own]
                value = unpack(batch.column("bits")[r].as_buffer(), np.float64)[own]
                columns = [pa.array([v.tobytes()]) for v in (key, value, of[own].astype(np.uint16))]
                yield pa.RecordBatch.from_arrays(columns, ["keys", "bits", "of"])

    table = bits.mapInArrow(chosen, "keys binary, bits binary, of binary").toArrow()
    keys, values, of = (
        np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=kind)
        for c, kind in (("keys", np.int64), ("bits", np.float64), ("of", np.uint16))
    )
    order = np.argsort(of, kind="stable")[::-1]
    return keys[order], values[order]


def _slots(keys: np.ndarray, turn: int, bits: int) -> np.ndarray:
    mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93 + 2 * turn)
    mixed >>= np.uint64(64 - bits)
    return mixed.view(np.int64)


def hashed(keys: np.ndarray) -> list[np.ndarray]:
    """Places of distinct keys by hash; what shares its slot in one table with a key before it is in a later one."""
    tables, left = [], np.arange(len(keys), dtype=np.int32)
    while len(left):
        bits = (2 * len(left) - 1).bit_length()
        at = _slots(keys[left], len(tables), bits)
        tables.append(np.zeros(1 << bits, dtype=np.int32))
        tables[-1][at[::-1]] = left[::-1]
        left = left[tables[-1][at] != left]
    return tables


def look_up(tables: list[np.ndarray], keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, missing): the values of ``asked``, 0 where ``keys`` lacks it, and the places where it does."""
    found, left = np.zeros(len(asked)), np.arange(len(asked))
    for turn, table in enumerate(tables):
        own = asked[left]
        at = table[_slots(own, turn, len(table).bit_length() - 1)]
        same = keys[at] == own
        found[left] = np.where(same, values[at], 0.0)
        left = left[~same]
    return found, left


def answered(asked: DataFrame, bits: DataFrame) -> DataFrame:
    """(block, at, bits): of ``asked`` (block, bucket, owners, keys), the sums of each owner's grams."""
    none = F.lit(None).cast("binary")
    table = bits.select("bucket", F.lit(None).cast("long").alias("block"), none.alias("owners"), "keys", "bits")
    rows = table.unionAll(asked.select("bucket", "block", "owners", "keys", none.alias("bits")))

    def task(batches):
        held: dict[int, list] = {}
        size, key, value = 0, None, None

        def out():
            for block, parts in held.items():
                packed = (pa.array([pack(v)], pa.binary()) for v in merged(*zip(*parts, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *packed], ["block", "owners", "bits"])
            held.clear()

        for batch in batches:
            for r in range(batch.num_rows):
                block = batch.column("block")[r].as_py()
                own = unpack(batch.column("keys")[r].as_buffer())
                if block is None:
                    key, value = own, unpack(batch.column("bits")[r].as_buffer(), np.float64)
                    continue
                owners = unpack(batch.column("owners")[r].as_buffer())
                parts = held.setdefault(block, [])
                parts.append(merged([owners], [value[np.searchsorted(key, own)]]))
                size += len(parts[-1][0])
                if size > 2 * FLUSH_GRAMS:
                    yield from out()
                    size = 0
        yield from out()

    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first())
    found = ordered.select("bucket", "block", "owners", "keys", "bits").mapInArrow(task, f"block long, owners {PACKED}, bits {PACKED}")
    # A block has as many answers as places at most.
    blocks = found.groupBy("block").agg(F.collect_list(F.struct("owners", "bits")).alias("found"))

    def together(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                parts = batch.column("found")[r].as_py()
                at, total = merged([unpack(x["owners"]) for x in parts], [unpack(x["bits"], np.float64) for x in parts])
                block = np.full(len(at), batch.column("block")[r].as_py(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(at), pa.array(total)], ["block", "at", "more_bits"])

    return blocks.mapInArrow(together, "block long, at long, more_bits double")


# ---- scores --------------------------------------------------------------------------------------


def blocks_of(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows: ``PLACES`` bytes of text and one text more at most, and ``BLOCK_ROWS`` rows."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PLACES)) + 1
        j = min(j, i + BLOCK_ROWS, len(texts))
        yield i, j
        i = j


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n, times) of the words of ``docs`` (text, learned): in the learned rows, and in all."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(parts).group_by("token", use_threads=False).aggregate([("n", "sum"), ("times", "sum")])
        return pa.table([found["token"], found["n_sum"], found["times_sum"]], names=["token", "n", "times"]).combine_chunks()

    def task(batches):
        parts, size = [], 0
        for batch in batches:
            learned_rows = batch.column("learned").to_numpy(zero_copy_only=False).astype(bool)
            for i, j in blocks_of(batch.column("text")):
                names, codes, owners = coded_words(word_lists(batch.column("text").slice(i, j - i)))
                n, times = (np.bincount(c, minlength=len(names)) for c in (codes[learned_rows[i:j][owners]], codes))
                parts.append(pa.table([names.cast(pa.string()), n, times], names=["token", "n", "times"]))
                size += len(names)
                if size > 2 * FLUSH:
                    parts = [summed(parts)]
                    size = len(parts[0])
                    if size > FLUSH:
                        yield from parts[0].to_batches()
                        parts, size = [], 0
        if parts:
            yield from summed(parts).to_batches()
        # The worker goes on with other tasks, whose memory is not Arrow's.
        parts.clear()
        pa.default_memory_pool().release_unused()

    parts = docs.select("text", "learned").mapInArrow(task, "token string, n long, times long")
    return parts.groupBy("token").agg(F.sum("n").alias("n"), F.sum("times").alias("times"))


def _names(words: pa.Array) -> list[str]:
    """The words, of the long ones their digests (after a space, which no word has)."""
    names = words.to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(pc.binary_length(words).to_numpy() > LONG_WORD):
        names[i] = " " + hashlib.sha256(names[i].encode()).hexdigest()
    return names.tolist()


def score_documents(docs: DataFrame, train: Column, depth: int = DEPTH) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row.

    ``train`` tells the rows of ``docs`` (doc_id, text) that are learned from.
    """
    spark = docs.sparkSession
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = min(TOP, depth)
    marked = docs.select("text", F.coalesce(train, F.lit(False)).alias("learned"))
    docs = docs.select("doc_id", "text")
    scratch = Scratch(spark, "lm-scoring")
    counts = scratch.write(token_counts(marked), "token-counts")
    ends = marked.filter("learned").count()
    words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n, v = words.n + ends, words.v + (ends > 0)
    # The shuffle files of the pieces go with the write: they are as much as the table.
    folder = shared_dir(spark, "tree-grams")
    grams = write_once(tree_grams(gram_pieces(marked, depth, buckets), depth), folder)
    bits = scratch.write(gram_bits(grams, depth), "tree-bits")
    remove(spark, folder)
    name = F.when(F.octet_length("token") <= LONG_WORD, F.col("token")).otherwise(F.concat(F.lit(" "), F.sha2(F.col("token").cast("binary"), 256)))
    hot = counts.orderBy(F.desc("times"), "token").limit(HOT_TOKENS).select(name.alias("name"), "n")
    # Whether a word is known, and its log10 probability in the base.
    known_words = {r.name: (int(r.n > 0), math.log10((r.n + 1) / (n + v + 1))) for r in hot.collect()}
    keys, values = frequent_grams(bits, CACHE)
    sent = spark.sparkContext.broadcast((known_words, hashed(keys), keys, values))

    def scored(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        """A block of rows; what the broadcast lacks is left in rare, and for all of them in asks of the first row."""
        hot, tables, *table = sent.value
        rows, lists = len(ids), word_lists(texts)
        streams = [(text + b" " if text else b"") + END for text in pc.binary_join(lists, " ").cast(pa.binary()).to_pylist()]
        names, codes, owners = coded_words(lists)
        found = list(map(hot.get, _names(names)))
        lacking = np.array([f is None for f in found], dtype=bool)
        own_known, own_base = (np.array([f[k] if f else 0 for f in found], dtype=float) for k in (0, 1))
        known = np.bincount(owners, own_known[codes], rows).astype(np.int64) + int(ends > 0)
        base = np.bincount(owners, own_base[codes], rows) + math.log10((ends + 1) / (n + v + 1))
        at = lacking[codes]
        pairs, rare_times = np.unique(owners[at] * len(names) + codes[at], return_counts=True)
        rare_owners, rare_codes = np.divmod(pairs, max(len(names), 1))
        rare_ends = np.searchsorted(rare_owners, np.arange(rows + 1))
        rare = pa.StructArray.from_arrays([names.take(pa.array(rare_codes)).cast(pa.string()), pa.array(rare_times, pa.int64())], ["token", "times"])
        total, ask_keys, ask_owners = np.zeros(rows), [], []
        for gram, owner in grams_of(streams, depth):
            # A few at a time, which the processor's cache holds.
            for i in range(0, len(gram), LOOKED_UP):
                own, of = gram[i : i + LOOKED_UP], owner[i : i + LOOKED_UP]
                values, missing = look_up(tables, *table, own)
                total += np.bincount(of, values, rows)
                ask_keys.append(own[missing])
                ask_owners.append(of[missing])
        key, owner = np.concatenate(ask_keys), np.concatenate(ask_owners)
        order = np.argsort(key)
        key, owner = key[order], owner[order]
        bucket = bucket_of(key >> (8 * (depth - top) + 8), buckets)
        order = by_bucket(bucket, buckets)
        asks = [(number, pack(owner[order[at]]), pack(key[order[at]])) for number, at in slices(bucket[order])]
        ask_type = pa.list_(pa.struct([("bucket", pa.int32()), ("owners", pa.binary()), ("keys", pa.binary())]))
        block = uuid.uuid4().int >> 65
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(rows, block, dtype=np.int64)), pa.array(np.arange(rows, dtype=np.int64)), ids,
                pc.add(pc.list_value_length(lists).cast(pa.int64()), 1), pa.array(known), pa.array(base), pa.array(total),
                pa.array([len(s) for s in streams], pa.int64()),
                pa.ListArray.from_arrays(pa.array(rare_ends, pa.int32()), rare),
                pa.array([asks, *[[]] * (rows - 1)], ask_type),
            ],
            ["block", "at", "doc_id", "n_tokens", "known", "base", "bits", "size", "rare", "asks"],
        )

    def task(batches):
        for batch in batches:
            for i, j in blocks_of(batch.column("text")):
                yield scored(*(batch.column(c).slice(i, j - i) for c in ("doc_id", "text")))

    schema = T.StructType.fromDDL(
        "block long, at long, doc_id long, n_tokens long, known long, base double, bits double, size long, "
        "rare array<struct<token:string,times:bigint>>, asks array<struct<bucket:int,owners:binary,keys:binary>>"
    )
    schema["doc_id"].dataType = docs.schema["doc_id"].dataType
    # Blocks are named at random: the table is written once, and all that follows reads it.
    rows = scratch.write(docs.mapInArrow(task, schema), "scored-rows")
    sent.destroy()
    asked = rows.filter("size(asks) > 0").select("block", F.inline("asks"))
    rare = rows.select("block", "at", F.inline("rare")).join(counts.select("token", "n"), "token")
    found = rare.groupBy("block", "at").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.col("n") + 1) / F.lit(float(n + v + 1)))).alias("more_base"),
    )
    # Written one after the other, so that the shuffle files of the one are gone when the next writes its own.
    found = scratch.write(found, "rare-words")
    scratch.drop("token-counts")
    more = scratch.write(answered(asked, bits), "rare-grams")
    scratch.drop("tree-bits")
    both = rows.drop("rare", "asks").join(found, ["block", "at"], "left").join(more, ["block", "at"], "left")
    total = F.col("bits") + F.coalesce("more_bits", F.lit(0.0))
    return both.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (total * math.log10(2)).alias("score"),
        (-total / F.col("size")).alias("bits_per_byte"),
    )


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 7, 2)
    scored = score_documents(common.read(spark, sf_dir, "documents", "doc_id", "text"), ~out)
    return scored.withColumn("held_out", out)
