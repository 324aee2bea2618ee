"""Best-fit packing with large-item matching.

Documents become token ids plus an end id; those longer than a sequence are cut
into full pieces and a rest. Pieces are dealt at random into groups of about
``group_pieces``, one task each, so a group has the length distribution of the
corpus and wastes less than a sequence or so against packing all at once.

Within a group, pieces above a third of the capacity come first: at most two
fit one sequence, so each, from the longest, is matched with the longest other
one that fits beside it. Smaller pieces, longest first, then go to the sequence
with the smallest gap that holds them, or open a new one.

Defined cases: null or empty text is the end id alone. Rows are packed one by
one, so repeated rows and doc_ids are each placed. Ties go by row number.
An empty table gives no rows. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.llm import common
from ovenplan.session import materialize

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 50_000
#: Words whose ids a worker remembers in one generation; it keeps two.
CACHE_WORDS = 200_000
#: Marks and digits around a run of letters; each part is then a pre-token, or several, of its own.
_PARTS = re.compile(r"([!-&(-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-@\[-`{-~]*)")
_WORD_END = "</w>"


class WordIds:
    """Little-endian unsigned 32-bit ids of words, each distinct one encoded once while remembered.

    The tokenizer drops white space and joins nothing across it, so a text's ids are
    those of its words. Runs of plain letters are lower-cased and encoded many
    at a time: each is one pre-token, whose last id alone ends a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith(_WORD_END)]] = True
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def of(self, texts: list[str | None]) -> list[bytes]:
        words = [(t or "").encode().split() for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.before, self.known = self.known, {}
        if len(self.parts) > 2 * CACHE_WORDS:
            self.parts = {}
        new = set().union(*words) - self.known.keys()
        for word in [w for w in new if w in self.before]:
            self.known[word] = self.before[word]
            new.discard(word)
        self._learn(new)
        return [b"".join(map(self.known.__getitem__, own)) for own in words]

    def _learn(self, new: set[bytes]) -> None:
        split, letters, other = {}, set(), set()
        for word in new:
            text = word.decode()
            found = None if "<|" in text else _PARTS.fullmatch(text)
            split[word] = (found[1], found[2].lower(), found[3]) if found else ("", "", text)
            letters.add(split[word][1])
            other.update(split[word][::2])
        letters = [x for x in letters if x and x not in self.parts]
        for i in range(0, len(letters), 20_000):
            block = letters[i : i + 20_000]
            lines = [" ".join(block[j : j + 200]) for j in range(0, len(block), 200)]
            found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, dtype="<u4") for x in found])
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            raw = ids.tobytes()
            starts = [0, *ends[:-1].tolist()]
            self.parts.update(zip(block, [raw[a:b] for a, b in zip(starts, ends.tolist(), strict=True)], strict=True))
        other = [x for x in other if x not in self.parts]
        for text, x in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.parts[text] = np.array(x.ids, dtype="<u4").tobytes()
        parts = self.parts
        parts[""] = b""
        for word, (a, b, c) in split.items():
            self.known[word] = parts[a] + parts[b] + parts[c]


_loaded: dict[str, WordIds] = {}


def token_ids(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text, without the end id."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path].of(texts)


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's pieces."""

    def cut(batch):
        rows, piece, start, length, crc, kept = [], [], [], [], [], []
        texts = batch.column("text").to_pylist()
        for at in range(0, len(texts), 500):
            for i, ids in enumerate(token_ids(texts[at : at + 500], path), at):
                ids += END_ID.to_bytes(4, "little")
                for n, lo in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[lo : lo + 4 * capacity]
                    rows.append(i)
                    piece.append(n)
                    start.append(lo // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(part)
        out = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), start, length, crc]
        return [*out, pa.array(kept, pa.binary())] if keep_ids else out

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return common.map_batches(docs.select("doc_id", "text"), cut, schema)


class _Gaps:
    """Sequences by free room; room is at most the capacity, so one bit tells of each size."""

    def __init__(self, capacity: int):
        self.at = [[] for _ in range(capacity + 1)]
        self.bits = 0

    def add(self, room: int, item: int) -> None:
        self.at[room].append(item)
        self.bits |= 1 << room

    def pop(self, room: int) -> int:
        item = self.at[room].pop()
        if not self.at[room]:
            self.bits &= ~(1 << room)
        return item

    def smallest(self, least: int) -> int:
        """The smallest size held of ``least`` or more, or -1."""
        high = self.bits >> least
        return least + (high & -high).bit_length() - 1 if high else -1

    def largest(self, most: int) -> int:
        """The largest size held of ``most`` or less, or -1."""
        return (self.bits & ((1 << (most + 1)) - 1)).bit_length() - 1


def pack(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each item; no item is longer than ``capacity``."""
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    large = _Gaps(capacity)
    for i in reversed(order):
        if 3 * lengths[i] > capacity:
            large.add(lengths[i], i)
    gaps, n = _Gaps(capacity), 0
    while large.bits:
        first = large.pop(large.largest(capacity))
        sequence[first], room = n, capacity - lengths[first]
        mate = large.largest(room)
        if mate > 0:
            second = large.pop(mate)
            sequence[second], offset[second] = n, lengths[first]
            room -= mate
        gaps.add(room, n)
        n += 1
    for i in order:
        if 3 * lengths[i] > capacity:
            continue
        room = gaps.smallest(lengths[i])
        if room < 0:
            sequence[i], room, n = n, capacity, n + 1
        else:
            sequence[i] = gaps.pop(room)
        offset[i] = capacity - room
        gaps.add(room - lengths[i], sequence[i])
    return sequence, offset


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = materialize(pieces_of(docs, path, capacity), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("n", F.monotonically_increasing_id())
    dealt = dealt.withColumn("g", F.pmod(F.xxhash64("n"), F.lit(groups)))

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("n")
        sequence, offset = pack(table.column("length").to_pylist(), capacity)
        first = table.column("g")[0].as_py() << 32
        table = table.drop_columns(["n", "g"])
        table = table.append_column("sequence_id", pa.array([first + s for s in sequence], pa.int64()))
        return table.append_column("offset", pa.array(offset, pa.int64()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("g").applyInArrow(
        one,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def sequences(pieces_with_ids: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences, as little-endian 32-bit ids.

    ``pieces_with_ids`` comes from ``pieces_of(keep_ids=True)`` over documents with
    distinct doc_ids. A sequence has at most its capacity of pieces.
    """
    both = placed.join(pieces_with_ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    parts = both.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select(
        "sequence_id",
        F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
