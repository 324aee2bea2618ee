"""Packing by concatenation: documents end to end, cut into sequences of one length.

Documents become token ids plus an end id and lie one after the other, in the
order of the input's partitions. Where a document lies follows from two
prefix sums. The first runs inside each task while it encodes: the tokens of its
partition before each document. The second runs over the partitions' totals, one
row per partition, in blocks. With both a document knows its global offset, and
cuts itself at the multiples of ``capacity`` inside it: no document is moved or
shuffled, and a sequence's two boundary records come from the documents across
its ends.

The rest behind the last whole sequence is cut at powers of two, longest first, so
it is at most log2(capacity) sequences, none of which needs padding.

The encoded table is written once to the shared folder; partition numbers and
prefix sums are read from it, so a task run again after a lost executor sees the
same ones.

Defined cases: null or empty text is the end id alone. Rows are packed one by
one, so repeated rows and doc_ids (null ones too) are each placed. An empty table
gives no rows. Columns beside doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ovenplan.llm import common
from ovenplan.session import materialize, shared_dir

CAPACITY = 1024
END_ID = 0
#: Chunks whose ids a worker remembers in one generation; it keeps two.
CACHE_CHUNKS = 400_000
#: Characters of text, or more by one document, that are encoded together.
BATCH_CHARS = 4_000_000
#: Partitions whose totals are summed by one task.
BLOCK = 1000

#: Letters with marks behind them: the letters, with the space before them, are one pre-token, the marks another.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_CHUNKS = re.compile(r"\s*\S+|\s+")
#: Space to Python but not to the tokenizer; and the mark of chunks taken as they are.
_CONTROLS = re.compile(r"[\x00\x1c-\x1f]")
#: These, and white space other than spaces and line feeds; for Arrow.
_ODD = r"[\x00\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SPACE_MARK = "Ġ"


class ChunkIds:
    """Little-endian unsigned 32-bit ids of texts, each distinct chunk encoded once while remembered.

    A pre-token never goes on from a character into white space, and of a run of white
    space before a word the last space belongs to the word. So a text may be
    split before each space or line feed that a word follows, and its ids are
    those of the chunks. A chunk's key leaves out the space it starts with.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.starts[[i for token, i in vocabulary.items() if token.startswith(_SPACE_MARK)]] = True
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_feed = self._encode(["\n"])[0]
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.raw: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _keys(self, text: str) -> list[str] | None:
        """The keys of any text's chunks, a line feed before the first; None: encode it whole."""
        if any(token in text for token in self.special) or _CONTROLS.search(text):
            return None
        keys = [c[1:] if c[0] == " " and not c[1:2].isspace() and c != " " else "\0" + c for c in _CHUNKS.findall(text)]
        if not text[0].isspace():
            keys[0] = "\0" + text[: len(keys[0]) - 1]
        return ["\0\n", *keys]

    def _spaced(self, text: str) -> str | None:
        """The text whose parts between single spaces are the chunks' keys, a line feed before the first; None if there is none."""
        fed = ("\n" + text).replace("\n", " \n")
        if "  " in fed or "\n " in fed or fed[-1] in " \n" or any(token in text for token in self.special):
            return None
        return fed[1:]

    def of(self, texts: list[str]) -> list[bytes]:
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), _ODD).to_numpy(zero_copy_only=False)
        spaced = [None if o or not t else self._spaced(t) for t, o in zip(texts, odd, strict=True)]
        lists = pc.split_pattern(pa.array([t for t in spaced if t is not None], pa.large_string()), " ")
        others = [self._keys(t) if s is None and t else None for t, s in zip(texts, spaced, strict=True)]
        rest = pa.array([key for keys in others if keys for key in keys], pa.large_string())
        coded = pa.concat_arrays([lists.flatten(), rest]).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._remember(names)
        # The ids of all chunks, end to end: gathered from those of the distinct ones.
        ids = list(map(self.known.__getitem__, names))
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        codes = coded.indices.to_numpy()
        own = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(own)])
        at = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], own)
        at += np.arange(ends[-1])
        data = np.frombuffer(b"".join(ids), dtype="<u4")[at].tobytes()
        chunks = pc.list_value_length(lists).to_pylist()
        counts = iter([*chunks, *(len(keys) for keys in others if keys)])
        # Spaced texts come first, then the others.
        cuts, done = [None] * len(texts), 0
        for of_kind in ([s is not None for s in spaced], [bool(keys) for keys in others]):
            for i in np.flatnonzero(of_kind).tolist():
                first, done = done, done + next(counts)
                cuts[i] = slice(int(ends[first]) * 4 + len(self.line_feed), int(ends[done]) * 4)
        return [data[c] if c else self._encode([t])[0] if t else b"" for t, c in zip(texts, cuts, strict=True)]

    def _remember(self, keys: list[str]) -> None:
        """Makes the ids of keys known."""
        if len(self.known) > CACHE_CHUNKS:
            self.before, self.known = self.known, {}
        for parts in (self.words, self.raw):
            if len(parts) > 2 * CACHE_CHUNKS:
                parts.clear()
        new = set(keys).difference(self.known)
        again = new & self.before.keys()
        self.known.update(zip(again, map(self.before.__getitem__, again), strict=True))
        self._learn(new - again)

    def _learn(self, new: set[str]) -> None:
        words, raw, known = self.words, self.raw, self.known
        # Most keys are plain letters: no parts to tell apart.
        plain = [key for key in new if key.isascii() and key.isalpha()]
        new_words, new_raw = set(plain).difference(words), set()
        new.difference_update(plain)
        parts, fed, others = [], [], []
        for key in new:
            word = key.rstrip(_MARKS)
            if word in words or _LETTERS.fullmatch(word):
                if word not in words:
                    new_words.add(word)
                marks = key[len(word) :]
                new_raw.add(marks)
                parts += key, word, marks
            elif key[0] == "\n" and _LETTERS.fullmatch(word, 1):
                fed.append((key, word[1:], key[len(word) :]))
                new_raw.update(fed[-1][1:])
            else:
                others.append((key, _text_of(key)))
                new_raw.add(others[-1][1])
        new_words = list(new_words)
        for i in range(0, len(new_words), 20_000):
            block = new_words[i : i + 20_000]
            lines = [" " + " ".join(block[j : j + 200]) for j in range(0, len(block), 200)]
            found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, dtype="<u4") for x in found])
            all_ids, at = ids.tobytes(), (np.flatnonzero(self.starts[ids]) * 4).tolist()
            words.update(zip(block, [all_ids[a:b] for a, b in zip(at, [*at[1:], len(all_ids)], strict=True)], strict=True))
        new_raw = list(new_raw - raw.keys())
        raw.update(zip(new_raw, self._encode(new_raw), strict=True))
        known.update(zip(plain, map(words.__getitem__, plain), strict=True))
        parts = iter(parts)
        for key, word, marks in zip(parts, parts, parts, strict=True):
            known[key] = words[word] + raw[marks]
        for key, word, marks in fed:
            known[key] = self.line_feed + raw[word] + raw[marks]
        for key, text in others:
            known[key] = raw[text]


def _text_of(key: str) -> str:
    """The chunk of a key: as it is behind the mark, with its line feed, or with the space left out."""
    return key[1:] if key[0] == "\0" else key if key[0] == "\n" else " " + key


_loaded: dict[str, ChunkIds] = {}


def token_ids(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text, without the end id."""
    if path not in _loaded:
        _loaded[path] = ChunkIds(path)
    return _loaded[path].of(texts)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, part, before, n, ids): each document's ids with the end id, its partition and the tokens before it there."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "part", "before", "n", "ids"]

    def task(batches):
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            chars = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy())
            ends = [*np.flatnonzero(np.diff(chars // BATCH_CHARS)) + 1, batch.num_rows] if batch.num_rows else []
            for lo, hi in zip([0, *ends], ends):
                rows = batch.slice(lo, hi - lo)
                texts = [t or "" for t in rows.column("text").to_pylist()]
                ids = [x + END_ID.to_bytes(4, "little") for x in token_ids(texts, path)]
                n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                before = total + np.cumsum(n) - n
                total += int(n.sum())
                columns = [pa.array(np.full(len(n), part, np.int64)), pa.array(before), pa.array(n), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(task, f"doc_id {kind}, part long, before long, n long, ids binary")


def part_offsets(table: DataFrame) -> DataFrame:
    """(part, base, total): the tokens before each partition, and in it."""
    totals = table.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    totals = materialize(totals.withColumn("block", F.expr(f"part div {BLOCK}")), "part-totals")
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block of partitions: a thousandth of the number of tasks.
    blocks = totals.groupBy("block").agg(F.sum("total").alias("t"))
    blocks = blocks.select("block", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("start") + F.coalesce(F.sum("total").over(inside), F.lit(0))
    return materialize(totals.join(blocks, "block").select("part", base.alias("base"), "total"), "part-offsets")


def tail_lengths(rest: int) -> list[int]:
    """The powers of two that add up to ``rest``, longest first."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of every piece."""
    spark, at = docs.sparkSession, shared_dir(docs.sparkSession, "encoded")
    table = encoded(docs, path)
    table.write.option("compression", "zstd").parquet(at)
    table = spark.read.schema(table.schema).parquet(at)
    offsets = part_offsets(table)
    tokens = offsets.agg(F.sum("total").alias("t")).first().t or 0
    whole = tokens // capacity
    # The sequences behind the whole ones, as (number, first token, end).
    tails, end = [], whole * capacity
    for k, length in enumerate(tail_lengths(tokens - end)):
        tails.append(f"named_struct('s', {whole + k}L, 'lo', {end}L, 'hi', {end + length}L)")
        end += length
    tails = f"array({', '.join(tails)})" if tails else "cast(array() as array<struct<s: bigint, lo: bigint, hi: bigint>>)"
    # A row per partition, of known size as it is a written table: broadcast if it is small enough.
    placed = table.join(offsets.select("part", "base"), "part").withColumn("g", F.col("base") + F.col("before"))
    # Windows of a document that meet [g, g + n): whole sequences, then those of the rest.
    first, last = f"g div {capacity}", f"least((g + n - 1) div {capacity}, {whole - 1}L)"
    inside = (
        f"transform(if({first} <= {last}, sequence({first}, {last}), cast(array() as array<bigint>)), "
        f"s -> named_struct('s', s, 'lo', s * {capacity}L, 'hi', (s + 1) * {capacity}L))"
    )
    windows = F.expr(f"concat({inside}, filter({tails}, w -> w.lo < g + n and g < w.hi))")

    def piece(w):
        lo, hi = F.greatest(w["lo"], F.col("g")), F.least(w["hi"], F.col("g") + F.col("n"))
        start, length = lo - F.col("g"), hi - lo
        ids = F.substring("ids", (start * 4 + 1).cast("int"), (length * 4).cast("int"))
        own = [start.alias("start"), length.alias("length"), F.crc32(ids).alias("ids_crc32")]
        own += [w["s"].alias("sequence_id"), (lo - w["lo"]).alias("offset")] + [ids.alias("ids")] * keep_ids
        return F.struct(*own)

    pieces = placed.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(F.transform(windows, piece)).alias("p"))
    names = ["start", "length", "ids_crc32"], ["sequence_id", "offset"] + ["ids"] * keep_ids
    return pieces.select("doc_id", *[f"p.{c}" for c in names[0]], "doc_tokens", *[f"p.{c}" for c in names[1]])


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the sequences of ``pack_documents(keep_ids=True)``; one has at most its capacity of pieces."""
    parts = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))


def op11_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
