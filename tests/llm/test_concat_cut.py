import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ovenplan.llm import concat_cut
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def check(rows, got, tokenizer, capacity):
    """Every id in one piece, pieces equal to the tokenizer's ids, sequences gapless and unpadded."""
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(ids_of(tokenizer, text))
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc_id, copies in texts.items():
        want = sum(len(ids) for ids in copies)
        pieces = by_doc[doc_id]
        assert sum(r.length for r in pieces) == want
        if len(copies) == 1:
            at = 0
            for r in sorted(pieces, key=lambda r: r.start):
                part = copies[0][r.start : r.start + r.length]
                assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part.tobytes()), want)
                at += r.length
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    lengths = []
    for sequence_id in sorted(held):
        at = 0
        for offset, length in sorted(held[sequence_id]):
            assert offset == at and length > 0
            at += length
        lengths.append(at)
    total = sum(len(x) for copies in texts.values() for x in copies)
    whole, rest = divmod(total, capacity)
    assert sorted(held) == list(range(len(held)))
    assert lengths == [capacity] * whole + concat_cut.tail_lengths(rest)


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "Bc", "é", "é", "'s", "'", "12", "漢", "!", "...", "　", "\xa0"]
    parts += ["\x1c", "\0", "<|endoftext|>", "<|", "\x0b", "\x85", "don't", "ʼn", "—", "🙂", "word,", "\nword."]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(20_000)]
    want = [ids_of(tokenizer, t)[:-1].tobytes() for t in texts]
    assert concat_cut.ChunkIds(PATH).of(texts) == want


def test_forgetting_words_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(concat_cut, "CACHE_CHUNKS", 5)
    chunks = concat_cut.ChunkIds(PATH)
    for block in (["one two three, four. five six seven"], ["one two eight nine\nten one"], ["two, eleven one"]) * 3:
        assert chunks.of(block) == [ids_of(tokenizer, t)[:-1].tobytes() for t in block]


def test_tail_lengths():
    assert concat_cut.tail_lengths(0) == []
    assert concat_cut.tail_lengths(700) == [512, 128, 32, 16, 8, 4]


def test_query_against_brute_force(spark, tokenizer):
    got = concat_cut.op11_concat_and_cut(spark, SF_SMALL).collect()
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in rows], got, tokenizer, 1024)


def test_edge_cases(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "null id"), (4, "long " * 3000), (5, " \n "), (6, "x" * 5000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("part", "before", "n", "ids", "g", "block", "p"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = concat_cut.pack_documents(docs, PATH, capacity=64)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(rows, got.collect(), tokenizer, 64)


def test_empty_table(spark):
    assert concat_cut.pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_long_batches_are_encoded_in_parts(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(concat_cut, "BATCH_CHARS", 50)
    rows = [(i, "word " * (i % 7) + "end") for i in range(200)]
    check(rows, concat_cut.pack_documents(spark.createDataFrame(rows, SCHEMA), PATH, 32).collect(), tokenizer, 32)


def test_many_partitions_and_offset_blocks(spark, monkeypatch):
    monkeypatch.setattr(concat_cut, "BLOCK", 3)
    table = spark.createDataFrame([(p, b, 2) for p in range(20) for b in range(0, 2 * p, 2)], "part long, before long, n long")
    found = {r.part: (r.base, r.total) for r in concat_cut.part_offsets(table).collect()}
    assert found == {p: (p * (p - 1), 2 * p) for p in range(1, 20)}


def test_sequences_hold_the_ids(spark, tokenizer):
    rows = [(i, f"text number {i} " * (i % 9)) for i in range(40)]
    pieces = concat_cut.pack_documents(spark.createDataFrame(rows, SCHEMA).coalesce(1), PATH, 32, keep_ids=True)
    found = sorted(concat_cut.sequences(pieces).collect(), key=lambda r: r.sequence_id)
    want = np.concatenate([ids_of(tokenizer, t) for _, t in rows])
    assert b"".join(bytes(r.ids) for r in found) == want.tobytes()


def test_plain_words_are_not_taken_apart(tokenizer, monkeypatch):
    asked = []

    class Letters:
        def fullmatch(self, word, *at, of=concat_cut._LETTERS):
            asked.append(word)
            return of.fullmatch(word, *at)

    monkeypatch.setattr(concat_cut, "_LETTERS", Letters())
    text = "plain letters, Été naïve ×sign x1 done.\nplain again and words here"
    got = concat_cut.ChunkIds(PATH).of([text, "words"])
    assert got == [ids_of(tokenizer, t)[:-1].tobytes() for t in (text, "words")]
    assert not {"words", "again", "and", "here"} & set(asked) and "Été" in asked


def test_ids_of_any_spacing_are_those_of_the_tokenizer(monkeypatch):
    # Spaced and other texts in one batch, chunks forgotten and taken up again.
    monkeypatch.setattr(concat_cut, "CACHE_CHUNKS", 40)
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(4)
    tokenizer = Tokenizer.from_file(path)
    ids_of = concat_cut.ChunkIds(path)
    parts = ["a", "Bé", " ", "  ", "\n", "\n\n", "\t", "\r\n", "word", "Word's", " the", " the,", "...", "\x85", "\xa0"]
    parts += ["\u2003", "\x1c", "\x00", "<|endoftext|>", "12", "!", "日本", "\u3000", "😀", "\x0b", "ɏ", "Ġ"]
    for size in (1, 3, 40, 400):
        texts = ["", *("".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(size)), ""]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in ids_of.of(texts)] == want
    assert ids_of.of([]) == [] and ids_of.of(["", ""]) == [b"", b""]


def test_chunks_in_common_are_looked_up_once_a_batch(monkeypatch):
    # Before, every place of a chunk was looked up.
    ids_of, asked = concat_cut.ChunkIds(public_tokenizers.path("byte_bpe_50k.json")), []
    before = ids_of._remember
    monkeypatch.setattr(ids_of, "_remember", lambda keys: asked.append(list(keys)) or before(keys))
    ids_of.of(["one two two\none two"] * 50)
    assert sorted(asked[0]) == ["\none", "two"]
