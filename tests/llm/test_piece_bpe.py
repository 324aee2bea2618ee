import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ovenplan.llm import piece_bpe
from tests.conftest import SF_MID

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def bpe():
    return piece_bpe.loaded(PATH)


def same(bpe, text):
    ids = LIBRARY.encode(text)
    assert bpe.encode(text) == ids, text[:80]
    assert bpe.decode(ids) == LIBRARY.decode(ids), text[:80]


EDGES = [
    "", " ", "  lead", "trail  ", "a\tb", "日本𝔘 é é ﬁ", "\n\n x", "▁x", "<s> a </s>", "\x00a", "<0x41>", "a  b   c    d",
    " " * 3000 + "x", "x" + " " * 33, "\r\n\t code();\r {\r", "don't it's 12.5% a_b_c __init__ x²½ Ⅷ", "　\xa0​﻿", "a" * 10_000,
    "Ünïcödé ßçñ", "...!!!???((()))[[]]", "=" * 5000, "https://a.b/c?d=e&f", "ΑΣ ß İ", " \x85\x0b\x0c",
]


def test_edges(bpe):
    for text in EDGES:
        same(bpe, text)


def test_vocabulary_pairs(bpe):
    rng = random.Random(3)
    pieces = [p for p in bpe.id_of if not p.startswith("▁▁")]
    for _ in range(2000):
        same(bpe, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))).replace("▁", " "))


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    same(piece_bpe.loaded(PATH), text)


@given(st.text("abeinorst ", max_size=60))
@settings(max_examples=150, deadline=None)
def test_few_letters(text):
    same(piece_bpe.loaded(PATH), text)


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()}
    got = piece_bpe.op5_piece_bpe(spark, SF_MID).collect()
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in got:
        ids = LIBRARY.encode(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha(",".join(map(str, ids)))
        assert r.decoded_sha256 == sha(LIBRARY.decode(ids))


def test_frames(spark):
    rows = [(1, None), (None, ""), (2, "same"), (2, "same"), (3, "word " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = piece_bpe.add_ids(df, PATH, "the_ids", "back")
    assert got.columns == [*df.columns, "the_ids", "back"]
    for r in got.collect():
        assert list(r.the_ids) == LIBRARY.encode(r.text or "") and r.back == (r.text or "")
    assert sorted(r.n_tokens for r in piece_bpe.digests(df, PATH).collect()) == sorted(len(LIBRARY.encode(t or "")) for _, t in rows)
    assert piece_bpe.digests(df.filter("false"), PATH).collect() == []


def test_chunks_cut_no_piece():
    import re

    for pieces in (["▁the", "(", "12"], ["▁the", "▁("], ["²."], ["a▁b"], ["\n\n", "▁a"], ["▁▁", "▁-a"]):
        found = re.compile(piece_bpe.chunk_pattern(pieces)).findall
        assert all(found(p) == [p] for p in pieces)
    assert piece_bpe.chunk_pattern(["▁the", "(", "12"]) != piece_bpe.chunk_pattern(["▁the", "▁("])


def test_a_million_letters_without_a_space():
    """Time and memory grow with the text's length, and the ids are the library's."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    text = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyzetaoin", k=1_000_000))
    assert piece_bpe.PieceBpe(path).encode(text) == sentencepiece.SentencePieceProcessor(model_file=path).encode(text)
