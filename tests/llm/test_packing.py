import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ovenplan.llm import packing
from tests.conftest import SF_MID

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]


@given(st.lists(st.integers(1, 100), max_size=60))
@settings(max_examples=200, deadline=None)
def test_pack_is_valid(lengths):
    sequence, offset = packing.pack(lengths, 100)
    held = defaultdict(list)
    for s, o, n in zip(sequence, offset, lengths, strict=True):
        held[s].append((o, n))
    for parts in held.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 100
    # No two sequences could be one.
    full = sorted(sum(n for _, n in p) for p in held.values())
    assert len(full) < 2 or full[0] + full[1] > 100


def test_pack_is_dense():
    rng = random.Random(1)
    lengths = [min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20_000)]
    sequence, _ = packing.pack(lengths)
    assert len(set(sequence)) <= 1.02 * sum(lengths) / 2048


def check(rows, got):
    want, tokenizer = defaultdict(int), Tokenizer.from_file(PATH)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for n, lo in enumerate(range(0, len(ids), 2048)):
            part = ids[lo : lo + 2048]
            want[(doc_id, n, lo, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))] += 1
    have = defaultdict(int)
    for r in got:
        have[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    assert have == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    return len(held)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    got = packing.op8_best_fit_packing(spark, SF_MID).collect()
    n = check(rows, got)
    assert n <= 1.02 * sum(r.length for r in got) / 2048 + 1


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "It's NULL\x85here <|endoftext|>"), (3, "x " * 5000), (3, "x " * 5000)]
    rows += [(4, "éte ́ combining space İ ΑΣ 日本"), (5, " \n\t"), (6, "a" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, packing.pack_documents(df, PATH).collect())
    check(rows, packing.pack_documents(df, PATH, group_pieces=2).collect())
    empty = spark.createDataFrame([], "doc_id long, text string, offset int")
    assert packing.pack_documents(empty, PATH).collect() == []


def test_sequences_hold_the_ids(spark):
    rows = [(i, f"document number {i} " * (40 * i)) for i in range(1, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    placed = packing.pack_documents(df, PATH)
    made = packing.sequences(packing.pieces_of(df, PATH, keep_ids=True), placed).collect()
    ids = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in made}
    for r in placed.collect():
        part = whole_ids(rows[r.doc_id - 1][1])[r.start : r.start + r.length]
        assert ids[r.sequence_id][r.offset : r.offset + r.length].tolist() == part
