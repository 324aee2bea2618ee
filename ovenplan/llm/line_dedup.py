"""Line dedup with two Bloom filters (once-seen and twice-seen hashes).

A line's key is the line without ASCII white space at both ends, A-Z lowered.
A key of at least ``min_chars`` code points found in at least ``min_docs``
documents loses its lines in every document but the one with the largest id.

1. Each task hashes the distinct keys of its documents and emits the filter
   positions of what it saw once or more, and of what it saw in two documents.
2. Positions are grouped by filter segment. A segment's task streams them:
   a position already set in the once-seen filter is set in the twice-seen one.
   Every key in two documents has all its positions in the twice-seen filter.
3. The twice-seen filter, of ``max_bits`` at most whatever the input, is
   broadcast. Only keys that it holds are shuffled, as text, and counted exactly.
   False positives cost shuffle; they never change a result.

Defined cases: null or empty text is one empty line. Rows with the same doc_id
are one document when documents are counted. A null doc_id is one document,
smaller than any other. Lines differing only in case or outer white space have
the same key. Columns beside doc_id and text pass through ``dedup_lines``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ovenplan.llm import common
from ovenplan.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
#: Proven bound of the broadcast filter: 2**30 bits are 128 MB.
MAX_BITS = 1 << 30
MIN_BITS = 1 << 16
HASHES = 2
SEGMENT_BITS = 1 << 20
HOT_KEYS = 10_000


def line_key(line: bytes) -> bytes:
    return line.strip(common.ASCII_WS).lower()


def _long_keys(text: str | None, min_chars: int) -> set[bytes]:
    found = {line_key(x) for x in (text or "").encode().split(b"\n") if len(x) >= min_chars}
    return {k for k in found if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode()) >= min_chars)}


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """HASHES filter positions of each hash, one row per hash function."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(HASHES)]).astype(np.int64)


def _seen(docs: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """Rows (segment, once, twice): little-endian int32 offsets set by one task."""

    def by_segment(positions: np.ndarray) -> dict[int, bytes]:
        positions = np.unique(positions)
        cuts = np.flatnonzero(np.diff(positions // SEGMENT_BITS)) + 1
        return {
            int(part[0] // SEGMENT_BITS): (part % SEGMENT_BITS).astype("<i4").tobytes()
            for part in np.split(positions, cuts)
            if len(part)
        }

    def task(frames):
        blocks = []
        for frame in frames:
            one = [xxhash.xxh64_intdigest(k) for t in frame["text"] for k in _long_keys(t, min_chars)]
            blocks.append(np.array(one, dtype=np.uint64))
        hashes, counts = np.unique(np.concatenate(blocks or [np.zeros(0, np.uint64)]), return_counts=True)
        once = by_segment(_positions(hashes, bits).ravel())
        twice = by_segment(_positions(hashes[counts > 1], bits).ravel())
        rows = [(s, once[s], twice.get(s, b"")) for s in once]
        for i in range(0, len(rows), 64):
            yield pd.DataFrame(rows[i : i + 64], columns=["segment", "once", "twice"])

    return docs.select("text").mapInPandas(task, "segment int, once binary, twice binary")


def _merge(seen: DataFrame) -> DataFrame:
    """(segment, twice): the packed twice-seen filter of each segment."""

    def task(frames):
        segment, once, twice = None, None, None
        for frame in frames:
            for s, a, b in zip(frame["segment"], frame["once"], frame["twice"], strict=True):
                if s != segment:
                    if segment is not None and twice.any():
                        yield pd.DataFrame({"segment": [segment], "twice": [np.packbits(twice).tobytes()]})
                    segment, once, twice = s, np.zeros(SEGMENT_BITS, np.uint8), np.zeros(SEGMENT_BITS, np.uint8)
                a, b = np.frombuffer(a, "<i4"), np.frombuffer(b, "<i4")
                twice[a] |= once[a]
                once[a] = 1
                twice[b] = 1
        if segment is not None and twice.any():
            yield pd.DataFrame({"segment": [segment], "twice": [np.packbits(twice).tobytes()]})

    return seen.repartition("segment").sortWithinPartitions("segment").mapInPandas(task, "segment int, twice binary")


def twice_seen_filter(docs: DataFrame, min_chars: int, max_bits: int) -> tuple[np.ndarray, int]:
    """Packed bits of the twice-seen filter, and their number."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A quarter bit per byte of text is over ten bits per line of 40 bytes or more.
    bits = MIN_BITS
    while bits < max_bits and bits < total // 4:
        bits *= 2
    packed = np.zeros(bits // 8, np.uint8)
    for row in _merge(_seen(docs, bits, min_chars)).toLocalIterator():
        at = row.segment * (min(SEGMENT_BITS, bits) // 8)
        part = np.frombuffer(bytes(row.twice), np.uint8)[: bits // 8]
        packed[at : at + len(part)] = part
    return packed, bits


def _suspects(docs: DataFrame, packed: np.ndarray, bits: int, min_chars: int) -> DataFrame:
    """(key, doc_id) of the keys that the twice-seen filter holds."""
    sent = docs.sparkSession.sparkContext.broadcast(packed.tobytes())

    def suspected(batch):
        has = np.frombuffer(sent.value, np.uint8)
        keys, rows = [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            own = _long_keys(text, min_chars)
            keys.extend(own)
            rows.extend([i] * len(own))
        at = _positions(np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64), bits)
        hit = ((has[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
        where = np.flatnonzero(hit)
        ids = batch.column("doc_id").take(pa.array(np.array(rows, dtype=np.int64)[where]))
        return [pa.array([keys[i].decode() for i in where], pa.string()), ids]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_batches(docs.select("doc_id", "text"), suspected, f"key string, doc_id {kind}")


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, max_bits: int = MAX_BITS):
    """(key, doc_id) of the lines that documents lose, one row per document and key."""
    docs = docs.select("doc_id", "text")
    packed, bits = twice_seen_filter(docs, min_chars, max_bits)
    own = materialize(_suspects(docs, packed, bits, min_chars).distinct(), "line-suspects")
    keys = own.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep"))
    keys = materialize(keys.filter(F.col("n") >= min_docs), "line-repeats")
    hot = keys.orderBy(F.desc("n"), "key").limit(HOT_KEYS)
    joined = common.salted_join(own, keys, "key", hot, F.xxhash64("doc_id"))
    return joined.filter(F.col("n").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keep"))).select("key", "doc_id")


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    max_bits: int = MAX_BITS,
    counts: bool = True,
) -> DataFrame:
    """All rows and columns of ``docs`` with the kept lines as ``text``.

    With ``counts`` also ``_n_lines`` and ``_n_dropped``, in place of columns of those
    names. Other columns pass through whatever their names.
    """
    lost = repeated_lines(docs, min_chars, min_docs, max_bits)
    lost = lost.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list("key").alias("lost"))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    both = rows.join(lost, rows["row.doc_id"].eqNullSafe(lost["id"]), "left").select("row", "lost")

    added = ["_n_lines", "_n_dropped"] if counts else []
    names = [n for n in docs.columns if n not in added]

    def kept(batch):
        row, texts, lines, dropped = batch.column("row"), [], [], []
        for text, gone in zip(row.field("text").to_pylist(), batch.column("lost").to_pylist(), strict=True):
            own = (text or "").split("\n")
            left = own
            if gone:
                gone = {k.encode() for k in gone}
                left = [x for x in own if line_key(x.encode()) not in gone]
            texts.append("\n".join(left))
            lines.append(len(own))
            dropped.append(len(own) - len(left))
        new = [pa.array(texts, pa.string()) if n == "text" else row.field(n) for n in names]
        return new + [lines, dropped] * counts

    out = T.StructType([f for f in docs.schema.fields if f.name in names])
    for n in added:
        out = out.add(n, "long")
    return common.map_batches(both, kept, out)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup_lines(common.read(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"),
    )


_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT r, doc_id, string_split(text, chr(10)) AS ls FROM docs),
lines AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM parts),
keyed AS (
  SELECT *, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
rep AS (
  SELECT k, max(doc_id) AS keep FROM (SELECT DISTINCT k, doc_id FROM keyed WHERE length(k) >= {MIN_CHARS})
  GROUP BY k HAVING count(*) >= {MIN_DOCS}),
marked AS (
  SELECT r, any_value(doc_id) AS doc_id, count(*) AS n_lines,
    count(*) FILTER (rep.k IS NOT NULL AND doc_id IS DISTINCT FROM keep) AS n_dropped,
    string_agg(line, chr(10) ORDER BY i) FILTER (rep.k IS NULL OR doc_id IS NOT DISTINCT FROM keep) AS kept
  FROM keyed LEFT JOIN rep USING (k) GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM marked
"""
