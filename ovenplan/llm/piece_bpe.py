"""SentencePiece BPE by backtracking over longest matches.

Merging joins the adjacent pair whose piece scores best, the leftmost of equals.
A sequence of pieces is what merging would give if and only if each adjacent
pair is what merging gives for the two alone. So the encoder goes left to right:
the longest piece from here on (Aho-Corasick finds all matches of a chunk at
once) that is compatible with the one before; else the next shorter; else it
goes back a piece, and a bitfield keeps that no encoding passes through here.
Pairs are checked by merging them once and remembered.

Text is cut into chunks first, at places that no piece spans (before the first of
a run of spaces, after a run of letters, around line ends; the vocabulary is
checked for it). Characters that are no piece become their UTF-8 byte pieces.
Runs of spaces, whose pieces score alike, are merged outright.

Defined cases: null or empty text has no ids and decodes to the empty string. A
text's ids depend on it alone, so repeated rows get equal ones. ``add_ids``
passes other columns through; its own are named by the caller.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ovenplan.llm import common

SPACE = "▁"
#: Chunks that a worker remembers in one generation (it keeps two), and their greatest length.
CACHE_CHUNKS = 250_000
CACHE_LENGTH = 64
CACHE_PAIRS = 1_000_000
_LETTERS = r"[^\W\d_]"


#: Chunks, from short to long ones; where one ends depends on the two characters there alone.
_CHUNKS = [
    rf"{SPACE}+{_LETTERS}*|\n|(?:[\d_]|[^\w{SPACE}\n])+{_LETTERS}*|{_LETTERS}+",
    rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+",
    r"(?s:.+)",
]


def chunk_pattern(pieces) -> str:
    """The shortest chunks that cut none of ``pieces``."""
    return next(c for c in _CHUNKS if all(re.fullmatch(c, p) and re.findall(c, p) == [p] for p in pieces if p))


class PieceBpe:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [
            i
            for i in range(len(self.pieces))
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.id_of = {self.pieces[i]: i for i in plain}
        self.rank = {self.pieces[i]: -model.get_score(i) for i in plain}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.silent = {i for i in range(len(self.pieces)) if model.is_control(i)}
        self.characters = {p for p in self.id_of if len(p) == 1}
        self.chunks = re.compile(chunk_pattern(self.id_of)).findall
        self.pairs: dict[tuple[str, str], bool] = {}
        # Pieces that merging never makes can't be part of an encoding.
        real = [p for p in self.id_of if p.strip(SPACE) == "" or self.merge(p) == [p]]
        self.matches = ahocorasick.Automaton()
        for p in real:
            self.matches.add_word(p, (len(p) - 1, p))
        self.matches.make_automaton()
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id_of), None) for p in real}
        self.shorter = {p: self._real(s, set(real)) for p, s in self.shorter.items()}
        self.known: dict[str, tuple] = {}
        self.before: dict[str, tuple] = {}

    def _real(self, piece: str | None, real: set[str]) -> str | None:
        while piece is not None and piece not in real:
            piece = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.id_of), None)
        return piece

    def merge(self, text: str) -> list[str]:
        """The pieces of ``text`` by merging from its characters on."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        todo = []

        def consider(i: int) -> None:
            if 0 <= i and right[i] < len(parts):
                joined = parts[i] + parts[right[i]]
                if joined in self.rank:
                    heapq.heappush(todo, (self.rank[joined], i, joined))

        for i in range(len(parts) - 1):
            consider(i)
        while todo:
            _, i, joined = heapq.heappop(todo)
            j = right[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            consider(left[i])
            consider(i)
        return [p for p in parts if p is not None]

    def fits(self, first: str, second: str) -> bool:
        """Whether merging the two pieces' text gives the two pieces."""
        found = self.pairs.get((first, second))
        if found is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            found = self.pairs[first, second] = self.merge(first + second) == [first, second]
        return found

    def backtrack(self, text: str) -> list[str]:
        """The pieces of ``text``, all of whose characters are pieces."""
        size = len(text)
        longest: list[str | None] = [None] * (size + 1)
        for end, (before, piece) in self.matches.iter(text):
            longest[end - before] = piece  # of one start, later ends are longer
        out: list[str] = []
        # One bit per position: no encoding passes through it.
        failed = bytearray((size >> 3) + 1)
        pairs, shorter, fits = self.pairs, self.shorter, self.fits
        at, piece, last = 0, longest[0], None
        while at < size:
            while piece is not None:
                to = at + len(piece)
                if not failed[to >> 3] >> (to & 7) & 1:
                    if last is None:
                        break
                    fit = pairs.get((last, piece))
                    if fits(last, piece) if fit is None else fit:
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                at, last, piece = to, piece, longest[to]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None
        return out

    def _encode_chunk(self, chunk: str) -> list[int]:
        if self.characters.issuperset(chunk) and not chunk.startswith(SPACE * 2):
            return [self.id_of[p] for p in self.backtrack(chunk)]
        ids, start = [], 0
        for i in range(len(chunk) + 1):
            if i == len(chunk) or chunk[i] not in self.id_of:
                if start < i:
                    part = chunk[start:i]
                    tied = part.startswith(SPACE * 2)
                    ids += [self.id_of[p] for p in (self.merge(part) if tied else self.backtrack(part))]
                if i < len(chunk):
                    ids += [self.byte_ids[b] for b in chunk[i].encode()]
                start = i + 1
        return ids

    def _decode_part(self, ids: list[int]) -> bytes:
        return b"".join(
            bytes([self.bytes_of[i]]) if i in self.bytes_of else self.pieces[i].replace(SPACE, " ").encode()
            for i in ids
            if i not in self.silent
        )

    def _chunk(self, chunk: str) -> tuple:
        """(number of ids, their decimal text, decoded bytes) of a chunk."""
        found = self.before.get(chunk)
        if found is None:
            ids = self._encode_chunk(chunk)
            found = (len(ids), ",".join(map(str, ids)).encode(), self._decode_part(ids))
        if len(chunk) <= CACHE_LENGTH:
            if len(self.known) > CACHE_CHUNKS:
                self.before, self.known = self.known, {}
            self.known[chunk] = found
        return found

    def parts(self, text: str | None) -> list[tuple]:
        """(number of ids, their decimal text, decoded bytes) of each chunk of a text."""
        if not text:
            return []
        known, made = self.known, self._chunk
        return [known.get(c) or made(c) for c in self.chunks(SPACE + text.replace(" ", SPACE))]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for _, ids, _ in self.parts(text) for i in ids.split(b",")]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD. The first space is the encoder's own."""
        return self._decode_part(ids).removeprefix(b" ").decode("utf-8", "replace")


_loaded: dict[str, PieceBpe] = {}


def loaded(path: str) -> PieceBpe:
    """One encoder per worker and model file."""
    if path not in _loaded:
        _loaded[path] = PieceBpe(path)
    return _loaded[path]


def add_ids(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All rows and columns of ``docs`` with the text's ids and the text decoded from them."""
    names = docs.columns

    def add(batch):
        bpe = loaded(path)
        found = [bpe.encode(t) for t in batch.column("text").to_pylist()]
        new = {ids: pa.array(found, pa.list_(pa.int32())), decoded: pa.array([bpe.decode(x) for x in found], pa.string())}
        return {n: batch.column(n) for n in names} | new

    out = T.StructType([*docs.schema.fields]).add(ids, T.ArrayType(T.IntegerType())).add(decoded, "string")
    return common.map_batches(docs, add, out)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids and decoded text as digests, as neither is kept."""

    def digest(batch):
        bpe = loaded(path)
        n, ids, decoded = [], [], []
        for text in batch.column("text").to_pylist():
            parts = bpe.parts(text)
            n.append(sum([x[0] for x in parts]))
            ids.append(hashlib.sha256(b",".join([x[1] for x in parts])).hexdigest())
            back = b"".join([x[2] for x in parts]).removeprefix(b" ")
            decoded.append(hashlib.sha256(back).hexdigest())
        return [batch.column("doc_id"), n, ids, decoded]

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return common.map_batches(docs.select("doc_id", "text"), digest, schema)


def op5_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    return digests(docs, public_tokenizers.path("piece_bpe_32k.model"))
