"""Byte-level BPE encoding and decoding.

Texts are cut by the tokenizer's pattern; every piece's UTF-8 bytes are read as
Latin-1, so one Aho-Corasick automaton (pyahocorasick) over the vocabulary finds
all token matches in one pass.  The encoder then walks left to right with the
longest match, shortens it to the next shorter token that is a prefix, and steps
back when no token can follow.  A token may follow another only if merging by rank
would keep both: that test of adjacent tokens is memoised.  A position that was
given up is marked and never tried again, hence linear time in the piece's length.
The result equals merging by rank exactly.

Defined results: null text counts as empty (no tokens); an empty text has no
tokens; repeated rows give equal results; extra columns are not read.
"""

from __future__ import annotations

import base64
import copy
import re
import sys
import weakref
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskframe.llm._common import hex_sha256, pick, ship, table

#: Distinct pieces (and token pairs) one Python worker remembers before it starts afresh.
PIECE_CACHE = 400_000
PAIR_CACHE = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 token, space, rank, per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def plain_classes(pattern: str, last: int = sys.maxunicode) -> str:
    """The pattern with its Unicode classes spelt out as ranges up to ``last``, for the
    standard ``re`` module.  With 0xFFFF ``re`` looks classes up in a bitmap, which is
    several times faster than ``regex``; texts beyond it need the full ranges."""
    import regex

    everything = "".join(chr(i) for i in range(last + 1) if not 0xD800 <= i < 0xE000)

    def ranges(cls: str) -> str:
        runs = regex.finditer(f"{cls}+", everything)
        return "".join(f"\\U{ord(m[0][0]):08x}-\\U{ord(m[0][-1]):08x}" for m in runs)

    space = ranges(r"\p{White_Space}")
    pattern = re.sub(r"\\p\{(\w+)\}", lambda m: _inside(pattern, m.start(), ranges(rf"\p{{{m[1]}}}")), pattern)
    pattern = pattern.replace(r"\S", f"[^{space}]")
    return re.sub(r"\\s", lambda m: _inside(pattern, m.start(), space), pattern)


def _inside(pattern: str, at: int, ranges: str) -> str:
    """Ranges as they stand inside a bracket, or with brackets of their own."""
    depth = pattern.count("[", 0, at) - pattern.count("]", 0, at)
    return ranges if depth else f"[{ranges}]"


class BytePairCodec:
    """Encoder and decoder for one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick

        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self._size = {r: len(t) for t, r in ranks.items()}
        self._cut_bmp = re.compile(plain_classes(pattern, 0xFFFF)).findall
        self._cut_any = re.compile(plain_classes(pattern)).findall
        self._shorter: dict[int, int | None] = {}   # longest token that is a proper prefix
        self._halves: dict[int, tuple[int, int]] = {}  # the last merge that makes a token
        self._merged: dict[tuple[int, int], int] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), None)
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if not self._learn_merge(token, rank):
                continue  # no merges lead to it: only a piece that equals it gives it
            automaton.add_word(token.decode("latin-1"), rank)
        self._fits.clear()
        automaton.make_automaton()
        self._matches = automaton.iter
        self._pieces = _PieceCache(self._encode_piece)

    def fresh(self) -> BytePairCodec:
        """The same tables with nothing remembered yet."""
        other = copy.copy(self)
        other._fits, other._pieces = {}, _PieceCache(other._encode_piece)
        return other

    def _learn_merge(self, token: bytes, rank: int) -> bool:
        if len(token) == 1:
            self._halves[rank] = (rank, rank)
            return True
        left = self._shorter[rank]
        while left is not None:
            right = self.ranks.get(token[len(self.token[left]):])
            if right is not None and left < rank and right < rank and left in self._halves and right in self._halves and self._adjacent(left, right):
                self._halves[rank] = (left, right)
                self._merged[left, right] = rank
                return True
            left = self._shorter[left]
        return False

    def _adjacent(self, a: int, b: int) -> bool:
        """Can ``a`` stand directly before ``b`` in an encoding?  Undo both tokens'
        merges, latest first; the pair is impossible if, while both parts stood
        there, a merge across the border would have come earlier."""
        bound = len(self.token) + 1
        while True:
            across = self._merged.get((a, b))
            if across is not None and across < bound:
                return False
            if a > b:
                bound, a = a, self._halves[a][1]
                if a == bound:  # a single byte: undo the other side
                    bound, b = b + 1, self._halves[b][0]
                    if b + 1 == bound:
                        return True
            else:
                bound, b = b + 1, self._halves[b][0]
                if b + 1 == bound:
                    bound, a = a, self._halves[a][1]
                    if a == bound:
                        return True

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, size, shorter, fits, adjacent = len(data), self._size, self._shorter, self._fits, self._adjacent
        if len(fits) >= PAIR_CACHE:
            fits.clear()
        longest: list[int | None] = [None] * (n + 1)
        reach = [0] * n
        for end, rank in self._matches(data.decode("latin-1")):
            length = size[rank]
            start = end + 1 - length
            if length > reach[start]:
                longest[start], reach[start] = rank, length
        out: list[int] = []
        open_at = bytearray(b"\x01") * (n + 1)
        at, before, candidate = 0, None, longest[0]
        while at < n:
            while candidate is not None:
                end = at + size[candidate]
                if open_at[end]:
                    if before is None:
                        break
                    known = fits.get((before, candidate))
                    if known is None:
                        known = fits[before, candidate] = adjacent(before, candidate)
                    if known:
                        break
                candidate = shorter[candidate]
            if candidate is not None:
                out.append(candidate)
                at, before = end, candidate
                candidate = longest[at]
            else:  # nothing can follow here: give this position up and shorten the token before
                if not out:
                    raise ValueError("the vocabulary lacks a single byte of the text")
                open_at[at] = 0
                candidate = out.pop()
                at -= size[candidate]
                before = out[-1] if out else None
        return out

    def _encode_piece(self, piece: str) -> bytes:
        return b"".join(r.to_bytes(4, "little") for r in self.encode_piece(piece.encode("utf-8")))

    def _cut(self, text: str) -> list[str]:
        bmp = len(text.encode("utf-16-le")) == 2 * len(text)
        return (self._cut_bmp if bmp else self._cut_any)(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after the other."""
        return b"".join(map(self._pieces.__getitem__, self._cut(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I").tolist()))


class _PieceCache(dict):
    def __init__(self, make):
        super().__init__()
        self._make = weakref.WeakMethod(make)  # no cycle: goes with its codec at once

    def __missing__(self, piece: str) -> bytes:
        ids = self._make()(piece)
        if len(piece) <= 64:
            if len(self) >= PIECE_CACHE:
                self.clear()
            self[piece] = ids
        return ids


_codecs: dict[tuple[int, str], BytePairCodec] = {}


def _codec(ranks: dict[bytes, int], pattern: str) -> BytePairCodec:
    """One codec per Python worker and vocabulary; workers are reused by tasks."""
    key = (hash(frozenset(ranks.items())), pattern)
    if key not in _codecs:
        _codecs[key] = BytePairCodec(ranks, pattern)
    return _codecs[key]


class Vocabulary:
    """What is broadcast.  A worker's codec hangs on its broadcast: pieces remembered
    for one job are let go when the worker serves a job without it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    @cached_property
    def codec(self) -> BytePairCodec:
        return _codec(self.ranks, self.pattern).fresh()


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked
    for, ``ids`` (binary, little-endian unsigned 32-bit).  ``ranks`` is broadcast:
    its size is that of the vocabulary file, not of the data."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(ranks, pattern))
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec
        for batch in batches:
            n, ids_sha, back_sha, kept = [], [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(hex_sha256(ids))
                back_sha.append(hex_sha256(codec.decode(ids)))
                if with_ids:
                    kept.append(ids)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return pick(docs, id_col, text_col).mapInArrow(run, schema)


VOCABULARY = "byte_bpe_50k.tiktoken"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), read_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)
