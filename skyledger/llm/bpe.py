"""Byte-level BPE encoding and decoding, linear in the piece's length.

A rank file in tiktoken's form (base64 token, rank) is the parameter.  Text is
split by a pattern into pieces; each piece is encoded alone:

* an Aho-Corasick automaton over the vocabulary (bytes mapped to Latin-1, one
  character per byte) gives the longest token starting at every byte;
* the encoder takes the longest token that is compatible with the token before
  it, shortens it through its prefixes if not, and backtracks when nothing
  fits; a bit per byte marks dead ends, so every position is left at most once;
* two adjacent tokens are compatible if merging by rank would keep the cut
  between them.  That is decided by undoing merges on both sides of the cut
  from the latest one on, and memoised.

The token sequence in which all neighbours are compatible is unique and is
the one that merging by rank gives.  As in the tiktoken library, a piece that
is itself a token is that token.

Defined cases: null text is empty (no tokens, empty decoding); bytes that are
not UTF-8 are replaced by U+FFFD before the split; long pieces need no special
case.  Other columns are carried or ignored; ids and texts may repeat.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, texts_of

CACHE_PIECES = 400_000  # encoded pieces kept per worker (a cache: cleared when full)
CACHE_PAIRS = 500_000


class _Pieces(dict):
    """Ids of pieces as little-endian unsigned 32-bit integers; encodes what it does not know yet.

    Bytes, since the interpreter's garbage collector does not visit them.
    """

    def __init__(self, encode_piece):
        super().__init__()
        self.encode_piece = encode_piece

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode_piece(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class Bpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.token = {r: t for t, r in ranks.items()}
        self.size = {r: len(t) for t, r in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self.encode_piece)
        self.automaton = ahocorasick.Automaton()
        for t, r in ranks.items():
            self.automaton.add_word(t.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.shorter = {r: self._longest_proper_prefix(t) for t, r in ranks.items()}
        self._learn_merges()

    def _longest_proper_prefix(self, t: bytes) -> int | None:
        return next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ranks), None)

    def _learn_merges(self) -> None:
        """The pair of tokens whose merge makes each token, in rank order; single bytes have none."""
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for r in sorted(self.token):
            t, left = self.token[r], self.shorter[r]
            self.parts[r] = (r, r)
            while left is not None:
                right = self.ranks.get(t[self.size[left]:])
                if right is not None and left < r and right < r and self._keeps_cut(left, right):
                    self.parts[r] = (left, right)
                    self.merged[left, right] = r
                    break
                left = self.shorter[left]
        self.pairs.clear()  # judged while later merges were unknown

    def _keeps_cut(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the cut between tokens ``a`` and ``b``.

        ``before`` is the merge last undone: a merge across the cut counts only
        if it would have come before that one.
        """
        merged, parts = self.merged, self.parts
        before = 1 << 62
        while True:
            if merged.get((a, b), before) < before:
                return False
            # undo the later of the two newest merges (the left one first on equal ranks)
            if a > b:
                before, (_, inner) = a, parts[a]
                if inner != a:
                    a = inner
                    continue
                before, (inner, _) = b + 1, parts[b]
                if inner == b:
                    return True
                b = inner
            else:
                before, (inner, _) = b + 1, parts[b]
                if inner != b:
                    b = inner
                    continue
                before, (_, inner) = a, parts[a]
                if inner == a:
                    return True
                a = inner

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._keeps_cut(a, b)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, size, shorter = len(piece), self.size, self.shorter
        longest = [0] * n
        for end, r in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size[r]] = r  # ends only grow: the last one for a start is the longest
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, tok = 0, longest[0]
        while True:
            end = at + size[tok]
            if alive[end] and (not out or self.compatible(out[-1], tok)):
                out.append(tok)
                at = end
                if at == n:
                    return out
                tok = longest[at]
                continue
            tok = shorter[tok]
            while tok is None:  # nothing fits from here: drop the token before and try a shorter one
                alive[at] = 0
                tok = out.pop()
                at -= size[tok]
                tok = shorter[tok]

    def forget(self) -> None:
        """Drop the caches: a worker lives on after a task, and the next stage's tasks need its memory."""
        self.pieces.clear()
        self.pairs.clear()
        give_back()

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Bpe:
    """The tokenizer of a rank file; read once per Python worker."""
    with open(path, "rb") as f:
        return Bpe({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}, pattern)


def _map(df: DataFrame, text_col: str, schema: str, make) -> DataFrame:
    keep = [c for c in df.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, make_row, names, types = make()
        for b in batches:
            rows = [make_row(t) for t in texts_of(b.column(b.schema.get_field_index(text_col)))]
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), *cols],
                                             [*keep, *names])
        bpe.forget()

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep)
    return df.mapInArrow(run, f"{kept}, {schema}" if kept else schema)


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``text_col`` replaced by its token ids (``array<int>`` in column ``out``, a new name)."""
    def make():
        bpe = load(path, pattern)
        return bpe, (lambda t: [bpe.encode(t.decode("utf-8", "replace"))]), [out], [pa.list_(pa.int32())]

    return _map(df.withColumn(text_col, F.col(text_col).cast("binary")), text_col, f"`{out}` array<int>", make)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the ids replaced by the bytes they stand for (binary column ``out``; null ids: empty)."""
    keep = [c for c in df.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in batches:
            ids = b.column(b.schema.get_field_index(ids_col)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in keep),
                 pa.array([bpe.decode(x or []) for x in ids], pa.binary())], [*keep, out])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep)
    return df.mapInArrow(run, f"{kept}, `{out}` binary" if kept else f"`{out}` binary")


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids: ``n_tokens, ids_sha256, decoded_sha256`` beside the other columns.

    ids_sha256 is over the ids as little-endian unsigned 32-bit integers.  Both
    steps run in one pass, so neither ids nor decoded bytes leave the task.
    """
    def make():
        bpe = load(path, pattern)

        def row(t: bytes):
            packed = bpe.encode_packed(t.decode("utf-8", "replace"))
            back = bpe.decode(np.frombuffer(packed, "<u4").tolist())
            return len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest()

        return bpe, row, ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()]

    return _map(df.withColumn(text_col, F.col(text_col).cast("binary")), text_col,
                "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
