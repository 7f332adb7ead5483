"""Vector codes by product quantisation with adaptive distance bounds (Drake and Hamerly).

Components become integers ``floor(scale * x)`` and vectors are cut into equal consecutive parts, each with a
codebook of its own.  A round assigns every part to its nearest entry (squared Euclidean distance, ties to the
lower index) and replaces each entry by the componentwise ``floor(sum / count)`` of its parts.

The bounds.  For every part its row keeps the entry assigned, an upper bound on the distance to it, the ``b``
closest other entries with ordered lower bounds, and one outer bound for all entries that are not in
the list.  After entries have moved, the upper bound grows by its entry's move, each lower bound shrinks
by its entry's move and the outer bound by the largest one; a running minimum from the outer bound inwards keeps
them ordered.  Entries whose bound is strictly above the upper bound are out; the others, always a prefix of the list,
are compared by exact integer distances, and only parts whose outer bound does not clear the upper bound meet the whole codebook.  Bounds
are floats rounded outwards, so rounding never decides: every uncertain case ends in integers.
``b`` adapts per batch: lists are cut to what all but one in a hundred rows needed, ``B_LEAST`` at least, and doubled (to a
quarter of the codebook at most) when over a quarter of the rows had to meet the whole codebook.

At scale: a round is one pass that writes rows with their bounds (no shuffle) and one narrow pass that sums parts per
entry: a task sends at most ``parts * entries`` rows of sums, however hot an entry, and the driver gets the
``parts * entries`` totals.  Each round's table is deleted when the next one is written.  ``label_error`` sums per
label on the map side; the sums join back on the label.

Defined cases: rows whose vector is null, or holds null or non-finite components, are dropped, and so are
empty vectors and vectors of another length than the one with the smallest id (ids ascending, nulls last; among
equal ids the smallest vector first).  Repeated rows count each time.  Fewer rows than entries give a smaller codebook; an empty
table gives an empty result.  Null labels are one label.  Distances must fit a long (an error says so otherwise).
Columns other than id, vector and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise

B_LEAST = 4
_OUT = 1 + 1e-6  # bounds are kept as 32-bit floats: outwards by more than their rounding
_NO_MORE = np.float32(3e38)  # outer bound when the list holds all entries


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all entries of ``c``, as longs."""
    if len(x) and len(c) and x.shape[1] and 4 * x.shape[1] * int(max(abs(x).max(), abs(c).max())) ** 2 < 1 << 53:
        f, g = x.astype(float), c.astype(float)  # every sum is an integer below 2 ** 53: exact in doubles
        return ((f * f).sum(1)[:, None] - 2 * (f @ g.T) + (g * g).sum(1)).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for j in range(x.shape[1]):
        d = x[:, j, None] - c[:, j]
        out += d * d
    return out


def _up(d: np.ndarray) -> np.ndarray:
    return (np.sqrt(d.astype(float)) * _OUT).astype(np.float32)


def _down(d: np.ndarray) -> np.ndarray:
    return (np.sqrt(d.astype(float)) / _OUT).astype(np.float32)


class Bounds:
    """Assignment and bounds of one part position for a batch of rows."""

    def __init__(self, code: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray, outer: np.ndarray):
        self.code, self.upper, self.near, self.lower, self.outer = code, upper, near, lower, outer
        self.exact = 0  # distances computed in the last step

    @classmethod
    def first(cls, x: np.ndarray, c: np.ndarray, b: int) -> Bounds:
        b = min(b, len(c) - 1)
        self = cls(np.zeros(len(x), np.uint8), np.zeros(len(x), np.float32), np.zeros((len(x), b), np.uint8),
                   np.zeros((len(x), b), np.float32), np.zeros(len(x), np.float32))
        self._all(np.arange(len(x)), x, c)
        return self

    def _all(self, rows: np.ndarray, x: np.ndarray, c: np.ndarray) -> None:
        """Meet the whole codebook."""
        b = self.near.shape[1]
        for at in range(0, len(rows), 4096):
            r = rows[at:at + 4096]
            d = distances(x[r], c)
            key = d * 256 + np.arange(len(c)) if len(c) and d.max(initial=0) < 1 << 54 else None
            if key is not None and b + 2 < len(c):  # the b + 2 smallest, in order of distance and index
                order = np.argpartition(key, b + 1, axis=1)[:, :b + 2]
                order = np.take_along_axis(order, np.take_along_axis(key, order, 1).argsort(1), 1)
            else:
                order = d.argsort(axis=1, kind="stable")[:, :b + 2]
            near = np.take_along_axis(d, order, 1)
            self.code[r], self.upper[r] = order[:, 0], _up(near[:, 0])
            self.near[r], self.lower[r] = order[:, 1:b + 1], _down(near[:, 1:b + 1])
            self.outer[r] = _down(near[:, b + 1]) if near.shape[1] > b + 1 else _NO_MORE
        self.exact += len(rows) * len(c)

    def move(self, moves: np.ndarray) -> None:
        """Entries have moved by at most ``moves``."""
        self.upper = (self.upper + moves[self.code]) * np.float32(_OUT)
        gone = np.concatenate([self.lower - moves[self.near], (self.outer - moves.max())[:, None]], 1)
        gone = gone - np.abs(gone) * np.float32(_OUT - 1)
        gone = np.minimum.accumulate(gone[:, ::-1], 1)[:, ::-1]
        self.lower, self.outer = gone[:, :-1], gone[:, -1]

    def resize(self, b: int) -> None:
        """Keep the first ``b`` of the list; the outer bound takes the rest in."""
        if b < self.near.shape[1]:
            self.outer = np.minimum(self.outer, self.lower[:, b:].min(1))
            self.near, self.lower = self.near[:, :b], self.lower[:, :b]

    def assign(self, x: np.ndarray, c: np.ndarray, moves: np.ndarray, most: int) -> None:
        """The nearest entry of every row after the entries have moved to ``c``; then a list length that fits."""
        self.exact = 0
        self.move(moves)
        self.lower, self.near = np.ascontiguousarray(self.lower), np.ascontiguousarray(self.near)
        b = self.near.shape[1]
        open_ = np.flatnonzero(np.minimum(self.lower.min(1, initial=np.inf), self.outer) <= self.upper)
        d = x[open_] - c[self.code[open_]]
        own = (d * d).sum(1)
        self.exact += len(open_)
        self.upper[open_] = _up(own)
        need = np.zeros(len(x), np.int64)  # entries whose bound does not clear the upper bound
        need[open_] = (self.lower[open_] <= self.upper[open_, None]).sum(1)
        far = self.outer[open_] <= self.upper[open_]
        need[open_[far]] = b + 1
        listed = open_[(need[open_] > 0) & ~far]
        own = own[(need[open_] > 0) & ~far]
        for z in np.unique(need[listed]).tolist():
            pick = need[listed] == z
            r, o = listed[pick], own[pick]
            ids = np.concatenate([self.code[r, None], self.near[r, :z]], 1)
            diff = x[r][:, None, :] - c[ids[:, 1:]]
            dist = np.concatenate([o[:, None], (diff * diff).sum(2)], 1)
            by_id = ids.argsort(1, kind="stable")  # by distance, then by index
            order = np.take_along_axis(by_id, np.take_along_axis(dist, by_id, 1).argsort(1, kind="stable"), 1)
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
            self.code[r], self.upper[r] = ids[:, 0], _up(dist[:, 0])
            self.near[r, :z], self.lower[r, :z] = ids[:, 1:], _down(dist[:, 1:])
            self.exact += len(r) * z
        if b < most and 4 * far.sum() > len(x):  # lists too short: all rows get longer ones
            b = min(2 * max(b, B_LEAST), most)
            self.near, self.lower = np.zeros((len(x), b), np.uint8), np.zeros((len(x), b), np.float32)
            self._all(np.arange(len(x)), x, c)
            return
        self._all(open_[far], x, c)
        need[open_[far]] = 0
        self.resize(max(int(np.quantile(need, 0.99, method="higher")) + 1, min(B_LEAST, most)))


def _vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int, scale: int) -> DataFrame:
    """``id, label, vec`` (array of longs) of the rows that are kept."""
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("v").isNotNull() & ~bad)
    rows = materialise(rows.select("id", "label", F.transform(
        "v", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vec")), "codes-vectors")
    one = rows.where(F.size("vec") > 0).orderBy(F.col("id").asc_nulls_last(), "vec").select(F.size("vec")).limit(1).collect()
    if not one:
        return rows.where(F.lit(False))
    dim = one[0][0]
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    return rows.where(F.size("vec") == dim)


def _matrix(col: pa.Array, parts: int) -> np.ndarray:
    """Rows x parts x components."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), parts, -1) if len(col) else np.zeros((0, parts, 0), np.int64)


def _pack(a: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    a = np.ascontiguousarray(a)
    width = a.dtype.itemsize * int(np.prod(a.shape[1:]))
    return pa.Array.from_buffers(pa.binary(), len(a), [
        None, pa.py_buffer((np.arange(len(a) + 1) * width).astype(np.int32)), pa.py_buffer(a.tobytes())])


def _unpack(col: pa.Array, dtype: type, *shape: int) -> np.ndarray:
    o = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(dtype).reshape(len(col), *shape).copy()


def _assign(rows: DataFrame, books: list[np.ndarray], moves: list[np.ndarray] | None, parts: int) -> DataFrame:
    """``rows`` with codes and bounds for the codebooks ``books``; ``moves`` is None in the first round."""
    base = [rows.schema[c] for c in ("id", "label", "vec")]
    schema = T.StructType([*base, T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType()),
                           T.StructField("state", T.BinaryType()), T.StructField("n_exact", T.LongType())])
    entries = len(books[0])
    most = max(min(entries // 4, entries - 1), 0)

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(b.column(2), parts)
        n = len(x)
        state = b.column(5).to_pylist() if moves is not None else None
        kept, err, exact = [], np.zeros(n, np.int64), 0
        if state is None:
            kept = [Bounds.first(x[:, p], books[p], max(entries // 8, min(B_LEAST, most))) for p in range(parts)]
        else:
            # rows of one earlier batch share their list lengths: a header of one byte a part
            groups: dict[bytes, list[int]] = {}
            for i, s in enumerate(state):
                groups.setdefault(s[:parts], []).append(i)
            whole: list[list[Bounds]] = []
            order = []
            for head, at in groups.items():
                raw = np.frombuffer(b"".join([state[i] for i in at]), np.uint8).reshape(len(at), -1)
                pos = parts
                mine = []
                for p in range(parts):
                    w = head[p]
                    code = raw[:, pos].copy()
                    near = raw[:, pos + 1:pos + 1 + w].copy()
                    f = np.ascontiguousarray(raw[:, pos + 1 + w:pos + 9 + 5 * w]).view(np.float32)
                    mine.append(Bounds(code, f[:, 0].copy(), near, f[:, 2:].copy(), f[:, 1].copy()))
                    pos += 9 + 5 * w
                    mine[p].assign(x[at, p], books[p], moves[p], most)
                whole.append(mine)
                order.append(at)
        out: list[bytes] = [b""] * n
        codes = np.zeros((n, parts), np.uint8)
        for mine, at in [(kept, np.arange(n))] if state is None else zip(whole, order):
            cols = [np.full((len(at), 1), s.near.shape[1], np.uint8) for s in mine]
            for p, s in enumerate(mine):
                f = np.concatenate([s.upper[:, None], s.outer[:, None], s.lower], 1).astype(np.float32)
                cols += [s.code[:, None], s.near, f.view(np.uint8)]
                codes[at, p] = s.code
                exact += s.exact
            raw = np.concatenate(cols, 1)
            for i, r in zip(np.asarray(at).tolist(), _pack(raw).to_pylist()):
                out[i] = r
        for p in range(parts):
            d = x[:, p] - books[p][codes[:, p]]
            err += (d * d).sum(1)
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), _pack(codes), pa.array(err), pa.array(out, pa.binary()),
             pa.array([exact] + [0] * (n - 1), pa.int64())], schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                yield step(b)

    return rows.mapInArrow(run, schema)


def _sums(rows: DataFrame, parts: int, dim: int, entries: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sum of the parts assigned to each entry that is in use."""
    width = dim // parts
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("part", "entry")] + [
        T.StructField("n", T.LongType()), T.StructField("s", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, entries), np.int64)
        s = np.zeros((parts, entries, width), np.int64)
        for b in batches:
            x, codes = _matrix(b.column(0), parts), _unpack(b.column(1), np.uint8, parts)
            for p in range(parts if len(x) else 0):
                n[p] += np.bincount(codes[:, p], minlength=entries)
                order = codes[:, p].argsort(kind="stable")
                used, first = np.unique(codes[order, p], return_index=True)
                s[p, used] += np.add.reduceat(x[order, p], first, axis=0)
        part, entry = n.nonzero()
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]),
                 pa.ListArray.from_arrays((np.arange(len(part) + 1) * width).astype(np.int32), s[part, entry].ravel())],
                schema.fieldNames())

    got = rows.select("vec", "code").mapInArrow(run, schema).groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width))).collect()
    return {(r[0], r[1]): (r[2], list(r[3:])) for r in got}


def compress(df: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list]:
    """``(rows, codebooks)``: ``id, label, code`` (one byte a part), ``error``, ``label_error``, and the final entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code byte holds 256 entries")
    rows = _vectors(df, id_col, vec_col, label_col, parts, scale)
    first = [list(r.vec) for r in rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()]
    if not first:
        return rows.select("id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error")), []
    largest = rows.select(F.max(F.greatest(F.abs(F.array_max("vec")), F.abs(F.array_min("vec"))))).first()[0] or 0
    dim = len(first[0])
    if dim * (2 * largest) ** 2 >= 1 << 62:
        raise ValueError(f"squared distances of components up to {largest} do not fit a long")
    start = np.array(first, np.int64).reshape(len(first), parts, -1)
    books = [np.ascontiguousarray(start[:, p]) for p in range(parts)]
    state = materialise(_assign(rows, books, None, parts), "codes-state")
    for _ in range(rounds):
        sums = _sums(state, parts, dim, len(first))
        new = [c.copy() for c in books]
        for (p, e), (n, s) in sums.items():
            new[p][e] = [v // n for v in s]
        moves = [_up(((a - c) ** 2).sum(1)) for a, c in zip(new, books)]
        books, before = new, state
        state = materialise(_assign(before, books, moves, parts), "codes-state")
        discard(before)
    per = state.groupBy("label").agg(F.sum("error").alias("label_error"))
    out = state.select("id", "label", "code", "error").join(
        per.withColumnRenamed("label", "label_"), F.col("label").eqNullSafe(F.col("label_"))).drop("label_")
    return out, books


def books_sha256(books: list[np.ndarray]) -> str:
    """Digest of all entries' decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for c in books for v in c.ravel().tolist()).encode()).hexdigest()
