"""Exact substring dedup with suffix arrays built by linear grouping.

Every byte covered by a ``length``-byte string that also starts anywhere else
(in another document or the same one; overlaps count) is removed; all is judged on
the input.

Suffixes of a corpus are sorted in parts that need not know each other:

1. Anchors.  Every ``length``-byte window has one anchor: the leftmost of its
   32-byte grams with the smallest hash.  It depends on the window's bytes only, so equal
   windows have equal anchors at equal places.  Consecutive windows mostly share
   their anchor; such a run is a *context*: the bytes of all windows that have this
   anchor.  One pass writes the texts with their contexts (hash of the gram,
   hash of the context's bytes, first window, windows); about one per 85 bytes.
2. A gram hash that occurs once cannot be in a repeated window.  Counts
   combine on the map side, so a passage that a third of all documents share is one row per task.
3. A context that occurs twice is repeated as a whole.  Distinct contexts that share a gram
   are brought together (each once, not once per copy), and a suffix array of their
   bytes is built: the contexts are cut, relative to the anchor, into symbols of ``length / 5`` bytes whose order is
   the order of their bytes, and sorted by ``suffix_array.suffix_array``.  Neighbours'
   common prefixes, compared byte by byte, give the intervals of suffixes that share
   ``length - r`` bytes; within an interval, equal ``r`` bytes to the left of the suffix make equal
   windows.  ``r`` runs through a symbol's length, so every window is judged, exactly.
4. Marked windows go back to all copies of their context, and each document removes what they cover.

A gram with over ``MAX_GROUP`` distinct contexts would make one large task: its
windows are counted instead, one row per distinct context and window, keyed by the window's 128-bit hash.
Grams take that way by a bitmap of fixed size, so a few more may take it by chance; both ways are exact.

Defined cases: null text is empty; texts shorter than ``length`` keep all bytes; repeated rows are
occurrences of their own; ids may be null or repeated (rows have an internal id); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, hash_bitmap, in_bitmap, materialise, release_shuffles, utf8_batch
from .suffix_array import suffix_array

LENGTH = 200
GRAM = 32
MAX_GROUP = 4096          # distinct contexts of one gram sorted together
BATCH_SYMBOLS = 50_000    # symbols of one suffix array, whole groups
SEEN = 50_000             # contexts a reading task remembers, to send each once
SEGMENT = 1 << 17         # bytes hashed at once: some 80 bytes of arrays each
_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_POS = np.uint64(0xFFFFFF)


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from every position, by doubling."""
    h = (b.astype(np.uint64) + np.uint64(1)) * _MUL[5]
    step = 1
    for m in _MUL[:5]:
        h = h[:-step] * m + h[step:]
        h ^= h >> np.uint64(29)
        step *= 2
    h *= _MUL[5]
    return h ^ (h >> np.uint64(32))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours (block-wise prefix and suffix minima)."""
    n = len(x)
    y = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    y[:n] = x
    y = y.reshape(-1, w)
    pre = np.minimum.accumulate(y, axis=1).ravel()
    suf = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    k = n - w + 1
    return np.minimum(suf[:k], pre[w - 1:w - 1 + k])


def contexts(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Contexts of texts laid end to end: ``doc, first window (in the text), windows, gram hash, context hash, anchor (in the context)``.

    Texts are taken a few MB at a time; a text longer than that is taken in
    parts that overlap by ``length - 1`` bytes (a context cut there is two).
    """
    out: list[tuple[np.ndarray, ...]] = []
    d, n = 0, len(off) - 1
    while d < n:
        e = max(int(np.searchsorted(off, off[d] + SEGMENT, "right")) - 1, d + 1)
        if off[e] - off[d] <= 2 * SEGMENT:
            parts = [(off[d], off[e])]
        else:  # one long text
            parts = [(a, min(a + SEGMENT + length - 1, off[e])) for a in range(off[d], off[e] - length + 1, SEGMENT)]
        for a, z in parts:
            if z - a < length:
                continue
            b = buf[a:z]
            g = gram_hashes(b)
            key = (g & ~_POS) | np.arange(len(g), dtype=np.uint64)
            at = (sliding_min(key, length - GRAM + 1) & _POS).astype(np.int64)
            # windows that do not cross a text's border
            bounds = np.clip(off[d:e + 1], a, z) - a
            doc = np.repeat(np.arange(e - d), np.diff(bounds))
            ok = np.flatnonzero(doc[:len(at)] == doc[length - 1:length - 1 + len(at)])
            if not len(ok):
                continue
            at, doc = at[ok], doc[ok]
            new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
            lo, count = ok[new], np.diff(np.concatenate([new, [len(ok)]]))
            raw = b.tobytes()
            h = np.fromiter((xxhash.xxh64_intdigest(raw[x:x + k + length - 1])
                             for x, k in zip(lo.tolist(), count.tolist())), np.uint64, len(lo))
            out.append((doc[new] + d, lo + a - off[d + doc[new]], count, g[at[new]].view(np.int64), h.view(np.int64),
                        at[new] - lo))
        d = e
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(c) for c in zip(*out))


def _context_table(docs: DataFrame, length: int) -> DataFrame:
    """``row, doc_id, text`` (binary) and the contexts as an array of structs, written once."""
    item = T.StructType([T.StructField("gram", T.LongType()), T.StructField("ctx", T.LongType()),
                         T.StructField("lo", T.IntegerType()), T.StructField("k", T.IntegerType()),
                         T.StructField("a", T.IntegerType())])
    src = docs.withColumn("row", F.monotonically_increasing_id())
    schema = T.StructType([*src.schema.fields, T.StructField("c", T.ArrayType(item))])

    def lists(b: pa.RecordBatch) -> pa.ListArray:
        buf, off = utf8_batch(b.column(b.schema.get_field_index("text")))
        doc, lo, k, g, h, a = contexts(buf, off, length)
        cut = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
        items = pa.StructArray.from_arrays(
            [pa.array(g), pa.array(h), *(pa.array(x.astype(np.int32)) for x in (lo, k, a))],
            ["gram", "ctx", "lo", "k", "a"])
        return pa.ListArray.from_arrays(pa.array(cut), items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, lists(b)], [*b.schema.names, "c"])
        b = None
        give_back()

    return materialise(src.mapInArrow(run, schema), "contexts")


def _items(b: pa.RecordBatch, col: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each struct in a list column of a batch, and the structs' fields."""
    lists = b.column(col)
    off = lists.offsets.to_numpy()
    flat = lists.flatten()
    f = {x.name: flat.field(x.name).to_numpy(zero_copy_only=False) for x in flat.type}
    return np.repeat(np.arange(len(lists)), np.diff(off)), f


def _repeated(table: DataFrame, grams: np.ndarray) -> DataFrame:
    """``row, gram, ctx, lo, k`` of the contexts whose gram may be repeated, written once."""
    shared = table.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, f = _items(b, 1)
            hit = np.flatnonzero(in_bitmap(shared.value, f["gram"]))
            rows = b.column(0).to_numpy()[row[hit]]
            yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(f[x][hit]) for x in ("gram", "ctx", "lo", "k"))],
                                             ["row", "gram", "ctx", "lo", "k"])
        b = row = f = hit = rows = None
        give_back()

    return materialise(table.select("row", "c").mapInArrow(run, "row long, gram long, ctx long, lo int, k int"),
                       "repeated")


def _context_bytes(table: DataFrame, length: int, wanted: np.ndarray, large: np.ndarray, of_large: bool) -> DataFrame:
    """``gram, ctx, k, a, bytes`` of the contexts whose gram is in ``wanted`` and (not) in ``large``; once per task."""
    shared = table.sparkSession.sparkContext.broadcast((wanted, large))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want, big = shared.value
        seen: set[tuple[int, int]] = set()
        for b in batches:
            if len(seen) > SEEN:
                seen.clear()  # a context sent twice is dropped where its group is gathered
            row, f = _items(b, 1)
            hit = np.flatnonzero(in_bitmap(want, f["gram"]) & (in_bitmap(big, f["gram"]) == of_large))
            buf, off = utf8_batch(b.column(0))
            raw = buf.tobytes()
            start = off[row[hit]] + f["lo"][hit]
            cols: list[list] = [[] for _ in range(5)]
            for g, c, k, a, s in zip(*(f[x][hit].tolist() for x in ("gram", "ctx", "k", "a")), start.tolist()):
                if (g, c) not in seen:
                    seen.add((g, c))
                    for x, v in zip(cols, (g, c, k, a, raw[s:s + k + length - 1])):
                        x.append(v)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)],
                                             ["gram", "ctx", "k", "a", "bytes"])
        b = row = f = hit = buf = off = raw = start = cols = v = None
        seen.clear()
        give_back()

    return table.select("text", "c").mapInArrow(run, "gram long, ctx long, k int, a int, bytes binary")


def repeated_windows(strings: list[bytes], anchors: list[int], length: int) -> np.ndarray:
    """For contexts laid end to end: whether the ``length`` bytes from each position also start elsewhere in them.

    ``anchors``: where each context's anchor is.  Symbols are cut relative to
    it, so equal windows are cut alike.
    """
    step = max(length // 5, 1)
    raw = b"".join(strings)
    size = len(raw)
    pieces, where, ends = [], [], []
    at = 0
    for s, a in zip(strings, anchors):
        for i in range(a % step, len(s), step):
            pieces.append(s[i:i + step])
            where.append(at + i)
        at += len(s)
        pieces.append(None)
        where.append(-1)
        ends.append(at)
    name = {p: r for r, p in enumerate(sorted({p for p in pieces if p is not None}), 2)}
    order = np.array(suffix_array([1 if p is None else name[p] for p in pieces] + [0]), np.int64)
    where = np.array([*where, -1], np.int64)
    marked = np.zeros(size, bool)
    p = where[order]
    p = p[p >= 0]  # suffixes at symbol starts, in order
    ends = np.array(ends, np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    which = np.searchsorted(ends, p, "right")
    rest, room = ends[which] - p, p - begins[which]
    least = length - step + 1
    keep = rest >= least
    p, rest, room = p[keep], rest[keep], room[keep]
    if len(p) < 2:
        return marked
    data = np.concatenate([np.frombuffer(raw, np.uint8), np.zeros(length, np.uint8)])
    common = np.zeros(len(p), np.int64)  # common prefix with the suffix before
    windows = np.lib.stride_tricks.sliding_window_view(data, length)  # a view: rows are copied a thousand at a time
    near = np.flatnonzero(data[p[1:]] == data[p[:-1]]) + 1
    for i in range(0, len(near), 1000):
        j = near[i:i + 1000]
        differs = windows[p[j]] != windows[p[j - 1]]
        n = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
        common[j] = np.minimum(n, np.minimum(rest[j], rest[j - 1]))
    long = common >= least
    alive = long | np.concatenate([long[1:], [False]])
    common = np.where(long, common, 0)[alive]
    p, rest, room = p[alive], rest[alive], room[alive]
    if not len(p):
        return marked
    left = np.zeros(len(p), np.int64)  # class of the r bytes to the left
    for r in range(step):
        if r:
            ok = room >= r
            left[ok] = np.unique(left[ok] * 256 + data[p[ok] - r], return_inverse=True)[1]
        interval = np.cumsum(common < length - r)
        ok = np.flatnonzero((room >= r) & (rest >= length - r))
        if len(ok) > 1:
            key = interval[ok] * len(p) + left[ok]
            by = np.argsort(key, kind="stable")
            same = key[by[1:]] == key[by[:-1]]
            twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            marked[p[ok[by[twice]]] - r] = True
    return marked


def _runs(marked: np.ndarray) -> list[int]:
    """First and last index of each run of True, flat."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    edge[1::2] -= 1
    return edge.tolist()


MARKS = "gram long, ctx long, runs array<int>"


def _marks(rows: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows of each context, by suffix arrays over whole gram groups."""
    def judge(group: list[tuple]) -> pa.RecordBatch:
        marked = repeated_windows([x[4] for x in group], [x[3] for x in group], length)
        out, at = [], 0
        for g, c, k, _, s in group:
            runs = _runs(marked[at:at + k])
            if runs:
                out.append((g, c, runs))
            at += len(s)
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.list_(pa.int32()))], ["gram", "ctx", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: dict[int, tuple] = {}
        last, symbols = None, 0
        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns)):
                if x[0] != last:
                    if len(group) > 1:  # a lone context repeats nothing here
                        held += group.values()
                        symbols += sum(len(y[4]) for y in group.values()) // (length // 5)
                    group, last = {}, x[0]
                    if symbols >= BATCH_SYMBOLS:
                        yield judge(held)
                        held, symbols = [], 0
                group.setdefault(x[1], x)
        if len(group) > 1:
            held += group.values()
        if held:
            yield judge(held)
        held, group, b, x = [], {}, None, None
        give_back()

    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, MARKS)


def _marks_by_window(rows: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many contexts: windows counted by their hash, nothing gathered by gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            for g, c, k, _, s in zip(*(x.to_pylist() for x in b.columns)):
                for i in range(k):
                    d = xxhash.xxh128_intdigest(s[i:i + length])
                    for x, v in zip(cols, (g, c, i, (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63))):
                        x.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["gram", "ctx", "i", "w1", "w2"])

    w = materialise(rows.dropDuplicates(["gram", "ctx"]).mapInArrow(
        run, "gram long, ctx long, i int, w1 long, w2 long"), "windows")
    twice = w.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    return w.join(twice, ["w1", "w2"]).groupBy("gram", "ctx").agg(
        F.flatten(F.collect_list(F.array("i", "i"))).alias("runs"))  # at most a context's windows


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   max_group: int = MAX_GROUP) -> tuple[DataFrame, DataFrame]:
    """The written texts ``row, doc_id, text, c`` and ``row, spans`` (covered byte spans, flat, may overlap)."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    spark = docs.sparkSession
    table = _context_table(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")), length)
    grams = table.select(F.explode("c").alias("c")).groupBy("c.gram").agg(
        F.count("*").alias("n"), F.min("c.ctx").alias("c0"), F.max("c.ctx").alias("c1")).where("n > 1")
    grams = materialise(grams.select("gram", (F.col("c0") != F.col("c1")).alias("several")), "grams")
    release_shuffles(spark)
    rows = _repeated(table, hash_bitmap(grams, "gram"))
    ctx = materialise(rows.groupBy("gram", "ctx").agg(F.count("*").alias("n")), "context-counts")
    several = hash_bitmap(grams.where("several"), "gram")
    groups = ctx.groupBy("gram").count().where(F.col("count") > max_group)
    large = hash_bitmap(groups, "gram")
    marks = _marks(_context_bytes(table, length, several, large, False), length)
    if large.any():
        marks = marks.unionByName(_marks_by_window(_context_bytes(table, length, several, large, True), length))
    marks = materialise(marks, "marks")
    release_shuffles(spark)
    whole = ctx.where("n > 1").select("gram", "ctx", F.array().cast("array<int>").alias("runs"))
    spans = F.when(F.size("runs") == 0, F.array(F.col("lo"), F.col("lo") + F.col("k") + (length - 1))).otherwise(
        F.transform("runs", lambda x, i: F.col("lo") + x + F.when(i % 2 == 1, length).otherwise(0)))
    hit = rows.join(marks.unionByName(whole), ["gram", "ctx"]).select("row", spans.alias("s"))
    return table, hit.groupBy("row").agg(F.flatten(F.collect_list("s")).alias("spans"))  # bounded by a text's length


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                     max_group: int = MAX_GROUP) -> DataFrame:
    """``doc_id, kept`` (binary: remaining bytes), ``n_bytes, n_removed, n_spans, kept_sha256`` per document."""
    table, spans = repeated_spans(docs, id_col, text_col, length, max_group)
    spans = materialise(spans.withColumn("h", F.xxhash64("row")), "spans")
    release_shuffles(docs.sparkSession)
    # most texts keep all their bytes: a bitmap of fixed size spares them the shuffle
    bitmap = docs.sparkSession.sparkContext.broadcast(hash_bitmap(spans, "h"))

    @F.pandas_udf("boolean")
    def may_lose(h: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bitmap.value, h.to_numpy(np.int64)))

    texts = table.select("row", "doc_id", "text").withColumn("loses", may_lose(F.xxhash64("row")))
    joined = (texts.where("loses").join(spans.drop("h"), "row", "left").select("doc_id", "text", "spans")
              .union(texts.where("not loses").select("doc_id", "text", F.lit(None).cast("array<int>").alias("spans"))))
    id_field = joined.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = utf8_batch(b.column(1))
            raw = buf.tobytes()
            cols: list[list] = [[] for _ in range(5)]
            for s, a, z in zip(b.column(2).to_pylist(), off.tolist(), off[1:].tolist()):
                text = raw[a:z]
                kept, removed, runs = text, 0, 0
                if s:
                    parts, end = [], 0
                    for x, y in sorted(zip(s[::2], s[1::2])):
                        if x > end or not runs:
                            parts.append(text[end:x])
                            runs += 1
                        if y > end:
                            end = y
                    parts.append(text[end:])
                    kept = b"".join(parts)
                    removed = len(text) - len(kept)
                for c, v in zip(cols, (kept, len(text), removed, runs, hashlib.sha256(kept).hexdigest())):
                    c.append(v)
            types = [pa.binary(), *[pa.int64()] * 3, pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        b = buf = off = raw = cols = text = kept = parts = v = None
        give_back()

    schema = T.StructType([id_field, T.StructField("kept", T.BinaryType()),
                           *(T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept_sha256", T.StringType())])
    return joined.mapInArrow(run, schema)
