"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, connected groups.

Normalised line: lower case, digits as ``0``, words of letters and digits joined
by one space.  A line without words is never removed.

1. One pass over the texts gives each line the 128-bit hash of its normalised
   form and a 64-bit SimHash of its words, weighted by their length.  Documents, lines and a row id
   are written once; all that follows reads that table.
2. Equal normalised lines are one line (with map-side combining, so a line
   that a third of all documents share costs one row per task).
3. The SimHash is cut into five blocks; two fingerprints within three bits agree in
   two blocks at least, so distinct lines meet under the ten pairs of blocks (25
   or 26 bits each).  In each bucket every member is first compared with the smallest one (a
   star, linear in the bucket); then members that are still in different groups
   are compared with each other, so no link between different lines is lost.  Two lines that share several
   buckets are a pair of one of them only.
4. Pairs within three bits are verified: edit similarity (1 - distance / longer
   length, code points of the normalised lines) of ``min_similarity`` or more.
5. Connected groups of verified pairs; the first occurrence of each group (by document id, nulls
   last, row, line number) stays, all others are removed.

Defined cases: null text stays null and has no lines; empty texts stay; a
document that loses all lines stays with an empty text; repeated rows are rows
of their own, so the lines of the first one stay; ties go to the earlier row of the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, fresh, give_back, hash_bitmap, in_bitmap, materialise, materialise_by, maybe_among, release_shuffles, texts_of

MIN_SIMILARITY = 0.8
MAX_BITS = 3
_BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]  # first bit, width
_KEY_BITS = 26  # of two blocks together, at most
_WORD = re.compile(r"[^\W_]+")
_DIGIT = re.compile(r"\d")
_CHUNK = 1 << 17  # bytes of normalised lines hashed at once
_HEAVY = 16       # weight of a word, at most
_LANE = 255 // _HEAVY  # words whose weighted bits fit into one byte per bit

_POWER = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))
# bits of a byte as eight bytes
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


# ASCII as normalised: digits are zero, all but letters, digits and line ends is space
_ASCII = bytes(10 if c == 10 else 48 if 48 <= c <= 57 else ord(chr(c).lower()) if c < 128 and chr(c).isalpha() else 32 for c in range(256))


def normalise(line: str) -> str:
    if line.isascii():
        return " ".join(line.encode().translate(_ASCII).decode().split())
    norm = " ".join(_WORD.findall(line.lower()))
    return _DIGIT.sub("0", norm) if _DIGIT.search(norm) else norm


_KNOWN: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    known = _KNOWN.get(int(base))
    if known is None or len(known) < n:
        out = np.full(max(n, _CHUNK + 1), base, np.uint64)
        out[0] = 1
        known = np.multiply.accumulate(out)
        if n <= 64 * _CHUNK:
            _KNOWN[int(base)] = known
    return known[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(m)
    return h ^ (h >> np.uint64(33))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word ``raw[starts[i]:ends[i]]``: polynomial by prefix sums, then mixed."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_POWER, len(raw)), out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(raw) + 1)[starts])


def _ones(h: np.ndarray, times: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of 64 bits is set in each run of hashes ``h[starts[i]:starts[i + 1]]`` (no run is empty), a hash counting ``times``."""
    # bits are added eight at a time, a byte each, so runs are cut first to as many hashes as a byte can hold
    pieces = -(-np.diff(starts) // _LANE)
    first = np.concatenate([[0], np.cumsum(pieces)])
    cut = np.repeat(starts[:-1], pieces) + _LANE * (np.arange(first[-1]) - np.repeat(first[:-1], pieces))
    lanes = np.add.reduceat(_SPREAD[h.view(np.uint8).reshape(-1, 8)] * times.astype(np.uint64)[:, None], cut, axis=0)
    return np.add.reduceat(lanes.view(np.uint8).reshape(-1, 64), first[:-1], axis=0, dtype=np.int64)


def simhash_of_words(h: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHash of each run of word hashes: bits set in over half of its words, a word of ``n`` bytes counting ``n * n / 16`` times.

    Long words tell lines apart, short ones are shared by all lines of a language.  A tie takes the
    first word's bit: else lines of few words would have few bits set, and meet by chance.
    """
    times = np.clip(sizes * sizes // 16, 1, _HEAVY)
    ones = 2 * _ones(h, times, starts)
    ones += np.unpackbits(h[starts[:-1]].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(ones > np.add.reduceat(times, starts[:-1])[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


# Scripts without spaces between words: Thai to Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]{2,}")


def _pairs(run: re.Match) -> str:
    s = run[0]
    return " " + " ".join(s[i:i + 2] for i in range(len(s) - 1)) + " "


def feature_words(norm: str) -> str:
    """The words whose hashes make the SimHash: a run of characters of a script without spaces gives its pairs of neighbours."""
    return " ".join(_UNSPACED.sub(_pairs, norm).split()) if _UNSPACED.search(norm) else norm


def simhashes(lines: list[str]) -> np.ndarray:
    """SimHash of each normalised line (none is empty)."""
    out, i = [], 0
    lines = [x if x.isascii() else feature_words(x) for x in lines]
    while i < len(lines):
        j, size = i, 0
        while j < len(lines) and size < _CHUNK:
            size += len(lines[j]) + 1
            j += 1
        raw = np.frombuffer("\n".join(lines[i:j]).encode(), np.uint8)
        gap = np.flatnonzero((raw == 32) | (raw == 10))
        starts, ends = np.concatenate([[0], gap + 1]), np.concatenate([gap, [len(raw)]])
        line = np.concatenate([[0], np.flatnonzero(raw[gap] == 10) + 1, [len(starts)]])
        out.append(simhash_of_words(word_hashes(raw, starts, ends), line, ends - starts))
        i = j
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def line_hashes(texts: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines per text, then per line: number in the text, two hashes of the normalised line, SimHash; lines without words are left out."""
    counts, numbers, digests, norms = [], [], [], []
    for raw in texts:
        n = len(norms)
        if raw.isascii():
            lines = [" ".join(x.split()) for x in raw.translate(_ASCII).decode().split("\n")]
        else:
            lines = map(normalise, raw.decode("utf-8", "replace").split("\n"))
        for k, norm in enumerate(lines):
            if norm:
                digests.append(xxhash.xxh128_digest(norm))
                numbers.append(k)
                norms.append(norm)
        counts.append(len(norms) - n)
    both = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    return counts, np.array(numbers, np.int32), both[:, 0], both[:, 1], simhashes(norms).view(np.int64)


def edit_similarity(x: str, y: str, least: float) -> bool:
    """Whether 1 - levenshtein / longer length is at least ``least`` (bit-parallel, common ends cut off first)."""
    longer = max(len(x), len(y))
    most = int((1 - least) * longer + 1e-9)
    if abs(len(x) - len(y)) > most:
        return False
    lo, hi = 0, min(len(x), len(y))
    while lo < hi:  # common prefix by halving
        mid = (lo + hi + 1) // 2
        if x[:mid] == y[:mid]:
            lo = mid
        else:
            hi = mid - 1
    x, y = x[lo:], y[lo:]
    lo, hi = 0, min(len(x), len(y))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if x[len(x) - mid:] == y[len(y) - mid:]:
            lo = mid
        else:
            hi = mid - 1
    x, y = x[:len(x) - lo], y[:len(y) - lo]
    if not x or not y:
        return max(len(x), len(y)) <= most
    if len(x) > len(y):
        x, y = y, x
    # columns of the distance matrix as bit vectors of +1 and -1 steps, one row per character of y
    where: dict[str, int] = {}
    for i, c in enumerate(x):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(x)) - 1, 1 << (len(x) - 1)
    plus, minus, dist = full, 0, len(x)
    left = len(y)
    for c in y:
        m = where.get(c, 0)
        diag = (((m & plus) + plus) ^ plus) | m | minus
        up = minus | (full & ~(diag | plus))
        down = plus & diag
        dist += bool(up & top) - bool(down & top)
        left -= 1
        if dist - left > most:
            return False
        up = (up << 1 | 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(diag | up))
        minus = up & diag
    return dist <= most


_ROW_BITS = 33  # of a row id, the place in its task; the task's number is above


def line_table(docs: DataFrame, text_col: str, out: str, row: str, part: str) -> DataFrame:
    """``docs``, a row id in ``row``, the task that reads it in ``part``, and in ``out`` an array of its lines ``(k, a, b, fp)``.

    Written once, bucketed by ``part``, so that what is found out about the lines can be brought to the texts.
    """
    src = docs.withColumn(row, F.monotonically_increasing_id())
    src = src.withColumn(part, F.shiftrightunsigned(row, _ROW_BITS))
    item = T.StructType([T.StructField("k", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in ("a", "b", "fp"))])
    schema = T.StructType([*src.schema.fields, T.StructField(out, T.ArrayType(item))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, k, x, y, fp = line_hashes(list(texts_of(b.column(b.schema.get_field_index(text_col)))))
            off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(k), pa.array(x), pa.array(y), pa.array(fp)], ["k", "a", "b", "fp"])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(off), items)],
                                             [*b.schema.names, out])
        give_back()

    return materialise_by(src.mapInArrow(run, schema), "lines", part)


def _near(side: WindowSpec, max_bits: int) -> Column:
    """Whether one of the three neighbours on either side is within ``max_bits``."""
    near = F.lit(False)
    for k in (1, 2, 3):
        for f in (F.lag, F.lead):
            near = near | F.coalesce(F.bit_count(F.col("fp").bitwiseXOR(f("fp", k).over(side))) <= max_bits, F.lit(False))
    return near


def _with_least(rows: DataFrame) -> DataFrame:
    """``rows`` with each bucket's size ``n``, smallest id ``least`` and that one's ``least_fp``."""
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumns({"n": F.count("*").over(w), "least": F.first("id").over(w), "least_fp": F.first("fp").over(w)})


def _sub_masks() -> list[list[int]]:
    """Per pair of blocks, the bits outside it in four masks (signed 64-bit numbers)."""
    out = []
    for pair in combinations(_BLOCKS, 2):
        inside = {first + i for first, width in pair for i in range(width)}
        rest = [i for i in range(64) if i not in inside]
        cut = [rest[len(rest) * j // 4:len(rest) * (j + 1) // 4] for j in range(4)]
        masks = [sum(1 << i for i in bits) for bits in cut]
        out.append([m - (1 << 64) if m >> 63 else m for m in masks])
    return out


def _without_chance(big: DataFrame, max_bits: int) -> DataFrame:
    """Members of buckets of over four, without those that have no partner there.

    A bucket's members agree in two blocks; two of them within three bits also
    agree in one of four parts of the other bits.  A member goes if in each
    part it meets at most three others, and none of them is within ``max_bits``.
    """
    pair = F.shiftrightunsigned("key", _KEY_BITS).cast("int") + 1
    stays = F.lit(False)
    for j, masks in enumerate(zip(*_sub_masks())):
        mask = F.element_at(F.array(*[F.lit(m).cast("long") for m in masks]), pair)
        big = big.withColumn(f"part{j}", F.col("fp").bitwiseAND(mask))
        sub = Window.partitionBy("key", f"part{j}")
        stays = stays | (F.count("*").over(sub) > 4) | _near(sub.orderBy("id"), max_bits)
    return _with_least(big.withColumn("stays", stays).where("stays").select("key", "id", "fp"))


def _candidates(lines: DataFrame, max_bits: int) -> DataFrame:
    """``key, id, fp, n, least, least_fp`` of lines that share a bucket with a line that may be near, written once.

    A bucket of up to four is settled here: a member stays only if another one is
    within ``max_bits`` (its three neighbours on either side are all there are).
    Larger buckets are cut finer (``_without_chance``).
    """
    if max_bits > 3:
        raise ValueError("five blocks taken two at a time find up to three differing bits")

    def block(first: int, width: int) -> Column:
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))

    keys = [F.lit(t << _KEY_BITS).bitwiseOR(F.shiftleft(block(*x), y[1])).bitwiseOR(block(*y))
            for t, (x, y) in enumerate(combinations(_BLOCKS, 2))]
    side = Window.partitionBy("key").orderBy("id")
    rows = lines.select("id", "fp", F.explode(F.array(*keys)).alias("key"))
    # most buckets hold one line: they go before the wider windows, which reuse this sort
    rows = rows.withColumns({"before": F.lag("fp").over(side), "after": F.lead("fp").over(side)})
    rows = _with_least(rows.where("before is not null or after is not null").drop("before", "after"))
    rows = rows.withColumn("near", _near(side, max_bits)).where((F.col("n") > 4) | F.col("near"))
    rows = materialise(rows.select("key", "id", "fp", "n", "least", "least_fp"), "line-buckets")
    big = _without_chance(rows.where("n > 4"), max_bits).select(*rows.columns)
    return materialise(rows.where("n <= 4").union(big), "line-neighbours")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs ``(x, y)`` of line ids whose normalised texts are similar enough."""
    t = lambda n: texts.select(F.col("id").alias(n), F.col("norm").alias(f"norm_{n}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = pa.array([edit_similarity(p, q, least) for p, q in zip(b.column(2).to_pylist(), b.column(3).to_pylist())],
                          pa.bool_())
            yield b.filter(ok).select(["x", "y"])

    both = pairs.join(t("x"), "x").join(t("y"), "y").select("x", "y", "norm_x", "norm_y")
    return both.mapInArrow(run, T.StructType([both.schema["x"], both.schema["y"]]))


def _texts(rows: DataFrame, text_col: str, out: str, want: DataFrame) -> DataFrame:
    """``id, norm`` of the lines ``want`` (``id, a, b``): one scan, filtered by a bitmap of fixed size before the shuffle."""
    bitmap = rows.sparkSession.sparkContext.broadcast(hash_bitmap(want, "a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = b.column(1)
            flat = items.flatten()
            a = flat.field("a").to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(in_bitmap(bitmap.value, a))
            off = items.offsets.to_numpy() - items.offsets[0].as_py()
            doc = np.searchsorted(off, hit, "right") - 1
            text, ks, bs = list(texts_of(b.column(0))), flat.field("k").to_numpy(), flat.field("b").to_numpy()
            seen: dict[tuple[int, int], str] = {}
            last, cut = -1, []
            for i, d in zip(hit.tolist(), doc.tolist()):
                key = (int(a[i]), int(bs[i]))
                if key not in seen:
                    if d != last:
                        last, cut = d, text[d].decode("utf-8", "replace").split("\n")
                    seen[key] = normalise(cut[ks[i]])
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.int64()),
                                              pa.array([k[1] for k in seen], pa.int64()),
                                              pa.array(list(seen.values()), pa.string())], ["a", "b", "norm"])

    found = rows.select(F.col(text_col).cast("binary"), out).where(F.size(out) > 0).mapInArrow(
        run, "a long, b long, norm string")
    return materialise(found.groupBy("a", "b").agg(F.first("norm").alias("norm")).join(want, ["a", "b"])
                       .select("id", "norm"), "line-texts")


def _first_key(p: str, q: str) -> Column:
    """The first pair of blocks on which two fingerprints agree: of the buckets they share, the one that gives the pair."""
    differ = F.col(p).bitwiseXOR(F.col(q))
    first = F
    for t, pair in enumerate(combinations(_BLOCKS, 2)):
        mask = sum(((1 << width) - 1) << start for start, width in pair)
        agree = differ.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)) == 0
        first = first.when(agree, t)
    return first


def _open_pairs(open_: DataFrame, max_bits: int) -> DataFrame:
    """``x, y`` of near lines of different ``comp``: each pair from one of the buckets it shares, or from none if it is of that one's star."""
    p = open_.select("key", "least", F.col("id").alias("x"), F.col("fp").alias("fx"), F.col("comp").alias("cx"))
    q = open_.select("key", F.col("id").alias("y"), F.col("fp").alias("fy"), F.col("comp").alias("cy"))
    apart = (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & (F.bit_count(F.col("fx").bitwiseXOR(F.col("fy"))) <= max_bits)
    once = (F.col("x") != F.col("least")) & (_first_key("fx", "fy") == F.shiftrightunsigned("key", _KEY_BITS))
    return p.join(q, "key").where(apart & once).select("x", "y")


def line_groups(rows: DataFrame, text_col: str, out: str, max_bits: int, least: float) -> DataFrame:
    """``a, b, comp`` of the distinct lines that are linked to another one."""
    lines = rows.select(F.explode(out).alias("l")).select("l.a", "l.b", "l.fp").distinct()
    lines = materialise(lines.withColumn("id", F.monotonically_increasing_id()), "line-ids")
    buckets = _candidates(lines, max_bits)
    release_shuffles(rows.sparkSession)
    # all that follows needs only the few lines left in a bucket: they are found in one pass, and their texts in one scan
    ids = materialise(buckets.select("id").distinct().withColumn("h", F.xxhash64("id")), "line-near-ids")
    maybe = maybe_among(ids, "h")
    lines = materialise(lines.select("id", "a", "b").where(maybe(F.xxhash64("id"))).join(ids.select("id"), "id"), "line-near")
    texts = _texts(rows, text_col, out, lines)
    close = lambda p, q: F.bit_count(F.col(p).bitwiseXOR(F.col(q))) <= max_bits
    stars = (buckets.where((F.col("id") != F.col("least")) & close("fp", "least_fp"))
             .select(F.col("least").alias("x"), F.col("id").alias("y")).distinct())
    stars = materialise(stars, "line-candidates")
    first = materialise(_verified(stars, texts, least), "line-pairs")
    comps = connected_components(first, "line-stars")
    # what the stars left apart: members of one bucket in different groups
    open_ = buckets.where("n > 2").join(comps, F.col("id") == F.col("node"), "left").select(
        "key", "id", "fp", "least", F.coalesce("comp", "id").alias("comp"))
    w = Window.partitionBy("key")
    open_ = materialise(open_.withColumns({"c0": F.min("comp").over(w), "c1": F.max("comp").over(w)})
                        .where("c0 <> c1").select("key", "id", "fp", "least", "comp"), "line-open")
    rest = materialise(_open_pairs(open_, max_bits).join(stars, ["x", "y"], "left_anti"), "line-candidates")
    second = materialise(_verified(rest, texts, least), "line-pairs")
    release_shuffles(rows.sparkSession)
    if not second.isEmpty():
        comps = connected_components(first.union(second), "line-groups")
    return lines.join(comps, F.col("id") == F.col("node")).select("a", "b", "comp")


def _chunk(row: Column) -> Column:
    return F.shiftright(row, 8)


def _by_task(gone: DataFrame) -> DataFrame:
    """``row, gone`` as ``part, gone_of``: the lists of a task's documents, by chunks of 256 row ids and by row id.

    A map is searched from its start, so there are two small ones instead of one.
    """
    chunks = gone.groupBy(_chunk(F.col("row")).alias("chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct("row", "gone"))).alias("of"))
    return chunks.groupBy(F.shiftright("chunk", _ROW_BITS - 8).alias("part")).agg(
        F.map_from_entries(F.collect_list(F.struct("chunk", "of"))).alias("gone_of"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS,
                min_similarity: float = MIN_SIMILARITY, counts: bool = False) -> DataFrame:
    """``docs`` with repeated lines removed from ``text_col``; with ``counts`` also ``n_lines, n_removed``."""
    out, row, part = fresh(docs, "lines_"), fresh(docs, "row_"), fresh(docs, "part_")
    rows = line_table(docs, text_col, out, row, part)
    groups = line_groups(rows, text_col, out, max_bits, min_similarity)
    at = rows.select(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row)).alias("doc"), F.col(row).alias("row"),
                     F.explode(out).alias("l")).select(
        "l.a", "l.b", F.struct("doc", "l.k").alias("at"), "row", F.col("l.k").alias("k"))
    # first occurrence of each group: per line first (combined on the map side), then per group
    firsts = at.groupBy("a", "b").agg(F.min("at").alias("at"), F.count("*").alias("n"))
    release_shuffles(docs.sparkSession)
    named = materialise(firsts.join(groups, ["a", "b"], "left").where("n > 1 or comp is not null"), "line-firsts")
    of_group = named.where("comp is not null").groupBy("comp").agg(F.min("at").alias("first"))
    stays = (named.where("comp is null").select("a", "b", F.col("at").alias("first"))
             .union(named.join(of_group, "comp").select("a", "b", "first")))
    # lines that occur once and are like no other are kept out of the shuffle by a bitmap of fixed size
    repeated = maybe_among(named, "a")
    gone = (at.where(repeated("a")).join(stays, ["a", "b"]).where("at <> first")
            .groupBy("row").agg(F.collect_list("k").alias("gone")))  # at most a document's own lines
    gone_part, gone_of, gone_k = (fresh(rows, x) for x in ("gone_part", "gone_of", "gone_k"))
    gone = materialise(_by_task(gone).toDF(gone_part, gone_of), "line-gone")
    release_shuffles(docs.sparkSession)
    # texts are not shuffled: their table is bucketed by the task, so the lists go to the texts
    joined = rows.drop(out).join(gone.hint("shuffle_hash"), F.col(part) == F.col(gone_part), "left")
    joined = joined.select(*docs.columns, F.try_element_at(F.try_element_at(gone_of, _chunk(F.col(row))), F.col(row)).alias(gone_k))
    text, cut = F.col(text_col), F.split(F.col(text_col), "\n")
    kept = F.array_join(F.filter(cut, lambda x, i: ~F.array_contains(gone_k, i)), "\n")
    new = F.when(F.col(gone_k).isNull() | text.isNull(), text).otherwise(kept)
    cols = [new.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if counts:
        cols += [F.coalesce(F.size(cut), F.lit(0)).cast("long").alias("n_lines"),
                 F.when(F.col(gone_k).isNull(), 0).otherwise(F.size(gone_k)).cast("long").alias("n_removed")]
    return joined.select(*cols)
