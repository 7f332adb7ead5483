"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

A document's ids are those of a ``tokenizers`` file, then the end id.  Documents of more than ``capacity`` ids are
cut into pieces of ``capacity`` ids, the last one shorter; nothing else is cut.  Full pieces are sequences of their own.

The algorithm, per block of about ``block`` pieces: an individual is a list of bins (groups of pieces).  Crossover
injects the well-filled bins of one parent whole into the other, removes the bins that hold a piece twice, and
best-fits the displaced pieces, largest first, into what is left.  Fitness is the mean squared fill, so that free
space gathers in few bins.  Each block is evolved on several islands (rows of their own, with their own random
start); after every epoch an island's elite migrates to the next island of its block.  An epoch ends early
on an island whose best individual reaches the bound ``ceil(tokens / capacity)`` with all bins but one full.

At scale: pieces are dealt to blocks by a hash, so each block is bounded and a task holds one block's lengths
(two bytes a piece), whatever the corpus.  Bins that are left with free space at a level, a few a block, are opened
and their pieces dealt to fewer blocks at the next level, until one block holds them all; the free space allowed to a
closed bin doubles with every level, so levels are at most ``log2(capacity)``.  Texts are read once; what
is written and shuffled are rows of a few dozen bytes a piece.

Defined cases: a null or empty text is one piece with the end id alone; repeated rows are pieces of their own; an empty table
gives an empty result; very long texts become many full pieces; null ids are ids like any other.  Other columns are
ignored.  Special tokens' strings in a text are read as the tokenizer's file says.
"""

from __future__ import annotations

import functools
import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise

CACHE_WORDS = 800_000  # encoded words kept per worker: the first ones met

# Letters that the normaliser leaves alone (but for their case) and the splitter takes as one word: a run of them
# goes to the model at once.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u4e00-\u9fa5]+")
# Byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on in order.
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_BYTE_CHARS = {b: 256 + n for n, b in enumerate(_OTHERS)}


class _Words(dict):
    """Packed ids of words; encodes what it does not know yet and keeps it while there is room."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model

    def __missing__(self, word: str) -> bytes:
        if word[-1:] in (".", ",") and word[-2:-1].isalpha():
            ids = self[word[:-1]] + self[word[-1]]
        elif _LETTERS.fullmatch(word):
            low = word.lower()
            ids = self[low] if low != word else array("I", [t.id for t in self.model.tokenize(
                low if low.isascii() else low.encode().decode("latin-1").translate(_BYTE_CHARS))]).tobytes()
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(self) < CACHE_WORDS:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts as unsigned 32-bit integers in the machine's order.

    With ``by_word`` texts are cut at spaces and line feeds and words are looked up: right for
    tokenizers that split at white space and drop it, split between a letter and a full stop or comma, take a run of
    letters as one word and fold ASCII letters (``word_bpe`` does all four).
    """

    def __init__(self, path: str, by_word: bool):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer) if by_word else None

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.words is None:
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        get = self.words.__getitem__
        return [b"".join(map(get, t.replace("\n", " ").split(" "))) for t in texts]


@functools.lru_cache(maxsize=2)
def encoder(path: str, by_word: bool) -> Encoder:
    """One encoder a worker process: tasks that follow find its words encoded."""
    return Encoder(path, by_word)


def pieces(docs: DataFrame, path: str, capacity: int, end: int, by_word: bool = True,
           chunk_chars: int = 1 << 21) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of all pieces; ``docs`` has the columns ``doc_id`` and ``text``."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.IntegerType()),
                           T.StructField("ids_crc32", T.LongType())])
    last = np.array([end], "<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, by_word)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            chars = np.cumsum([len(t) for t in texts]) // chunk_chars
            for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(chars)) + 1):
                row, piece, length, crc = [], [], [], []
                for i, ids in zip(rows.tolist(), encode([texts[i] for i in rows])):
                    if sys.byteorder == "big":
                        ids = np.frombuffer(ids, np.uint32).astype("<u4").tobytes()
                    ids += last
                    for n, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        row.append(i)
                        piece.append(n)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                if row:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row)), pa.array(piece, pa.int32()),
                         pa.array([n * capacity for n in piece], pa.int64()), pa.array(length, pa.int32()),
                         pa.array(crc, pa.int64())], schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Packing:
    """One individual: bins of item numbers and their loads."""

    def __init__(self, bins: list[list[int]], loads: list[int]):
        self.bins, self.loads = bins, loads

    def fitness(self, capacity: int) -> float:
        f = np.array(self.loads, float) / capacity
        return float((f * f).mean()) if len(f) else 1.0


def best_fit(size: list[int], items: list[int], capacity: int, bins: list[list[int]], loads: list[int]) -> Packing:
    """``items`` in the order given, each into the fullest bin that has room for it, else into a new one."""
    free = sorted((capacity - load, i) for i, load in enumerate(loads))
    for item in items:
        s = size[item]
        at = bisect_left(free, (s, -1))
        if at < len(free):
            left, i = free.pop(at)
            bins[i].append(item)
            loads[i] += s
        else:
            left, i = capacity, len(bins)
            bins.append([item])
            loads.append(s)
        if left > s:
            insort(free, (left - s, i))
    return Packing(bins, loads)


def crossover(size: list[int], capacity: int, donor: Packing, other: Packing, rng: np.random.Generator) -> Packing:
    """Well-filled bins of ``donor`` whole, the bins of ``other`` that share no piece with them, the rest by best fit."""
    load = np.array(donor.loads)
    # a random share of the bins, fullest first (equal loads in random order)
    order = np.lexsort((rng.random(len(load)), -load))
    chosen = order[:max(1, int(len(load) * rng.uniform(0.3, 0.9)))].tolist()
    bins = [list(donor.bins[i]) for i in chosen]
    loads = [donor.loads[i] for i in chosen]
    taken = {item for b in bins for item in b}
    displaced = []
    for b, n in zip(other.bins, other.loads):
        if taken.isdisjoint(b):
            bins.append(list(b))
            loads.append(n)
        else:
            displaced += [item for item in b if item not in taken]
    displaced.sort(key=lambda i: -size[i])
    return best_fit(size, displaced, capacity, bins, loads)


def mutate(size: list[int], capacity: int, p: Packing, rng: np.random.Generator) -> Packing:
    """The emptiest bins and a few others are opened and their pieces best-fitted in slightly shuffled order."""
    load = np.array(p.loads) - rng.integers(0, max(capacity // 8, 1), len(p.loads))
    opened = set(np.argsort(load)[:max(2, len(load) // 8)].tolist())
    bins = [list(b) for i, b in enumerate(p.bins) if i not in opened]
    loads = [n for i, n in enumerate(p.loads) if i not in opened]
    items = [x for i in opened for x in p.bins[i]]
    noise = dict(zip(items, rng.uniform(0.8, 1.2, len(items)).tolist()))
    items.sort(key=lambda i: -size[i] * noise[i])
    return best_fit(size, items, capacity, bins, loads)


def evolve(size: list[int], capacity: int, start: list[Packing], population: int, children: int,
           rng: np.random.Generator) -> list[Packing]:
    """One epoch on one island: the population after ``children`` offspring, fittest first."""
    every = list(range(len(size)))
    alive = list(start)
    while len(alive) < population:
        noise = rng.uniform(0.7, 1.3, len(size)) if alive else np.ones(len(size))
        alive.append(best_fit(size, sorted(every, key=lambda i: -size[i] * noise[i]), capacity, [], []))
        if _ideal(alive[-1], capacity):
            break
    alive.sort(key=lambda p: -p.fitness(capacity))
    for _ in range(children):
        if _ideal(alive[0], capacity):
            break
        a, b = (alive[int(i)] for i in rng.permutation(len(alive))[:2]) if len(alive) > 1 else (alive[0], alive[0])
        child = crossover(size, capacity, a, b, rng)
        if rng.random() < 0.5 or len(alive) == 1:
            child = mutate(size, capacity, child, rng)
        alive.append(child)
        alive.sort(key=lambda p: -p.fitness(capacity))
        del alive[population:]
    return alive


def _ideal(p: Packing, capacity: int) -> bool:
    """All bins but one are full: no packing is better."""
    return sum(n < capacity for n in p.loads) <= 1


def _flat(p: Packing, n: int) -> bytes:
    """Bin number of every item."""
    out = np.zeros(n, np.int32)
    for k, b in enumerate(p.bins):
        out[b] = k
    return out.tobytes()


def _unflat(raw: bytes, size: np.ndarray) -> Packing:
    k = np.frombuffer(raw, np.int32)
    order = k.argsort(kind="stable")
    bins = [b.tolist() for b in np.split(order, np.flatnonzero(np.diff(k[order])) + 1)]
    return Packing(bins, [int(size[b].sum()) for b in bins])


_ISLAND = "blk long, island int, sizes binary, elite binary, guest binary"


def _epoch(blocks: DataFrame, capacity: int, population: int, children: int, seed: int) -> DataFrame:
    """Every island evolved from its elite and its guest (both may be null); the new elite in ``elite``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                size = np.frombuffer(r["sizes"], np.int32)
                start = [_unflat(x, size) for x in (r["elite"], r["guest"]) if x is not None]
                rng = np.random.default_rng([seed, r["blk"], r["island"]])
                best = evolve(size.tolist(), capacity, start, population, children, rng)[0]
                yield pa.RecordBatch.from_pylist([r | {"elite": _flat(best, len(size)), "guest": None}], b.schema)

    return blocks.select(*(c.split()[0] for c in _ISLAND.split(", "))).mapInArrow(run, _ISLAND)


def _settle(blocks: DataFrame, capacity: int, slack: int) -> DataFrame:
    """``blk, idx, bin, offset, closed`` of every item under the block's fittest elite."""
    schema = "blk long, idx int, bin int, offset int, closed boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                size = np.frombuffer(r["sizes"], np.int32)
                best = max((_unflat(x, size) for x in r["elites"]), key=lambda p: p.fitness(capacity))
                idx = [i for x in best.bins for i in x]
                bins = [k for k, x in enumerate(best.bins) for _ in x]
                at = [o for x in best.bins for o in np.concatenate([[0], size[x].cumsum()[:-1]]).tolist()]
                closed = [capacity - best.loads[k] <= slack for k in bins]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["blk"]] * len(idx), pa.int64()), pa.array(idx, pa.int32()), pa.array(bins, pa.int32()),
                     pa.array(at, pa.int32()), pa.array(closed)], ["blk", "idx", "bin", "offset", "closed"])

    return blocks.select("blk", "sizes", "elites").mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int = 4096, block: int = 4096, islands: int = 2, epochs: int = 2,
         population: int = 4, children: int = 8, slack: int = 1) -> DataFrame:
    """``items`` (columns ``length`` and ``uid``, a unique long, and others) with ``sequence_id`` and ``offset``.

    ``slack``: free space of a bin that is closed at the first level; twice that at each further level.
    """
    spark = items.sparkSession
    most = 16 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    full = items.where(F.col("length") == capacity).withColumn("sequence_id", -F.col("uid") - 1).withColumn(
        "offset", F.lit(0).cast("long"))
    done = [full]
    open_ = items.where(F.col("length") < capacity)
    level = 0
    while n := open_.count():
        n_blocks = -(-n // block)
        last = n_blocks == 1
        w = Window.partitionBy("blk").orderBy(F.col("length").desc(), "uid")
        dealt = materialise(
            open_.withColumn("blk", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(n_blocks)))
            .withColumn("idx", (F.row_number().over(w) - 1).cast("int")), "pack-items")
        sizes = dealt.groupBy("blk").agg(F.sort_array(F.collect_list(F.struct("idx", "length"))).alias("l")).select(
            "blk", F.col("l.length").alias("l"))  # about ``block`` lengths
        state = _with_sizes(sizes).select("blk", F.explode(F.array(*map(F.lit, range(islands)))).alias("island"), "sizes",
                                          F.lit(None).cast("binary").alias("elite"), F.lit(None).cast("binary").alias("guest"))
        used = [dealt]
        for e in range(epochs):
            # as many tasks as islands (up to ``most``): rows are small, the work on each is not
            state = materialise(_epoch(state.repartition(min(n_blocks * islands, most), "blk", "island"), capacity,
                                       population, children, level * epochs + e), "pack-islands")
            used.append(state)
            if e + 1 < epochs:  # the elite of each island moves on to the next one
                guests = state.select("blk", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                                      F.col("elite").alias("guest"))
                state = state.drop("guest").join(guests, ["blk", "island"])
        best = state.groupBy("blk").agg(F.first("sizes").alias("sizes"), F.collect_list("elite").alias("elites"))
        placed = dealt.join(_settle(best, capacity, capacity if last else slack), ["blk", "idx"])
        placed = materialise(
            placed.withColumn("sequence_id", F.lit(level) * F.lit(1 << 56) + F.col("blk") * F.lit(1 << 20) + F.col("bin"))
            .withColumn("offset", F.col("offset").cast("long")), "pack-placed")
        for df in used:
            discard(df)
        done.append(placed.where("closed").select(*items.columns, "sequence_id", "offset"))
        open_ = placed.where("NOT closed").select(*items.columns)
        level, slack = level + 1, min(2 * slack, capacity)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _with_sizes(sizes: DataFrame) -> DataFrame:
    """``blk, sizes``: lengths as packed 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [np.array(x, np.int32).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["blk", "sizes"])

    return sizes.mapInArrow(run, "blk long, sizes binary")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1, by_word: bool = True,
                   id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document."""
    cut = pieces(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), tokenizer, capacity, end, by_word)
    items = materialise(cut.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    return pack(items, capacity, **how).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
