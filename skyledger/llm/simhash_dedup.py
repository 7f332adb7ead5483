"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: the text's bytes with A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``, shingles of ``shingle`` words (repeats included,
joined by one space; a shorter text is one shingle), each hashed with XXH64
(seed 42).  A bit is 1 if it is set in over half of the hashes.  A text
without words (empty, null, white space) has fingerprint zero and links like
any other.

Links: every distinct fingerprint emits all fingerprints within half the
radius; two fingerprints within the radius share such a variant, since the
differing bits can be divided between them.  The shuffle is on the variant.  Members
of one variant's group are at most the ball's size (65 for radius 2),
because only distinct fingerprints are emitted: copies, however many, were
counted before.  For an even radius the triangle inequality links every
member to the group's smallest one, so each group gives a star, not all
pairs; colliding pairs are deduplicated and verified with ``bit_count``.

Nulls in other columns and clashing names do not matter (the operators read
id and text only); a null id never becomes a component's smallest id unless
all its ids are null; repeated rows stay repeated; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, fresh, give_back, materialise, texts_of, without

SEED = 42
_CHUNK = 1 << 16  # hashes whose bits are counted at once (64 bytes each)


def simhash(text: bytes, shingle: int) -> int:
    """The 64-bit fingerprint of one UTF-8 text (unsigned)."""
    words = text.lower().split()  # bytes: lower() and split() know ASCII only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(grams))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _CHUNK):
        bits = np.unpackbits(h[i:i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprints(df: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """``df`` and the fingerprint of ``text_col`` as a signed long in column ``out`` (a new name)."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(b.schema.get_field_index(text_col))
            fp = np.fromiter((simhash(t, shingle) for t in texts_of(col)), np.uint64, len(col)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], [*b.schema.names, out])
        give_back()

    return df.mapInArrow(run, schema)


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Linked pairs ``(a, b)`` among the distinct fingerprints of column ``fp``.

    Every two fingerprints within ``radius`` bits are connected through the
    returned pairs, and every returned pair is within ``radius`` bits.
    """
    half = (radius + 1) // 2
    masks = [sum(1 << i for i in c) for k in range(half + 1) for c in combinations(range(64), k)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    near = fps.select("fp").distinct().select(
        "fp", F.explode(F.transform(F.lit(signed), lambda m: m.bitwiseXOR(F.col("fp")))).alias("variant"))
    if radius % 2 == 0:
        least = F.min("fp").over(Window.partitionBy("variant"))
        pairs = near.select("fp", least.alias("a")).select("a", F.col("fp").alias("b")).where("a <> b")
    else:
        pairs = (near.select("variant", F.col("fp").alias("a"))
                 .join(near.select("variant", F.col("fp").alias("b")), "variant").where("a < b").select("a", "b"))
    return pairs.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp, component_id`` (smallest id reachable through links)."""
    rows = with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")),
                             "text", shingle).select("doc_id", "fp")
    rows = materialise(rows, "simhash-fps")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comps = connected_components(links(rows, radius), "simhash")
    named = distinct.join(comps, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("comp", "fp").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(smallest, "comp").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (nulls last; then by the text's hash, then by place).

    Texts are written once and then only filtered.  What is ranked and joined are narrow rows: per fingerprint one candidate
    (an aggregate with map-side combining, so a hot group of copies never meets in one task), per component one
    of those; the rows that go are found by their row id.
    """
    fp, row = fresh(docs, "fp"), fresh(docs, "row_")
    rows = materialise(with_fingerprints(docs.withColumn(row, F.monotonically_increasing_id()), text_col, shingle, fp),
                       "simhash-docs")
    narrow = rows.select(F.col(fp).alias("fp"), F.struct(F.col(id_col).isNull(), F.col(id_col).alias("id"),
                                                         F.xxhash64(text_col).alias("t"), F.col(row).alias("row")).alias("at"))
    first = materialise(narrow.groupBy("fp").agg(F.min("at").alias("at")), "simhash-firsts")
    comps = connected_components(links(first, radius), "simhash")
    # one fingerprint of each component stays: the one whose first row comes first
    named = first.join(comps, F.col("fp") == F.col("node"), "left").select(F.coalesce("comp", "fp").alias("comp"), "at")
    stays = named.groupBy("comp").agg(F.min("at").alias("at")).select(F.col("at.row").alias("stay"))
    gone = materialise(rows.select(F.col(row).alias("gone_row")).join(stays, F.col("gone_row") == F.col("stay"), "left_anti")
                       .withColumn("h", F.xxhash64("gone_row")), "simhash-gone")
    return without(rows, gone, F.xxhash64(row), F.col(row) == F.col("gone_row")).select(*docs.columns)
