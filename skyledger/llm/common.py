"""Helpers shared by the operators: written intermediates, connected components, Arrow text batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    This cuts lineage: a lost executor costs the running stage only, and
    several consumers read the files instead of computing the rows again.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for made in _made:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, tag: str, key: str) -> DataFrame:
    """The same as a table bucketed by ``key``: a join on it, or grouping by it, leaves these rows where they are.

    Best for a key that has one value in a task, which then writes one file.  The name leaves the catalog at once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    for made in _made:
        made.append(path)
    out = spark.table(name).select("*")
    spark.sql(f"DROP TABLE {name}")
    return out


_made: list[list[str]] = []


@contextmanager
def intermediates() -> Iterator[list[str]]:
    """The paths that ``materialise`` writes in the meantime."""
    made: list[str] = []
    _made.append(made)
    try:
        yield made
    finally:
        _made.remove(made)


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders, wherever they lie; missing ones do not matter."""
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files behind ``df`` (rows of ``materialise`` that nothing reads any more)."""
    delete_paths(df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()})


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files of finished phases now.

    The cleaner removes the files of plans that the driver's JVM has collected;
    a driver that is rarely short of memory would keep them to the end of the job.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base


def utf8_batch(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string/binary Arrow column, end to end, and the row offsets; null rows are empty."""
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def give_back() -> None:
    """At a task's end: return freed memory to the system, which the next task's worker or the JVM may need.

    A worker process lives on, and the allocators of Arrow and C keep what they freed.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def texts_of(col: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each row; null rows are empty."""
    buf, off = utf8_batch(col)
    raw = buf.tobytes()
    o = off.tolist()
    for a, b in zip(o, o[1:]):
        yield raw[a:b]


def connected_components(edges: DataFrame, tag: str) -> DataFrame:
    """Components of an undirected graph: ``(node, comp)``, comp = smallest node of the component.

    ``edges`` has two columns of one orderable type; direction, repeats and
    self-loops do not matter; nulls are ignored.  Only nodes with an edge come back.  Each
    round hooks every node to its smallest neighbour, follows that pointer
    twice more, and contracts the edges to the labels reached; a round drops
    all settled edges, so the graph shrinks geometrically.  ``min`` combines on
    the map side, so a node with very many links costs one row per map task;
    joins have one unique side, and AQE splits a hot key of the other.  Only the count of open edges
    reaches the driver.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = materialise(e.union(e.select("v", "u")).distinct(), f"{tag}-edges")
    total = None
    while True:
        p = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p"))
        for _ in range(2):
            nxt = p.select(F.col("u").alias("q"), F.col("p").alias("pp"))
            p = p.join(nxt, F.col("p") == F.col("q")).select("u", F.col("pp").alias("p"))
        p = materialise(p, f"{tag}-parents")
        total = p if total is None else (
            total.join(p.select(F.col("u").alias("q"), F.col("p").alias("pp")), F.col("p") == F.col("q"), "left")
            .select("u", F.coalesce("pp", "p").alias("p")))
        pu, pv = p.select("u", F.col("p").alias("pu")), p.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        e = materialise(e.join(pu, "u").join(pv, "v").where("pu <> pv")
                        .select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), f"{tag}-edges")
        release_shuffles(spark)
        if e.isEmpty():
            return materialise(total.select(F.col("u").alias("node"), F.col("p").alias("comp")), f"{tag}-components")


BITMAP_BITS = 25


def hash_bitmap(df: DataFrame, col: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of ``2 ** bits`` bits in which the low bits of every hash in ``col`` are set.

    Its size is fixed (4 MB for 25 bits), whatever the number of hashes: it is
    combined by ``bit_or`` on the executors and collected as at most ``2 ** (bits - 6)``
    words.  It is a filter in front of a join, never the join: rows it lets through
    by chance are dropped by the join, and no row with a hash of ``df`` is lost.
    """
    low = F.col(col).bitwiseAND(F.lit((1 << bits) - 1))
    words = (df.select(F.shiftright(low, 6).alias("w"), F.expr("1L").alias("one"),
                       low.bitwiseAND(F.lit(63)).cast("int").alias("b"))
             .groupBy("w").agg(F.expr("bit_or(shiftleft(one, b))").alias("v"))).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64)
    return out.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes may be in the bitmap."""
    low = hashes.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def maybe_among(few: DataFrame, col: str) -> Callable[..., Column]:
    """A test of hashes against a bitmap of those in ``few[col]``: true for all of them, and for some others by chance."""
    bitmap = few.sparkSession.sparkContext.broadcast(hash_bitmap(few, col))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bitmap.value, h.to_numpy(np.int64)))

    return maybe


def without(rows: DataFrame, gone: DataFrame, hashed: Column, on: Column) -> DataFrame:
    """``rows`` without those that the condition ``on`` finds in ``gone``, whose column ``h`` holds their hash ``hashed``.

    A bitmap of fixed size keeps the rows it does not know out of the join's shuffle: few texts travel if few rows go.
    """
    maybe = maybe_among(gone, "h")
    flag = fresh(rows, "maybe_")
    marked = rows.withColumn(flag, maybe(hashed))
    kept = marked.where(F.col(flag)).drop(flag).join(gone.drop("h"), on, "left_anti")
    return kept.unionByName(marked.where(~F.col(flag)).drop(flag))
