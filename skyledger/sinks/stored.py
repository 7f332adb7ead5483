"""Stored tables: partitioned Parquet folders with a declared schema and restartable partition swaps.

A table is a folder of partition folders.  Beside them lie

* ``_schema.json``: the declared schema (U5).  Every read goes through it, so a new column shows as NULL in partitions
  written before it existed and a dropped column is gone from all of them;
* ``_swap-*.json``: redo notes.  A change first writes its new partitions completely to a stage folder, then
  leaves a note that names the stage, the partitions to replace and those to drop, and only then touches the
  table.  A run that dies in between leaves the note; the next read or change completes it
  (``complete_swaps``), so no partition is lost between its deletion and its replacement.

Names that start with ``_`` are invisible to Spark's readers.  All file work goes through the path's own Hadoop file system and is
metadata only, on a bounded list of partitions; rows are read and written by Spark.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Surrogate keys are hexadecimal: entropy coding halves them, where snappy finds nothing to repeat.
CODEC = "zstd"


# ── files ────────────────────────────────────────────────────────────────────

def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    return spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(p), "UTF-8")


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, or copy and delete between two file systems."""
    s, sfs = _path(spark, source)
    t, tfs = _path(spark, target)
    if sfs.getUri().equals(tfs.getUri()):
        if not sfs.rename(s, t):
            raise OSError(f"cannot rename {source} to {target}")
    else:
        conf = spark._jsc.hadoopConfiguration()
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(sfs, s, tfs, t, True, True, conf)


# ── reading ──────────────────────────────────────────────────────────────────

def partitions(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the partition folders of ``col`` in ascending order, from the file listing; the null partition is left out."""
    found = [unquote(n.split("=", 1)[1]) for n in names(spark, path) if n.startswith(f"{col}=")]
    return sorted(v for v in found if v != NULL_PARTITION)


def declared_schema(spark: SparkSession, path: str) -> T.StructType | None:
    f = f"{path}/_schema.json"
    return T.StructType.fromJson(json.loads(_read_text(spark, f))) if exists(spark, f) else None


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table under its declared schema (all files' columns if none was declared); None if there is no partition yet."""
    complete_swaps(spark, path)
    if not any(not n.startswith(("_", ".")) for n in names(spark, path)):
        return None
    schema = declared_schema(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(schema).parquet(path)


# ── changing ─────────────────────────────────────────────────────────────────

def declare(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """From now on the table has these columns."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    _write_text(spark, f"{path}/_schema.json", nullable.json())


def complete_swaps(spark: SparkSession, path: str) -> int:
    """Carry out what an interrupted run had noted; the number of notes found."""
    notes = [n for n in names(spark, path) if n.startswith("_swap-")]
    for n in notes:
        _carry_out(spark, path, f"{path}/{n}")
    return len(notes)


def _carry_out(spark: SparkSession, path: str, note: str) -> None:
    """Idempotent: a partition whose staged folder is gone was moved before."""
    todo = json.loads(_read_text(spark, note))
    for name in todo["drop"]:
        delete(spark, f"{path}/{name}")
    for name in todo["replace"]:
        staged = f"{todo['stage']}/{name}"
        if exists(spark, staged):
            delete(spark, f"{path}/{name}")
            _move(spark, staged, f"{path}/{name}")
    declare(spark, path, T.StructType.fromJson(todo["schema"]))
    delete(spark, note)
    delete(spark, todo["stage"])


def replace_partitions(spark: SparkSession, path: str, rows: DataFrame, part: str,
                       touched: Sequence | None = None) -> None:
    """Replace the partitions of ``rows`` (all their rows, new and kept); those of ``touched`` left without rows are dropped.

    ``touched=None`` replaces the whole table.  The columns of ``rows`` become the declared ones.
    """
    stage = scratch_path(spark, f"stage-{uuid.uuid4().hex}")
    rows.write.option("compression", CODEC).partitionBy(part).parquet(stage)
    fresh = [n for n in names(spark, stage) if "=" in n]
    if touched is None:
        old = [n for n in names(spark, path) if n.startswith(f"{part}=")]
    else:
        old = [f"{part}={NULL_PARTITION if v is None else quote(str(v), safe=' ')}" for v in touched]
    note = {"stage": stage, "replace": fresh, "drop": sorted(set(old) - set(fresh)),
            "schema": rows.schema.jsonValue()}
    file = f"{path}/_swap-{uuid.uuid4().hex}.json"
    _write_text(spark, file, json.dumps(note))
    _carry_out(spark, path, file)


def change_partitions(spark: SparkSession, path: str, source: DataFrame, part: str,
                      merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Rewrite the partitions that ``source`` touches as ``merge(stored rows, source)``.

    Only the touched partition values reach the driver (days or months of an increment); as literals they prune
    the read, so untouched partitions are neither read nor written.  ``source`` is written once first, as it is read three times.
    """
    from ..operators.incremental import materialize
    source = materialize(source)
    touched = [r[0] for r in source.select(part).distinct().collect()]
    if not touched:
        return
    stored = read_table(spark, path)
    if stored is None:
        merged = source
    else:
        known = [v for v in touched if v is not None]
        pick = F.col(part).isin(known) if known else F.lit(False)
        merged = merge(stored.filter(pick | F.col(part).isNull() if None in touched else pick), source)
    replace_partitions(spark, path, merged.hint("rebalance", part), part, touched)


def merge_table(spark: SparkSession, path: str, source: DataFrame, part: str, key: str = "surrogate_key") -> None:
    """U1 (+U5): the increment's rows replace the stored rows of their key; its columns become the table's."""
    from ..operators.incremental import merge_upsert
    change_partitions(spark, path, source, part, lambda old, new: merge_upsert(old, new, key))


def upsert_table(spark: SparkSession, path: str, source: DataFrame, part: str, keys: Sequence[str],
                 keep_cols: Sequence[str] = ()) -> None:
    """K3/K4 on a stored table: ON CONFLICT (keys) DO UPDATE, but for ``keep_cols``; touched partitions only."""
    from .tables import upsert_on_conflict
    change_partitions(spark, path, source, part,
                      lambda old, new: upsert_on_conflict(old.select(*new.columns), new, keys, keep_cols))


def expire(spark: SparkSession, path: str, part: str, before: str) -> list[str]:
    """K6: drop the partition folders whose value is below ``before`` (ISO text sorts as time); the values dropped.

    No row is read: the folder list decides.
    """
    complete_swaps(spark, path)
    old = [v for v in partitions(spark, path, part) if v < before]
    for v in old:
        delete(spark, f"{path}/{part}={quote(v, safe=' ')}")
    return old
