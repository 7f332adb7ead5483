"""Training-data pipeline over ``documents``: five stages, each an operator of ``skyledger.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns what the next one reads;
``run`` writes each stage's rows to the shared checkpoint folder and reads them
again, so a lost executor costs one stage at most.  All stages but the last
return the columns of ``documents``; ``n_chars`` follows the text.  A stage's result must be written before the next
stage is called: that one deletes the intermediates it does not read.

Defined cases, in every stage: a null text counts as an empty one (quality rules reject both, as every text of under 20 words); null ids are
kept like any other; repeated rows are copies, of which near-dedup keeps one; an empty table gives an empty result with the same
columns; columns of any other name are carried along untouched, and may have the names of the operators' own columns.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, decontaminate, line_dedup, quality_rules, simhash_dedup
from skyledger.llm.common import delete_paths, fresh, intermediates, materialise, release_shuffles, table
from skyledger.session import apply_conf

_left: list[str] = []


def _stage(fn):
    """A stage: deletes what the stage before has left behind, as its result is written by now, and notes its own intermediates."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        read = docs.inputFiles()
        delete_paths(spark, [p for p in _left if not any(f"{p}/" in f for f in read)])
        release_shuffles(spark)
        with intermediates() as made:
            out = fn(spark, docs, sf_dir)
        _left[:] = made
        return out
    return run_stage


def _with_chars(docs: DataFrame) -> DataFrame:
    """``n_chars`` brought up to date, if the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go; documents that fail, or lose too much, go."""
    q = fresh(docs, "quality")
    judged = quality_rules.judge(docs, out=q)
    return _with_chars(judged.where(F.col(q)["kept"]).withColumn("text", F.col(q)["text"]).select(*docs.columns))


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar lines the first one stays; every document stays."""
    return _with_chars(line_dedup.dedup_lines(docs))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (3-word shingles, 2 bits)."""
    return simhash_dedup.keep_one(docs, shingle=3, radius=2)


@_stage
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), one_to_one=False)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' count and digest, and the digest of what they decode to."""
    return bpe.round_trip(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("decontamination", benchmark), ("byte-level bpe", tokens)]

#: Fingerprints, edit distances and merges are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    release_shuffles(spark)
    return docs
