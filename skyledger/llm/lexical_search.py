"""Exact top-k lexical search by the Best Position Algorithm over impact-ordered lists.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII;
only A-Z are lower-cased.  A document of ``n`` terms gives a term with ``tf`` occurrences the impact
``w * ((10**9 * tf) div (1000 * tf + 20 * m))`` with ``m = 50 + (50 * n * N) div L`` and
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``; ``N``, ``L`` and ``df`` are counted over all documents.
A score is the sum of the impacts of the item's terms, each once.

At scale:

* The items are searched in blocks of about ``item_bytes`` of distinct text, so what travels to the tasks
  (vocabulary and term lists of a block) does not grow with the number of items.
* One pass over the documents writes each one's length and its postings for the block's terms.
  Counts come from that table: ``N`` and ``L`` by an aggregate, ``df`` per term of the block.
* Tasks take the postings in blocks of ``block_docs`` documents.  In a block each term has a
  list in descending impact; an item's lists are read in parallel, every document met is looked up
  in all of the item's lists at once (direct access), and its positions there count as seen.  The best position of a
  list ends its longest wholly seen prefix.  No unseen document can score more than the sum of the
  impacts at the best positions (0 for a list seen to its end), and reading stops once that sum is
  strictly below the k-th score, so equal scores are never lost.  The k-th score is carried from block to block of a task.
* A task returns at most ``k`` documents an item; they are ranked in two steps (salted by document, then per item),
  both with Spark's map-side group limit.

Defined cases: null texts have no terms; documents without terms count in neither ``N`` nor ``L``;
items without terms find nothing; equal scores rank by ascending id, null ids last; repeated documents take a
rank each; every row of ``items`` gets its own ranking, repeated ones too; an empty table
on either side gives an empty result.  Other columns are ignored, so their names do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, texts_of

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c if c in _KEEP or c >= 0x80 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_SALTS = 64


def terms_of(text: bytes) -> list[bytes]:
    """Terms of one UTF-8 text in order, with repeats."""
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def postings(docs: DataFrame, vocabulary: dict[bytes, int], chunk_terms: int = 1 << 20) -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term; ``terms`` are those of the vocabulary, each once.

    ``docs`` has the columns ``id`` and ``text`` (binary).  Long texts are counted in one go each,
    short ones together up to ``chunk_terms`` terms.
    """
    schema = T.StructType([docs.schema["id"], T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.IntegerType()))])
    size = len(vocabulary)

    def count(rows: list[int], found: list[np.ndarray], lengths: list[int], ids: pa.Array) -> pa.RecordBatch:
        which = np.concatenate([np.full(len(f), i, np.int64) for i, f in enumerate(found)])
        key, tf = np.unique(which * size + np.concatenate(found), return_counts=True)
        offsets = np.searchsorted(key, np.arange(len(rows) + 1, dtype=np.int64) * size).astype(np.int32)
        term = (key % max(size, 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(rows)), pa.array(lengths, pa.int64()),
             pa.ListArray.from_arrays(offsets, term), pa.ListArray.from_arrays(offsets, tf.astype(np.int32))],
            schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for b in batches:
            ids, col = b.column(0), b.column(1)
            rows: list[int] = []
            found: list[np.ndarray] = []
            lengths: list[int] = []
            held = 0
            for i, text in enumerate(texts_of(col)):
                words = terms_of(text)
                if not words:
                    continue
                f = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                rows.append(i)
                lengths.append(len(words))
                found.append(f[f >= 0])
                held += len(words)
                if held >= chunk_terms:
                    yield count(rows, found, lengths, ids)
                    rows, found, lengths, held = [], [], [], 0
            if rows:
                yield count(rows, found, lengths, ids)

    return docs.select("id", "text").mapInArrow(run, schema)


class Lists:
    """Impact-ordered lists of one block of documents, with direct access by document.

    Documents are numbered ``0 .. n - 1`` in the order that breaks ties.  ``start[t] .. start[t + 1]`` is term
    ``t``'s part of all arrays: ``doc`` and ``impact`` in descending impact, ``by_doc`` the same documents
    ascending, and ``place`` the position in the impact order of each of those.
    """

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int):
        keep = impact > 0
        term, doc, impact = term[keep], doc[keep], impact[keep]
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.start = np.searchsorted(term, np.arange(n_terms + 1))
        back = np.lexsort((self.doc, term))
        self.by_doc, self.place = self.doc[back], back - self.start[term[back]]
        self.n_docs = int(doc.max()) + 1 if len(doc) else 0

    def top(self, terms: np.ndarray, k: int, floor: int = 0, step: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents of the block and their scores; those below ``floor`` may be left out."""
        parts = [(s, e) for s, e in zip(self.start[terms].tolist(), self.start[terms + 1].tolist()) if e > s]
        lists = [(self.doc[s:e], self.impact[s:e], self.by_doc[s:e], self.place[s:e], np.zeros(e - s, bool))
                 for s, e in parts]
        best = [0] * len(lists)  # length of the wholly seen prefix of each list
        known = np.zeros(self.n_docs, bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth = 0
        while lists:
            met = np.concatenate([doc[depth:depth + step] for doc, *_ in lists])  # sorted access, all lists alike
            new = np.unique(met[~known[met]])
            depth += step
            known[new] = True
            score = np.zeros(len(new), np.int64)
            for doc, impact, by_doc, place, seen in lists:  # direct access
                at = np.minimum(np.searchsorted(by_doc, new), len(by_doc) - 1)
                hit = by_doc[at] == new
                p = place[at[hit]]
                score[hit] += impact[p]
                seen[p] = True
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, score])
            if len(docs) > 4 * k:
                docs, scores = _best(docs, scores, k)
            limit = 0
            for i, (_, impact, _, _, seen) in enumerate(lists):
                rest = seen[best[i]:]
                gap = int(rest.argmin()) if len(rest) else 0
                best[i] += len(rest) if len(rest) and rest[gap] else gap
                limit += int(impact[best[i] - 1]) if best[i] < len(seen) else 0
            if limit == 0:
                break
            kth = max(floor, int(np.partition(scores, -k)[-k])) if len(scores) >= k else floor
            if limit < kth:
                break
            step = min(2 * step, 4096)
        docs, scores = _best(docs, scores, k)
        ok = scores >= max(floor, 1)
        return docs[ok], scores[ok]


def _best(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def _search(rows: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int,
            k: int, block_docs: int) -> DataFrame:
    """At most k candidates ``item, id, score`` of every item and task."""
    id_type = rows.schema["id"]
    schema = T.StructType([T.StructField("item", T.IntegerType()), id_type, T.StructField("score", T.LongType())])

    def block(ids: list, n: np.ndarray, size: np.ndarray, term: np.ndarray, tf: np.ndarray,
              top: list[list[tuple]]) -> None:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        m = 50 + 50 * n * n_docs // n_terms
        doc = np.repeat(np.arange(len(ids)), size)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        lists = Lists(term, rank[doc], impact, len(weights))
        for i, terms in enumerate(items):
            have = top[i]
            floor = have[-1][0] if len(have) == k else 0
            docs, scores = lists.top(terms, k, floor)
            if len(docs):
                have += [(s, ids[order[d]]) for s, d in zip(scores.tolist(), docs.tolist())]
                have.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                del have[k:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[list[tuple]] = [[] for _ in items]
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            ids, n, terms, tfs = (t.column(c).combine_chunks() for c in range(4))
            block(ids.to_pylist(), n.to_numpy(), pc.list_value_length(terms).to_numpy(),
                  terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64), top)
            held.clear()

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= block_docs:
                flush()
        if held:
            flush()
        for i, have in enumerate(top):
            if have:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(have), pa.int32()), pa.array([d for _, d in have], b_type),
                     pa.array([s for s, _ in have], pa.int64())], schema.fieldNames())

    from pyspark.sql.pandas.types import to_arrow_type
    b_type = to_arrow_type(id_type.dataType)
    return rows.where(F.size("terms") > 0).select("id", "n", "terms", "tfs").mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", item_bytes: int = 8 << 20,
           block_docs: int = 8192) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents with a score above 0 of every row of ``items``."""
    spark = docs.sparkSession
    corpus = docs.select(F.col(doc_id).alias("id"), F.col(doc_text).cast("binary").alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    asked = asked.withColumn("key", F.sha2("text", 256)).where("text IS NOT NULL")
    texts = materialise(asked.select("key", "text").dropDuplicates(["key"]), "search-items")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // item_bytes)
    found = None
    for n in range(blocks):
        mine = texts.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == n).orderBy("key").collect()  # item_bytes or so
        vocabulary: dict[bytes, int] = {}
        wanted = [np.array(sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(bytes(r.text))}), np.int64)
                  for r in mine]
        rows = materialise(postings(corpus, vocabulary), "search-postings")
        n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term
            weights[term] = weight(n_docs, df)
        keys = spark.createDataFrame([(i, r.key) for i, r in enumerate(mine)], "item int, key string")
        part = _ranked(_search(rows, wanted, weights, n_docs, n_terms or 1, k, block_docs), k).join(keys, "item")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], T.StructType([
            asked.schema["item_id"], T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", corpus.schema["id"].dataType), T.StructField("score", T.LongType())]))
    return asked.select("item_id", "key").join(found, "key").select(
        "item_id", "rank", F.col("id").alias("doc_id"), "score")


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each item with their rank, first per salt, then per item."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("id"), F.lit(_SALTS))
    near = candidates.withColumn("salt", salt)
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(
        F.col("rank") <= k).drop("salt", "rank")
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(
        F.col("rank") <= k)
