"""Lexical search, vector codes and packing against brute force."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm import lexical_search, packing, vector_codes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# ---- lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k):
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    terms = [(i, t) for i, t in terms if t]
    n_docs, n_terms = len(terms), sum(len(t) for _, t in terms)
    df = Counter(w for _, t in terms for w in set(t))
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for i, t in terms:
            tf, m = Counter(t), 50 + 50 * len(t) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * (10 ** 9 * tf[w] // (1000 * tf[w] + 20 * m)) for w in asked if tf[w])
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("block_docs, item_bytes", [(7, 40), (10_000, 1 << 20)])
def test_search_equals_brute_force(spark, docs, block_docs, item_bytes):
    rng = np.random.default_rng(3)
    words = ["alpha", "Beta", "gamma-ray", "ÉTÉ", "été", "x1", "中文", "the", "the", "the", "of", "of", "z\x00y"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 12)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " ,. "), (7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, None)]
    rows += [(100 + i, "alpha of the été") for i in range(9)] + [(200, "the " * 30_000 + "alpha")]
    items = [(1, "the alpha x1"), (2, "été 中文 ray"), (3, None), (4, "nothing here"), (1, "the alpha x1"), (None, "of"),
             (6, "z Y gamma"), (7, "")]
    table = docs(rows).withColumn("key", F.lit(1)).withColumn("N", F.lit("x")).withColumn("terms", F.lit(0))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(9)).withColumn("score", F.lit(1))
    for k in (3, 50):
        got = lexical_search.search(table, asked, k, item_bytes=item_bytes, block_docs=block_docs)
        assert found(got) == brute_search(rows, items, k)


def test_search_of_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert found(lexical_search.search(docs([]), items)) == []
    assert found(lexical_search.search(docs([(1, "a")]), items.limit(0))) == []
    assert found(lexical_search.search(docs([(1, None)]), items)) == []


def test_best_positions_stop_early_and_keep_ties():
    rng = np.random.default_rng(5)
    for n, n_terms in [(2000, 3), (50, 6), (1, 1)]:
        dense = rng.integers(0, 40, (n_terms, n)) * (rng.random((n_terms, n)) < 0.5) * 10 ** 6
        t, d = dense.nonzero()
        lists = lexical_search.Lists(t, d, dense[t, d], n_terms)
        docs, scores = lists.top(np.arange(n_terms), 10)
        want = sorted((-s, i) for i, s in enumerate(dense.sum(0).tolist()) if s)[:10]
        assert [(-s, i) for i, s in zip(docs.tolist(), scores.tolist())] == want


# ---- vector codes

def brute_codes(vectors, entries, rounds):
    """Plain integer k-means of the four parts; ``vectors`` in the order of ids."""
    x = np.array([[math.floor(1024 * float(np.float32(v))) for v in vec] for vec in vectors], np.int64)
    codes, books, err = [], [], np.zeros(len(x), np.int64)
    for part in np.split(x, 4, axis=1):
        c = part[:entries].copy()
        for r in range(rounds + 1):
            d = ((part[:, None, :] - c) ** 2).sum(2)
            a = d.argmin(1)
            if r < rounds:
                for e in set(a.tolist()):
                    c[e] = part[a == e].sum(0) // (a == e).sum()
        codes.append(a)
        books.append(c)
        err += d.min(1)
    return np.array(codes).T, books, err


def vectors_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, state int")


@pytest.mark.parametrize("n, entries", [(400, 32), (90, 256), (5, 4), (3, 1)])
def test_codes_equal_plain_kmeans(spark, n, entries):
    rng = np.random.default_rng(n)
    centers = rng.normal(size=(12, 8))
    x = (centers[rng.integers(0, 12, n)] + rng.normal(size=(n, 8)) * 0.2).astype(np.float32)
    x[n // 2] = x[0]  # repeated vectors
    if n > 50:
        x[40:80] = np.round(x[40:80])  # ties
    label = [None if i % 5 == 0 else i % 3 for i in range(n)]
    rows = [(i, v.tolist(), lab, "x", 1) for i, (v, lab) in enumerate(zip(x, label))]
    bad = [(-1, None, 1, None, None), (-2, [1.0, None] * 4, 1, "", 0), (-3, [math.nan] + [0.0] * 7, 2, "", 0),
           (-4, [math.inf] * 8, None, "", 0), (10 ** 6, [1.0], 1, "", 0), (-5, [], 1, "", 0)]
    out, books = vector_codes.compress(vectors_table(spark, rows[::-1] + bad).repartition(3), entries=entries)
    codes, want_books, err = brute_codes(x, entries, 4)
    assert [b.tolist() for b in books] == [b.tolist() for b in want_books]
    got = {r.id: r for r in out.collect()}
    assert sorted(got) == list(range(n))
    per = defaultdict(int)
    for i in range(n):
        per[label[i]] += int(err[i])
    for i in range(n):
        assert (list(got[i].code), got[i].error, got[i].label_error) == (codes[i].tolist(), err[i], per[label[i]])


def test_codes_of_empty_and_unfit_tables(spark):
    empty, books = vector_codes.compress(vectors_table(spark, []))
    assert empty.collect() == [] and books == []
    empty, _ = vector_codes.compress(vectors_table(spark, [(1, None, 1, "", 0), (2, [], 1, "", 0)]))
    assert empty.collect() == []
    with pytest.raises(ValueError):
        vector_codes.compress(vectors_table(spark, [(1, [1e15] * 4, 1, "", 0)]))


def test_repeated_and_null_ids(spark):
    rows = [(None, [9.0] * 4, 1, "", 0), (2, [1.0] * 4, 1, "", 0), (2, [0.5] * 4, None, "", 0), (2, [0.5] * 4, None, "", 0)]
    out, books = vector_codes.compress(vectors_table(spark, rows), entries=3)
    codes, want, err = brute_codes([[0.5] * 4, [0.5] * 4, [1.0] * 4, [9.0] * 4], 3, 4)
    assert [b.tolist() for b in books] == [b.tolist() for b in want]
    assert sorted((list(r.code), r.error) for r in out.collect()) == sorted(zip(codes.tolist(), err.tolist()))


def test_bounds_spare_distances():
    rng = np.random.default_rng(1)
    x = rng.integers(-900, 900, (3000, 4))
    c = x[:128].copy()
    b = vector_codes.Bounds.first(x, c, 16)
    for _ in range(5):
        new = c + rng.integers(-6, 7, c.shape)
        b.assign(x, new, vector_codes._up(((new - c) ** 2).sum(1)), 32)
        c = new
        assert (b.code == vector_codes.distances(x, c).argmin(1)).all()
        assert b.exact < 0.2 * len(x) * len(c)


# ---- packing

def check_packing(rows, docs, capacity):
    """Every document's pieces, and sequences without gaps; returns the number of sequences."""
    tok = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[i, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seq = defaultdict(list)
    for r in rows:
        seq[r.sequence_id].append((r.offset, r.length))
    for parts in seq.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1]
        assert sum(n for _, n in parts) <= capacity
    return len(seq), -(-sum(r.length for r in rows) // capacity)


@pytest.mark.parametrize("block", [12, 4096])
def test_packing_whole_corpus(spark, docs, block):
    rng = np.random.default_rng(2)
    words = ["Hello", "don't", "naïve", "中文字符", "ciónrr,", "WORLD.", "x1,2", "a|b", "<|endoftext|>", "\t", "ſ", "é"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 25)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "\n \n"), (None, "null id"), (3, rows[3][1]), (3, rows[3][1]), (300, "word " * 1000)]
    rows += [(400 + i, "the same text") for i in range(40)]
    table = docs(rows).withColumn("uid", F.lit(1)).withColumn("piece", F.lit("x")).withColumn("blk", F.lit(0))
    got = packing.pack_documents(table, TOKENIZER, capacity=64, block=block).collect()
    n, least = check_packing(got, rows, 64)
    assert n <= least + 1


def test_packing_of_empty_table(spark, docs):
    assert packing.pack_documents(docs([]), TOKENIZER).collect() == []


def test_words_encode_as_whole_texts():
    odd = ["It's.S.,a A,B. C.,D", "İstanbul ǅ ŉ ſK", "é é ́a", "a\tb\r\nc \x1c\x1d", "漢字a中，。 カ゛", "1,000.5 x2.", "'S 're.", ""]
    by_word, whole = packing.Encoder(TOKENIZER, True), packing.Encoder(TOKENIZER, False)
    assert by_word(odd) == whole(odd)


def optimum(size, capacity):
    """Fewest bins, by trying every assignment."""
    best = len(size)

    def go(i, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if i == len(size):
            best = len(loads)
            return
        for k in range(len(loads)):
            if loads[k] + size[i] <= capacity:
                go(i + 1, loads[:k] + [loads[k] + size[i]] + loads[k + 1:])
        go(i + 1, [*loads, size[i]])

    go(0, [])
    return best


def test_genetic_algorithm_finds_the_optimum_of_small_cases():
    rng = np.random.default_rng(4)
    for case in range(25):
        size = sorted(rng.integers(15, 60, 11).tolist(), reverse=True)
        best = packing.evolve(size, 100, [], 4, 30, np.random.default_rng(case))[0]
        assert sorted(i for b in best.bins for i in b) == list(range(11))
        assert len(best.bins) == optimum(size, 100)


def test_crossover_keeps_whole_bins_and_every_item():
    rng = np.random.default_rng(6)
    size = rng.integers(5, 70, 60).tolist()
    a, b = (packing.best_fit(size, rng.permutation(60).tolist(), 100, [], []) for _ in range(2))
    child = packing.crossover(size, 100, a, b, rng)
    assert sorted(i for x in child.bins for i in x) == list(range(60))
    assert [sum(size[i] for i in x) for x in child.bins] == child.loads and max(child.loads) <= 100
    fullest = max(a.loads)
    assert any(set(x) <= set(y) for x, n in zip(a.bins, a.loads) if n == fullest for y in child.bins)
