"""Dedup operators against brute force on small fixtures with planted copies, ties, nulls and long texts."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from skyledger.llm import line_dedup, simhash_dedup, suffix_dedup
from skyledger.llm.common import connected_components
from skyledger.llm.suffix_array import suffix_array

WORDS = [a + b for a in "ka lo mi ner tu vas".split() for b in "ba den fi gor lu".split()]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        a, b = self.find(x), self.find(y)
        self.up[max(a, b)] = min(a, b)


def test_suffix_array_is_sorted():
    rnd = random.Random(3)
    for _ in range(3000):
        t = [rnd.randint(1, rnd.randint(1, 4)) for _ in range(rnd.randint(0, 14))] + [0]
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(300, 300), (500, 501), (501, 500)]
    edges += [(rnd.randint(600, 700), rnd.randint(600, 700)) for _ in range(60)]
    s = Sets()
    for a, b in edges:
        s.join(a, b)
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {x: s.find(x) for a, b in edges if a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def brute_substrings(texts, n):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for b in raw:
        cover = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                cover[i:i + n] = b"\1" * n
        kept = bytes(x for x, c in zip(b, cover) if not c)
        runs = len([x for x in bytes(cover).split(b"\0") if x])
        out.append((len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


def substring_rows(rnd):
    passage = prose(rnd, 60)
    texts = [prose(rnd, 80) for _ in range(12)]
    texts += [prose(rnd, rnd.randint(0, 30)) + passage[rnd.randint(0, 60):rnd.randint(200, 340)] + prose(rnd, 20) for _ in range(25)]
    for t in texts[:3]:  # near copies: one character differs
        i = rnd.randrange(len(t))
        texts.append(t[:i] + "§" + t[i + 1:])
    texts += [texts[0], "", None, "z" * 900, "ab" * 300, "short", "\x00" * 250, "é" * 160, passage * 3]
    return [(k // 2, t) for k, t in enumerate(texts)]  # ids repeat


@pytest.mark.parametrize("max_group", [4096, 2])
def test_substrings_like_brute_force(spark, docs, max_group):
    for seed in (5, 6):
        rows = substring_rows(random.Random(seed))
        got = suffix_dedup.dedup_substrings(docs(rows), max_group=max_group).collect()
        want = [(i, *x) for (i, _), x in zip(rows, brute_substrings([t for _, t in rows], 200))]
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
        assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


def test_substrings_of_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)
    rnd = np.random.default_rng(2)
    buf = rnd.integers(97, 101, 9000).astype(np.uint8)
    doc, lo, k, g, h, a = suffix_dedup.contexts(buf, np.array([0, 5000, 5100, 9000]), 200)
    starts = sorted((int(d), int(x) + j) for d, x, n in zip(doc, lo, k) for j in range(n))
    assert starts == [(0, i) for i in range(4801)] + [(2, i) for i in range(3701)]


def test_context_pass_holds_small_arrays():
    rnd = np.random.default_rng(5)
    buf, off = rnd.integers(97, 123, 4_000_000, dtype=np.uint8), np.arange(0, 4_000_001, 4000)
    tracemalloc.start()
    try:
        doc, *_ = suffix_dedup.contexts(buf, off, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert set(doc.tolist()) == set(range(1000))
    assert peak < 40e6  # whole batches of texts pass through, a few at a time


def test_substrings_of_nothing(spark, docs):
    assert suffix_dedup.dedup_substrings(docs([])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.dedup_substrings(docs([]), length=40)


def brute_simhash(t, n=3):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(x, 42) for x in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def simhash_rows(rnd):
    base = [prose(rnd, 300) for _ in range(15)]
    texts = list(base)
    for t in base[:6]:
        w = t.split()
        for _ in range(6):
            w = list(w)
            w[rnd.randrange(len(w))] = "other"
            texts.append(" ".join(w))
    texts += ["", None, "  \n", base[0], base[0].upper(), "one", "one two", "ÄÖ Ü é"]
    return list(enumerate(texts))


def test_simhash_like_brute_force(spark, docs):
    rows = simhash_rows(random.Random(8))
    fp = {i: brute_simhash(t) for i, t in rows}
    s = Sets()
    for i in fp:
        for j in fp:
            if (fp[i] ^ fp[j]).bit_count() <= 2:
                s.join(i, j)
    got = simhash_dedup.near_duplicates(docs(rows)).collect()
    assert {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in got} == {i: (fp[i], s.find(i)) for i in fp}
    kept = simhash_dedup.keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({s.find(i) for i in fp})
    three = simhash_dedup.links(simhash_dedup.with_fingerprints(docs(rows), shingle=3), 3).collect()
    distinct = sorted({x - (1 << 64) if x >> 63 else x for x in fp.values()})
    assert {(r.a, r.b) for r in three} == {(a, b) for a in distinct for b in distinct
                                           if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3}


def test_simhash_null_ids_and_clashing_names(spark):
    df = spark.createDataFrame([(None, "a b c", 1), (7, "a b c", 2), (7, "a b c", 3), (None, "zz", None)],
                               "doc_id long, text string, fp long")
    got = Counter((r.doc_id, r.component_id) for r in simhash_dedup.near_duplicates(df).collect())
    assert got == Counter([(None, None), (None, 7), (7, 7), (7, 7)])
    kept = simhash_dedup.keep_one(df).collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {None, 7}
    assert simhash_dedup.near_duplicates(df.where("false")).count() == 0


def plain_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_edit_similarity_like_the_table():
    rnd = random.Random(4)
    for _ in range(3000):
        a = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12)))
        b = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12)))
        least = rnd.choice([0.5, 0.7, 0.8, 0.9])
        n = max(len(a), len(b))
        assert line_dedup.edit_similarity(a, b, least) == (plain_distance(a, b) <= int((1 - least) * n + 1e-9)), (a, b)


def brute_lines(rows):
    lines = [(k, j, line_dedup.normalise(x)) for k, (_, t) in enumerate(rows) for j, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    norms = sorted({x[2] for x in lines})
    fps = dict(zip(norms, line_dedup.simhashes(norms).tolist()))
    s = Sets()
    for a in norms:
        for b in norms:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3 and plain_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9):
                s.join(a, b)
    first, gone = {}, defaultdict(set)
    for k, j, n in sorted(lines, key=lambda x: (rows[x[0]][0] is None, rows[x[0]][0] or 0, x[0], x[1])):
        if first.setdefault(s.find(n), (k, j)) != (k, j):
            gone[k].add(j)
    return [None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[k])
            for k, (_, t) in enumerate(rows)]


def test_lines_like_brute_force(spark, docs):
    rnd = random.Random(11)
    pool = [prose(rnd, rnd.randint(3, 40)) for _ in range(30)]
    pool += [p[:-1] + "x" for p in pool[:10]] + [p.upper() + " !!" for p in pool[:5]] + ["", "--", "page 12", "Page 7", "١٢"]
    rows = [(k, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 8)))) for k in range(40)]
    rows += [(None, pool[3]), (50, None), (51, ""), (51, ""), (52, "solo line of its own"), (52, "solo line of its own"),
             (53, prose(rnd, 30_000))]
    df = docs(rows).coalesce(1)  # one partition: ties go to the earlier row
    got = line_dedup.dedup_lines(df, counts=True)
    assert got.columns == [*df.columns, "n_lines", "n_removed"]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((i, t) for (i, _), t in zip(rows, brute_lines(rows)))
    assert line_dedup.dedup_lines(df.where("false")).count() == 0


def test_line_simhash_of_very_long_lines():
    rnd = random.Random(2)
    norms = ["one", "one two", prose(rnd, 255), prose(rnd, 256), prose(rnd, 2000)]
    alone = [int(line_dedup.simhashes([n])[0]) for n in norms]
    assert line_dedup.simhashes(norms).tolist() == alone
    for n, got in zip(norms, alone):
        raw = n.encode()
        at = [0] + [i + 1 for i, c in enumerate(raw) if c == 32]
        h = line_dedup.word_hashes(np.frombuffer(raw, np.uint8), np.array(at), np.array([a - 1 for a in at[1:]] + [len(raw)]))
        w = [int(x) for x in h]
        times = [min(max(len(x) ** 2 // 16, 1), 16) for x in n.split()]
        assert got == sum(1 << k for k in range(64)
                          if 2 * sum(t * (x >> k & 1) for x, t in zip(w, times)) + (w[0] >> k & 1) > sum(times))


def test_recall_of_planted_line_pairs():
    """Share of planted pairs at edit similarity 0.8 or more that are within three bits: what the candidate search can find."""
    rnd = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.choice([2, 3, 3, 4, 5, 6, 7, 9, 11])))
    han = lambda: chr(rnd.randrange(0x4e00, 0x9fa5))
    share = {}
    for n in (15, 30, 60):
        pairs = []
        for _ in range(200):
            x = [word() for _ in range(n)]
            y = list(x)
            y[rnd.randrange(n)] = word()
            pairs.append((" ".join(x), " ".join(y)))
        share[n] = near_share(pairs)
    pairs = []
    for _ in range(200):
        x = [han() for _ in range(80)]
        y = list(x)
        y[rnd.randrange(80)] = han()
        pairs.append(("".join(x), "".join(y)))
    share["han"] = near_share(pairs)
    assert share[15] >= 0.3 and share[30] >= 0.35 and share[60] >= 0.55 and share["han"] >= 0.3


def near_share(pairs):
    a, b = (line_dedup.simhashes([line_dedup.normalise(p[i]) for p in pairs]).tolist() for i in (0, 1))
    return sum((x ^ y).bit_count() <= line_dedup.MAX_BITS for x, y in zip(a, b)) / len(pairs)


def test_line_candidates_keep_every_near_pair(spark):
    """Buckets of two to some hundred members: no pair within three bits is lost, and few others stay."""
    rng = np.random.default_rng(5)
    fps = []
    for group in (1, 2, 3, 4, 5, 6, 9, 40, 300):  # members share two blocks, the other bits are random
        shared = int(rng.integers(1 << 26))
        fps += [int(rng.integers(1 << 38)) << 26 | shared for _ in range(group)]
    for fp in fps[::4]:  # and some have a partner one to four bits away
        flip = rng.choice(64, int(rng.integers(1, 5)), replace=False)
        fps.append(fp ^ sum(1 << int(b) for b in flip))
    rows = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(fps)]
    got = line_dedup._candidates(spark.createDataFrame(rows, "id long, fp long"), 3).collect()
    buckets, least = {}, {}
    for r in got:
        buckets.setdefault(r["key"], set()).add(r["id"])
        least.setdefault(r["key"], set()).add((r["least"], r["least_fp"]))
    near = {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if (fps[a] ^ fps[b]).bit_count() <= 3}
    met = {(a, b) for ids in buckets.values() for a in ids for b in ids if a < b}
    assert near <= met
    linked = {(k, x) for k, ids in buckets.items() for x in ids if any((min(x, y), max(x, y)) in near for y in ids - {x})}
    assert len(got) == sum(map(len, buckets.values())) < 2 * len(linked)  # few members stay without a partner
    assert all(len(x) == 1 for x in least.values())
    assert all(r["least"] <= r["id"] and (r["n"] <= 4 or r["n"] == len(buckets[r["key"]])) for r in got)


def test_open_pairs_come_once_and_all(spark):
    """Near copies of one group that share up to ten buckets: each pair that no star holds comes from one bucket."""
    rng = np.random.default_rng(9)
    base = int(rng.integers(1 << 62))
    fps = [base ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 3)), replace=False)) for _ in range(120)]
    rows = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(fps)]
    buckets = line_dedup._candidates(spark.createDataFrame(rows, "id long, fp long"), 3)
    got = [(r.x, r.y) for r in line_dedup._open_pairs(buckets.where("n > 2").selectExpr("*", "id % 50 as comp"), 3).collect()]
    stars = {(r.least, r.id) for r in buckets.collect() if r.id != r.least}
    want = {(a, b) for a in range(120) for b in range(a + 1, 120) if (fps[a] ^ fps[b]).bit_count() <= 3 and a % 50 != b % 50}
    assert len(got) == len(set(got)) and set(got) <= want <= set(got) | stars


def test_texts_of_lines_are_read_once(spark, docs, monkeypatch):
    """Stars and what they leave apart take the lines' texts from one scan."""
    scans, texts = [], line_dedup._texts
    monkeypatch.setattr(line_dedup, "_texts", lambda *a: scans.append(a) or texts(*a))
    rnd = random.Random(13)
    line = prose(rnd, 40)
    rows = [(k, line[:-1 - k % 3] + "xyz"[:k % 3] + str(k) * (k % 2)) for k in range(12)]
    got = line_dedup.dedup_lines(docs(rows).coalesce(1)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for (i, _), t in zip(rows, brute_lines(rows)))
    assert len(scans) == 1


def test_lists_of_removed_lines_go_to_the_texts(spark, docs):
    rows = [(i, f"a line that all have\n{hashlib.md5(str(i).encode()).hexdigest()} of its own\nanother line of all") for i in range(700)]
    out = line_dedup.dedup_lines(docs(rows).coalesce(2).withColumnsRenamed({"lang": "gone_k", "source": "gone_of"}), counts=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1  # the lists', not the texts'
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.collect()}
    assert got == {i: (t if i == 0 else t.split("\n")[1], 3, 0 if i == 0 else 2) for i, t in rows}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_")]


def test_normalised_lines_of_ascii_are_as_of_any_text():
    raw = "".join(map(chr, range(128)))
    for t in (raw, "A_b-1\t2\x1cC", "", "\r", "Zoë 12", "ß\n" + raw):
        words = [line_dedup._DIGIT.sub("0", " ".join(line_dedup._WORD.findall(x.lower()))) for x in t.split("\n")]
        assert [line_dedup.normalise(x) for x in t.split("\n")] == words
        assert line_dedup.line_hashes([t.encode()])[2].tolist() == [
            int.from_bytes(xxhash.xxh128_digest(w)[:8], "big", signed=True) for w in words if w]
