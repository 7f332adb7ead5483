"""BPE against the tiktoken library, and token attribution against a plain loop."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from skyledger.llm import bpe, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def enc():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(enc):
    own = bpe.load(RANKS, P.PATTERN)
    random.seed(7)
    letters = "abcdefé ñß123 \n\t.,!-—中文字漢😀ℵabtheinglyer'sll\x00\x1c\x85\xa0½"
    texts = ["", " ", "a" * 5000, "ab" * 3000, "".join(random.choice("abcdefgh") for _ in range(20_000))]
    texts += ["".join(random.choice(letters) for _ in range(random.randint(1, 80))) for _ in range(1500)]
    for t in texts:
        ids = own.encode(t)
        assert ids == enc.encode_ordinary(t), t
        assert own.decode(ids) == t.encode()


def test_round_trip_query_rows(spark, docs, enc):
    rows = [(1, "The cat's  hat.\n\nΟδυσσέας 123"), (2, ""), (3, None), (None, "x"), (1, "The cat's  hat.\n\nΟδυσσέας 123"),
            (9, "long " * 40_000)]
    got = bpe.round_trip(docs(rows), RANKS, P.PATTERN).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0], r[1])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=key) == sorted(want, key=key)


def test_encode_then_decode_gives_the_text(spark, docs):
    rows = [(1, "naïve — 😀 text"), (2, None), (3, "")]
    out = bpe.decode(bpe.encode(docs(rows), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in out} == {1: "naïve — 😀 text", 2: "", 3: ""}
    assert bpe.encode(docs([]), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution_rules(rule):
    starts, ends = np.array([0, 3, 4, 9]), np.array([3, 4, 9, 10])
    borders = np.array([0, 2, 6, 8, 10])
    got, crossed = token_counts.attribute(starts, ends, borders, rule)
    want, cross = [0] * 4, [0] * 4
    for s, e in zip(starts, ends):
        sec = [max(k for k in range(4) if borders[k] <= c) for c in range(s, e)]
        to = {"start": sec[0], "end": sec[-1], "most": max(sorted(set(sec)), key=lambda k: (sec.count(k), -k))}[rule]
        want[to] += 1
        cross[to] += len(set(sec)) > 1
    assert got.tolist() == want and crossed.tolist() == cross


def test_sections_sum_to_the_document(spark, docs, enc):
    path = P.path("byte_bpe_50k.tiktoken")
    rows = [(1, "one\ntwo 中文\n\nlast 😀😀"), (2, ""), (3, None), (4, "no break"), (5, "\n\n"), (5, "\n\n")]
    out = token_counts.section_tokens(docs(rows), path, P.PATTERN).collect()
    for i, t in dict(rows).items():
        mine = [r for r in out if r.doc_id == i]
        assert all(sum(r.n_tokens for r in mine) == (2 if i == 5 else 1) * r.doc_tokens for r in mine)
        assert max(r.end for r in mine) == len(t or "") and min(r.start for r in mine) == 0
    starts, ends = token_counts.token_spans("a😀b", path, P.PATTERN)
    assert starts[0] == 0 and ends[-1] == 3 and (ends > starts).all()
    with pytest.raises(ValueError):
        token_counts.section_tokens(docs(rows), path, P.PATTERN, rule="other")
