"""Token counts by section, from one encoding of the whole document.

Encoding sections apart would count differently at their borders.  Here the
whole text is encoded once (byte-level BPE, so the tokens' bytes laid end to
end are the text and offsets are running sums of token lengths), token spans
are brought to character offsets, and joined with the sections' spans.

Spans are half-open, in code points.  A token that holds a part of a character
spans that character.  Sections tile the text: by default one per line, the
line break belonging to the line it ends.  A token that crosses a border goes
to one section, by ``rule``:

* ``start``: the section of its first character;
* ``end``: the section of its last character;
* ``most``: the section with most of its characters, the earliest on a tie.

So the counts of a document's sections always sum to its tokens.

Both span lists are sorted, so the join inside a document is a binary
search, and no row leaves its task.  Defined cases: null and empty texts have
one section (0, 0) with no tokens; bytes that are not UTF-8 become U+FFFD; other
columns are not read.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

RULES = ("start", "end", "most")
SCHEMA = ("doc_id long, section int, start long, end long, n_tokens long, n_crossing long, "
          "doc_tokens long")


@functools.lru_cache(maxsize=4)
def _encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for t, r in ranks.items():
        size[r] = len(t)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size


def line_borders(text: str) -> np.ndarray:
    """Starts of the lines, and the text's end, in code points."""
    b = [0]
    at = text.find("\n")
    while at >= 0:
        b.append(at + 1)
        at = text.find("\n", at + 1)
    if b[-1] < len(text) or len(b) == 1:
        b.append(len(text))
    return np.array(b, np.int64)


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans ``(start, end)`` of the tokens of ``text``."""
    enc, size = _encoder(path, pattern)
    ids = enc.encode_ordinary(text)
    ends = np.cumsum(size[np.array(ids, np.int64)])
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # character of each byte
    return char[starts], char[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens given to each section, and tokens that cross out of each section's first or last border."""
    n = len(borders) - 1
    first = np.searchsorted(borders, starts, "right") - 1
    last = np.searchsorted(borders, ends - 1, "right") - 1
    crossing = first != last
    to = last if rule == "end" else first.copy()
    if rule == "most":
        for t in np.flatnonzero(crossing).tolist():
            cut = np.clip(borders[first[t]:last[t] + 2], starts[t], ends[t])
            to[t] += int(np.argmax(np.diff(cut)))  # argmax: the earliest on a tie
    return np.bincount(to, minlength=n), np.bincount(to[crossing], minlength=n)


def section_tokens(docs: DataFrame, path: str, pattern: str, rule: str = "start",
                   borders: Callable[[str], np.ndarray] = line_borders,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and section: its span, tokens, tokens taken across a border, the document's tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            cols: list[list] = [[] for _ in range(7)]
            for doc, raw in zip(ids, texts_of(b.column(1))):
                text = raw.decode("utf-8", "replace")
                cuts = borders(text)
                s, e = token_spans(text, path, pattern)
                got, crossed = attribute(s, e, cuts, rule)
                n = len(cuts) - 1
                for c, v in zip(cols, ([doc] * n, range(n), cuts[:-1].tolist(), cuts[1:].tolist(), got.tolist(),
                                       crossed.tolist(), [len(s)] * n)):
                    c.extend(v)
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(run, SCHEMA)
