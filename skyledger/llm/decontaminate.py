"""Benchmark decontamination by template windows.

Texts are canonicalised token by token: a token is a run without white space (one
character of Chinese, Japanese, Thai, Lao, Khmer or Burmese, which set no spaces),
stripped of punctuation at its ends and lower-cased; a number becomes ``<num>``, a
unit after a number ``<unit>``, a run of capitalised words that do not start a
sentence one ``<name>``.  The replaced values are the slots.  A question copied with
other numbers, names or units keeps its template.  In a second template capitalised
words that start a sentence are names too; windows of either one match.

Windows of ``window`` template tokens, with at least ``min_words`` of them
literal words (a row of numbers has no wording to match), are hash-joined between benchmark and documents.  A
shorter item is one window of its own length.  An item without a window of ``min_words`` literal
words has windows of plain tokens, numbers and names included: it is found verbatim only
(an item of one or two words, in every document that says them).  A
document's windows first pass a bitmap of the benchmark's window hashes, of a
fixed size, so that the corpus itself is not shuffled; the join then compares the
hash and the canonical window itself, so chance collisions do not count.

Slots: windows that align a document with an item at one offset are taken
together; with ``one_to_one=False`` those of offsets less than a window apart are, too, so a name of
another length does not part them.  With ``one_to_one=False`` (the registered queries) the largest
consistent set of windows counts: windows with unchanged slots always do; of the others those in which each value
of the item becomes the value that it becomes in most of them (two values may become
one).  With ``one_to_one`` the values of the whole alignment
must map one to one (5 always becomes 7, and only 5 does), or none of its windows count.
A pair is reported if at least ``min_windows`` counted windows match (all of the item's windows if it has fewer).

Defined cases: null or empty texts have no windows (such items are
never found); repeated rows are reported
alike, once per distinct (id, text); clashing column names do not matter (id and text are read).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, give_back, hash_bitmap, in_bitmap, materialise, texts_of, without

WINDOW, MIN_WORDS, MIN_WINDOWS = 8, 4, 5

# Units that follow a number.
UNITS = frozenset("mm cm m km inch inches in ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton "
                  "tons lb lbs oz ml l liter liters litre litres s sec second seconds min minute minutes h hr hour hours "
                  "day days week weeks month months year years percent pct usd eur gbp dollar dollars euro euros "
                  "cent cents pound pounds hz khz mhz ghz kb mb gb tb v w kw kwh mph kmh km/h m/s degrees".split())
_DIGIT = re.compile(r"\d")
_NUMBER = re.compile(r"[+\-]?[$€£]?\d[\d.,:/]*%?")
_NUMBER_UNIT = re.compile(r"([+\-]?\d[\d.,]*)([a-z/°]+)")
_STRIP = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "“”‘’«»…–—¿¡、。「」『』（）《》！？，：；"
_ENDS = re.compile(r"[.!?…:。！？：][\"'”’»)\]」』）》]*$")
# scripts without spaces (Thai, Lao, Burmese, Khmer, Kana, Han) and their punctuation; marks stay with their letter
_UNSPACED = ("ก-ะาำเ-ๆກ-ະາຳຽ-ໆက-ဪក-ឳ"
             "、-】ぁ-ヿ㐀-䶿一-鿿豈-﫿！-／：-？\U00020000-\U0003134f")
_MARKS = "ัิ-ฺ็-๎ັິ-ຼ່-ໍါ-ှ឴-៓"
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_CUTS = re.compile(rf"(?=[{_UNSPACED}])|(?<=[{_UNSPACED}{_MARKS}])(?=[\da-zA-Z])")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 16  # characters of texts read at once
WORD, NUM, NAME, UNIT = range(4)
MARK = {NUM: "<num>", NAME: "<name>", UNIT: "<unit>"}


EMPTY, NUM_, CAP, ENDS, UNIT_, SPLIT = 1, 2, 4, 8, 16, 32  # what a raw token is


def _h(s: str) -> int:
    return xxhash.xxh64_intdigest(s if s.isascii() else s.encode("utf-8", "surrogatepass"))


class Canon:
    """Canonical tokens of texts.  What a raw token is, is worked out once per worker; texts are arrays of codes."""

    LIMIT = 400_000

    def __init__(self) -> None:
        self._reset()

    def _reset(self) -> None:
        self.codes: dict[str, int] = {}
        self.core: list[str] = []
        self.flags = np.zeros(1 << 16, np.uint8)
        self.hashes = np.zeros(1 << 16, np.uint64)

    def _codes(self, raw: list[str]) -> np.ndarray:
        """Codes of raw tokens; those not met before are added, all at once."""
        known = self.codes
        new = set(raw).difference(known)
        if new:
            n = len(self.core)
            known.update(zip(new, range(n, n + len(new))))
            # plain lower-case words need no closer look
            low, flags = [], []
            for x in new:
                if x.isascii() and x.isalpha() and x.islower():
                    low.append(x)
                    flags.append(UNIT_ if x in UNITS else 0)
                else:
                    core, flag = self._look(x)
                    low.append(core)
                    flags.append(flag)
            end = n + len(new)
            if end > len(self.flags):
                room = max(end, 2 * len(self.flags)) - len(self.flags)
                self.flags = np.concatenate([self.flags, np.zeros(room, np.uint8)])
                self.hashes = np.concatenate([self.hashes, np.zeros(room, np.uint64)])
            self.core += low
            self.flags[n:end] = flags
            self.hashes[n:end] = np.fromiter(map(_h, low), np.uint64, len(low))
        return np.fromiter(map(known.__getitem__, raw), np.int64, len(raw))

    def _look(self, raw: str) -> tuple[str, int]:
        """A raw token's core in lower case, and what it is."""
        core = raw if raw.isalpha() else raw.strip(_STRIP)
        low = core.lower()
        flag = 0 if core is raw or raw[-1].isalnum() or not _ENDS.search(raw) else ENDS
        digits = not core.isalpha() and _DIGIT.search(core)
        if not core:
            flag |= EMPTY
        elif digits and _NUMBER.fullmatch(core):
            flag |= NUM_
        elif digits and _NUMBER_UNIT.fullmatch(low):
            flag |= SPLIT
        elif low is not core and low != core:
            flag |= UNIT_ * (low in UNITS) | CAP * (len(core) > 1 and core[0] != low[0] and core[1:] == low[1:])
        else:
            flag |= UNIT_ * (low in UNITS)
        return low, flag

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the tokens that are not empty, text after text: codes, kinds, which are capitalised words at a sentence start; texts' bounds."""
        if len(self.core) > self.LIMIT:
            self._reset()
        raw: list[str] = []
        cuts = [0]
        for text in texts:
            if not text.isascii() and _ANY_UNSPACED.search(text):
                text = _CUTS.sub(" ", text)
            raw += text.split()
            cuts.append(len(raw))
        bounds = np.array(cuts)
        code = self._codes(raw)
        flag = self.flags[code]
        split = np.flatnonzero(flag & SPLIT)
        if len(split):  # "5km," is "5" and "km,"
            found = [(i, _NUMBER_UNIT.search(raw[i].lower())) for i in split.tolist()]
            found = [(i, m.end(1)) for i, m in found if m]
            at = np.array([i for i, _ in found], np.int64)
            parts = self._codes([x for i, k in found for x in (raw[i][:k], raw[i][k:])]).reshape(-1, 2)
            code[at] = parts[:, 0]
            code = np.insert(code, at + 1, parts[:, 1])
            bounds = bounds + np.searchsorted(at, bounds)
            flag = self.flags[code]
        at = np.flatnonzero((flag & EMPTY) == 0)
        ends = np.concatenate([[0], np.cumsum((flag & ENDS) > 0)])
        bounds = np.searchsorted(at, bounds)
        code, flag = code[at], flag[at]
        heads = bounds[:-1][bounds[:-1] < bounds[1:]]  # first tokens of texts
        starts = np.ones(len(at), bool)  # no sentence end since the token before
        starts[1:] = ends[at[1:]] > ends[at[:-1]]
        starts[heads] = True
        number = (flag & NUM_) > 0
        cap = (flag & CAP) > 0
        kind = np.where(number, NUM, WORD)
        kind[cap & ~starts] = NAME
        unit = number[:-1] & ((flag[1:] & UNIT_) > 0)
        unit[heads[heads > 0] - 1] = False
        kind[1:][unit] = UNIT
        return code, kind, cap & starts & (kind == WORD), bounds

    def templates(self, texts: list[str]) -> tuple[np.ndarray, list["Template"], np.ndarray]:
        """Codes of the tokens, the templates: first words as words, first words as names (if there are any); texts' bounds."""
        code, kind, first, bounds = self.read(texts)
        out = [self._template(code, kind, np.zeros(len(code), bool), first)]
        if first.any():
            out.append(self._template(code, np.where(first, NAME, kind), first, first))
        return code, out, bounds

    def plain(self, code: np.ndarray) -> "Template":
        """The tokens as they are."""
        at = np.arange(len(code))
        return Template(at, at + 1, np.zeros(len(code), np.int64), at >= 0, self.hashes[code])

    def _template(self, code: np.ndarray, kind: np.ndarray, changed: np.ndarray, first: np.ndarray) -> "Template":
        name = kind == NAME
        goes = np.zeros(len(code), bool)  # a name after a name of the same sentence
        goes[1:] = name[1:] & name[:-1] & ~first[1:]
        at = np.flatnonzero(~goes)
        if len(at) < len(code):
            kind, changed, code_at = kind[at], changed[at], code[at]
        else:
            code_at = code
        hashes = self.hashes[code_at]
        marks = np.flatnonzero(kind)
        hashes[marks] = _MARK_HASH[kind[marks]]
        return Template(at, np.append(at[1:], len(code)), kind, changed, hashes)

    def window(self, code: np.ndarray, t: "Template", p: int, size: int) -> tuple[str, list[str]]:
        """Canonical text and slot values of the window at ``p``."""
        core = [" ".join(self.core[c] for c in code[a:b].tolist())
                for a, b in zip(t.at[p:p + size].tolist(), t.end[p:p + size].tolist())]
        kinds = t.kind[p:p + size].tolist()
        return " ".join([MARK.get(k, x) for k, x in zip(kinds, core)]), [x for k, x in zip(kinds, core) if k]


class Template(NamedTuple):
    """Per canonical token: its raw tokens ``at`` to ``end``, kind, whether it differs from the first template, hash."""

    at: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    changed: np.ndarray
    hashes: np.ndarray

    def windows(self, size: int, min_words: int, changed: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows, and which have ``min_words`` literal words (with ``changed``, and differ)."""
        def runs(x: np.ndarray) -> np.ndarray:
            total = np.zeros(len(x) + 1, np.int32)
            np.cumsum(x, out=total[1:])
            return total[size:] - total[:-size]

        ok = runs(self.kind == WORD) >= min_words
        return window_hashes(self.hashes, size), ok & (runs(self.changed) > 0) if changed else ok


_MARK_HASH = np.array([0, *(_h(MARK[k]) for k in (NUM, NAME, UNIT))], np.uint64)


def window_hashes(tokens: np.ndarray, window: int) -> np.ndarray:
    """A 64-bit hash of every run of ``window`` token hashes."""
    n = max(len(tokens) - window + 1, 0)
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h = (h ^ tokens[k:k + n]) * _MUL
        h ^= h >> np.uint64(32)
    return h


def _item_windows(canon: Canon, text: str, window: int, min_words: int) -> tuple[int, list[tuple]]:
    """How many windows an item has, and each: position, size, template (2: plain tokens), hash, canonical text, slots."""
    code, templates, _ = canon.templates([text])
    out, n = [], 0
    for k, t in enumerate([*templates, canon.plain(code)]):
        plain = k == len(templates)
        size = min(window, len(t.at))
        if not size or plain and n:
            continue
        h, ok = t.windows(size, 0 if plain else min_words, k > 0 and not plain)
        n = n or int(ok.sum())
        out += [(int(t.at[p]), size, 2 if plain else k, int(h[p].astype(np.int64)), *canon.window(code, t, p, size))
                for p in np.flatnonzero(ok).tolist()]
    return n, out


def _text_windows(canon: Canon, texts: list[str], min_words: int, sizes: list[int], plain: list[int],
                  bitmap: np.ndarray) -> list[list[tuple]]:
    """The windows of documents that may match, as those of an item; ``sizes`` and ``plain`` are what the items have."""
    code, templates, bounds = canon.templates(texts)
    todo = [(k, t, size, min_words) for k, t in enumerate(templates) for size in sizes]
    if plain:
        todo += [(2, canon.plain(code), size, 0) for size in plain]
    out: list[list[tuple]] = [[] for _ in texts]
    for k, t, size, words in todo:
        if len(t.at) < size:
            continue
        h, ok = t.windows(size, words, k == 1)
        for b in np.searchsorted(t.at, bounds[1:-1]).tolist():  # a window is of one text
            ok[max(b - size + 1, 0):b] = False
        at = np.flatnonzero(ok)
        at = at[in_bitmap(bitmap, h[at])]
        doc = np.searchsorted(bounds, t.at[at], "right") - 1
        for p, d in zip(at.tolist(), doc.tolist()):
            out[d].append((int(t.at[p] - bounds[d]), size, k, int(h[p].astype(np.int64)), *canon.window(code, t, p, size)))
    return out


def _some(texts: Iterator[str]) -> Iterator[list[str]]:
    """``texts`` in lists of about ``_CHUNK`` characters, or of one longer text."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= _CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


def _windows(df: DataFrame, key: str, window: int, min_words: int, match: tuple | None = None) -> DataFrame:
    """``key, text_hash, n, pos, size, template, hash, canon, slots`` for the windows of column ``text``.

    ``match``: sizes of the items' template and plain windows, bitmap of their hashes; None for the items themselves.
    """
    shared = df.sparkSession.sparkContext.broadcast(match) if match is not None else None
    names = [key, "text_hash", "n", "pos", "size", "template", "hash", "canon", "slots"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canon()
        for b in batches:
            cols: list[list] = [[] for _ in names]
            ids, ths = b.column(0).to_pylist(), b.column(1).to_pylist()
            texts = (raw.decode("utf-8", "replace") for raw in texts_of(b.column(2)))
            found = ((_item_windows(canon, text, window, min_words) for text in texts) if shared is None else
                     ((0, got) for some in _some(texts) for got in _text_windows(canon, some, min_words, *shared.value)))
            for i, th, (n, got) in zip(ids, ths, found):
                for w in got:
                    for c, v in zip(cols, (i, th, n, *w)):
                        c.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(),
                     pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
        del canon
        give_back()

    return df.mapInArrow(run, f"`{key}` long, text_hash long, n int, pos int, size int, template int, hash long, "
                              "canon string, slots array<string>")


def consistent_windows(windows: list[list[tuple]]) -> list[list[tuple]]:
    """The largest set of windows whose slots agree: unchanged ones, and changed ones that follow the most frequent new values.

    A window is a list of (item's value, document's value) pairs.
    """
    changed = [w for w in windows if any(b != d for b, d in w)]
    votes: dict[str, Counter] = {}
    for w in changed:
        for b, d in set(w):
            votes.setdefault(b, Counter())[d] += 1
    best = {b: min(c.items(), key=lambda x: (-x[1], str(x[0])))[0] for b, c in votes.items()}
    return [w for w in windows if all(b == d for b, d in w) or all(best[b] == d for b, d in w)]


def _consistent(aligned: DataFrame) -> DataFrame:
    """``aligned`` (with the slots of its ``windows``) reduced to the consistent ones: ``n_windows, n_slots, reparameterised``."""
    keep = ["doc_id", "text_hash", "item_id", "item_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [consistent_windows([[(x["b"], x["d"]) for x in w] for w in ws]) for ws in b.column(len(keep)).to_pylist()]
            pairs = [{p for w in ws for p in w} for ws in got]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keep)], pa.array([len(ws) for ws in got], pa.int64()), pa.array([len(p) for p in pairs], pa.int64()),
                 pa.array([any(x != y for x, y in p) for p in pairs], pa.bool_())],
                [*keep, "n_windows", "n_slots", "reparameterised"])

    rows = aligned.select(*keep, "windows")
    return rows.mapInArrow(run, "doc_id long, text_hash long, item_id long, item_windows int, "
                                "n_windows long, n_slots long, reparameterised boolean")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 min_words: int = MIN_WORDS, min_windows: int = MIN_WINDOWS, one_to_one: bool = True) -> DataFrame:
    """One row per document and item found in it: ``doc_id, text_hash, item_id, n_windows, item_windows, n_slots, reparameterised``.

    n_windows: the consistent windows of the best alignment; n_slots: distinct
    slot values in it; reparameterised: some slot differs from the item's.
    """
    def side(df: DataFrame, i: str, t: str, name: str) -> DataFrame:
        return df.select(F.col(i).cast("long").alias(name), F.xxhash64(t).alias("text_hash"),
                         F.col(t).cast("binary").alias("text"))

    items = _windows(side(benchmark, item_col, item_text_col, "item_id"), "item_id", window, min_words).distinct()
    sizes = [(r.size, r.plain) for r in items.select("size", (F.col("template") == 2).alias("plain")).distinct().collect()]
    match = (*([x for x, p in sorted(sizes) if p == plain] for plain in (False, True)), hash_bitmap(items, "hash"))
    found = _windows(side(docs, id_col, text_col, "doc_id"), "doc_id", window, min_words, match)
    i = items.select("item_id", F.col("text_hash").alias("item_hash"), F.col("pos").alias("item_pos"), "template",
                     F.col("n").alias("item_windows"), "hash", "canon", F.col("slots").alias("item_slots"))
    hits = (found.drop("template").join(i, ["hash", "canon"])
            .withColumn("shift", F.col("pos") - F.col("item_pos"))
            .select("doc_id", "text_hash", "item_id", "item_hash", "item_windows", "shift", "item_pos", "template",
                    F.arrays_zip(F.col("item_slots").alias("b"), F.col("slots").alias("d")).alias("pairs")))
    if not one_to_one:  # a window counts if each of its item's values becomes one value
        p = F.array_distinct("pairs")
        hits = hits.where(F.size(F.array_distinct(F.transform(p, lambda x: x["b"]))) == F.size(p))
        # shifts less than a window apart are in one of the stripes of two windows, each half over the next
        stripe = F.floor(F.col("shift") / window).cast("int")
        hits = hits.withColumn("shift", F.explode(F.array(stripe, stripe + 1)))
    # a window counts once, by its first template
    hits = (hits.groupBy("doc_id", "text_hash", "item_id", "item_hash", "item_windows", "shift", "item_pos")
            .agg(F.min(F.struct("template", "pairs"))["pairs"].alias("pairs")))
    # an alignment has at most the item's windows, so what it collects is bounded by the item's length
    aligned = hits.groupBy("doc_id", "text_hash", "item_id", "item_hash", "item_windows", "shift").agg(
        F.count("*").alias("n_windows"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("m"),
        F.collect_list("pairs").alias("windows"))
    n = F.size("m")
    if one_to_one:
        aligned = aligned.where((F.size(F.array_distinct(F.transform("m", lambda x: x["b"]))) == n)
                                & (F.size(F.array_distinct(F.transform("m", lambda x: x["d"]))) == n))
    need = F.least(F.lit(min_windows), F.col("item_windows"))
    if one_to_one:
        aligned = aligned.select("*", n.cast("long").alias("n_slots"),
                                 F.exists("m", lambda x: ~x["b"].eqNullSafe(x["d"])).alias("reparameterised"))
    else:
        aligned = _consistent(aligned.where(F.col("n_windows") >= need))
    return (aligned.where(F.col("n_windows") >= need)
            .groupBy("doc_id", "text_hash", "item_id")
            .agg(F.max(F.struct("n_windows", "item_windows", "n_slots", "reparameterised")).alias("x"))
            .select("doc_id", "text_hash", "item_id", "x.*"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **params) -> DataFrame:
    """``docs`` without the documents in which an item was found; texts that no item was found in are not shuffled."""
    i, t = fresh(docs, "bad_id"), fresh(docs, "bad_hash")
    bad = contaminated(docs, benchmark, id_col, text_col, **params).select(
        F.col("doc_id").alias(i), F.col("text_hash").alias(t), F.col("text_hash").alias("h")).distinct()
    bad = materialise(bad, "contaminated")
    on = F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(t))
    return without(docs, bad, F.xxhash64(text_col), on).select(*docs.columns)
