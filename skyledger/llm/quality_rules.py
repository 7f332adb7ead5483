"""Line-first quality rules: judge each line, remove failures, then judge what the document lost.

Native: DataFrame functions only.  Everything is an expression over one row
(splits, array functions), so there is no shuffle and no Python; a long text
costs time in proportion to its length (times a logarithm for the window
sort, which only texts with a repeated window pay).

Line rules (a line fails if one holds; a line without a word always stays):

* punctuation: symbols ``[#*$%&|<>]`` number at least ``max_symbols`` per word, or doubled
  exclamation/question marks at least ``max_marks`` per word, or under ``min_letters``
  of its non-blank characters are letters, marks or digits;
* navigation: separators (``|`` ``»`` ``›`` ``·`` ``•``) at least ``max_separators`` per word and two of
  them, or a line of at most 12 words with two menu words;
* shouting: at least ``caps_words`` words, and capitals are over ``max_caps`` of its letters, marks and digits;
* boilerplate: it has a phrase of ``BOILERPLATE``.

Document: rejected if the base statistics fail, or the lines kept hold under
``min_kept`` of the word characters of the whole text, or under
``min_words`` words.

Defined cases: a null text has no words and is rejected; its cleaned text is
null; an empty text stays empty; repeated rows are judged alike; columns with
clashing names are left alone (results use fresh names inside).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

WORD = "[^\\x20\\x09-\\x0D]"
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# Phrases of legal and technical boilerplate, and menu words (lower case).
BOILERPLATE = ["all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy",
               "cookie policy", "accept cookies", "uses cookies", "use of cookies", "enable javascript",
               "javascript is disabled", "lorem ipsum", "copyright ©", "copyright (c)", "click here to",
               "subscribe to our", "sign up for our", "powered by", "permission is hereby granted",
               "without warranty of any kind", "redistribution and use in source"]
MENU = ["home", "about", "contact", "login", "logout", "register", "sitemap", "search", "menu", "help", "faq",
        "sign in", "sign up", "next", "previous", "share"]

DEFAULTS = {"max_symbols": 0.3, "max_marks": 0.3, "min_letters": 0.6, "max_separators": 0.25, "caps_words": 3,
            "max_caps": 0.7, "min_kept": 0.7, "min_words": 20}


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _chars(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w))


def _once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once: lambda bodies are evaluated as written, without common parts."""
    return F.transform(F.array(value), use)[0]


def repeat_words(words: Column, window: int = 8) -> Column:
    """Words covered by a ``window``-word window that occurs twice or more in the list."""
    n = F.size(words)
    zero = F.lit(0).cast("long")

    def covered(h: Column) -> Column:
        # windows sorted by hash; equal neighbours are repeats; their starts in text order
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = _once(pairs, lambda s: F.sort_array(F.transform(F.filter(
            s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
            | (F.get(s, k + 1)["h"] == x["h"])), lambda x: x["i"])))
        return F.aggregate(starts, F.struct(zero.alias("n"), F.lit(-window).alias("end")),
                           lambda a, i: F.struct((a["n"] + window - F.greatest(a["end"] - i, F.lit(0))).alias("n"),
                                                 (i + window).alias("end")),
                           lambda a: a["n"])

    def doubled(h: Column, k: int) -> Column:  # hashes of 2k words from those of k
        return _once(h, lambda a: F.zip_with(a, F.slice(a, k + 1, F.size(a)), lambda x, y: F.xxhash64(x, y)))

    hashes, k = F.transform(words, lambda w: F.xxhash64(w)), 1
    while k < window:
        hashes, k = doubled(hashes, k), 2 * k
    if k != window:
        raise ValueError("window must be a power of two")
    hashes = F.slice(hashes, 1, n - (window - 1))
    return F.when(n < window + 1, zero).otherwise(_once(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(covered(h))))


def _features(line: Column) -> Column:
    """What the line rules look at; ``words`` holds the words for now."""
    return F.struct(line.alias("line"), F.lower(line).alias("low"), _words(line).alias("words"),
                    _count(line, SYMBOLS).alias("symbols"), _count(line, "[!?]{2,}").alias("marks"),
                    _count(line, "[|»›·•]").alias("seps"), F.char_length(line).alias("chars"),
                    F.char_length(F.regexp_replace(line, "[\\p{L}\\p{M}\\p{N}]+", "")).alias("others"),
                    F.char_length(F.regexp_replace(line, "\\p{Lu}+", "")).alias("not_upper"))


def _counted(s: Column) -> Column:
    return F.struct(*(s[c].alias(c) for c in ("line", "low", "symbols", "marks", "seps", "chars", "others", "not_upper")),
                    F.size(s["words"]).alias("w"), _chars(s["words"]).alias("solid"))


def _fails(s: Column, p: dict) -> Column:
    """Whether a counted line is removed (a line without a word never is)."""
    w, letters = s["w"], s["chars"] - s["others"]
    menu = "(?:^|[^\\p{L}])(?:" + "|".join(MENU) + ")(?![\\p{L}])"
    boiler = F.lit(False)
    for phrase in BOILERPLATE:
        boiler = boiler | s["low"].contains(phrase)
    punctuation = ((s["symbols"] >= p["max_symbols"] * w) & (s["symbols"] > 1)) | (
        (s["marks"] >= p["max_marks"] * w) & (s["marks"] > 1)) | (letters < p["min_letters"] * s["solid"])
    navigation = ((s["seps"] >= p["max_separators"] * w) & (s["seps"] >= 2)) | (
        (w <= 12) & (_count(s["low"], menu) >= 2))
    shouting = (w >= p["caps_words"]) & (s["chars"] - s["not_upper"] > p["max_caps"] * letters)
    return (w > 0) & (punctuation | navigation | shouting | boiler)


def judge(docs: DataFrame, text_col: str = "text", out: str | None = None, **params) -> DataFrame:
    """``docs`` with one more column (``out``, by default a free name): a struct of statistics, verdict and cleaned text.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_removed_lines,
    kept_words, kept_chars, text (lines that passed), base_failed, kept.
    """
    p = DEFAULTS | params
    out, a, b = out or fresh(docs, "quality"), fresh(docs, "split_"), fresh(docs, "judged_")
    t = F.coalesce(F.col(text_col), F.lit(""))
    # each step is a generator over one element: what it computes is not repeated for every later use
    step = docs.select("*", F.explode(F.array(F.transform(F.split(t, "\n"), _features))).alias(a))
    step = step.select("*", F.explode(F.array(F.struct(
        F.flatten(F.transform(a, lambda s: s["words"])).alias("words"),
        F.transform(a, _counted).alias("lines")))).alias(b)).drop(a).withColumnRenamed(b, a)
    step = step.select("*", F.explode(F.array(F.struct(
        F.filter(F.col(a)["lines"], lambda s: ~_fails(s, p)).alias("passed"),
        F.filter(F.col(a)["lines"], lambda s: s["w"] > 0).alias("full"),
        repeat_words(F.col(a)["words"]).alias("n_repeat_words")))).alias(b))
    words, passed, full = F.col(a)["words"], F.col(b)["passed"], F.col(b)["full"]
    total = lambda lines, c: F.aggregate(lines, F.lit(0).cast("long"), lambda x, s: x + s[c])
    step = step.select("*", F.explode(F.array(F.struct(
        F.size(words).cast("long").alias("n_words"), total(full, "solid").alias("word_chars"),
        total(F.col(a)["lines"], "symbols").alias("n_symbols"),
        (F.size(full) - F.size(F.array_distinct(F.transform(full, lambda s: s["line"])))).cast("long").alias("n_dup_lines"),
        F.col(b)["n_repeat_words"].alias("n_repeat_words"), F.size(F.col(a)["lines"]).alias("n_lines"),
        (F.size(F.col(a)["lines"]) - F.size(passed)).alias("n_removed_lines"),
        total(passed, "w").alias("kept_words"), total(passed, "solid").alias("kept_chars"),
        F.when(F.col(text_col).isNotNull(), F.array_join(F.transform(passed, lambda s: s["line"]), "\n")).alias("text"),
    ))).alias(out)).drop(a, b)
    q = F.col(out)
    failed = (q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])
    kept = (~failed & (q["kept_words"] >= p["min_words"]) & (q["kept_chars"] >= p["min_kept"] * q["word_chars"]))
    return step.withColumn(out, q.withField("base_failed", failed).withField("kept", kept))
