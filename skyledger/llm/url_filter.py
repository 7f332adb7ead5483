"""URL filter: host/path rules first, then a logistic regression on hashed character n-grams.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.  Null or no ``://``: both empty.

A rule is ``host/path...``; it fits its host and all its subdomains if the
path starts with the rule's path.  The longest fitting rule decides.  The
rule list is a parameter of bounded size (``MAX_RULES``), so it is one expression, longest first.

URLs without a rule go to the model: character n-grams (3 to 5) of host and
of path, numbers as ``0``, hashed to ``2 ** bits`` counts, weighted by a
logistic regression that is trained on a small labelled URL table (``labelled_urls``
by default; a parameter).  Training and scoring are Spark ML jobs.

Defined cases: null, empty and malformed urls have empty host and path, no
rule, and the model's verdict for a URL without n-grams (its intercept); equal
urls are judged alike; other columns are carried along.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_RULES = 1000
BITS = 16

# Words of addresses to block (advertising, gambling, pills, link spam, adult, piracy, fraud) and to allow.
BLOCK_WORDS = ("ads adserver banner tracker track tracking click popunder casino slots jackpot poker roulette bet bets "
               "betting win bingo lotto pills pharma viagra meds cheap rx diet spam farm linkfarm backlink seo farms adult "
               "porn xxx sex cams escort nude torrent warez crack keygen phish payday loans cash replica freebets free "
               "bonus x").split()
ALLOW_WORDS = ("news times post press library school university museum science physics history nation national station "
               "weather earth north south health hospital thing reading writing letters garden cooking recipes kitchen "
               "music theatre theory mathematics another brother father mother other gather leather northern southern "
               "translation education election section motion ocean mountain river forest nature animals travel "
               "transport railway harbour house home street town city council government law justice culture art "
               "painting photo photography film book author poetry language grammar sport football tennis run shop "
               "market bank economy money work jobs craft tools engine motor data code docs guide wiki forum journal "
               "review opinion essay blog diary family children teacher student research method test island "
               "shine share shire then there these thin thread three thank within method anthem ethics").split()


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled URL table: hosts of one or two words of a class under every kind of address and path (1 = block)."""
    front, top = ("", "www.", "m.", "blog."), ("com", "org", "net")
    tail = ("/en/1", "/de/12.html", "/fr/7?page=2", "/es/31/", "/", "")
    rows = []
    for label, words in ((1, BLOCK_WORDS), (0, ALLOW_WORDS)):
        for i, w in enumerate(words):
            for k in range(1, 7 if label else 4):
                other = words[(i * (k + 1) + 5 * k) % len(words)]
                host = (w, f"{w}-{other}", f"{other}{w}", f"{other}-{w}", f"{w}{other}", f"{w}-{other}")[k - 1]
                n = i + k
                rows.append((f"https://{front[n % 4]}{host}.{'example.' * (n % 2)}{top[n % 3]}{tail[(n + k) % 6]}", label))
    return rows


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, as above."""
    u = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(u, "(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule that fits, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules: keep them in a table and join on the host's suffixes")
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=len):  # the longest ends up outermost
        h, _, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(r)).otherwise(out)
    return out


def _grams(text: Column, sizes: tuple[int, ...], tag: str) -> Column:
    """Character n-grams of ``^text$``, marked by ``tag`` (none of an empty text)."""
    s = F.concat(F.lit("^"), F.regexp_replace(text, "[0-9]+", "0"), F.lit("$"))

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.char_length(s) - (n - 1))
        return F.when(F.char_length(s) >= n, F.transform(
            starts, lambda i: F.concat(F.lit(tag), F.substr(s, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))

    parts = [of(n) for n in sizes]
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.concat(*parts))


def features(host: Column, path: Column) -> Column:
    return F.concat(_grams(host, (3, 4, 5), "h"), _grams(path, (3, 4), "p"))


def _tf() -> HashingTF:
    return HashingTF(numFeatures=1 << BITS, inputCol="grams_", outputCol="features_", binary=True)


def train(spark: SparkSession, labelled: list[tuple[str, int]] | DataFrame | None = None) -> LogisticRegressionModel:
    """The model of a small labelled table ``(url, label)``."""
    df = labelled if isinstance(labelled, DataFrame) else spark.createDataFrame(
        labelled or labelled_urls(), "url string, label int")
    host, path = host_path(F.col("url"))
    rows = df.select(F.col("label").cast("double").alias("label_"), features(host, path).alias("grams_"))
    # both classes weigh the same, however many rows each has
    share = F.avg("label_").over(Window.partitionBy(F.lit(0)))
    rows = rows.withColumn("weight_", 0.5 / F.when(F.col("label_") == 1, share).otherwise(1 - share))
    return LogisticRegression(featuresCol="features_", labelCol="label_", weightCol="weight_", regParam=0.001,
                              maxIter=50, standardization=False).fit(_tf().transform(rows).coalesce(1))


def judge(pages: DataFrame, rules: dict[str, str], model: LogisticRegressionModel, url_col: str = "url",
          threshold: float = 0.5) -> DataFrame:
    """``pages`` with ``host, path, rule, score, verdict`` (score: the model's probability of ``block``)."""
    host, path = host_path(F.col(url_col))
    clash = {c.lower() for c in pages.columns} & {"host", "path", "rule", "score", "verdict", "grams_", "features_"}
    if clash:
        pages = pages.withColumnsRenamed({c: f"{c}_in" for c in pages.columns if c.lower() in clash})
    rows = pages.withColumns({"host": host, "path": path})
    rows = rows.withColumns({"rule": rule_of(F.col("host"), F.col("path"), list(rules)),
                             "grams_": features(F.col("host"), F.col("path"))})
    rows = model.transform(_tf().transform(rows))
    says = F.lit(None).cast("string")
    for r, v in rules.items():
        says = F.when(F.col("rule") == r, F.lit(v)).otherwise(says)
    block = vector_to_array(F.col("probability"))[1]
    return rows.select(*pages.columns, "host", "path", "rule", block.alias("score"),
                       F.coalesce(says, F.when(block >= threshold, "block").otherwise("allow")).alias("verdict"))
