r"""URL filters (operator 7, DataFrame only).

A list of rules decides first: a rule ``host/path`` fits its host and all its
subdomains where the url's path starts with the rule's; the longest fitting rule
wins.  A url that no rule fits gets the verdict of a logistic regression on hashed
character n-grams of host and path, trained (Spark ML, on the JVM) from a small
labelled table of urls.  Scoring is a column expression: n-grams, ``xxhash64`` into
``buckets`` bins, one lookup per n-gram in a constant array of weights.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and the method's verdict on the empty feature set (allow); ties cannot arise
among distinct rules of one length that fit the same url unless they are equal;
repeated rows are judged each; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import json
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbis.llm.common import lower_ascii

BUCKETS = 4096
NGRAMS = (3, 4, 5)
THRESHOLD = 0.5

# Labelled urls are made by rule from general words, each beside words that belong to both labels
# and so tell nothing.  1: block.
BLOCKED_WORDS = ["casino", "poker", "slots", "roulette", "betting", "bets", "jackpot", "lottery", "xxx", "porn", "adult",
                 "sex", "escort", "viagra", "pills", "pharma", "replica", "cheap", "free", "warez", "torrent", "crack",
                 "keygen", "malware", "phishing", "spam", "ads", "adserver", "popup", "track", "tracker", "clicks",
                 "loans", "payday", "prize", "bonus"]
ALLOWED_WORDS = ["news", "library", "museum", "school", "university", "docs", "wiki", "journal", "garden", "recipes",
                 "weather", "history", "science", "music", "travel", "community", "health", "books", "sports",
                 "gallery", "paper", "photo", "council", "theatre", "railway", "hospital", "forest", "bakery",
                 # harmless words that look like parts of the others
                 "freedom", "freight", "cheaper-by-rail", "alphabets", "roads", "headset", "adsorption", "racetrack",
                 "tractor", "adulthood", "essex", "caspian", "pillar", "sparrow", "loanword", "bonnet"]
OTHER_WORDS = ["", "online", "royal", "club", "live", "now", "zone", "hub", "store", "king", "world", "city", "plus"]
# most addresses are harmless: names of no meaning, made of two or three syllables
SYLLABLES = ["an", "bel", "cor", "den", "est", "fi", "gar", "hal", "in", "jo", "ka", "lor", "mer", "no", "or", "pel",
             "qui", "ren", "so", "ti", "ul", "ver", "wen", "ya", "zo"]
HOSTS = ["{w}.example.com", "www.{w}.com", "{w}.example.org", "blog.{w}.example.net", "m.{w}.net", "{w}.org",
         "shop.{w}.example.com", "cdn.{w}.net", "news.{w}.example.org", "{w}.co.uk", "www.{w}.example.net"]
PATHS = ["/en/{i}", "/de/{i}.html", "/fr/{i}/", "/es/{i}", "/", "/index.html", "/{i}/about", "/post/{i}", "/{i}"]


def host_names() -> list[tuple[str, int]]:
    """(name, label): words of both labels, alone and beside others, and names of no meaning."""
    out = [(f"{w}{j}{x}" if x else w, label) for label, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS))
           for w in words for x in OTHER_WORDS for j in (("-", "") if x else ("",))]
    out += [(f"{x}-{w}", label) for label, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS))
            for w in words for x in OTHER_WORDS if x]
    n = len(SYLLABLES)
    out += [(a + b, 0) for a in SYLLABLES for b in SYLLABLES if a != b]
    out += [(SYLLABLES[i] + SYLLABLES[(7 * i + j) % n] + SYLLABLES[(3 * j + i) % n], 0) for i in range(n) for j in range(n)]
    return out


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(url, label)``: every host name in two forms of address."""
    rows = [(f"https://{HOSTS[(k + 5 * n) % len(HOSTS)].format(w=w)}{PATHS[(3 * k + n) % len(PATHS)].format(i=37 * k % 9973)}", label)
            for k, (w, label) in enumerate(host_names()) for n in (0, 1)]
    return spark.createDataFrame(rows, "url string, label int")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest ``rule`` (like ``example.net/en/``) that fits, else null.
    ``rules`` is a short configuration list of (verdict, rule)."""
    out = F.lit(None).cast("string")
    for rule in sorted({r for _, r in rules}, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, rule).otherwise(out)
    return out


def _ngrams(text: Column) -> Column:
    """All character n-grams of ``text`` with edge marks."""
    def of(n: int, t: Column) -> Column:
        last = F.char_length(t) - n + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                             lambda i: F.substr(t, i, F.lit(n)))) \
            .otherwise(F.array().cast("array<string>"))
    return F.concat(*[of(n, text) for n in NGRAMS])


def features(host: Column, path: Column) -> Column:
    """Bucket numbers of the n-grams of host and of path (empty if both are)."""
    marked = F.concat(F.lit("^"), host, F.lit("$"), lower_ascii(path), F.lit("$"))
    grams = F.transform(F.array(marked), lambda t: _ngrams(t))[0]
    ids = F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int"))
    return F.when((host == "") & (path == ""), F.array().cast("array<int>")).otherwise(ids)


def train(labelled: DataFrame) -> tuple[list[float], float]:
    """Weights per bucket and intercept; features are n-gram shares of a url."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel, Normalizer
    words = labelled.select(
        "label", F.transform(features(host_of(F.col("url")), path_of(F.col("url"))),
                             lambda i: i.cast("string")).alias("ids"))
    vocab = [str(i) for i in range(BUCKETS)]
    counts = CountVectorizerModel.from_vocabulary(vocab, "ids", "counts")
    data = Normalizer(p=1.0, inputCol="counts", outputCol="features").transform(counts.transform(words))
    model = LogisticRegression(maxIter=60, regParam=1e-4, featuresCol="features",
                               labelCol="label").fit(data)
    return [float(x) for x in model.coefficients.toArray()], float(model.intercept)


@lru_cache(maxsize=4)
def _default_model(app: str) -> tuple[str, float]:
    weights, bias = train(labelled_urls(SparkSession.active()))
    return json.dumps(weights), bias


def score(host: Column, path: Column, weights_json: str, bias: float) -> Column:
    """Probability of label 1 (block)."""
    weights = F.from_json(F.lit(weights_json), "array<double>")      # a constant, folded once
    ids = features(host, path)

    def logit(xs: Column, w: Column) -> Column:
        total = F.aggregate(xs, F.lit(0.0), lambda acc, i: acc + F.get(w, i))
        return total / F.greatest(F.size(xs), F.lit(1)) + F.lit(bias)
    z = F.transform(F.array(F.struct(ids.alias("i"), weights.alias("w"))),
                    lambda s: logit(s["i"], s["w"]))[0]
    return F.when(F.size(ids) == 0, F.lit(0.0)).otherwise(1 / (1 + F.exp(-z)))


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
               url_col: str = "url", labelled: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score.
    ``rules``: (``"block"`` or ``"allow"``, rule); ``labelled (url, label)``: the
    training table, small by contract (it is fitted in one job)."""
    if labelled is None:
        weights, bias = _default_model(pages.sparkSession.sparkContext.applicationId)
    else:
        w, bias = train(labelled)
        weights = json.dumps(w)
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")) \
        .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = urls.select("*", matched_rule(F.col("host"), F.col("path"), rules).alias("rule"))
    verdicts = {r: v for v, r in rules}
    by_rule = F.lit(None).cast("string")
    for rule, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == rule, verdict).otherwise(by_rule)
    scored = judged.select("*", score(F.col("host"), F.col("path"), weights, bias).alias("score"))
    own = F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce(by_rule, own).alias("verdict"), "score")
