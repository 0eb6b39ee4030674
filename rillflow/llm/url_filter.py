"""URL filter: allow/block rules first, then logistic regression on hashed
character n-grams of host and path (JVM only: SQL functions and Spark ML).

* ``split_url`` cuts a url into host and path.
* ``longest_rule`` finds the rule that fits a host (or one of its parent
  domains) and a path prefix; the longest rule wins, of equally long ones the
  one with the longer host. Rules are a list the caller states, so they become
  one expression in the scan: no join, no shuffle.
* ``fit`` trains the model on a small labelled url table (bounded by
  ``MAX_LABELLED`` rows, checked); ``judge`` applies rules and model.

Edge cases: a null url, or one without ``://``, has an empty host and path and
goes to the model; repeated rows are judged alike; an empty table gives an empty
result; other columns of the input are ignored. A very long url is split once
into characters, so the work is linear in its length.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.common import ascii_lower

#: the largest labelled table ``fit`` takes
MAX_LABELLED = 100_000
#: slots that the n-grams are hashed to
SLOTS = 1 << 14
#: n-gram lengths
NGRAMS = (3, 4)

Rule = tuple[str, str, str]  # verdict, host, path prefix

#: Words of the default labelled url table (1 = block): what sites of either kind are
#: called. Prefixes, top-level domains and paths are dealt to both classes alike, so that only
#: the names tell. Most sites are allowed, and so are most rows: that is the prior of a host
#: whose n-grams the table does not have.
_NAMES = {
    1: ("casino-royal", "slots-jackpot", "poker-cash", "betting-tips", "sports-bets",
        "lottery-winner", "adult-cams", "sex-chat", "porn-tube", "xxx-movies", "escort-girls",
        "viagra-pills", "cheap-pharmacy", "weight-loss-pills", "payday-loans",
        "quick-cash-loans", "replica-handbags", "fake-watches", "spam-mailer", "seo-link-farm",
        "click-ads", "popup-ads", "free-prizes", "malware-download", "crack-keygen",
        "torrent-movies", "big-casino", "adult-shop", "bulk-spam", "bonus-slots"),
    0: ("library", "garden", "museum", "recipes", "weather", "cooking", "physics", "chemistry",
        "hospital", "bakery", "football", "chess", "poetry", "novels", "painting", "archive",
        "schools", "campus", "council", "parks", "railway", "airport", "harbour", "mountain",
        "forest", "river", "village", "market", "journal", "gazette", "observer", "review",
        "magazine", "photography", "astronomy", "biology", "geology", "economics", "medicine",
        "nursing", "dentist", "plumber", "carpenter", "furniture", "bicycle", "camping",
        "hiking", "sailing", "fishing", "knitting", "pottery", "orchestra", "cinema", "opera",
        "ballet", "festival", "charity", "parish", "software", "history", "travel", "science",
        "theatre", "station", "university", "kindergarten", "insurance", "engineering",
        "housing", "embassy", "swimming", "puppet-stage", "old-town", "town-hall",
        "local-news", "food-blog", "bird-watch", "map-room", "open-data", "book-club")}
_PREFIXES, _DOMAINS = ("", "www.", "m.", "blog."), (".com", ".net", ".org")
_PATHS = ("/en/12", "/de/34.html", "/fr/5/", "/es/678")

#: the default labelled url table: each name twice, and some telling paths
LABELLED: tuple[tuple[str, int], ...] = tuple(
    (f"https://{_PREFIXES[(i + k) % 4]}{name}{_DOMAINS[(i + k) % 3]}{_PATHS[(i // 4 + k) % 4]}", y)
    for y, names in _NAMES.items() for i, name in enumerate(names) for k in (0, 1)
) + tuple((f"http://site.org{p}", y) for y, ps in (
    (1, ("/casino/bonus", "/cheap-pills", "/free/prizes", "/adult/xxx")),
    (0, ("/about", "/history/castle", "/articles/weather", "/2020/01/notes"))) for p in ps)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: from there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, its verdict), both null where none fits."""
    best = verdict = F.lit(None).cast("string")
    # the shortest first: each longer one overrides
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        best = F.when(fits, F.lit(h + p)).otherwise(best)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return best, verdict


def _chars(text: str) -> Column:
    return F.split(F.concat(F.lit("^"), F.col(text), F.lit("$")), "")


def _grams(c: Column, mark: str) -> Column:
    """N-grams of an array of characters, each with ``mark`` in front."""
    def of(n: int) -> Column:
        starts = F.when(F.size(c) >= n, F.sequence(F.lit(0), F.size(c) - n)) \
            .otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(
            F.lit(mark), *[F.get(c, i + k) for k in range(n)]))

    return F.concat(*[of(n) for n in NGRAMS])


def _with_grams(df: DataFrame) -> DataFrame:
    # the characters are columns of their own, so that no n-gram splits the text again
    parts = df.withColumn("host_chars", _chars("host")).withColumn("path_chars", _chars("path"))
    return parts.withColumn("grams", F.concat(
        _grams(F.col("host_chars"), "h"), _grams(F.col("path_chars"), "p"))) \
        .drop("host_chars", "path_chars")


def fit(labelled: DataFrame) -> PipelineModel:
    """Logistic regression from a labelled table (``url``, ``label`` 0/1)."""
    n = labelled.limit(MAX_LABELLED + 1).count()
    if not 0 < n <= MAX_LABELLED:
        raise ValueError(f"the labelled url table must have 1 to {MAX_LABELLED} rows")
    host, path = split_url(F.col("url"))
    rows = _with_grams(labelled.select(host.alias("host"), path.alias("path"),
                                       F.col("label").cast("double").alias("label")))
    return Pipeline(stages=[
        HashingTF(inputCol="grams", outputCol="counts", numFeatures=SLOTS),
        Normalizer(inputCol="counts", outputCol="features"),
        LogisticRegression(regParam=0.001, maxIter=50, standardization=False)]).fit(rows)


def default_model(spark: SparkSession) -> PipelineModel:
    rows = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label"))
                     for u, y in LABELLED])
    return fit(spark.range(1).select(F.inline(rows)).coalesce(1))


def judge(urls: DataFrame, rules: list[Rule], model: PipelineModel, id_col: str = "page_id",
          url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """Per row: id, host, path, rule (null if none fits), verdict (the rule's, else
    the model's) and the model's probability of ``block``."""
    host, path = split_url(F.col(url_col))
    rows = _with_grams(urls.select(F.col(id_col), host.alias("host"), path.alias("path")))
    scored = model.transform(rows)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    p = F.element_at(vector_to_array("probability"), 2)
    return scored.select(
        id_col, "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(p > threshold, "block").otherwise("allow")).alias("verdict"),
        p.alias("block_score"))
