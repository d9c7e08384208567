"""URL filter: host and path rules, and a logistic regression on hashed character n-grams.

A rule names a host with all its subdomains and a path prefix; the longest fitting
rule decides.  All other URLs are judged by a logistic regression whose features are
the character n-grams of host and path, hashed into a fixed number of buckets.  It is
trained from a small labelled table of URLs and applied with built-in functions and
the JVM-side model only.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, pick

#: (verdict, host and path); the longest fitting rule wins, of equally long ones the first in order of text.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

N_FEATURES = 1 << 13
GRAM = 3

#: The labelled table, by rule: every topic under every shape of host, the paths dealt round to both labels alike.
BLOCKED_TOPICS = ["casino", "casino-win", "poker", "free-bets", "bets", "betting", "lottery", "cheap-pills", "pills", "viagra",
                  "adult", "adult-x", "xxx", "porn", "ads", "ads-track", "adserver", "track", "tracker", "banner", "popup",
                  "spam", "spam-farm", "link-farm", "cheap-loans", "free-money"]
ALLOWED_TOPICS = ["news", "garden", "history", "library", "science", "kitchen", "travel", "music", "school", "museum", "weather",
                  "river", "mountain", "theatre", "bakery", "thorn", "thunder", "mother", "nation", "thing", "nothing", "reader",
                  "station", "health", "notion", "either"]
HOST_SHAPES = ["{}.example.com", "www.{}.example.org", "blog.{}.example.net", "m.{}.example.com", "{}.example.org"]
PATHS = ["/en/1", "/fr/22.html", "/de/333/", "/es/4?page=2", "/en/55#top", "/article/6", "/"]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(url, label)``: 260 URLs, label 1 for those to block."""
    rows = [(f"http://{shape.format(topic)}{PATHS[(i + j) % len(PATHS)]}", label)
            for label, topics in ((1.0, BLOCKED_TOPICS), (0.0, ALLOWED_TOPICS))
            for i, topic in enumerate(topics) for j, shape in enumerate(HOST_SHAPES)]
    table = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(table))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest fitting rule, else null."""

    def fits(rule: str) -> Column:
        name, _, prefix = rule.partition("/")
        return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + prefix))

    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    found = [F.when(fits(rule), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))) for verdict, rule in ordered]
    return F.coalesce(*found, F.lit(None).cast("struct<rule:string,verdict:string>"))


def with_grams(urls: DataFrame) -> DataFrame:
    """Adds ``grams``: the character n-grams of ``host`` and of ``path``, marked with where they come from."""

    def grams(text: Column, mark: str) -> Column:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.transform(
            F.sequence(F.lit(1), F.char_length(text) + 3 - GRAM),
            lambda i: F.concat(F.lit(mark), F.substring(F.concat(F.lit("^"), text, F.lit("$")), i, GRAM))))

    return urls.withColumn("grams", F.concat(grams(F.col("host"), "h"), grams(F.col("path"), "p")))


def train_url_model(labelled: DataFrame, n_features: int = N_FEATURES) -> PipelineModel:
    """A logistic regression on hashed n-grams from ``(url, label)``; label 1 means block."""
    host, path = host_and_path(F.col("url"))
    rows = with_grams(labelled.select("label", host.alias("host"), path.alias("path")))
    steps = [HashingTF(inputCol="grams", outputCol="features", numFeatures=n_features, binary=True),
             LogisticRegression(maxIter=50, regParam=0.01, standardization=False)]
    return Pipeline(stages=steps).fit(rows)


def filter_urls(pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str]] | None = None,
                url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict`` and the model's own ``model_blocks``.

    A null URL, or one without ``://``, has empty host and path, fits no rule and gets
    the model's verdict on no features.  ``rules`` are a short list, compiled into the
    expression.  Repeated rows give repeated results; an empty table an empty result.
    """
    host, path = host_and_path(F.col("url"))
    parts = pick(pages, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path"))
    parts = with_grams(parts.select("*", fitting_rule(F.col("host"), F.col("path"), RULES if rules is None else rules).alias("fit")))
    judged = model.transform(parts)
    blocks = F.col("prediction") > 0.5
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                         F.coalesce("fit.verdict", F.when(blocks, "block").otherwise("allow")).alias("verdict"),
                         blocks.alias("model_blocks"))
