"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

The model is fitted by Spark ML on a small labelled URL table (a bounded parameter, here a
fixed list) and applied as a DataFrame transformation; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Lengths of the n-grams and the number of hashed features.
GRAMS, FEATURES = (3, 4, 5), 1 << 18

#: Fixed values of the default labelled table: names that hosts to be blocked and allowed are made of.
BLOCKED_NAMES = (
    "casino win poker bets free-bets slots jackpot lottery gambling betting pills cheap-pills viagra pharma-deals weight-loss "
    "adult adult-x xxx porn sex-cams escort hot-girls spam spam-farm spam-links link-farm seo-links ads ads-track ad-tracker "
    "ad-server popup-ads click-bait clickfarm malware phishing warez torrents crack-keygen payday-loans fake-watches replica-bags"
).split()
ALLOWED_NAMES = (
    "news daily-times weather library archive museum university college school physics chemistry biology history geography "
    "mathematics medicine hospital garden kitchen recipes travel maps city town village council government parliament justice "
    "court tax forms research papers journal review science nature planet ocean river mountain forest animals birds music "
    "theatre cinema books reading writing poetry language grammar dictionary encyclopedia wiki help support manual docs "
    "developer software hardware network python data engine forum community letters family children sports football tennis "
    "running cycling market economy finance trade industry energy water transport railway airport harbour shipping weather-report"
).split()


#: Names that say nothing of their own, for hosts whose evidence is in the path.
NEUTRAL_NAMES = "neutral home alpha delta omega north station corner".split()


def labelled_urls(
    spark: SparkSession, blocked: Sequence[str] = BLOCKED_NAMES, allowed: Sequence[str] = ALLOWED_NAMES
) -> DataFrame:
    """url, label (1: block): each name as a host in twelve shapes, and in the path of four neutral hosts.

    The shapes of hosts have the same paths for both labels.  Then come allowed hosts with blocked
    words in the path (block), and blocked hosts with allowed words (block).
    """
    ends = ("/en/728", "/de/25.html", "/fr/340?page=2", "/es/617#top")
    shapes = [
        f"{'http' if i % 2 else 'https'}://{front}{{}}.example.{last}{ends[(i + j) % 4]}"
        for i, front in enumerate(("", "www.", "m.", "blog.")) for j, last in enumerate(("com", "net", "org"))
    ]
    rows = [
        (shape.format(name), label) for label, names in ((1.0, blocked), (0.0, allowed)) for name in names for shape in shapes
    ]
    paths = ("/{}/", "/{}/25.html", "/en/{}-728", "/a/best-{}")
    for label, names in ((1.0, blocked), (0.0, allowed)):
        for n, name in enumerate(names):
            for i, path in enumerate(paths):
                host = NEUTRAL_NAMES[(n + i) % len(NEUTRAL_NAMES)]
                rows.append((f"https://{('', 'www.', 'blog.', 'm.')[(n + i) % 4]}{host}.example.{('com', 'net', 'org')[n % 3]}{path.format(name)}", label))
    for n, name in enumerate(blocked):
        other = allowed[n % len(allowed)]
        rows.append((f"https://www.{other}.example.{('com', 'net', 'org')[n % 3]}{paths[n % 4].format(name)}", 1.0))
        rows.append((f"https://www.{name}.example.{('com', 'net', 'org')[n % 3]}{paths[n % 4].format(other)}", 1.0))
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one or for null."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule ``host/path`` that fits, and its verdict; null where none does.

    A rule fits its host and all subdomains, if the path starts with the rule's.  ``rules`` is a short list.
    """
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def grams_of(host: Column, path: Column) -> Column:
    """Distinct character n-grams of host and path, told apart by their first letter."""

    def grams(text: Column, mark: str, n: int) -> Column:
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        places = F.when(F.length(framed) >= n, F.sequence(F.lit(1), F.length(framed) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.lit(mark), F.substring(framed, i, F.lit(n))))

    return F.array_distinct(F.concat(*[grams(text, mark, n) for text, mark in ((host, "h"), (path, "p")) for n in GRAMS]))


def fit(labelled: DataFrame, url: str = "url", label: str = "label") -> PipelineModel:
    """A model of block (1) or allow (0) from labelled urls; the table is small by contract."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    stages = [
        HashingTF(inputCol="__grams", outputCol="__features", numFeatures=FEATURES, binary=True),
        LogisticRegression(
            featuresCol="__features", labelCol="__label", predictionCol="__verdict", probabilityCol="__chance",
            rawPredictionCol="__margin", regParam=0.001, standardization=False, maxIter=60,
        ),
    ]
    return Pipeline(stages=stages).fit(labelled.select(grams_of(host, path).alias("__grams"), F.col(label).alias("__label")))


def judge(pages: DataFrame, model: PipelineModel, rules: Sequence[tuple[str, str]] = (), url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict ('allow' or 'block') and score, the model's chance of block.

    A null url and one without ``://`` have an empty host and path, fit no rule, and get the
    model's verdict like any other.  Repeated rows stay, an empty table gives an empty one, and
    columns of ``pages`` named like the new ones are replaced.
    """
    kept = [c for c in pages.columns if c == url or c not in ("host", "path", "rule", "verdict", "score")]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, says = rule_for(host, path, rules)
    scored = model.transform(pages.select(*[F.col(f"`{c}`") for c in kept]).withColumn("__grams", grams_of(host, path)))
    score = F.round(vector_to_array("__chance")[1], 9)
    return scored.select(
        *[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"), rule.alias("rule"),
        F.coalesce(says, F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"), score.alias("score"),
    )
