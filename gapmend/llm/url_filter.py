"""Block or allow URLs: rules first, then a logistic regression on their letters.

The regression sees hashed character n-grams of host and path and is trained
from a small labelled table of URLs. Both training and scoring are SQL
expressions: training folds gradient steps over the array of labelled URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

GRAM = 4
BUCKETS = 8192
ROUNDS = 60
RATE = 2.0
DECAY = 1e-4
# The labelled table is folded in one row; more URLs than this are refused.
MOST_LABELLED = 2000

# A rule fits its host and all subdomains where the path starts
# with the rule's; the longest that fits wins.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

# The small labelled table. 1 is to be blocked.
LABELLED = [
    (1, "https://casino-royal.example.com/en/12"),
    (1, "http://www.win-casino.example.net/de/play"),
    (1, "https://blog.big-win-slots.example.com/fr/7"),
    (1, "http://cheap-meds.example.net/en/order"),
    (1, "https://www.cheap-viagra-pills.example.com/en/4"),
    (1, "http://buy-pills-online.example.org/es/3"),
    (1, "https://m.diet-pills.example.net/en/99"),
    (1, "http://adult-video.example.com/en/1"),
    (1, "https://www.adult-x-cams.example.net/fr/5"),
    (1, "http://xxx-adult.example.org/de/2"),
    (1, "https://free-porn.example.com/en/8"),
    (1, "https://adult-dating.example.com/en/66.html"),
    (1, "http://adult.example.net/de/3050"),
    (1, "https://m.free-bets-now.example.net/en/31"),
    (1, "http://sport-bets.example.com/es/6"),
    (1, "https://blog.poker-bets.example.org/en/11"),
    (1, "http://ads-network.example.com/en/click"),
    (1, "https://m.track-ads.example.net/en/77"),
    (1, "http://popup-ads-track.example.com/de/5"),
    (1, "https://ad-track-pixel.example.net/fr/15"),
    (1, "http://link-farm.example.org/en/21"),
    (1, "https://www.spam-links.example.com/en/3"),
    (1, "http://seo-spam-farm.example.net/es/9"),
    (1, "https://free-money-win.example.com/en/44"),
    (1, "http://phishing-login.example.net/en/account"),
    (1, "https://crypto-giveaway.example.com/en/claim"),
    (1, "http://online-casino.example.org/fr/61"),
    (1, "https://www.lucky-casino-win.example.com/en/20.html"),
    (1, "https://blog.cheap-replicas.example.com/de/81/"),
    (1, "http://pills-shop.example.net/fr/70"),
    (1, "https://content-farm.example.com/de/904?page=2"),
    (1, "http://m.adult-chat.example.net/es/13"),
    (1, "https://ads.example.net/en/5501?utm_source=feed"),
    (0, "https://www.city-library.example.org/en/120"),
    (0, "http://news.morning-post.example.com/de/45"),
    (0, "https://blog.garden-notes.example.net/en/33"),
    (0, "https://recipes.example.com/fr/210"),
    (0, "http://weather.example.org/en/2024"),
    (0, "https://m.history-of-science.example.com/es/17"),
    (0, "https://docs.opensource.example.org/en/install.html"),
    (0, "http://university.example.net/de/studium"),
    (0, "https://www.museum.example.org/fr/expositions/"),
    (0, "https://travel-guide.example.com/es/madrid"),
    (0, "http://blog.mountain-hikes.example.net/en/5?page=2"),
    (0, "https://forum.woodwork.example.com/en/8812#top"),
    (0, "https://theory.example.org/en/66.html"),
    (0, "http://www.health-ministry.example.net/fr/vaccins"),
    (0, "https://m.thornhill.example.com/en/3001"),
    (0, "http://station.example.net/de/fahrplan"),
    (0, "https://translation.example.org/en/51/"),
    (0, "https://theatre.example.com/fr/saison"),
    (0, "http://blog.thestone.example.org/en/772"),
    (0, "https://school.example.net/es/clase"),
    (0, "https://another-tale.example.com/en/19?utm_source=feed"),
    (0, "http://www.northern-rivers.example.org/en/408"),
    (0, "https://edition.example.net/en/30077"),
    (0, "https://tionary.example.com/de/1204.html"),
    (0, "https://thousand.example.com/en/35"),
    (0, "http://m.thinking.example.net/en/2906?ref=x"),
    (0, "https://blog.heather.example.com/de/718/"),
    (0, "https://www.with-others.example.net/es/4017"),
    (0, "http://southern.example.org/fr/93.html"),
    (0, "https://the-end.example.com/en/650/"),
]

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for null and where ``://`` is missing."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, CAPITALS, SMALL), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column, buckets: int) -> Column:
    """Buckets of the character n-grams, each once, in order; digits are alike."""
    text = F.translate(F.concat(F.lit("^"), host, F.lit("$"), path, F.lit("$")), "123456789", "0" * 9)
    last = F.greatest(F.length(text) - (GRAM - 1), F.lit(1))
    each = F.transform(F.sequence(F.lit(1), last), lambda i: F.pmod(F.xxhash64(F.substr(text, i, F.lit(GRAM))), F.lit(buckets)).cast("int"))
    return F.array_sort(F.array_distinct(each))


def logistic(total: Column) -> Column:
    return 1 / (1 + F.exp(-total))


def train(labelled: DataFrame, buckets: int = BUCKETS, rounds: int = ROUNDS) -> list[float]:
    """Weights of the buckets, and last of all the intercept.

    ``labelled`` has url and label (1: block). Gradient steps go through the
    URLs in their order, ``rounds`` times. Without a labelled URL all weights
    are 0. More than ``MOST_LABELLED`` URLs are refused.
    """
    rows = labelled.filter("url is not null and label is not null").select("url", "label").distinct()
    if rows.limit(MOST_LABELLED + 1).count() > MOST_LABELLED:
        raise ValueError(f"the labelled table has more than {MOST_LABELLED} URLs")
    host, path = host_and_path(F.col("url"))
    features = F.struct("url", F.col("label").cast("double").alias("label"), grams(host, path, buckets).alias("grams"))
    examples = rows.groupBy().agg(F.array_sort(F.collect_list(features)).alias("examples"))
    examples = examples.withColumn("known", F.array_sort(F.array_distinct(F.flatten("examples.grams"))))
    # Weights of the buckets that occur, in the order of ``known``, and the intercept.
    places = F.transform("examples", lambda e: F.struct(
        e["label"].alias("label"), F.transform(e["grams"], lambda g: F.array_position("known", g).cast("int")).alias("at")
    ))
    size = F.size("known")

    def step(weights: Column, example: Column) -> Column:
        at = example["at"]
        total = F.aggregate(at, F.element_at(weights, -1), lambda sum_, p: sum_ + F.element_at(weights, p) / F.sqrt(F.size(at)))
        change = RATE * (example["label"] - logistic(total))
        return F.transform(
            weights,
            lambda w, i: w * (1 - DECAY)
            + F.when(i == size, change).when(F.array_contains(at, i + 1), change / F.sqrt(F.size(at))).otherwise(0.0),
        )

    weights = F.aggregate(
        F.flatten(F.array_repeat("places", rounds)), F.array_repeat(F.lit(0.0), size + 1), step
    )
    found = examples.withColumn("places", places).select("known", weights.alias("weights")).first()
    out = [0.0] * (buckets + 1)
    for bucket, weight in zip([*found["known"], buckets], found["weights"]):
        out[bucket] = weight
    return out


def labelled_urls(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"({label}, '{url}')" for label, url in LABELLED)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(label, url)")


def judge_urls(
    pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]] = RULES, url: str = "url", page_id: str = "page_id"
) -> DataFrame:
    """Returns page_id, host, path, rule, verdict and score of each page.

    ``rule`` is the longest that fits, else null; ``verdict`` is its kind, else
    block where the score, the probability that the URL is to be blocked, is
    0.5 or more. Null URLs and those without ``://`` have an empty host and
    path, fit no rule and are scored on nothing. Repeated rows are judged
    alike; an empty table gives no rows; other columns are not looked at.
    """
    weights = train(labelled)
    known = F.lit(weights)
    host, path = host_and_path(F.coalesce(F.col(url), F.lit("")))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, kind = rule_of(F.col("host"), F.col("path"), rules)
    scored = rows.select("page_id", "host", "path", rule.alias("rule"), kind.alias("kind"), grams(F.col("host"), F.col("path"), len(weights) - 1).alias("grams"))
    total = F.aggregate("grams", F.lit(0.0), lambda sum_, b: sum_ + known[b])
    score = logistic(weights[-1] + total / F.sqrt(F.size("grams")))
    judged = scored.select("page_id", "host", "path", "rule", "kind", score.alias("score"))
    guess = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("kind", guess).alias("verdict"), "score")
