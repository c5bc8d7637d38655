"""URL filters: given rules first, then rules mined from the urls that those judge.

A given rule names a host and a start of the path; it fits that host and its subdomains, and the longest that fits
decides. What it decides are the labels: FP-growth mines the token combinations of labelled urls, and a combination
that is blocked often enough (support) and nearly always (confidence) becomes a rule for the urls no given rule fits.
A mined rule must name a site, that is a label of a host that is neither its top level nor a label of a given rule's
host: a language or a top level alone says nothing of a site.

The labels are not a sample: where a given rule looks at the path, it is the path that decides which urls of a host are
labelled, and how. So a url counts as blocked only for combinations that hold as many leading segments of its path as
the given rules of its host look at. And a rule must say more than its other tokens: without those that name a site (if
nothing is left: over all labelled urls) it must not be confident already.

Mined rules are found by an inverted index: each is listed under its rarest token, and a url that has that token is
checked for the others. Urls with equal tokens are looked up once.

Everything is Spark's own, FP-growth included. The number of mined rules does not grow with the urls: a token in at
least a share s of urls with at most t tokens each is one of t / s.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule, has no token and is
allowed; empty tables give empty results, without labelled urls nothing is mined; repeated rows are judged each; other
columns are ignored.
"""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroband.llm.texts import col
from aeroband.session import written_once

# (verdict, host, start of the path)
RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
]
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.95
BLOCKED = "=block"
SHORT = "=short"  # in place of segments that a path does not have; no combination holds it
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def parsed(pages: DataFrame) -> DataFrame:
    return pages.select(
        col("page_id").alias("page_id"), host_of(col("url")).alias("host"), path_of(col("url")).alias("path")
    )


def ruled(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule``, the longest that fits or null, and ``label``, its verdict."""
    chosen = label = F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last that fits is the longest
        inside = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = inside & F.col("path").startswith(path)
        chosen = F.when(fits, F.lit(host + path)).otherwise(chosen)
        label = F.when(fits, F.lit(verdict)).otherwise(label)
    return urls.withColumn("rule", chosen).withColumn("label", label)


def segments() -> Column:
    return F.transform(F.filter(F.split("path", "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))


def tokens() -> Column:
    """The distinct labels of the host, the last as top level, and segments of the path."""
    hosts = F.transform(F.filter(F.split("host", r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    top = F.transform(F.slice(hosts, -1, 1), lambda x: F.concat(F.lit("t:"), F.substr(x, F.lit(3))))
    below = F.slice(hosts, F.lit(1), F.greatest(F.size(hosts) - 1, F.lit(0)))
    return F.array_sort(F.array_distinct(F.concat(below, top, segments())))


def looked_at(rules=RULES) -> Column:
    """The leading segments of the path that the given rules of the host look at."""
    depths = [
        F.when((F.col("host") == host) | F.col("host").endswith("." + host), len([x for x in path.split("/") if x]))
        for _, host, path in rules
    ]
    depth = F.array_max(F.array(F.lit(0), *depths))
    return F.when(F.size(segments()) < depth, F.array(F.lit(SHORT))).otherwise(F.slice(segments(), F.lit(1), depth))


def names_site(token: Column, rules=RULES) -> Column:
    given = sorted({"h:" + label for _, host, _ in rules for label in host.split(".")})
    return token.startswith("h:") & ~token.isin(given)


def mined(labelled: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``wanted`` (tokens that together mean block), their rarest (``listed``), ``support`` and ``confidence``.

    ``labelled`` has ``tokens``, ``looked_at`` and ``label``. Tokens below the support are dropped by FP-growth itself;
    the label takes part as a token of its own, so that the combinations with it are counted in the same pass. Those
    that pass are counted again over the blocked urls, without the ones whose path decides.
    """
    items = labelled.select(F.when(F.col("label") == "block", F.array_append("tokens", F.lit(BLOCKED)))
                            .otherwise(F.col("tokens")).alias("items"))
    total = items.count()
    if not total:
        empty = "wanted array<string>, listed string, support double, confidence double"
        return labelled.sparkSession.createDataFrame([], empty)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    frequent = written_once(model.freqItemsets)
    blocked = frequent.filter(F.array_contains("items", BLOCKED) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", BLOCKED)).alias("wanted"), F.col("freq").alias("n_blocked")
    )
    seen = frequent.filter(~F.array_contains("items", BLOCKED)).select(
        F.array_sort("items").alias("wanted"), F.col("freq").alias("n")
    )
    counted = blocked.join(seen, "wanted").withColumn("sure", F.col("n_blocked") >= min_confidence * F.col("n"))
    rest = counted.select(F.col("wanted").alias("rest"), F.col("sure").alias("rest_sure"))
    all_sure = items.filter(F.array_contains("items", BLOCKED)).count() >= min_confidence * total
    candidates = (
        counted.filter("sure").withColumn("rest", F.filter("wanted", lambda x: ~names_site(x, rules)))
        .filter(F.size("rest") < F.size("wanted")).join(rest, "rest", "left")
        .filter(~F.coalesce("rest_sure", F.when(F.size("rest") == 0, F.lit(all_sure)).otherwise(F.lit(False))))
    )
    single = frequent.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("freq").alias("n_token"))
    each = candidates.select("wanted", "n", F.explode("wanted").alias("token")).join(single, "token")
    listed = each.groupBy("wanted", "n").agg(F.min(F.struct("n_token", "token")).alias("rarest")).select(
        "wanted", F.col("rarest.token").alias("listed"), "n"
    )
    urls = labelled.filter(F.col("label") == "block").groupBy("tokens", "looked_at").agg(F.count("*").alias("n_urls"))
    met = urls.withColumn("token", F.explode("tokens")).join(listed, F.col("token") == F.col("listed"))
    shown = met.filter(
        (F.size(F.array_except("wanted", "tokens")) == 0) & (F.size(F.array_except("looked_at", "wanted")) == 0)
    ).groupBy("wanted", "listed", "n").agg(F.sum("n_urls").alias("n_shown"))
    return shown.select(
        "wanted", "listed", (F.col("n_shown") / total).alias("support"), (F.col("n_shown") / F.col("n")).alias("confidence")
    ).filter((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``tokens`` that have all tokens of some rule."""
    each = token_sets.select("tokens").distinct().withColumn("token", F.explode("tokens"))
    met = each.join(rules, each["token"] == rules["listed"])
    return met.filter(F.size(F.array_except("wanted", "tokens")) == 0).select("tokens").distinct()


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per page: ``page_id``, ``host``, ``path``, ``rule`` and ``verdict``."""
    urls = ruled(parsed(pages), rules).withColumn("tokens", tokens())
    labelled = urls.filter(F.col("label").isNotNull()).select("tokens", looked_at(rules).alias("looked_at"), "label")
    mined_rules = written_once(mined(labelled, rules))
    hits = matched(urls.filter(F.col("label").isNull()), mined_rules).withColumn("mined", F.lit(True))
    verdict = F.coalesce("label", F.when(F.col("mined"), F.lit("block")).otherwise("allow"))
    return urls.join(hits, "tokens", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
