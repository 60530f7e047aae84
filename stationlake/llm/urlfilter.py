"""URL filter: listed rules first, association rules mined from labelled urls for the rest.

A url is a transaction of its tokens. Single tokens are judged first. What is left is reduced before
Spark's FP-growth mines combinations of any length: tokens that already are rules (a combination with
one only narrows it), tokens too rare for any frequent combination, and all but one of the tokens that
occur in the very same labelled urls are taken out. So a url of many tokens that repeats a thousand
times is one token to the miner, not all subsets of its tokens. Confidence is counted over all labelled
urls, and must be more than chance would give: a rule is kept if its share of blocked urls reaches
``MIN_CONFIDENCE`` and the base rate would give as large a share with a probability below ``CHANCE``, shared
among all combinations tried. Rules match urls through an inverted index: each rule is filed under
its rarest token, urls look up their tokens, and the few hits are checked in full.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import staged, table
from stationlake.llm.html_text import host_of

#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: words of a host that mark it as blocked when labelling urls
SEED_WORDS = ["ads", "adult", "banner", "bet", "bets", "casino", "escort", "gambling", "malware", "phishing", "pills", "poker",
              "porn", "sex", "spam", "torrent", "tracker", "viagra", "warez", "xxx"]
MIN_SUPPORT = 0.01         # share of the blocked labelled urls that a combination must occur in
MIN_COUNT = 5              # and that many urls at least
MIN_CONFIDENCE = 0.8       # share of the labelled urls with the combination that are blocked
CHANCE = 0.01              # probability that any rule is kept by chance


def _after_scheme(url: Column) -> Column:
    first = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    return F.substring(url, F.char_length(first) + 4, F.char_length(url))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct words of host, path and query, marked by where they stand; words of digits are left out."""
    words = lambda text, mark: F.transform(
        F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.rlike(r"^[0-9]+$")),
        lambda w: F.concat(F.lit(mark), w))
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    return F.array_distinct(F.concat(words(host_of(url), "h:"), words(path_of(url), "p:"), words(query, "q:")))


def listed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, or nulls."""
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in rules]
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), i))
    pick = lambda value: reduce(lambda rest, i: F.when(fits[i], F.lit(value(rules[i]))).otherwise(rest),
                                reversed(order), F.lit(None).cast("string"))
    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


def document_number(url: Column) -> Column:
    """The number of the document that a page was made of: the last digits of the url's path; null if it has none."""
    return F.regexp_extract(path_of(url), r"([0-9]+)[^0-9]*$", 1).try_cast("long")


def label_urls(pages: DataFrame, labels: DataFrame, seeds: list[str] = SEED_WORDS) -> DataFrame:
    """(tokens, blocked): urls that are labelled, by a seed word in the host or by ``labels``.

    A label row is that of the document whose number the url has; poor quality or toxic means blocked, and of
    several labels of a document one is enough.
    """
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    judged = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("number")).agg(
        F.bool_or(F.coalesce(bad, F.lit(False))).alias("bad"))
    tokens = pages.select(document_number(F.col("url")).alias("number"), url_tokens(F.col("url")).alias("tokens"))
    seeded = F.exists("tokens", lambda t: t.isin([f"h:{w}" for w in seeds]))
    known = tokens.withColumn("seeded", seeded).join(judged, "number", "left")
    return known.where(F.col("seeded") | F.col("bad").isNotNull()).select(
        "tokens", (F.col("seeded") | F.coalesce("bad", F.lit(False))).alias("blocked")).where(F.size("tokens") > 0)


def _lookup(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (_id, tokens) × rules whose filed token they hold and whose other tokens they hold too."""
    return (rows.select("*", F.explode("tokens").alias("token")).join(rules, "token")
            .where(F.size(F.array_except("items", "tokens")) == 0))


def _filed(sets: DataFrame, counts: DataFrame) -> DataFrame:
    """``sets`` (items, …) plus ``token``, the rarest of their items."""
    rarest = (sets.select("items", F.explode("items").alias("token")).join(counts, "token")
              .groupBy("items").agg(F.min(F.struct("urls", "token")).alias("r")).select("items", F.col("r.token").alias("token")))
    return sets.join(rarest, "items")


def sure(blocked: Column, urls: Column, base: float, tried: int, min_confidence: float, chance: float) -> Column:
    """Whether a share of blocked urls is high, and not by chance: the Chernoff bound on the probability of it at
    the base rate is below ``chance`` for all ``tried`` combinations together."""
    share = blocked / urls
    log = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    surprise = urls * (log(share, F.lit(base)) + log(1 - share, F.lit(1 - base)))
    rare = F.lit(True) if base <= 0 else surprise >= math.log(max(tried, 1) / chance)
    return (share >= min_confidence) & (share > base) & rare


def mine_rules(known: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
               min_confidence: float = MIN_CONFIDENCE, chance: float = CHANCE) -> DataFrame:
    """``known`` (tokens, blocked) → rules (items sorted array, token, blocked_urls, urls, confidence).

    ``token`` is the rule's rarest token, under which the inverted index files it. Of tokens that occur in the
    same labelled urls the first in alphabetical order stands for all.
    """
    spark = known.sparkSession
    # equal token sets are counted once, with how often they occur
    urls = staged(known.groupBy(F.array_sort("tokens").alias("tokens")).agg(
        F.count("*").alias("times"), F.count_if("blocked").alias("bad")), "labelled-urls")
    totals = urls.agg(F.sum("bad").alias("bad"), F.sum("times").alias("times")).first()
    empty = spark.createDataFrame([], "items array<string>, token string, blocked_urls long, urls long, confidence double")
    n = totals.bad or 0
    if n < min_count:
        return empty
    base, least = n / totals.times, max(math.ceil(min_support * n), min_count)
    mark = F.xxhash64("tokens")  # a token's urls are known by the sum of their marks
    counts = staged(urls.select(F.explode("tokens").alias("token"), "times", "bad", mark.alias("mark")).groupBy("token").agg(
        F.sum("bad").alias("blocked_urls"), F.sum("times").alias("urls"), F.expr("bit_xor(mark)").alias("same"))
        .where(F.col("blocked_urls") >= least), "frequent-tokens")
    judge = lambda tried: sure(F.col("blocked_urls"), F.col("urls"), base, tried, min_confidence, chance)
    singles = counts.withColumn("sure", judge(counts.count()))
    kept = singles.where("sure").select(F.array("token").alias("items"), "token", "blocked_urls", "urls")
    open_tokens = singles.where("NOT sure").groupBy("same", "urls", "blocked_urls").agg(F.min("token").alias("token"))
    # the transactions of FP-growth: what is left of the blocked urls, each as often as it occurs
    left = (urls.where("bad > 0").select(F.xxhash64("tokens").alias("set"), "bad", F.explode("tokens").alias("token"))
            .join(open_tokens.select("token"), "token").groupBy("set", "bad").agg(F.collect_list("token").alias("tokens"))
            .where(F.size("tokens") > 1))
    each = staged(left.select("tokens", F.explode(F.sequence(F.lit(1), F.col("bad").cast("int")))).select("tokens"), "open-urls")
    m = each.count()
    if m >= least:
        sets = FPGrowth(itemsCol="tokens", minSupport=min(1.0, (least - 0.5) / m)).fit(each).freqItemsets
        sets = staged(_filed(sets.where(F.size("items") > 1).select(F.array_sort("items").alias("items"), F.col("freq").alias("blocked_urls")),
                             counts.select("token", "urls")), "itemsets")
        seen = _lookup(urls, sets.select("items", "token")).groupBy("items").agg(F.sum("times").alias("urls"))
        found = sets.join(seen, "items").where(judge(sets.count()))
        # a rule that only adds tokens to another one matches nothing new
        found = staged(found.select("items", "token", "blocked_urls", "urls"), "sure-rules")
        wide = found.select(F.col("items").alias("tokens"))
        narrow = _lookup(wide, found.select("items", "token")).where(F.size("items") < F.size("tokens")).select(F.col("tokens").alias("items")).distinct()
        kept = kept.unionByName(found.join(narrow, "items", "left_anti"))
    return staged(kept.withColumn("confidence", F.col("blocked_urls") / F.col("urls")).select(*empty.columns), "rules")


def judge_urls(pages: DataFrame, rules: DataFrame, listed=RULES) -> DataFrame:
    """``pages`` plus host, path, rule and verdict (replacing columns of those names).

    A listed rule decides first; else a url that a mined rule matches is blocked and any other
    allowed, null and malformed urls included. Repeated urls keep one row each.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    url = F.col("url")
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    parted = (pages.select(*[f"`{c}`" for c in keep], host_of(url).alias("host"), path_of(url).alias("path"))
              .withColumns({"rule": rule, "_listed": verdict}))
    urls = pages.select("url").where(url.isNotNull()).distinct().select(url.alias("_url"), url_tokens(url).alias("tokens"))
    matched = staged(_lookup(urls, rules.select("items", "token")).select("_url").distinct(), "matched-urls")
    out = parted.join(matched, parted["url"] == matched["_url"], "left")
    mined = F.when(F.col("_url").isNotNull(), "block").otherwise("allow")
    return out.select(*[f"`{c}`" for c in keep], "host", "path", "rule", F.coalesce("_listed", mined).alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = mine_rules(label_urls(pages, table(spark, sf_dir, "labels")))
    return judge_urls(pages, rules).drop("url")
