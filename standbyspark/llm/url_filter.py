"""URL filters: fixed host/path rules first, then association rules mined by Spark's FP-growth, with DataFrame functions only.

A url becomes a set of tokens, each fact once: words of its host (between dots and hyphens) but the top-level domain, that
domain, words of its path's segments (other than numbers), file ending, query keys and scheme.  Labelled urls (bad or not)
are the transactions, with one more item for bad ones.  Rules "tokens -> bad" of enough support and confidence remain if the
bad urls among theirs exceed what the base rate explains by ``SIGMAS`` standard deviations; a rule is dropped if a part of
its tokens is a rule of no less confidence.  Rules are kept in an inverted index under their rarest token: a url looks up
only its own tokens, and a hit needs all tokens of the rule.

Defined results: null urls and urls without ``://`` have empty host and path, no tokens, and are allowed; repeated
rows are judged alike; other columns may have any name; without labelled urls there are no mined rules.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small

#: Production rules (host and path, verdict).
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.0005, 0.8
MIN_COUNT = 5  #: bad urls that a rule must fit, whatever the support asks for
SIGMAS = 5.0
_BAD = "!bad"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    host, path = host_of(url), path_of(url)
    tag = lambda kind, values: F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(kind + ":"), x))
    domain = F.regexp_extract(host, r"([^.]*)$", 1)
    inner = F.regexp_replace(host, r"[.]?[^.]*$", "")
    words = F.filter(F.split(F.lower(path), r"[^a-z0-9\x{80}-\x{10FFFF}]+"), lambda x: ~x.rlike("^[0-9]*$"))
    keys = F.regexp_extract_all(url, F.lit(r"[?&]([^=&#]+)="), 1)
    ending = F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1)
    found = F.concat(tag("h", F.split(inner, "[.-]")), tag("t", F.array(domain)), tag("p", words), tag("q", keys), tag("e", F.array(ending)), tag("s", F.array(F.regexp_extract(url, r"^([A-Za-z]+)://", 1))))
    return F.when(host != "", F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT, sigmas: float = SIGMAS) -> DataFrame:
    """(rule_id, items, confidence, support) from ``labelled(tokens, bad)``."""
    baskets = checkpointed(labelled.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(_BAD))).otherwise(F.col("tokens")).alias("items")).filter(F.size("items") > 0))
    numbers = baskets.agg(F.count("*").alias("all"), F.count_if(F.array_contains("items", _BAD)).alias("bad")).first()
    total, n_bad = numbers["all"], numbers["bad"]
    if n_bad == 0:
        return baskets.sparkSession.createDataFrame([], "rule_id long, items array<string>, confidence double, support double")
    # a token of every basket changes nobody's cover
    everywhere = [r["item"] for r in baskets.select(F.explode(F.array_distinct("items")).alias("item")).groupBy("item").count().filter(F.col("count") == total).collect() if r["item"] != _BAD]
    narrowed = baskets.select(F.array_except("items", F.array(*(F.lit(x) for x in everywhere)).cast("array<string>")).alias("items"))
    frequent = checkpointed(FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(narrowed).freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    bad = frequent.filter(F.array_contains("items", _BAD) & (F.size("items") > 1)).select(F.array_remove("items", _BAD).alias("items"), F.col("freq").alias("bad_freq"))
    rate = n_bad / total
    chance = F.col("freq") * rate
    rules = bad.join(frequent, "items").filter((F.col("bad_freq") >= min_count) & (F.col("bad_freq") / F.col("freq") >= min_confidence) & (F.col("bad_freq") - chance >= F.lit(sigmas) * F.sqrt(chance * (1 - rate))))
    rules = checkpointed(rules.select(F.xxhash64("items").alias("rule_id"), "items", (F.col("bad_freq") / F.col("freq")).alias("confidence"), (F.col("bad_freq") / total).alias("support")))
    keyed = rules.select("rule_id", "items", "confidence", F.explode("items").alias("item"))
    part = rules.select(F.col("items").alias("part"), F.col("confidence").alias("part_confidence"), F.array_min("items").alias("item"))
    implied = keyed.join(part, "item").filter((F.size("part") < F.size("items")) & (F.size(F.array_except("part", "items")) == 0) & (F.col("part_confidence") >= F.col("confidence"))).select("rule_id").distinct()
    return rules.join(implied, "rule_id", "left_anti")


def inverted_index(rules: DataFrame, per_item: DataFrame) -> DataFrame:
    """(item, rule_id, items, confidence): each rule once, under its rarest token."""
    spread = rules.select("*", F.explode("items").alias("item")).join(per_item, "item", "left")
    return spread.groupBy("rule_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "item")).alias("rare"), F.first("items").alias("items"), F.first("confidence").alias("confidence")).select(F.col("rare.item").alias("item"), "rule_id", "items", "confidence")


def bad_urls(urls: DataFrame, index: DataFrame) -> DataFrame:
    """(url, n_rules, confidence) of the distinct ``urls(url)`` that some rule fits."""
    looked_up = urls.filter("url is not null").distinct().select("url", tokens(F.col("url")).alias("tokens")).select("url", "tokens", F.explode("tokens").alias("item"))
    hits = looked_up.join(small(index, size=F.aggregate("items", F.lit(64).cast("long"), lambda a, x: a + F.octet_length(x) + 16)), "item").filter(F.size(F.array_except("items", "tokens")) == 0)
    return hits.groupBy("url").agg(F.count("*").alias("n_rules"), F.max("confidence").alias("confidence"))


def judged(pages: DataFrame, labelled_urls: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_rules, confidence) for each row of ``pages(page_id, url)``.

    ``labelled_urls(url, bad)`` has one row for each labelled page.
    """
    baskets = checkpointed(labelled_urls.filter("bad is not null").select(tokens(F.col("url").cast("string")).alias("tokens"), "bad"))
    per_item = baskets.select(F.explode("tokens").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    index = checkpointed(inverted_index(mined_rules(baskets), per_item))
    own = pages.select("page_id", F.col("url").cast("string").alias("url"))
    found = bad_urls(own.select("url"), index)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    out = own.join(found, "url", "left").select("page_id", host.alias("host"), path.alias("path"), F.col("n_rules"), F.col("confidence"))
    method = F.when(F.col("n_rules") > 0, "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"), "confidence")


def labels_of_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): a page is bad if its document (the number at the end of its path) is toxic or of no quality; null without a label."""
    own = pages.select(F.col("url").cast("string").alias("url")).withColumn("doc", F.regexp_extract("url", r"/(\d{1,18})[^/]*/?$", 1).try_cast("long"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc")).agg(F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")).alias("mark"))
    return own.join(marks, "doc", "left").select("url", (F.col("mark") == 1).alias("bad"))
