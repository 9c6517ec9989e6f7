"""Operator 8: URL filter by fixed host/path rules and mined association rules (built-in functions only).

Fixed rules (host, path, verdict) fit their host and its subdomains when the
path starts with the rule's path; the longest rule text wins.

URLs without a fixed rule are judged by association rules. Every URL becomes
a small set of tokens (top-level domain, site, first subdomain, first path
segment, file type, query keys). Spark's FP-growth mines the labelled URLs
(here: those with a fixed rule, labelled by its verdict) and keeps rules
``tokens -> block`` with enough support and confidence. A rule whose tokens
contain those of a shorter kept rule is pruned, as it could never decide.

FP-growth lists every subset of a frequent set, so what cannot be part of a
pruned rule is taken out before it runs: tokens with too few blocked URLs; tokens that are a rule of their own
(a longer rule would be pruned); tokens of all labelled URLs (they change nothing); and of tokens that
stand in exactly the same labelled URLs all but one, which stands for its class. So query keys that always come together count as one
token. What is left grows with the subsets of distinguishable, undecided tokens that are frequent together.
Rules are matched by an inverted index token -> rule: a URL's tokens are
joined with it, matches are counted per (URL, rule), and a rule fires when all
its tokens are there. A URL with a firing rule is blocked, others are allowed.

Defined cases: a null URL or one without ``://`` has empty host and path, no
rule and no tokens, so it is allowed; empty rules match nothing; repeated
rows each get a verdict; an empty table, or one without labelled URLs, mines
nothing; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import LOWER, UPPER, bounded_broadcast, written

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
LABEL = "="


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fixed rule that fits; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # later (longer) rules override
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The URL's distinct tokens: a handful, whatever its length but for the query keys."""
    labels = F.split(host, r"\.")
    site = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")
    segment = F.regexp_extract(path, r"^/([^/]*)", 1)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda kv: F.concat(F.lit("query:"), F.split_part(kv, F.lit("="), F.lit(1))))
    kind = (F.when(F.endswith(path, F.lit("/")), F.lit("dir"))
            .otherwise(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)))
    one = F.array(
        F.concat(F.lit("tld:"), F.element_at(labels, -1)),
        F.concat(F.lit("site:"), site),
        F.when(F.size(labels) > 3, F.concat(F.lit("sub:"), F.element_at(labels, 1))),
        F.when(segment != "", F.concat(F.lit("segment:"), segment)),
        F.when(kind != "", F.concat(F.lit("kind:"), kind)))
    found = F.array_distinct(F.concat(F.array_compact(one), F.when(query != "", keys).otherwise(F.array().cast("array<string>"))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(found)


def token_classes(sets: DataFrame, total: int, least: int, min_confidence: float) -> DataFrame:
    """(token, class, n, blocked, rule): tokens with enough blocked URLs; ``rule``: confident alone.

    ``sets``: distinct token sets (id, tokens) with n labelled URLs, ``blocked`` of them. A class is named by its smallest token.
    """
    each = sets.select("id", "n", "blocked", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.count("*").alias("sets"),
        F.bit_xor(F.xxhash64("id")).alias("h1"), F.bit_xor(F.xxhash64(F.lit("class"), "id")).alias("h2"))
    each = each.filter(F.col("blocked") >= least).withColumn("rule", F.col("blocked") / F.col("n") >= min_confidence)
    each = each.filter(F.col("rule") | (F.col("n") < total))
    names = each.groupBy("h1", "h2", "sets", "n").agg(F.min("token").alias("class"))
    return each.join(names, ["h1", "h2", "sets", "n"]).select("token", "class", "n", "blocked", "rule")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Pruned block rules from (id, tokens, verdict) rows, over token classes: (rule_id, tokens, n_tokens, confidence, support), (token, class)."""
    block = F.col("verdict") == "block"
    sets = written(labelled.groupBy("id").agg(F.first("tokens").alias("tokens"), F.count("*").alias("n"),
                                              F.count(F.when(block, 1)).alias("blocked")), "url-labelled")
    total = sets.agg(F.sum("n")).first()[0] or 0
    least = max(1, math.ceil(min_support * total))
    classes = written(token_classes(sets, total, least, min_confidence), "url-classes")
    alone = classes.filter("rule and token = class").select(
        F.array("class").alias("tokens"), (F.col("blocked") / F.col("n")).alias("confidence"),
        (F.col("blocked") / F.lit(total or 1)).alias("support"))
    open_ = classes.filter("not rule").select("token", "class")
    items = sets.select("id", F.explode("tokens").alias("token")).join(open_, "token").groupBy("id").agg(F.collect_set("class").alias("items"))
    each = sets.join(items, "id", "left").select(
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.explode(F.array(F.struct(F.lit("block").alias("v"), F.col("blocked").alias("times")),
                          F.struct(F.lit("allow").alias("v"), (F.col("n") - F.col("blocked")).alias("times")))).alias("of"))
    each = each.filter("of.times > 0").select(F.concat("items", F.array(F.concat(F.lit(LABEL), F.col("of.v")))).alias("items"),
                                              F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("of.times"))).alias("k"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(written(each.select("items"), "url-items"))
    rules = model.associationRules.filter(
        (F.col("consequent")[0] == LABEL + "block")).select(
            F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    rules = rules.unionByName(alone).withColumn("n_tokens", F.size("tokens")).withColumn("rule_id", F.array_join("tokens", "\u0001"))
    rules = written(rules, "url-rules")
    index = rules.select(F.col("rule_id").alias("short"), F.col("n_tokens").alias("short_n"), F.explode("tokens").alias("token"))
    long = rules.select("rule_id", "n_tokens", F.explode("tokens").alias("token"))
    covered = (long.join(index, "token").filter(F.col("short_n") < F.col("n_tokens"))
               .groupBy("rule_id", "short", "short_n").agg(F.count("*").alias("n")).filter(F.col("n") == F.col("short_n")))
    return rules.join(covered.select("rule_id").distinct(), "rule_id", "left_anti"), classes.select("token", "class")


def matches(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Ids of (id, tokens) rows where some rule has all its classes, through the token -> rule index."""
    index = rules.select("rule_id", "n_tokens", F.explode("tokens").alias("class")).join(classes, "class")
    index = bounded_broadcast(written(index, "url-index"))
    hits = urls.select("id", F.explode("tokens").alias("token")).join(index, "token").select("id", "rule_id", "n_tokens", "class").distinct()
    return (hits.groupBy("id", "rule_id", "n_tokens").agg(F.count("*").alias("n"))
            .filter(F.col("n") == F.col("n_tokens")).select("id").distinct())


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    Pages with the same token set share one verdict, so mining and matching
    run on token sets; labelled sets keep their multiplicity.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    base = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    base = base.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("fixed"),
                       F.array_sort(tokens(F.col("url"), F.col("host"), F.col("path"))).alias("tokens"))
    base = written(base.withColumn("id", F.array_join("tokens", "\u0001")), "url-base")
    mined, classes = mine(base.filter(F.col("fixed").isNotNull()).select("id", "tokens", F.col("fixed").alias("verdict")),
                          min_support, min_confidence)
    sets = base.filter(F.col("fixed").isNull()).groupBy("id").agg(F.first("tokens").alias("tokens"))
    blocked = written(matches(sets, mined, classes), "url-blocked").withColumn("blocked", F.lit(True))
    out = base.join(bounded_broadcast(blocked), "id", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "fixed", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
