"""URL filter: fixed host and path rules, and association rules for the rest.

Given rules decide where one fits. For the other addresses FP-growth mines
combinations of URL tokens that go with a label among the labelled addresses;
rules pruned by support and confidence are matched through an inverted index
from token to rule. DataFrame functions and Spark ML only.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import shared_table

#: Least part of the labelled addresses that a combination covers, least confidence of a rule.
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
LABEL = "label="


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]], value: int) -> Column:
    """The longest (host, path, verdict) rule that fits, as its text (``value``
    0) or its verdict (1); null where none fits. A rule fits its host and all
    subdomains if the path starts with the rule's."""
    out = F.lit(None).cast("string")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.lit((rule_host + rule_path, verdict)[value])).otherwise(out)
    return out


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a whole address: scheme, every host suffix, first
    host label, the word of every path part with its place (runs of digits as
    one 0), file ending, names of all parameters, and that of the fragment's
    presence."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.lit("host="), F.array_join(F.slice(labels, -k, k), ".")))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    words = F.transform(parts, lambda p, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="),
                                                     F.regexp_replace(F.lower(p), "[0-9]+", "0")))
    scheme = F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""),
                        lambda p: F.concat(F.lit("query="), F.substring_index(p, "=", 1)))
    single = F.array(scheme, F.when(n > 2, F.concat(F.lit("first="), F.get(labels, F.lit(0)))),
                     F.when(ending != "", F.concat(F.lit("ending="), F.lower(ending))),
                     F.when(F.instr(url, "#") > 0, F.lit("fragment")))
    return F.array_sort(F.array_distinct(F.filter(F.concat(single, suffixes, words, names), lambda t: t.isNotNull())))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(``tokens``, ``label``) -> (``rule_id``, ``antecedent``, ``label``,
    ``confidence``, ``support``): token combinations that go with a label.

    Support bounds the frequent combinations, and so the rules, whatever the
    number of addresses. No labelled row gives no rule.
    """
    baskets = labelled.select(F.array_distinct(
        F.concat("tokens", F.array(F.concat(F.lit(LABEL), F.col("label"))))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    to = F.get("consequent", F.lit(0))
    rules = model.associationRules.where(
        to.startswith(LABEL) & ~F.exists("antecedent", lambda t: t.startswith(LABEL)))
    return rules.select(
        F.xxhash64(F.array_sort("antecedent"), to).alias("rule_id"), F.array_sort("antecedent").alias("antecedent"),
        F.substring(to, len(LABEL) + 1, 1 << 20).alias("label"), "confidence", "support")


def match_rules(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``tokens`` arrays -> the ``label`` of the best rule all of whose
    tokens they hold, found by an inverted index from token to rules: the most
    confident, then best supported, then longest, then least label and id.
    Arrays without a matching rule are absent."""
    index = rules.select("rule_id", "label", "confidence", "support", F.size("antecedent").alias("needs"),
                         F.explode("antecedent").alias("token"))
    held = tokens.select("tokens", F.explode("tokens").alias("token"))
    full = (held.join(index, "token").groupBy("tokens", "rule_id", "label", "confidence", "support", "needs")
            .count().where("count = needs"))
    best = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"),
                          (-F.col("needs")).alias("n"), "label", "rule_id"))
    return full.groupBy("tokens").agg(best.alias("best")).select("tokens", F.col("best.label").alias("label"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], key_col: str = "page_id", url_col: str = "url",
               default: str = "allow", min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Judge every address: the key, ``host``, ``path``, ``rule`` (null without
    one), ``verdict``: the rule's, else the mined rules', else ``default``.

    A null or empty address has empty host and path. Repeats and null keys give
    a row each; other columns are not read.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(key_col), url.alias("__url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = (rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules, 0))
            .withColumn("__given", fitting_rule(F.col("host"), F.col("path"), rules, 1))
            .withColumn("tokens", url_tokens(F.coalesce("__url", F.lit("")), F.col("host"), F.col("path"))))
    mined = shared_table(mine_rules(rows.where(F.col("__given").isNotNull()).select(
        "tokens", F.col("__given").alias("label")), min_support, min_confidence), "url-rules")
    found = match_rules(rows.where(F.col("__given").isNull()).select("tokens").distinct(), mined)
    return rows.join(found, "tokens", "left").select(
        key_col, "host", "path", "rule", F.coalesce("__given", "label", F.lit(default)).alias("verdict"))
