"""URL filters (operator 8): a host-and-path rule list, then association rules mined by Spark FP-growth.

Labelled urls become transactions of tokens (host labels, path segments, query keys) plus the token of their label.
FP-growth finds the combinations that enough bad pages share (tokens that are rules by themselves or that always come
together are dealt with before, see ``mine``); each is counted over all labelled pages, and becomes a rule if the lower end of the 95 % (Wilson) interval of its share of bad pages reaches the threshold and no shorter rule
inside it has as high a share.  The interval alone says how many bad pages a rule needs (16 at 0.8, all of them bad),
so whether pages teach a rule does not depend on how large the table around them is.  Rules are matched through an inverted index: each
rule is listed under its rarest token, the urls' tokens are joined to the lists, and the rule holds if its other
tokens are there too.  Everything is DataFrame and SQL functions.

Verdict: the longest rule of the list that fits decides; else block if an association rule matches, else allow.

Defined results: null urls and urls without ``://`` have an empty host and path and, having no tokens, are allowed;
null page ids and repeated rows pass through; a page without label, or no labels at all, teaches nothing (no rules,
all allowed); other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.shared import written

MIN_CONFIDENCE = 0.8
#: Width of the 95 % interval in standard deviations.
Z = 1.96
BLOCK_TOKEN = "#block"

# The rule list (action, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Mined:
    """rules: antecedent tokens, confidence, support; names: tokens that rules know by another's name (token, named)."""

    rules: DataFrame
    names: DataFrame


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or end, A-Z lower-cased; path: then up to ? # or end; else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and action of the longest rule that fits, as one conditional expression (null if none does)."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return name, action


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: h:<host label>, p:<path segment>, q:<query key>; host and path may be empty."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), "^[^?#]*\\?([^#]*)", 1)

    def part(prefix: str, items: Column) -> Column:
        return F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))
    return F.when(host != "", F.array_distinct(F.concat(
        part("h:", F.split(host, "\\.")), part("p:", F.split(path, "/")),
        part("q:", F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0]))))).otherwise(
        F.array().cast("array<string>"))


def least_pages(min_confidence: float) -> int:
    """Bad pages below which no combination's interval can reach the threshold: n / (n + Z^2) is the end for n of n."""
    return max(1, math.ceil(min_confidence * Z * Z / (1 - min_confidence)))


def lower_end(bad: Column, pages: Column) -> Column:
    """Lower end of the Wilson interval of the share bad / pages."""
    share = bad / pages
    spread = Z * F.sqrt(share * (1 - share) / pages + Z * Z / (4 * pages * pages))
    return (share + Z * Z / (2 * pages) - spread) / (1 + Z * Z / pages)


def mine(labelled: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> Mined:
    """Rules from rows of (items: tokens and, where the label is bad, BLOCK_TOKEN).

    A token that is a rule by itself is taken out before FP-growth: a longer rule with it would hold on no other page.
    Tokens that stand on the same labelled pages become one (the least of them): they can't be told apart, so their 2^n
    combinations are one.  What FP-growth sees is therefore the tokens of bad pages that good pages share, each once.
    """
    spark = labelled.sparkSession
    none = Mined(spark.createDataFrame([], "antecedent array<string>, confidence double, support double"), spark.createDataFrame([], "token string, named string"))
    labelled = written(labelled.withColumn("page", F.monotonically_increasing_id()), "url-labelled")
    is_bad = F.array_contains("items", BLOCK_TOKEN)
    n_all, n_bad, least = *labelled.agg(F.count("*"), F.count_if(is_bad)).first(), least_pages(min_confidence)
    if n_bad < least:
        return none
    each = labelled.select("page", is_bad.alias("bad"), F.explode("items").alias("token")).filter(F.col("token") != BLOCK_TOKEN)
    counted = each.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.bit_xor(F.xxhash64("page")).alias("pages"))
    counted = written(counted.filter(F.col("n_bad") >= least).withColumn("rule", lower_end(F.col("n_bad"), F.col("n")) >= min_confidence), "url-tokens")
    share, support = (F.col("n_bad") / F.col("n")).alias("confidence"), (F.col("n_bad") / n_all).alias("support")
    single = counted.filter("rule").select(F.array("token").alias("antecedent"), share, support)
    same = counted.filter("not rule").groupBy("n", "n_bad", "pages").agg(F.min("token").alias("named"), F.collect_list("token").alias("tokens"))
    names = written(same.select(F.explode("tokens").alias("token"), "named"), "url-names")
    merged = written(each.join(names, "token").groupBy("page", "bad").agg(F.collect_set("named").alias("items")), "url-merged")
    bad = merged.filter("bad and size(items) > 1").select("items")
    if bad.isEmpty():
        return Mined(single, names)
    # half a page less, as the product of share and count may come out above the whole number
    sets = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / bad.count())).fit(bad).freqItemsets
    sets = written(sets.filter("size(items) > 1").select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("n_bad")), "url-sets")
    held = _holding(merged.select("page", F.col("items").alias("tokens")), sets)
    rules = sets.join(held.groupBy("antecedent").agg(F.count("*").alias("n")), "antecedent")
    rules = written(rules.filter(lower_end(F.col("n_bad"), F.col("n")) >= min_confidence).select("antecedent", share, support), "url-rules")
    # a rule says nothing new if a shorter one within it is at least as confident: found through the shorter one's rarest token
    short = rules.select(F.col("antecedent").alias("inner"), F.col("confidence").alias("inner_confidence"))
    inside = _holding(rules.select(F.col("antecedent").alias("tokens"), "confidence"), rules.select("antecedent"))
    implied = (inside.filter(F.size("antecedent") < F.size("tokens")).join(short, F.col("inner") == F.col("antecedent"))
               .filter(F.col("inner_confidence") >= F.col("confidence")).select(F.col("tokens").alias("antecedent")).distinct())
    return Mined(single.unionByName(rules.join(implied, "antecedent", "left_anti")), names)


def _by_rarest(sets: DataFrame, each: DataFrame) -> DataFrame:
    """antecedent and the token of it that is rarest among the rows of ``each`` (token)."""
    often = each.groupBy("token").agg(F.count("*").alias("n"))
    entries = sets.select("antecedent", F.explode("antecedent").alias("token")).join(often, "token")
    return entries.groupBy("antecedent").agg(F.min_by("token", F.struct("n", "token")).alias("token"))


def _holding(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of (tokens, ...) with each set (antecedent) that they hold, found under the set's rarest token."""
    each = rows.withColumn("token", F.explode("tokens"))
    return each.join(_by_rarest(sets, each.select("token")), "token").filter(F.size(F.array_except("antecedent", "tokens")) == 0).drop("token")


def matches(urls: DataFrame, mined: Mined) -> DataFrame:
    """Distinct urls (url, tokens) on which at least one rule holds, through the rules' rarest tokens."""
    named = (urls.select("url", F.explode("tokens").alias("token")).join(mined.names, "token")
             .groupBy("url").agg(F.collect_set("named").alias("named")))
    known = urls.join(named, "url", "left").select("url", F.array_union("tokens", F.coalesce("named", F.array().cast("array<string>"))).alias("tokens"))
    return _holding(known, mined.rules.select("antecedent")).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url); labels: doc_id, quality, toxic.

    A page is labelled by the row of its id; it is bad if it is toxic.
    """
    url = F.col("url").cast("string")
    own = pages.select("page_id", url.alias("url"))
    host, path = host_and_path(F.col("url"))
    # how bad a url is counts per page, so pages that share a url stay separate transactions
    bad = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id")).agg(F.max("toxic").alias("toxic"))
    marked = (own.join(bad, "page_id").filter(F.col("toxic").isNotNull() & F.col("url").isNotNull())
              .select(tokens(F.col("url"), host, path).alias("t"), "toxic").filter(F.size("t") > 0)
              .select(F.when(F.col("toxic") > 0, F.array_append("t", F.lit(BLOCK_TOKEN))).otherwise(F.col("t")).alias("items")))
    found = mine(marked, min_confidence)
    mined = Mined(written(found.rules, "url-kept-rules"), found.names)
    distinct = own.filter(F.col("url").isNotNull()).select("url").distinct()
    distinct = distinct.select("url", tokens(F.col("url"), host, path).alias("tokens"))
    blocked = written(matches(distinct, mined).withColumn("hit", F.lit(True)), "url-blocked")
    rule, action = listed(F.col("host"), F.col("path"), rules)
    return (own.join(blocked, "url", "left")
            .select("page_id", host.alias("host"), path.alias("path"), "hit")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(action, F.when(F.col("hit"), F.lit("block")), F.lit("allow")).alias("verdict")))
