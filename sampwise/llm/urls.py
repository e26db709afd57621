"""URL rules by host-suffix and path-prefix expressions, in DataFrame operations only.

Every URL becomes a few expressions: each suffix of its host that has as many labels as
some rule's host, with each prefix of its path that has the length of some rule's path.  The expressions
meet the rules in an equi-join on a short hash prefix; a full digest then confirms
the match, and the longest confirmed rule decides.

Rules are (host, path, verdict) rows.  A rule fits its host and all subdomains when
the URL's path starts with the rule's path.  Among fitting rules the one with the
longest host plus path wins; equal lengths: the longer host, then ``block``.

Defined cases: a null URL or one without ``://`` has an empty host and path and only
fits a rule whose host is empty and whose path is empty; null rule columns are empty;
rules that repeat count once; rows that repeat an id or URL are judged one by one; an
empty rule table gives the default verdict everywhere; input columns other than the
id and the URL are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_RULES = 100_000


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", prefix_chars: int = 8,
               broadcast_rules: int = BROADCAST_RULES, salts: int = 32) -> DataFrame:
    """Rows (id, host, path, rule, verdict, n_rules), one per input row.

    The path lengths and label counts of the rules are read first (as many values as there
    are different ones), so a long host costs no more expressions than a short one.  Up to
    ``broadcast_rules`` rules, a counted bound, the rules are broadcast; beyond it each rule
    is copied to ``salts`` lanes, so that an expression shared by a third of all URLs is
    joined by many tasks.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    known = (rules.select(text("host").alias("rule_host"), text("path").alias("rule_path"),
                          text("verdict").alias("rule_verdict"))
             .groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
             .withColumn("digest", _key(F.col("rule_host"), F.col("rule_path")))
             .withColumn("short", F.substring("digest", 1, prefix_chars)))
    shape = (known.groupBy(F.length("rule_path").alias("n"), F.size(F.split("rule_host", r"\.", -1)).alias("labels"))
             .count().collect())
    lengths, depths = sorted({r["n"] for r in shape}), sorted({r["labels"] for r in shape})
    n_rules = sum(r["count"] for r in shape)

    pages = urls.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        url_host(F.col(url_col)).alias("host"),
                        url_path(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.", -1)
    n = F.size(labels)

    def numbers(values):
        return F.array(*[F.lit(x) for x in values]).cast("array<int>")

    suffixes = F.transform(F.filter(numbers(depths), lambda x: x <= n),
                           lambda x: F.array_join(F.slice(labels, n - x + 1, x), "."))
    prefixes = F.transform(F.filter(numbers(lengths), lambda x: x <= F.length("path")),
                           lambda x: F.substring("path", F.lit(1), x))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: _key(h, p))))
    exploded = (pages.withColumn("expression", F.explode_outer(expressions))
                .withColumn("short", F.substring("expression", 1, prefix_chars)))
    if n_rules <= broadcast_rules:
        joined = exploded.join(F.broadcast(known), "short", "left")
    else:
        lanes = known.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = (exploded.withColumn("lane", F.pmod(F.hash("row"), F.lit(salts)))
                  .join(lanes, ["short", "lane"], "left"))
    rule = F.concat("rule_host", "rule_path")
    confirmed = F.when(F.col("expression") == F.col("digest"), F.struct(
        F.length(rule).alias("n"), F.length("rule_host").alias("h"),
        F.col("rule_verdict").alias("verdict"), rule.alias("rule")))
    best = joined.groupBy("row", "id", "host", "path").agg(
        F.max(confirmed).alias("best"), F.count(confirmed).alias("n_rules"))
    return best.select("id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"), "n_rules")
