"""URL rules by hashed expressions.

A rule is a host, a path and an action; it fits its host and all subdomains when the
URL's path starts with the rule's. Each URL is expanded into host suffixes times path
prefixes, restricted to the label counts and path lengths that rules have, which loses
no rule. Expressions join rules on the first four bytes of a SHA-256 digest; the full
digest confirms. Of several fitting rules the longest (host and path together) wins,
then the longer host, then `block`.

Defined results: a URL that is null or has no `://` has an empty host and path and fits
no rule; an empty path fits no rule whose path has a character; a rule list without rows
gives the default everywhere; repeated rules count once; rows repeat as in the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE_SCHEMA = "rule_host string, rule_path string, action string"


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expression_digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def hash_prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules with label count, path length, digest and short hash."""
    host, path = F.col("rule_host"), F.col("rule_path")
    return (
        rules.where(host.isNotNull() & path.isNotNull() & F.col("action").isin("allow", "block"))
        .groupBy(host, path).agg(F.max("action").alias("action"))
        .withColumn("labels", F.size(F.split(host, r"\.")))
        .withColumn("path_length", F.length(path))
        .withColumn("digest", expression_digest(host, path))
        .withColumn("short", hash_prefix(F.col("digest")))
    )


def expressions(urls: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """One row per URL and expression; `urls` has url, host and path."""
    parts = F.split(F.col("host"), r"\.")
    suffixes = F.filter(F.array(*[
        F.when(F.size(parts) >= n, F.substring_index(F.col("host"), ".", -n)) for n in labels
    ]), lambda x: x.isNotNull())
    prefixes = F.filter(F.array(*[
        F.when(F.length("path") >= n, F.substring(F.col("path"), 1, n)) for n in lengths
    ]), lambda x: x.isNotNull())
    return (
        urls.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
        .withColumn("digest", expression_digest(F.col("suffix"), F.col("prefix")))
        .select("url", hash_prefix(F.col("digest")).alias("short"), "digest")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule and verdict; columns of these names are replaced.

    Only distinct URLs are expanded; the rules' label counts and path lengths are the
    only values that reach the driver, and they are bounded by the longest rule.
    """
    known = prepared_rules(rules)
    shape = known.select("labels", "path_length").distinct().collect()
    labels, lengths = sorted({r[0] for r in shape}), sorted({r[1] for r in shape})
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    address = F.col(f"`{url}`")
    named = pages.select(*[f"`{c}`" for c in kept], url_host(address).alias("host"), url_path(address).alias("path"))
    if not shape:
        return named.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    key = "__url"
    distinct = (
        pages.where(address.isNotNull()).select(address.alias("url")).distinct()
        .withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    )
    order = F.struct(F.length(F.concat("rule_host", "rule_path")), F.length("rule_host"), F.col("action"))
    best = (
        expressions(distinct, labels, lengths).alias("e")
        .join(known.alias("k"), "short")
        .where(F.col("e.digest") == F.col("k.digest"))
        .groupBy("url")
        .agg(F.max(F.struct(order.alias("o"), F.concat("rule_host", "rule_path").alias("rule"), F.col("action"))).alias("b"))
        .select(F.col("url").alias(key), F.col("b.rule").alias("rule"), F.col("b.action").alias("verdict"))
    )
    return (
        named.join(best, F.col(f"`{url}`") == F.col(key), "left").drop(key)
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    )
