"""Allow and block rules for urls, with block decisions carried over redirects and canonical links.

A rule is a host and a path; it fits its host and all subdomains where the url's path starts with the
rule's path, and the longest fitting rule decides (of equally long ones the allowing). Urls that
redirect to each other or name each other as canonical form one group; a block decision holds for all
urls of its group that no rule allows explicitly. Other urls are allowed.

A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed. Repeated
rows get the same verdict each. A null html has no links. Very long urls and pages are read whole. Other
columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.llm.graph import components
from contest_analytics.llm.text import lower_ascii

Rule = tuple[str, str, str]  # verdict, host, path
SALTS = 32


def _part(url: Column, pattern: str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)


def host_of(url: Column) -> Column:
    return lower_ascii(_part(url, "(?s)^.*?://([^/?#]*)"))


def path_of(url: Column) -> Column:
    return _part(url, "(?s)^.*?://[^/?#]*([^?#]*)")


def address_of(url: Column) -> Column:
    """Host, path and query: what stays the same under another scheme or fragment; null without host."""
    rest = _part(url, "(?s)^.*?://[^/?#]*([^#]*)")
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.when(rest == "", "/").otherwise(rest)))


def link_targets(url: Column, html: Column) -> Column:
    """Absolute urls of the canonical links and immediate or timed refreshes of a page."""
    page = F.coalesce(html, F.lit(""))
    tags = F.regexp_extract_all(page, F.lit("(?is)<(?:link|meta)\\b[^>]*>"), F.lit(0))
    quoted = "\\s*=\\s*[\"']?\\s*([^\"'\\s>]+)"

    def target(tag: Column) -> Column:
        canonical = F.regexp_extract(tag, "(?is)\\bhref" + quoted, 1)
        refresh = F.regexp_extract(tag, "(?is)\\burl\\s*=\\s*[\"']?\\s*([^\"'\\s>]+)", 1)
        return (
            F.when(tag.rlike("(?is)^<link\\b.*\\brel\\s*=\\s*[\"']?canonical\\b"), canonical)
            .when(tag.rlike("(?is)^<meta\\b.*\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b"), refresh)
            .otherwise("")
        )

    def absolute(link: Column) -> Column:
        site = F.concat(F.lit("http://"), host_of(url))
        folder = F.regexp_extract(path_of(url), "(?s)^(.*/)", 1)
        return (
            F.when(link.contains("://"), link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
        )

    found = F.filter(F.transform(tags, target), lambda link: link != "")
    marked = page.rlike("(?i)canonical|http-equiv")  # one cheap pass for pages without such tags
    return F.when(marked, F.transform(found, absolute)).otherwise(F.array().cast("array<string>"))


def apply_rules(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rule`` (host and path; null if none fits) and ``rule_verdict`` to rows with host and path.

    Rules are joined to the distinct hosts by host suffix, so lists may be long; a frequent host is
    one key with one row on the rule side.
    """
    schema = "verdict string, rule_host string, rule_path string"
    listed = rows.sparkSession.createDataFrame(list(rules), schema).distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    hosts = rows.where("host <> ''").select("host").distinct().select("host", F.explode(suffixes).alias("rule_host"))
    fitting = hosts.join(listed, "rule_host").select(
        "host",
        F.struct(
            F.length(F.concat("rule_host", "rule_path")).alias("length"),
            (F.col("verdict") == "allow").alias("allows"),
            F.concat("rule_host", "rule_path").alias("rule"),
            "rule_path",
            "verdict",
        ).alias("fit"),
    )
    by_host = fitting.groupBy("host").agg(F.collect_set("fit").alias("_fits"))
    best = F.array_max(F.filter("_fits", lambda fit: F.col("path").startswith(fit["rule_path"])))
    # A host may hold a third of all rows: each host's rules are repeated for every salt.
    salted = by_host.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    joined = dealt.join(salted, ["host", "_salt"], "left").withColumn("_best", best)
    return joined.select(
        *rows.columns, F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("rule_verdict")
    )


def filter_urls(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    Edges come from the pages' canonical links and refreshes and from ``redirects`` (from_url, to_url).
    """
    links = pages.select("url", F.explode(link_targets(F.col("url"), F.col("html"))).alias("target"))
    if redirects is not None:
        links = links.union(redirects.select("from_url", "to_url"))
    edges = links.select(address_of(F.col("url")).alias("a"), address_of(F.col("target")).alias("b"))
    groups = components(edges)

    place = F.concat(F.lit("http://"), F.col("node"))
    aliases = groups.select("node", "component", host_of(place).alias("host"), path_of(place).alias("path"))
    judged = apply_rules(aliases, rules)
    blocked = judged.groupBy("component").agg(F.max(F.col("rule_verdict").eqNullSafe("block")).alias("blocked"))
    hit = groups.join(blocked.where("blocked"), "component").select(F.col("node").alias("_node"), "blocked")

    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("_node"))
    ruled = apply_rules(parsed, rules).join(hit, "_node", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked"), "block"), F.lit("allow"))
    return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
