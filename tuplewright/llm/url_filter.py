"""URL rules, and block decisions carried over to redirects and canonical links.

A URL is judged by the longest rule that fits it.  A URL that no rule fits
gets the method's verdict: block if a blocked URL is among those it is
equivalent to, else allow.  Equivalence is the connected components of the
redirect and canonical-link edges, computed over edges only.  An explicit allow
has precedence: a URL whose own longest rule allows it stays allowed whatever
its aliases are.

Two URLs are one node if host, path and query agree: scheme and fragment don't
count.  Edges come from ``rel=canonical`` links and refresh redirects in a
page's html, and from an optional table of redirects.

A null url or one without ``://`` has empty host and path, no node, no rule and
the verdict allow.  Null html has no links.  Null ids and repeated rows are
kept; other columns are ignored; no rows give no rows.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick
from .components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The production list.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def _after_scheme(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Host, path and query; null without a host."""
    query = F.regexp_extract(_after_scheme(url), r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (name, action); null if none does."""
    found = F.lit(None).cast("struct<name:string,action:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.trim(F.regexp_replace(value, r"""^["']|["']$""", ""))


def _resolved(href: Column, url: Column) -> Column:
    """An absolute URL for a link found in the page at ``url``; null for an empty link."""
    scheme = F.regexp_extract(url, r"(?s)^([^/?#]*?://)", 1)
    site = F.concat(scheme, host_of(url))
    return (
        F.when(href == "", F.lit(None))
        .when(F.contains(F.regexp_extract(href, r"(?s)^[^/?#]*://", 0), F.lit("://")), href)
        .when(href.startswith("//"), F.concat(F.lit("http:"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .otherwise(F.concat(site, F.regexp_replace(F.concat(F.lit("/"), path_of(url)), r"^//|[^/]*$", ""), href))
    )


def links_in(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """source, target: canonical links and refresh redirects of the pages, as URLs."""
    base = pick(pages, url=url_col, html=html_col).where(F.col("html").rlike("(?i)canonical|http-equiv"))
    href = _attribute(F.regexp_extract("html", r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""", 0), "href")
    refresh = _attribute(F.regexp_extract("html", r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""", 0), "content")
    to = F.regexp_replace(F.regexp_extract(refresh, r"""(?is)\burl\s*=\s*["']?([^"'\s]+)""", 1), "&amp;", "&")
    both = F.array(F.regexp_replace(href, "&amp;", "&"), to)
    return base.select(F.col("url").alias("source"), F.explode(both).alias("href")).select("source", _resolved(F.col("href"), F.col("source")).alias("target")).where("target is not null")


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, host, path, rule, verdict.  ``redirects``: source, target URLs."""
    edges = links_in(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    nodes = components(edges.select(node_of(F.col("source")).alias("u"), node_of(F.col("target")).alias("v")))
    named = nodes.withColumn("rule", rule_of(F.regexp_extract("node", r"(?s)^([^/?]*)", 1), F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1), rules))
    blocked = named.groupBy("component").agg(F.bool_or(F.coalesce(F.col("rule.action") == "block", F.lit(False))).alias("bad")).where("bad").select("component")
    tainted = nodes.join(blocked, "component", "left_semi").select(F.col("node").alias("bad_node")).distinct()
    base = pick(pages, id=id_col, url=url_col).select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    base = base.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    return base.join(tainted, base["node"] == tainted["bad_node"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("found.name").alias("rule"),
        F.coalesce("found.action", F.when(F.col("bad_node").isNotNull(), "block"), F.lit("allow")).alias("verdict"),
    )
