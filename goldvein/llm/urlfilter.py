"""URL rules with redirect equivalence.

A URL's own rule decides: of the rules whose host is the URL's or a parent domain and
whose path starts the URL's path, the longest.  URLs that redirect to each other or
name a canonical URL are aliases, so without a rule of its own a URL is blocked if an
alias is blocked by a rule.  A URL that a rule allows stays allowed whatever its
aliases are.  Anything else is allowed.

Aliases are connected components of the link table, found with the alternating star
joins of `graph`; neither links nor components leave the executors.  Scheme and
fragment do not count in a link.

Edge cases: a null URL, or one without "://", has an empty host and path and no rule.
Null html has no links.  Rows are judged one by one, so repeated rows are judged alike.
Of rules with the same host and path, allow wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldvein.llm.graph import components

Rule = tuple[str, str, str]  # verdict, host, path
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first "://", empty if there is none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def node(url: Column) -> Column:
    """Host, path and query: what two spellings of one address share."""
    return F.concat(host(url), F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1))


def parse_rule(verdict: str, text: str) -> Rule:
    """example.com/en/ is host example.com and path /en/."""
    name, slash, rest = text.partition("/")
    return verdict, name.lower(), slash + rest


def own_rule(rules: list[Rule], name: Column, where: Column) -> Column:
    """The longest fitting rule as (length, allow, rule, verdict), or null; rules are configuration."""
    fits = [
        F.when(
            ((name == h) | name.endswith("." + h)) & where.startswith(p),
            F.struct(
                F.lit(len(h) + len(p)).alias("length"),
                F.lit(v == "allow").alias("allow"),
                F.lit(h + p).alias("rule"),
                F.lit(v).alias("verdict"),
            ),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,allow:boolean,rule:string,verdict:string>")


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): links from pages to their canonical URL and the target of a refresh."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    named = F.filter(tags, lambda t: t.rlike(r"(?is)rel=[\"']?canonical\b|http-equiv=[\"']?refresh\b"))
    found = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("u"), F.explode(named).alias("tag"))
    target = F.regexp_extract("tag", r"(?is)(?:href=[\"']?|url=[\"']?)([^\"'>\s]+)", 1)
    site = F.concat(F.lit("x://"), F.regexp_extract(_rest(F.col("u")), r"^[^/?#]*", 0))
    folder = F.regexp_extract(_rest(F.col("u")), r"^[^?#]*/", 0)
    full = (
        F.when(F.instr(target, "://") > 0, target)
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(folder != "", F.concat(F.lit("x://"), folder, target))
        .otherwise(F.concat(site, F.lit("/"), target))
    )
    return found.where(target != "").select(node(F.col("u")).alias("a"), node(full).alias("b"))


def judge(
    pages: DataFrame,
    rules: list[Rule],
    redirects: DataFrame | None = None,
    id: str = "page_id",
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """(id, host, path, rule, verdict) for each page.

    redirects: more links, as (from_url, to_url).
    """
    links = page_links(pages, url, html) if html else None
    if redirects is not None:
        more = redirects.where("from_url is not null and to_url is not null")
        more = more.select(node(F.col("from_url")).alias("a"), node(F.col("to_url")).alias("b"))
        links = more if links is None else links.unionByName(more)
    seen = pages.select(F.col(id), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), node(F.col(url)).alias("node"))
    seen = seen.withColumn("own", own_rule(rules, F.col("host"), F.col("path")))
    if links is None:
        blocked = None
    else:
        alias = components(links)
        address = F.concat(F.lit("x://"), F.col("node"))
        judged = alias.withColumn("own", own_rule(rules, host(address), path(address)))
        bad = judged.where("own.verdict = 'block'").select("component").distinct()
        blocked = alias.join(bad, "component").select("node", F.lit(True).alias("by_alias")).distinct()
    by_rule = seen.where("own is not null").select(id, "host", "path", "own.rule", "own.verdict")
    rest = seen.where("own is null")
    rest = rest.withColumn("by_alias", F.lit(None).cast("boolean")) if blocked is None else rest.join(blocked, "node", "left")
    rest = rest.select(id, "host", "path", F.lit(None).cast("string").alias("rule"), F.when(F.col("by_alias"), "block").otherwise("allow").alias("verdict"))
    return by_rule.unionByName(rest)
