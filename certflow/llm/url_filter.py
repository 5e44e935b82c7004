"""URL rules with redirect equivalence: block decisions reach all aliases of a page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certflow.llm.components import connected_components
from certflow.llm.tasks import stored

# (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What a browser takes for no tag; then a tag with an attribute that makes it a canonical link or a redirect, and
# the attribute that holds the address.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
CANONICAL_TAG = r"(?i)<link\s[^>]*rel\s*=\s*[\"']?canonical[\"'\s>/][^>]*>?"
REFRESH_TAG = r"(?i)<meta\s[^>]*http-equiv\s*=\s*[\"']?refresh[\"'\s>/][^>]*>?"
HREF = r"(?i)\shref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?i)url\s*=\s*[\"']?([^\"'\s>]+)"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null without one.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    found = F.lit(None)
    for verdict, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def node_of(url: Column) -> Column:
    """Key of an address as a node: scheme and host lower-cased, no fragment. Null without `://`."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?#]*)", 1)
    return F.when(head != "", F.concat(ascii_lower(head), F.substring(bare, F.length(head) + 1, F.length(bare))))


def resolved(target: Column, base: Column) -> Column:
    """A target address as seen from page `base`: absolute, or relative to scheme, host or folder."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*(/(?:[^?#]*/)?)", 1)
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    return (F.when(target.isNull() | (target == ""), F.lit(None))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, target))
            .when(target.startswith("/"), F.concat(root, target))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target)))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges source, target between addresses: all canonical links and refresh redirects of the pages.

    Tags inside comments, scripts and styles are none.
    """
    page = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).where(F.col("url").contains("://"))
    page = page.withColumn("html", F.regexp_replace("html", HIDDEN, " "))
    found = lambda tag, target: F.transform(
        F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, target, 1))
    targets = F.concat(found(CANONICAL_TAG, HREF), found(REFRESH_TAG, REFRESH_URL))
    edges = page.select("url", F.explode(targets).alias("target")).where("target != ''")
    return (edges.select(node_of(F.col("url")).alias("source"), node_of(resolved(F.col("target"), F.col("url"))).alias("target"))
            .where(F.col("target").isNotNull()))


def filter_urls(
    pages: DataFrame, redirects: DataFrame | None = None, page_id: str = "page_id", url: str = "url",
    html: str | None = "html", *, rules: Sequence[tuple[str, str, str]] = RULES,
) -> DataFrame:
    """Verdict per page: page_id, host, path, rule, verdict, alias_blocked.

    Addresses that redirects or canonical links join, over any number of steps, are aliases.
    Links are read from the pages; `redirects` may add a table of source, target. A page with a
    rule has the rule's verdict, so an explicit allow holds against blocked aliases. A page
    without one is blocked if any address among its aliases, page or not, has a block as its
    rule, else allowed. alias_blocked tells if an alias is blocked.

    Null addresses and such without `://` have empty host and path, no rule and no aliases, so
    they are allowed. Null html has no links. Repeated rows give a row each; extra columns are
    ignored; page_id may be null.
    """
    links = [redirects.select(node_of(F.col("source")).alias("source"), node_of(F.col("target")).alias("target"))] if redirects is not None else []
    if html is not None:
        links.append(alias_edges(pages, url, html))
    page = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    page = page.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    judged = page.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    if not links:
        blocked = None
    else:
        edges = stored((links[0].union(links[1]) if len(links) > 1 else links[0]).distinct(), "aliases")
        parts = stored(connected_components(edges, "source", "target"), "alias-components")
        verdict = rule_for(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
        # stored, so that Spark can split the rows of a large component or of an address of very many pages
        bad = stored(parts.where(verdict == "block").select("component").distinct(), "blocked-components")
        blocked = stored(parts.join(bad, "component").select("node", F.lit(True).alias("alias_blocked")), "blocked")
    if blocked is not None:
        judged = judged.join(blocked, "node", "left")
    else:
        judged = judged.withColumn("alias_blocked", F.lit(False))
    known = F.coalesce("alias_blocked", F.lit(False))
    return judged.select(
        "page_id", "host", "path", F.col("found")["rule"].alias("rule"),
        F.coalesce(F.col("found")["verdict"], F.when(known, "block").otherwise("allow")).alias("verdict"), known.alias("alias_blocked"))
