"""Block and allow rules for urls, carried over to aliases by redirects and canonical links.

A rule is a host and the beginning of a path (``example.com/en/``); it fits its host and all subdomains, and the
longest fitting rule decides. Urls joined by redirects, canonical links or spellings of one address form a
component. A url without a rule takes the decision of its component: allow if any member is allowed by a rule, else
block if any is blocked, else allow. A rule of the url's own always comes first.

Everything is DataFrame operations. Null urls and urls without ``://`` have empty host and path, no rule and no
aliases and are allowed. Rows are never merged: equal urls get equal verdicts. Rules without host or with a null in
any field are ignored, of two rules with one host and path the allowing one counts. Empty tables give empty results.
Columns of the pages other than the three named ones are dropped. A page of any length is read once for its tags, a tag
ends at the next bracket; a link must be marked within its own tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.components import components
from skytally.llm.storage import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\??[^#]*)"
#: Parameters that follow a reader and don't change the page.
_TRACKING = r"(?i)(?<=[?&])(utm_[a-z]+|gclid|fbclid)=[^&]*&?"
# No pattern can be tried again from within what it has passed, so the time grows with the page's length.
_LINK, _META = r"(?i)<link\b[^<>]*+>", r"(?i)<meta\b[^<>]*+>"
_CANONICAL = r"""(?i)\brel\s*+=\s*+["']?+canonical\b"""
_HREF = r"""(?i)\bhref\s*+=\s*+["']?+([^"'>\s]++)"""
_REFRESH = r"""(?i)\bhttp-equiv\s*+=\s*+["']?+refresh\b"""
_URL = r"""(?i)\burl\s*+=\s*+["']?+([^"'>\s]++)"""


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z in lower case."""
    return F.translate(_part(url, 2), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return _part(url, 3)


def spelling(url: Column) -> Column:
    """The address that http, https, fragments, tracking parameters and upper case in hosts don't change."""
    query = F.regexp_replace(F.regexp_replace(_part(url, 4), _TRACKING, ""), "[?&]$", "")
    scheme = F.regexp_replace(F.translate(_part(url, 1), _UPPER, _LOWER), "^https?$", "https")
    return F.concat(scheme, F.lit("://"), host(url), path(url), query)


def _absolute(link: Column, url: Column) -> Column:
    """A link found on a page, as a full url."""
    site = F.concat(_part(url, 1), F.lit("://"), _part(url, 2))
    return (
        F.when(link == "", None)
        .when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(_part(url, 1), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .otherwise(F.concat(site, F.regexp_replace(path(url), "[^/]*$", ""), link))
    )


def links(pages: DataFrame) -> DataFrame:
    """Edges (a, b) from each page to its canonical address and the page it forwards to."""
    url, html = F.col("url"), F.col("html")

    def found(tag: str, mark: str, link: str) -> Column:
        marked = F.filter(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda t: t.rlike(mark))
        return F.transform(marked, lambda t: F.regexp_extract(t, link, 1))

    every = F.concat(found(_LINK, _CANONICAL, _HREF), found(_META, _REFRESH, _URL))
    rows = pages.filter(url.contains("://") & html.isNotNull()).select("url", F.explode(every).alias("link"))
    return rows.select(F.col("url").alias("a"), _absolute(F.col("link"), F.col("url")).alias("b")).dropna()


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``url`` with host, path and the longest fitting rule (rule, action; else null).

    Each url meets the rules of its host and of every parent domain in an equi-join, so the work doesn't grow
    with the number of rules.
    """
    known = rules.select("host", "path", "action").dropna().filter("host <> ''")
    known = known.groupBy("host", "path").agg(F.min("action").alias("action"))  # allow before block
    known = known.select(F.col("host").alias("parent"), F.col("path").alias("prefix"), "action")
    split = urls.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = (
        split.select("url", "host", "path", F.explode(parents).alias("parent"))
        .join(known, "parent", "left")
        .withColumn("fits", F.col("path").startswith(F.col("prefix")))
    )
    rule = F.when(
        F.col("fits"),
        F.struct(
            F.length(F.concat("parent", "prefix")).alias("size"),
            F.concat("parent", "prefix").alias("rule"),
            "action",
        ),
    )
    best = fitting.groupBy("url").agg(
        F.first("host").alias("host"), F.first("path").alias("path"), F.max(rule).alias("best")
    )
    return best.select("url", "host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Pages (page_id, url, html) to page_id, url, host, path, rule, action, component, verdict.

    ``rules`` has host, path and action (allow or block); ``redirects``, if given, has url and target.
    """
    edges = links(pages)
    if redirects is not None:
        edges = edges.union(redirects.select("url", "target").dropna())
    ends = edges.select(F.col("a").alias("url")).union(edges.select("b"))
    urls = pages.select("url").filter(F.col("url").contains("://")).union(ends).distinct()
    decided = stored(judged(urls, rules), "judged-urls")
    spellings = decided.select(F.col("url").alias("a"), spelling(F.col("url")).alias("b"))
    joined = components(edges.union(spellings))
    members = decided.join(joined.withColumnRenamed("node", "url"), "url")
    decisions = stored(
        members.groupBy("component").agg(
            F.max((F.col("action") == "allow").cast("int")).alias("allowed"),
            F.max((F.col("action") == "block").cast("int")).alias("blocked"),
        ),
        "component-decisions",
    )
    verdict = (
        F.when(F.col("action").isNotNull(), F.col("action"))
        .when(F.col("allowed") == 1, "allow")
        .when(F.col("blocked") == 1, "block")
        .otherwise("allow")
    )
    final = members.join(decisions, "component").select(
        "url", "host", "path", "rule", "action", "component", verdict.alias("verdict")
    )
    empty = F.lit("")
    return pages.select("page_id", "url").join(final, "url", "left").select(
        "page_id",
        "url",
        F.coalesce("host", empty).alias("host"),
        F.coalesce("path", empty).alias("path"),
        "rule",
        "action",
        "component",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
