"""URL filters with redirect equivalence.

Rules (host, path, action) fit a host and its subdomains where the url's path
starts with the rule's; the longest rule wins.  URLs that lead to each other
are aliases: edges run along canonical links and meta refreshes in the pages,
a table of known redirects, and the redirects by which servers unify spellings
(https for http, no ``m.`` or ``www.``, no fragment, no tracking parameters, no
closing slash).  Connected components of that graph carry decisions to pages
without a rule: an explicit allow anywhere in the component is worth more than
any block, a block more than nothing, and without either a page is allowed.

Nodes are 128-bit digests of urls; pages' html is read once, in the JVM, and
never shuffles.  Only pages without a rule in components with a decision are
joined.  The rules are a given list, applied as one CASE expression (meant for
up to a few hundred; it does not grow with the data).

Edge cases: a null url or one without "://" has an empty host and path, no rule
and no edges, and is allowed; repeated pages are judged alike; edges with a
null end are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelab.llm.common import written
from notelab.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    action: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(action: str, text: str) -> UrlRule:
    """``net/`` or ``example.net/en/``: host, then path from the first slash."""
    host, _, path = text.partition("/")
    return UrlRule(host, "/" + path, action)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _fits(r: UrlRule, host: Column, path: Column) -> Column:
    return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)


def longest_rule(rules: list[UrlRule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and action of the longest rule that fits; of rules of the same
    length, allow goes first."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.action == "allow", r.name)):  # the last wins
        fits = _fits(r, host, path)
        name, action = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.action)).otherwise(action)
    return name, action


def spelled(url: Column) -> Column:
    """Where a server would send this spelling of a url."""
    host = F.regexp_replace(host_of(url), r"^(?:m|www)\.|:(?:80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"^[^#?]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(f"^(?:{TRACKING})(?:=|$)")), "&")
    return F.concat(F.lit("https://"), host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def node(url: Column) -> Column:
    return F.unhex(F.md5(url))


def without_dots(target: Column) -> Column:
    """A path (and query) from the root with its ``.`` and ``..`` resolved."""
    path, rest = F.regexp_extract(target, r"^[^?#]*", 0), F.regexp_extract(target, r"^[^?#]*(.*)", 1)
    parts = F.split(F.regexp_replace(path, r"/(\.\.?)$", "/$1/"), "/")
    kept = F.aggregate(F.slice(parts, 2, 1 << 20), F.array().cast("array<string>"), lambda own, x: (
        F.when(x == "..", F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(0)))).when(x == ".", own)
        .otherwise(F.concat(own, F.array(x)))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), rest)


def _targets(url: Column, html: Column) -> Column:
    """Absolute canonical and refresh targets of a page; relative ones are
    resolved against its url."""
    def attribute(tag: Column, name: str) -> Column:
        return F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*["']?([^"'\s>]+)""", 1)

    links = F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0))
    metas = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))
    found = F.concat(
        F.when(F.contains(F.lower(html), F.lit("canonical")), F.transform(links, lambda t: attribute(t, "href")))
        .otherwise(F.array().cast("array<string>")),
        F.when(F.contains(F.lower(html), F.lit("refresh")), F.transform(metas, lambda t: attribute(t, "url")))
        .otherwise(F.array().cast("array<string>")))
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    site, path = F.concat(scheme, F.lit("://"), host_of(url)), path_of(url)
    page = F.when(path == "", F.lit("/")).otherwise(path)
    folder = F.regexp_replace(page, r"[^/]*$", "")
    query = F.regexp_extract(url, r"^[^#?]*(\?[^#]*)", 1)

    def absolute(x: Column) -> Column:
        return (F.when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), x).when(x.startswith("//"), F.concat(scheme, F.lit(":"), x))
                .when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))  # mailto: and the like
                .when(x.startswith("/"), F.concat(site, without_dots(x)))
                .when(x.startswith("?"), F.concat(site, page, x))
                .when(x.startswith("#"), F.concat(site, page, query, x))
                .when(x != "", F.concat(site, without_dots(F.concat(folder, x)))))

    return F.filter(F.transform(found, absolute), lambda x: x.isNotNull())


def judge(pages: DataFrame, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url",
          html_col: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the decision's ``via``
    (rule, alias or default).  redirects: columns source, target."""
    url = F.col("url")
    columns = [F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")]
    linked = url.isNotNull() & F.contains(url, F.lit("://"))
    named = pages.select(*columns)
    name, action = longest_rule(rules, host_of(url), path_of(url))
    named = named.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), name.alias("rule"),
                         action.alias("action"), F.when(linked, node(url)).alias("node"))

    # edges as (url, target); a target is a node with a decision of its own
    edges = pages.select(*columns).filter(linked).select(url.alias("source"), spelled(url).alias("target"))
    if html_col is not None:
        html = F.coalesce(F.col("html"), F.lit(""))
        edges = edges.unionByName(
            pages.select(*columns, F.col(html_col).cast("string").alias("html")).filter(linked)
            .select(url.alias("source"), F.explode(_targets(url, html)).alias("target")))
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    edges = edges.filter(F.col("source").isNotNull() & F.col("target").isNotNull() & (F.col("source") != F.col("target")))
    target = F.col("target")
    _, target_action = longest_rule(rules, host_of(target), path_of(target))
    edges = written(edges.select(node(F.col("source")).alias("source"), node(target).alias("target"), target_action.alias("action")),
                    "url-edges")
    found = connected_components(edges.select("source", "target"))

    decided = (named.select("node", "action").unionByName(edges.select(F.col("target").alias("node"), "action"))
               .filter(F.col("action").isNotNull() & F.col("node").isNotNull()).distinct())
    component = F.coalesce("component", "node")
    verdicts = written(
        decided.join(found, "node", "left").groupBy(component.alias("component"))
        .agg(F.when(F.bool_or(F.col("action") == "allow"), "allow").otherwise("block").alias("alias_action")), "url-verdicts")
    open_ = named.filter(F.col("rule").isNull())
    aliases = (open_.select("node").filter(F.col("node").isNotNull()).distinct().join(found, "node", "left")
               .select("node", component.alias("component")).join(verdicts, "component").select("node", "alias_action"))
    open_ = open_.join(written(aliases, "url-aliases"), "node", "left")
    verdict = F.coalesce("action", "alias_action", F.lit("allow"))
    via = F.when(F.col("rule").isNotNull(), "rule").when(F.col("alias_action").isNotNull(), "alias").otherwise("default")
    ruled = named.filter(F.col("rule").isNotNull()).withColumn("alias_action", F.lit(None).cast("string"))
    return ruled.unionByName(open_).select("page_id", "host", "path", "rule", verdict.alias("verdict"), via.alias("via"))
