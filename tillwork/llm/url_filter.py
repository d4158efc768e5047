"""URL filters by redirect equivalence.

Pages that redirect to one another or name the same canonical address are one resource: the
connected components over these links. A rule's block spreads from any member to the aliases
that no rule fits; an explicit allow of a member takes precedence over the spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.graph import components
from tillwork.llm.shared import narrow, saved

Rule = tuple[str, str, str]  # host, path prefix, "block" or "allow"

TAG = r"(?is)(<(?:link|meta)\s[^>]*>)"
CANONICAL = r"""(?is)^<link\s(?:.*\s)?rel\s*=\s*["']?canonical["'\s/>]"""
REFRESH = r"""(?is)^<meta\s(?:.*\s)?http-equiv\s*=\s*["']?refresh["'\s/>]"""
HREF = r"""(?is)\shref\s*=\s*["']?([^"'\s>]+)"""
TARGET = r"""(?is)\scontent\s*=\s*["']?[^"'>]*?url\s*=\s*["']?([^"'\s>]+)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or a url without ://."""
    whole = F.coalesce(url, F.lit(""))
    after = F.regexp_extract(whole, r"(?s)^.*?://(.*)$", 1)
    host = _ascii_lower(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule (host and path together) that fits, as text and as its verdict; null if none."""
    text = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def node(url: Column) -> Column:
    """What a link leads to: the url without its fragment, scheme and host lower-cased."""
    host, _ = host_and_path(url)
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    scheme = _ascii_lower(F.regexp_extract(bare, r"(?s)^(.*?)://", 1))
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?]*(.*)$", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host, rest)).otherwise(bare)


def _any_scheme(address: Column) -> Column:
    """An address (node) with https as http: the two are one resource."""
    return F.regexp_replace(address, "^https://", "http://")


def _absolute(target: Column, base: Column) -> Column:
    """An address in a page, also //host/x and /x; other relative forms follow the page's folder."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when(target == "", None)
        .when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*:"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), target))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst) from the canonical link and the meta refresh of every page; each page is read once."""
    pages = narrow(pages, "url", "html")

    def target(tag: Column) -> Column:
        return F.when(tag.rlike(CANONICAL), F.regexp_extract(tag, HREF, 1)).when(tag.rlike(REFRESH), F.regexp_extract(tag, TARGET, 1))

    tags = F.regexp_extract_all("html", F.lit(TAG), 1)
    found = pages.filter("url IS NOT NULL AND html IS NOT NULL").select(
        "url", F.explode(F.array_distinct(F.transform(tags, target))).alias("target")
    )
    linked = found.filter("target <> ''").select(node(F.col("url")).alias("src"), node(_absolute(F.col("target"), F.col("url"))).alias("dst"))
    return linked.filter("src <> dst")


def judge_urls(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """Every page with host, path, rule and verdict, and its resource (the component's smallest address).

    Addresses that differ in http and https only are one where links meet them; a page that no link
    touches is its own resource, scheme and all.
    pages: page_id, url, html; more columns are not carried. redirects (src, dst urls) adds
    redirects known from a crawl. A rule of the page's own url decides; else allow if some address
    of the resource is explicitly allowed, else block if some is blocked, else allow. Repeated
    pages are judged each; a null url, or one without ://, has an empty host and is allowed;
    a null html has no links. An empty table gives an empty result.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select(node(F.col("src")), node(F.col("dst"))))
    links = saved(links.filter("src <> dst"), "links")
    ends = links.select(F.explode(F.array("src", "dst")).alias("address")).distinct()
    # links within one address but for the scheme have no component of two
    member = components(links.select(_any_scheme(F.col("src")).alias("src"), _any_scheme(F.col("dst")).alias("dst")))
    placed = ends.withColumn("id", _any_scheme(F.col("address"))).join(member, "id", "left")
    member = saved(placed.select("address", "id", F.coalesce("component", "id").alias("component")), "resources")
    _, decided = fitting_rule(*host_and_path(F.col("id")), rules)
    spread = member.withColumn("decided", decided).groupBy("component").agg(
        F.min("address").alias("resource"),
        F.max(F.col("decided") == "allow").alias("allowed"), F.max(F.col("decided") == "block").alias("blocked"),
    )
    resource = member.select("id", "component").distinct().join(spread, "component").select(
        F.col("id").alias("alias"),
        "resource",
        F.when(F.coalesce("allowed", F.lit(False)), "allow").when(F.coalesce("blocked", F.lit(False)), "block").alias("shared"),
    )
    page_host, page_path = host_and_path(F.col("url"))
    rule, decided = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = narrow(pages, "page_id", "url").select("page_id", "url", page_host.alias("host"), page_path.alias("path"))
    judged = judged.select("*", node(F.col("url")).alias("node"), rule.alias("rule"), decided.alias("decided"))
    joined = judged.withColumn("alias", _any_scheme(F.col("node"))).join(resource, "alias", "left")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("decided", "shared", F.lit("allow")).alias("verdict"),
        F.coalesce("resource", "node").alias("resource"),
    )
