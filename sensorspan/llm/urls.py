"""URL filters whose decisions reach the aliases of a URL.

A rule names a host and the start of a path; it fits the host and all of its
subdomains, and the longest fitting rule decides. Pages that redirect to each
other or name each other as canonical are one resource: connected components
over these edges carry a block to URLs that no rule fits. A URL's own rule
always wins, and inside a component an explicit allow wins over a block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, lower_ascii, saved
from .components import connected_components

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Tags that name another address of the page; attributes in any order, any quotes.
LINK_TAG = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?\s*canonical\b[^>]*>"
META_TAG = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
REFRESH = r"(?is)\burl\s*=\s*['\"]?\s*([^'\"\s>]+)"
COMMENT = r"(?s)<!--.*?(?:-->|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, name: str) -> Rule:
    """A rule from its verdict and its name, like `net/` or `example.net/en/`."""
    host, slash, path = name.partition("/")
    return Rule(verdict, host, slash + path)


RULES = (
    rule("block", "net/"),
    rule("allow", "example.net/en/"),
    rule("block", "example.com/de/"),
    rule("allow", "org/fr/"),
)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    return spark.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in rules], "rule_host string, rule_path string, rule string, rule_verdict string")


def with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``urls`` (host, path) with the name and verdict of the longest rule that fits.

    A host is looked up under each of its endings, so any number of rules is
    one equi-join. Of rules of equal length an allow wins.
    """
    labels = F.split("host", r"\.")
    endings = let(
        labels,
        lambda parts: F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")),
    )
    looked = urls.select("host", "path", F.explode(endings).alias("rule_host"))
    fits = looked.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = F.max(F.struct(F.char_length("rule").alias("length"), (F.col("rule_verdict") == "allow").alias("allow"), "rule", "rule_verdict"))
    chosen = fits.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict")
    )
    return urls.join(chosen, ["host", "path"], "left")


def address(url: Column) -> Column:
    """A URL as a node: without fragment, scheme and host lower-cased; null without `://`."""
    parts = r"(?s)^([^:/?#]*)://([^/?#]*)([^#]*)"
    bare = lambda i: F.regexp_extract(url, parts, i)
    rest = F.when(bare(3) == "", "/").otherwise(bare(3))
    return F.when(url.rlike(parts), F.concat(lower_ascii(bare(1)), F.lit("://"), lower_ascii(bare(2)), rest))


def resolved(base: Column, link: Column) -> Column:
    """The address that ``link`` means on the page ``base``; null if it is empty or no web address."""
    scheme = F.regexp_extract(base, r"^([^:/?#]*)://", 1)
    site = F.regexp_extract(base, r"(?s)^([^:/?#]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"(?s)^([^?#]*)", 1)
    folder = F.when(path_of(base) == "", F.concat(site, F.lit("/"))).otherwise(F.regexp_extract(page, r"(?s)^(.*/)", 1))
    full = (
        F.when(link.rlike(r"(?i)^https?://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(page, link))
        .when((link == "") | link.startswith("#") | link.rlike(r"(?i)^[a-z][a-z0-9+.\-]*:"), None)
        .otherwise(F.concat(folder, link))
    )
    return let(full, address)


def alias_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between addresses from the redirects and canonical links of ``pages`` (url, html)."""
    # Few pages have such tags; what they say is saved, so that the resolution below starts from plain columns.
    html = F.regexp_replace("html", COMMENT, "")
    tags = saved(
        pages.where(F.col("html").rlike(LINK_TAG) | F.col("html").rlike(META_TAG)).select("url", html.alias("html")).select(
            "url", F.regexp_extract("html", LINK_TAG, 0).alias("link"), F.regexp_extract("html", META_TAG, 0).alias("meta")
        )
    )
    named = F.concat(*(F.regexp_extract("link", HREF, i) for i in (1, 2, 3)))
    sent = F.regexp_extract("meta", REFRESH, 1)
    said = saved(
        tags.select("url", F.explode(F.array(named, sent)).alias("link"))
        .select("url", F.trim(F.regexp_replace("link", "(?i)&amp;", "&")).alias("link"))
        .where("link <> ''")
    )
    ends = said.select(address(F.col("url")).alias("a"), resolved(F.col("url"), F.col("link")).alias("b"))
    return ends.where("a is not null and b is not null and a <> b").distinct()


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, edges: DataFrame | None = None) -> DataFrame:
    """Judge the url of every row of ``pages`` (page_id, url, html).

    Returns page_id, host, path, rule, verdict. The verdict is that of the
    longest fitting rule. Without one it is the component's: allow if a rule
    allows a member, else block if one blocks a member; alone, allow.
    ``edges`` (a, b) of addresses, such as a redirect log, are added to those that
    the pages themselves name. A null url, or one without `://`, has an
    empty host and path, fits no rule, has no aliases and is allowed; null html
    names no alias. Repeated rows are rows of their own. No rows give no rows.
    """
    spark = pages.sparkSession
    own = alias_edges(pages)
    links = saved(own if edges is None else own.unionByName(edges.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b"))))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address(F.col("url")).alias("node")
    )
    ruled = rule_table(spark, rules)
    members = connected_components(links)
    nodes = members.select("node", "root", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    judged = with_rules(nodes.select("host", "path").distinct(), ruled)
    decisions = (
        nodes.join(judged, ["host", "path"])
        .groupBy("root")
        .agg(F.max(F.col("rule_verdict") == "allow").alias("allowed"), F.max(F.col("rule_verdict") == "block").alias("blocked"))
    )
    blocked = members.join(decisions.where("blocked and not coalesce(allowed, false)"), "root").select("node", F.lit(True).alias("alias_blocked"))
    known = with_rules(rows.select("host", "path").distinct(), ruled)
    verdict = F.coalesce("rule_verdict", F.when(F.col("alias_blocked"), "block").otherwise("allow"))
    return (
        rows.join(known, ["host", "path"])
        .join(blocked, "node", "left")
        .select("page_id", "host", "path", "rule", verdict.alias("verdict"))
    )
