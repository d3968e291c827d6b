"""Allow and block rules for urls, with blocks carried along redirects and canonical links."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.llm.components import components
from gustline.sources.shared import write_stage

#: Rules of the registered query: host and path, verdict.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty where there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What spellings of one address share, which sites redirect to each other: no scheme, fragment,
    tracking parameters or last slash, and a host in lower case. What is no url is its own address."""
    query = F.regexp_replace(F.regexp_extract(url, r"://[^/?#]*[^?#]*\?([^#]*)", 1), r"(?:^|&)utm_[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    plain = F.concat(host(url), F.regexp_replace(path(url), "/$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(url.contains("://"), plain).otherwise(url)


def resolved(link: Column, base: Column) -> Column:
    """The link as a url, seen from the page at `base`."""
    scheme = F.regexp_extract(base, r"^([^:/?#]*):", 1)
    site = F.concat(scheme, F.lit("://"), host(base))
    folder = F.coalesce(F.nullif(F.regexp_extract(path(base), r"^(.*/)", 1), F.lit("")), F.lit("/"))
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .otherwise(F.concat(site, folder, link))
    )


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target): urls of pages and where their canonical link or their refresh leads."""
    html = F.col(html_col)
    found = F.concat(F.regexp_extract_all(html, F.lit(CANONICAL), 1), F.regexp_extract_all(html, F.lit(REFRESH), 1))
    # Few pages have such a tag, so one cheap test goes before the patterns.
    likely = F.lower(html).contains("canonical") | F.lower(html).contains("refresh")
    each = pages.where(likely & F.col(url_col).contains("://")).select(F.col(url_col).alias("source"), F.explode(found).alias("link"))
    unescaped = F.replace("link", F.lit("&amp;"), F.lit("&"))
    return each.select("source", resolved(unescaped, F.col("source")).alias("target"))


def rule_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The urls (url, host, path) with the longest rule (rule, verdict) that fits, if any does; of equal ones allow wins.

    Each host is split into itself and its parents, which meet the rules' hosts in an equality
    join; so many rules cost no more than few. A host that a third of the urls share can be split by adaptive execution.
    """
    wanted = rules.select(
        F.col("rule"), F.col("verdict"), F.regexp_extract("rule", "^([^/]*)", 1).alias("parent"), F.regexp_extract("rule", "^[^/]*(.*)$", 1).alias("start")
    )
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    hosts = urls.select("host").distinct().withColumn("parent", F.explode(parents)).join(wanted, "parent")
    fits = urls.join(hosts, "host").where(F.col("path").startswith(F.col("start")))
    best = fits.groupBy("url").agg(
        F.max(F.struct(F.length("rule").alias("size"), (F.col("verdict") == "allow").alias("allow"), "rule", "verdict")).alias("best")
    )
    return urls.join(best, "url", "left").select("url", "host", "path", "best.rule", "best.verdict")


def judge_urls(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, host, path, rule and verdict.

    `rules` has (rule, verdict), `redirects` (source, target) urls from elsewhere, such as a crawl's log. A
    rule's verdict stands where one fits. Other urls are blocked if a rule blocks a url in their connected component over
    redirects, canonical links and spellings of one address, and allowed otherwise. So an explicit
    allow is never overruled by an alias, and does not free its aliases.

    A null url, or one without ://, has an empty host and path and is allowed unless its component is blocked; null urls
    have no aliases. Null html has no links. Repeated rows give repeated results. Starts jobs while it is built.
    """
    url = F.col(url_col).cast("string")
    edges = links(pages.select(url.alias("url"), F.col(html_col).cast("string").alias("html")), "url", "html")
    if redirects is not None:
        edges = edges.union(redirects.select("source", "target"))
    edges = write_stage(edges.distinct(), "url-edges")
    ends = edges.select(F.explode(F.array("source", "target")).alias("url"))
    urls = pages.select(url.alias("url")).where("url is not null").union(ends).distinct()
    urls = urls.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    judged = rule_of(urls, rules).withColumn("node", F.xxhash64(address(F.col("url"))))
    judged = write_stage(judged, "url-rules")
    joined = components(edges.select(F.xxhash64(address(F.col("source"))).alias("a"), F.xxhash64(address(F.col("target"))).alias("b")))
    grouped = judged.join(joined, judged.node == joined.id, "left").withColumn("group", F.coalesce("component", "node"))
    blocked = grouped.where("verdict = 'block'").select("group").distinct().withColumn("bad", F.lit(True))
    verdicts = grouped.join(blocked, "group", "left").select(
        "url", "rule", F.coalesce("verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict")
    )
    own = pages.select(F.col(id_col).alias("page_id"), url.alias("url"))
    return own.join(verdicts, "url", "left").select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )
