"""URL filters: host and path rules, and block decisions that spread over redirects and canonical links.

A rule names a host and the start of a path; it fits the host and its subdomains,
and the longest rule that fits decides. URLs that redirect to each other or name
each other as canonical are aliases. The classes of aliases are the connected
components of these links; where one member of a class is blocked by a rule, every
member without a rule of its own is blocked. An explicit allow rule takes
precedence over what comes from aliases. Tags in comments and scripts state no link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.components import connected_components
from stationflow.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'>\s]+)"
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"
TARGET = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'>\s]+)"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return F.translate(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def _suffixes(host: Column) -> Column:
    """The host and every host that it is a subdomain of, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def fitting_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, decision) of distinct (host, path) pairs that a rule fits.

    Each pair looks its own host suffixes and path starts up in the rules, so
    the work does not grow with the number of rules; only path lengths that
    rules have are tried.
    """
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "decision").distinct()
    lengths = F.broadcast(rules.agg(F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths")))  # one row, no longer than a URL
    pairs = urls.select("host", "path").distinct().join(lengths)
    starts = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    looked = pairs.select("host", "path", F.explode(_suffixes(F.col("host"))).alias("rule_host"), starts.alias("starts")).select("host", "path", "rule_host", F.explode("starts").alias("rule_path"))
    fits = looked.join(rules, ["rule_host", "rule_path"]).withColumn("rule", F.concat("rule_host", "rule_path"))
    # Of equal rules with both decisions the allow counts.
    order = F.struct(F.length("rule"), F.length("rule_host"), (F.col("decision") == "allow").cast("int"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "decision"), order).alias("best"))
    return best.select("host", "path", "best.rule", "best.decision")


def resolve(base: Column, link: Column) -> Column:
    """An absolute URL of a link on page `base`: absolute, scheme-relative, rooted and relative links."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    root = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link))
    )


def _without_dots(path: Column) -> Column:
    """A path whose `.` and `..` segments are taken out."""
    none = F.array().cast("array<string>")
    kept = F.aggregate(F.split(path, "/"), none, lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(s))))
    return F.when(path.rlike(r"/\.\.?(/|\z)"), F.array_join(kept, "/")).otherwise(path)


def address(url: Column) -> Column:
    """What two spellings of one address share: no scheme, host in lower case without the scheme's own port, no dot segments, no fragment, no trailing slash."""
    url = F.coalesce(url, F.lit(""))
    scheme, host = F.lower(F.regexp_extract(url, r"^([^:/?#]*)://", 1)), host_of(url)
    named = F.when(scheme == "http", F.regexp_replace(host, r":(80)?\z", "")).when(scheme == "https", F.regexp_replace(host, r":(443)?\z", "")).otherwise(host)
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)?", 1)
    return F.concat(named, F.regexp_replace(_without_dots(path_of(url)), r"/+\z", ""), query)


def alias_links(pages: DataFrame) -> DataFrame:
    """(url, target): canonical links and immediate redirects that pages (url, html) state."""
    read = pages.filter("url is not null and html is not null").select("url", F.regexp_replace("html", UNREAD, " ").alias("html"))
    tags = F.array(F.regexp_extract(F.regexp_extract("html", CANONICAL, 0), HREF, 1), F.regexp_extract(F.regexp_extract("html", REFRESH, 0), TARGET, 1))
    stated = read.select("url", F.explode(tags).alias("link")).filter("link <> ''")
    link = F.regexp_replace("link", "(?i)&(amp|#38|#x26);", "&")
    return stated.select("url", resolve(F.col("url"), link).alias("target"))


def judge_urls(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """`pages` (page_id, url) judged: page_id, host, path, rule, verdict, via.

    `links` (url, target) are the redirects and canonical links; without them
    those stated in `pages.html` serve. `via` says what decided: rule, alias or
    default. A page without a rule is blocked where an alias is blocked by a rule
    of its own, else allowed. Null or malformed URLs have an empty host and path, fit no rule,
    have no alias and are allowed. Repeated rows come back each; other columns
    are ignored; no rules or no links are allowed.
    """
    links = alias_links(pages) if links is None else links
    urls = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    links = links.filter("url is not null and target is not null")
    ends = lambda u: F.struct(host_of(u).alias("host"), path_of(u).alias("path"), address(u).alias("address"))
    both = links.select(ends(F.col("url")).alias("x"), ends(F.col("target")).alias("y")).filter("x.host <> '' and y.host <> '' and x.address <> y.address")
    both = materialise(both.distinct(), "links")
    ruled = materialise(fitting_rule(urls.select("host", "path").union(both.select("y.host", "y.path")), rules), "ruled")
    # A table as long as the pages is short as a compressed file, which must not make it a broadcast: these joins sort both sides.
    by_place = ruled.hint("merge")
    classes = connected_components(both.select(F.xxhash64("x.address").alias("a"), F.xxhash64("y.address").alias("b")))
    known = both.select("x.*").union(both.select("y.*")).union(urls.select("host", "path", address(F.col("url")).alias("address")).filter("host <> ''"))
    blocked = known.withColumn("node", F.xxhash64("address")).join(classes, "node").join(by_place, ["host", "path"]).filter("decision = 'block'").select("component").distinct()
    spread = classes.join(blocked, "component").select("node")
    judged = urls.join(by_place, ["host", "path"], "left").withColumn("node", F.when(F.col("host") != "", F.xxhash64(address(F.col("url")))))
    judged = judged.join(spread.withColumn("alias", F.lit(True)).hint("merge"), "node", "left")
    verdict = F.coalesce("decision", F.when(F.col("alias"), "block"), F.lit("allow"))
    via = F.when(F.col("decision").isNotNull(), "rule").when(F.col("alias"), "alias").otherwise("default")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), via.alias("via"))
