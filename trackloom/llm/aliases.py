"""URL filters with redirect equivalence, in DataFrame functions only.

A page's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z
lower-cased; its path goes on up to ``?``, ``#`` or the end. A rule (verdict, host, path) fits
its host and all subdomains where the path starts with the rule's. Of the fitting rules the
longest wins (host and path together; then the longer host; then ``allow``).

Addresses that lead to one page are aliases. They are the nodes of a graph:

* an address as servers redirect it by convention: http and https, default ports, a trailing
  slash, ``utm_`` parameters and the fragment make no difference. All forms are one node;
* declared links are edges: ``<link rel="canonical" href>`` and ``<meta http-equiv="refresh"
  content="...url=...">`` of the page's HTML, outside comments and scripts, resolved against
  its url, and the rows of ``redirects`` (from_url, to_url), as a crawl records them.

The connected components of that graph carry block decisions: a page that no rule fits is
blocked where any page of its component is blocked by a rule, and allowed otherwise. An
explicit allow takes precedence: a page that an allow rule fits stays allowed, whatever its
aliases are. (A page can declare any page as canonical, so that an allowed alias frees
nobody.)

Null urls and those without ``://`` have empty host and path, fit no rule and have no aliases.
Null html has no links. Repeated rows are judged each; equal urls alike. Rules without a host
never fit; a null path is empty. Further columns of the inputs are not read.

Nothing is grouped by host: rules meet distinct (host, path) pairs by equality of whole keys,
and the joins' right sides hold one row per key. Those with a row per place, node or component are
never broadcast: their files pack so well that Spark would send millions of rows through the
driver. Rules are, up to ``FEW_RULES``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.tables import components
from trackloom.session import materialize

# The letters that host names ignore the case of.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINKS = "array<string>"
# Rules that every task may hold.
FEW_RULES = 1 << 16


def _after_scheme(url: Column) -> Column:
    """What follows ``://``; null without it."""
    at = F.position(F.lit("://"), url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.split(_after_scheme(url), "[/?#]", 2)[0], F.lit("")), UPPER, LOWER)


def _after_host(url: Column) -> Column:
    return F.regexp_replace(_after_scheme(url), "^[^/?#]+", "")


def path_of(url: Column) -> Column:
    return F.coalesce(F.split(_after_host(url), "[?#]", 2)[0], F.lit(""))


def address(url: Column) -> Column:
    """The form that all conventional redirects of ``url`` lead to; null without ``://``."""
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.split(F.split(_after_host(url), "#", 2)[0], "\\?", 2)
    asked = F.filter(F.split(F.coalesce(F.get(query, F.lit(1)), F.lit("")), "&"), lambda p: ~p.startswith("utm_") & (p != ""))
    return F.when(
        _after_scheme(url).isNotNull(),
        F.concat(host, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise("")),
    )


def _without_dots(path: Column) -> Column:
    """``path`` with its ``.`` and ``..`` segments resolved."""
    parts = F.aggregate(
        F.split(path, "/"),
        F.array().cast(LINKS),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.array_join(parts, "/")


def resolved(base: Column, link: Column) -> Column:
    """The absolute url of ``link`` in the page at ``base``; null where ``base`` is none."""
    scheme = F.substring_index(base, "://", 1)
    site = F.concat(scheme, F.lit("://"), F.split(_after_scheme(base), "[/?#]", 2)[0])
    folder = F.regexp_replace(path_of(base), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    tail = F.regexp_extract(link, "[?#].*$", 0)
    path = F.substr(link, F.lit(1), F.length(link) - F.length(tail))
    return (
        F.when(_after_scheme(base).isNull(), F.lit(None))
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, _without_dots(path), tail))
        .when(path == "", F.concat(site, path_of(base), tail))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, path)), tail))
    )


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, or an empty string."""
    found = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return F.trim(F.regexp_replace(F.regexp_replace(found, "^[\"']|[\"']$", ""), "&amp;", "&"))


def declared(html: Column) -> Column:
    """The targets of the canonical links and refreshes of a page, as written."""
    code = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<script\b.*?</script", " ")
    tags = F.regexp_extract_all(code, F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))
    canonical = F.transform(
        F.filter(tags, lambda t: t.rlike("(?i)^<link") & F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical")),
        lambda t: _attribute(t, "href"),
    )
    refresh = F.transform(
        F.filter(tags, lambda t: t.rlike("(?i)^<meta") & (F.lower(_attribute(t, "http-equiv")) == "refresh")),
        lambda t: F.trim(F.regexp_replace(F.regexp_extract(_attribute(t, "content"), r"(?is)[;,]\s*url\s*=\s*(.*)$", 1), "^[\"']|[\"']$", "")),
    )
    return F.filter(F.concat(canonical, refresh), lambda link: link != "")


def _node(url: Column) -> Column:
    return F.unhex(F.md5(address(url).cast("binary")))


def fitting(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, verdict: the rule that decides each distinct (host, path) that one fits."""
    rules = rules.select(
        "verdict", F.translate("host", UPPER, LOWER).alias("_host"), F.coalesce("path", F.lit("")).alias("_path")
    ).where("_host <> ''")
    # A line feed keeps host and path of a key apart.
    key = F.concat_ws("\n", F.col("_host"), F.col("_path"))
    # No more lengths than the longest path of a rule has characters.
    counts = rules.groupBy(F.length("_path")).count().collect()
    lengths, few = [row[0] for row in counts], sum(row[1] for row in counts) <= FEW_RULES
    labels = F.split("host", "\\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    starts = F.array(*[F.substring("path", 1, n) for n in lengths]).cast(LINKS)
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda s: F.concat_ws("\n", h, s))))
    tried = places.where("host <> ''").distinct().select("host", "path", F.explode(F.array_distinct(keys)).alias("_key"))
    rank = F.struct(F.length("_key"), F.length("_host"), (F.col("verdict") == "allow"))
    won = F.max_by(F.struct(F.concat("_host", "_path").alias("rule"), "verdict"), rank)
    return (
        tried.join(rules.withColumn("_key", key).hint("broadcast" if few else "merge"), "_key")
        .groupBy("host", "path")
        .agg(won.alias("_won"))
        .select("host", "path", "_won.*")
    )


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html)."""
    url = F.col("url")
    # Html is read once; what goes on is a few short values per page.
    places = materialize(
        pages.select(
            "page_id",
            host_of(url).alias("host"),
            path_of(url).alias("path"),
            _node(url).alias("node"),
            F.transform(declared(F.col("html")), lambda link: _node(resolved(url, link))).alias("links"),
        ),
        "places",
    )
    edges = places.select(F.col("node").alias("u"), F.explode("links").alias("v"))
    if redirects is not None:
        edges = edges.union(redirects.select(_node(F.col("from_url")), _node(F.col("to_url"))))
    aliases = components(edges.where("u IS NOT NULL AND v IS NOT NULL"), "u", "v", hint="merge")
    decided = materialize(
        places.drop("links")
        .join(fitting(places.select("host", "path"), rules).hint("merge"), ["host", "path"], "left")
        .join(aliases.hint("merge"), "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "decided",
    )
    blocked = decided.where("verdict = 'block'").select("root").distinct().withColumn("tainted", F.lit(True))
    spread = F.when(F.col("tainted"), "block").otherwise("allow")
    return decided.join(blocked.hint("merge"), "root", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", spread).alias("verdict")
    )
